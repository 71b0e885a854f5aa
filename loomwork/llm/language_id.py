"""Language ID: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its byte 2-, 3- and 4-grams, hashed to a fixed
number of rows. Embeddings and softmax are trained together by stochastic gradient
descent in NumPy, on a bounded sample. Scores are calibrated by a temperature on sampled
documents that the training has not seen, and the limits beyond which a document is
rejected come from them too: a score too low, or too large a share of byte trigrams that
occur nowhere in training, as of a language or script that was not learned. The second
holds for any number of languages; a score cannot tell what none of them is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import kernels
from loomwork.llm.mapping import filter_texts, map_texts
from loomwork.llm.sampling import held_out, labelled_sample

UNKNOWN = "und"


@dataclass(frozen=True)
class Training:
    #: Documents of each language, at most.
    per_language: int = 1000
    #: Characters of a document in training, from a seeded place.
    chars: int = 2000
    buckets: int = 1 << 16
    dimensions: int = 16
    epochs: int = 4
    batch: int = 32
    rate: float = 8.0
    #: One in so many sampled documents calibrates and is not trained on.
    calibration: int = 5
    #: Rejected at most: this share of the calibration documents that are predicted right …
    reject_share: float = 0.001
    #: … and no document with a score from here on.
    reject_most: float = 0.4
    #: Nor is a document for its new trigrams, if they are less than this share …
    unseen_least: float = 0.5
    #: … of all and so many more, which lets short texts off.
    unseen_spare: int = 8
    #: Fewer calibration documents do not show what share is usual, and set no limit to it.
    unseen_documents: int = 20
    seed: int = 42


@dataclass
class LanguageModel:
    languages: list[str]
    #: For every bucket its embedding times the softmax weights, so a text's logits are a mean.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject: float
    #: One bit for each of the 2^24 byte trigrams: whether the training has it.
    seen: np.ndarray
    unseen_most: float = 1.0
    unseen_spare: int = 0


GRAMS = (2, 3, 4)


def trigrams(raw: np.ndarray) -> np.ndarray:
    """The number of the lower-cased byte trigram that begins at each byte."""
    low = kernels.lower(raw).astype(np.uint32)
    return (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]


def seen_trigrams(texts: list[str]) -> np.ndarray:
    seen = np.zeros(1 << 24, dtype=bool)
    for text in texts:
        seen[trigrams(np.frombuffer(text.encode(), np.uint8))] = True
    return np.packbits(seen, bitorder="little")


def unseen_shares(raw: np.ndarray, offsets: np.ndarray, seen: np.ndarray, spare: int) -> np.ndarray:
    """Of each text's trigrams and ``spare`` more, the share that is not in ``seen``."""
    codes = trigrams(raw)
    new = (seen[codes >> np.uint32(3)] >> (codes & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 0
    reached = np.concatenate([[0], np.cumsum(new), [0, 0]])
    last = np.maximum(offsets[1:] - 2, offsets[:-1])
    some = last > offsets[:-1]
    count = np.where(some, reached[last] - reached[offsets[:-1]], 0)
    return count / np.maximum(last - offsets[:-1] + spare, 1)


def grams(raw: np.ndarray, buckets: int) -> list[np.ndarray]:
    """The bucket of the n-gram that begins at each byte, for each n."""
    low = kernels.lower(raw).astype(np.uint32)
    out, code = [], low
    shift = 32 - (buckets.bit_length() - 1)
    for n in range(2, max(GRAMS) + 1):
        code = (code[:-1] << np.uint32(8)) | low[n - 1 :] if len(code) else code
        if n in GRAMS:
            out.append(((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(shift))
    return out


def logits(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The mean of the table's rows over each text's n-grams, plus bias."""
    n = len(offsets) - 1
    total, count = np.zeros((n, table.shape[1])), np.zeros(n)
    for size, ids in zip(GRAMS, grams(raw, len(table))):
        last = np.maximum(offsets[1:] - size + 1, offsets[:-1])
        full = np.flatnonzero(last > offsets[:-1])
        if len(full) == 0:
            continue
        # every other sum is of the n-grams that run into the next text
        bounds = np.ravel(np.column_stack([offsets[:-1][full], last[full]]))
        rows = np.concatenate([table[ids], np.zeros((1, table.shape[1]), table.dtype)])
        total[full] += np.add.reduceat(rows, np.minimum(bounds, len(ids)), axis=0, dtype=np.float64)[::2]
        count += last - offsets[:-1]
    return total / np.maximum(count, 1)[:, None] + bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(texts: list[str], rng: np.random.Generator, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every text its buckets with their shares, and the same for a short passage of it."""
    out = []
    for text in texts:
        size = int(np.exp(rng.uniform(np.log(12), np.log(400))))
        start = int(rng.integers(0, max(1, len(text) - size + 1)))
        for part in (text, text[start : start + size]):
            raw = np.frombuffer(part.encode(), np.uint8)
            ids, n = np.unique(np.concatenate(grams(raw, buckets)), return_counts=True)
            out.append((ids.astype(np.int64), n / max(1, n.sum())))
    return out


def train(texts: list[str], labels: list[str], how: Training = Training()) -> LanguageModel | None:
    """None without any text."""
    if not texts:
        return None
    rng = np.random.default_rng(how.seed)
    languages = sorted(set(labels))
    place = {x: i for i, x in enumerate(languages)}
    y = np.array([place[x] for x in labels])
    own = np.arange(len(texts)) % how.calibration == how.calibration - 1
    own = rng.permutation(own) if 0 < own.sum() < len(texts) else own & False
    learnt = np.flatnonzero(~own)
    examples = _examples([texts[i] for i in learnt], rng, how.buckets)
    target = np.repeat(y[learnt], 2)
    embedding = rng.normal(0, 0.1, (how.buckets, how.dimensions))
    weights = rng.normal(0, 0.1, (how.dimensions, len(languages)))
    bias = np.zeros(len(languages))
    steps = how.epochs * -(-len(examples) // how.batch)
    step = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), how.batch):
            batch = order[at : at + how.batch]
            sizes = [len(examples[i][0]) for i in batch]
            ids = np.concatenate([examples[i][0] for i in batch])
            share = np.concatenate([examples[i][1] for i in batch])
            row = np.repeat(np.arange(len(batch)), sizes)
            mean = np.zeros((len(batch), how.dimensions))
            np.add.at(mean, row, embedding[ids] * share[:, None])
            error = softmax(mean @ weights + bias)
            error[np.arange(len(batch)), target[batch]] -= 1
            error /= len(batch)
            rate = how.rate * (1 - step / steps)
            to_mean = error @ weights.T
            weights -= rate / 8 * (mean.T @ error)
            bias -= rate / 8 * error.sum(axis=0)
            np.subtract.at(embedding, ids, rate * 8 * share[:, None] * to_mean[row])
            step += 1
    model = LanguageModel(
        languages,
        (embedding @ weights).astype(np.float32),
        bias,
        temperature=1.0,
        reject=0.0,
        seen=seen_trigrams([texts[i] for i in learnt]),
        unseen_spare=how.unseen_spare,
    )
    held = np.flatnonzero(own) if own.any() else np.arange(len(texts))
    raw, offsets = kernels.text_bytes(pa.array([texts[i] for i in held]))
    values = logits(raw, offsets, model.table, bias)
    right = y[held]

    def loss(t: float) -> float:
        p = softmax(values / t)[np.arange(len(held)), right]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    model.temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    scores = softmax(values / model.temperature)
    found = scores.argmax(axis=1) == right
    good = scores.max(axis=1)[found]
    limit = float(np.quantile(good, how.reject_share)) if len(good) else 0.0
    model.reject = min(limit, how.reject_most)
    shares = unseen_shares(raw, offsets, model.seen, how.unseen_spare)[found]
    usual = 1.0
    if own.any() and len(shares) >= how.unseen_documents:
        usual = float(np.quantile(shares, 1 - how.reject_share))
    model.unseen_most = max(usual, how.unseen_least)
    return model


def prediction_kernel(model: LanguageModel | None):
    """Language, score and whether the document is rejected, for each text."""

    def kernel(texts: pa.Array) -> list:
        n = len(texts)
        raw, offsets = kernels.text_bytes(texts)
        folded = kernels.lower(raw)
        plain = kernels.per_text(((folded >= 97) & (folded <= 122)).astype(np.int64), offsets)
        letters = plain > 0
        for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)):
            letters[i] = any(c.isalpha() for c in texts[i].as_py())
        if model is None:
            return [np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.ones(n, dtype=bool)]
        p = softmax(logits(raw, offsets, model.table, model.bias) / model.temperature)
        score = np.where(letters, p.max(axis=1), 0.0)
        names = np.array(model.languages, dtype=object)[p.argmax(axis=1)]
        strange = unseen_shares(raw, offsets, model.seen, model.unseen_spare) > model.unseen_most
        return [np.where(letters, names, UNKNOWN), score, ~letters | (score < model.reject) | strange]

    return kernel


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every document; whole texts.

    A null text, and one without any letter, is ``und`` with score 0 and rejected, as is
    every text without a model. Other texts get the likeliest language; they are rejected
    if its probability is under the model's limit, or if too many of their trigrams are new.
    """
    fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]
    return map_texts(docs, prediction_kernel(model), fields, slice_bytes=1 << 20)


def fit(docs: DataFrame, how: Training = Training()) -> LanguageModel | None:
    """Learn from the documents that are not held out and have a text and a lang."""
    labels = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = labelled_sample(
        docs, labels.select("doc_id", "lang"), "lang", how.per_language, how.chars, how.seed
    )
    return train(sample["text"].tolist(), sample["label"].tolist(), how)


def language_id(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """Every document with its predicted language.

    ``docs`` has ``doc_id``, ``text`` and ``lang``; other columns are not read, and
    ``lang`` only to learn. Result: doc_id, held_out, lang_pred, score, rejected. Without
    any row to learn from, all are ``und``. Repeated rows are predicted each. An empty
    table gives an empty result.
    """
    model = fit(docs, how)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def drop_rejected(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    Without any row to learn from, every document is rejected.
    """
    kernel = prediction_kernel(fit(docs, how))
    return filter_texts(docs, lambda texts: ~kernel(texts)[2], slice_bytes=1 << 20)
