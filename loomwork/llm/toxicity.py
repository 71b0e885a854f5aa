"""Toxicity by weak supervision.

Many voters look at a document: lexicon voters for words, pattern voters for how words
begin; two more speak against when no voter of their kind fires. A generative label model,
fitted by expectation maximisation on a sample of labelled documents, estimates how often
each voter fires on toxic and on other documents, and how voters hang together within a
class; its posterior labels train a linear classifier over the words and word beginnings,
which scores every document. Labels propose voters and enter the label model as a prior of
half the weight. The sample takes the labels about evenly; its rows are weighted so that
each label has the share it has among all labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import kernels
from loomwork.llm.mapping import map_texts
from loomwork.llm.sampling import held_out, labelled_sample


@dataclass(frozen=True)
class Supervision:
    #: Labelled documents of each label, at most.
    per_label: int = 2500
    #: Characters of a labelled document, from a seeded place.
    chars: int = 20_000
    #: Documents with label 1 in which a word or beginning must occur to be proposed.
    support: int = 3
    #: A word or beginning is told apart from chance if its log odds reach this, and if of all
    #: words of the sample about so many would come as far without any bearing on the label.
    odds: float = 1.5
    by_chance: float = 1.0
    lexicon_voters: int = 48
    pattern_voters: int = 48
    #: Words and beginnings that the classifier sees.
    features: int = 4096
    rounds: int = 60
    threshold: float = 0.3
    seed: int = 42


@dataclass
class ToxicityModel:
    #: Ascending hashes of the features and their weights.
    hashes: np.ndarray
    weights: np.ndarray
    bias: float


#: Bytes of the beginnings of words that pattern voters look at.
BEGINNINGS = (4, 5, 6)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def tokens(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and text numbers: of all words first, then of the beginnings of each size.

    A word is a run of letters (any byte from 128 on counts as one), A-Z in lower case. A
    beginning is hashed for words that are longer.
    """
    low, n = kernels.lower(raw), len(raw)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = _LETTER[raw]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    ends = inside[:n] & ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    begins[heads] = inside[heads]
    ends[tails] = inside[tails]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    prefix = kernels.sums_of(low)
    out = [(kernels.spans(low, starts, stops, prefix), text)]
    for size in BEGINNINGS:
        long = stops - starts > size
        hashes = kernels.spans(low, starts[long], starts[long] + size, prefix)
        out.append((kernels.mix(hashes + np.uint64(size)), text[long]))
    return out


def _indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of text and token: text, hash, and whether it is a beginning."""
    parts = []
    for start, end in kernels.row_slices(texts, 1 << 20):
        raw, offsets = kernels.text_bytes(texts.slice(start, end - start))
        for i, (hashes, text) in enumerate(tokens(raw, offsets)):
            order = np.lexsort((hashes, text))
            h, t = hashes[order], text[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
            parts.append(((t[new] + start).astype(np.int32), h[new], np.full(int(new.sum()), i > 0)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def first_of_copies(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts that are no near copies of an earlier one.

    A text is a copy if a quarter of its 16 smallest hashes of five words in a row have
    occurred before; the chance words of a copied text would else look telling.
    """
    # the lighter hash, as all sampled texts are here at once
    w = kernels.words(kernels.lower(raw), offsets, kernels.spans)
    windows = kernels.runs(w.hashes, 5)
    seen: set[int] = set()
    out = []
    for i in range(len(offsets) - 1):
        least = np.unique(windows[w.first[i] : max(w.first[i], w.first[i + 1] - 4)])[:16].tolist()
        least = least or [hash((int(h), "short")) for h in w.hashes[w.first[i] : w.first[i + 1]]]
        if least and 4 * sum(h in seen for h in least) >= len(least):
            continue
        seen.update(least)
        out.append(i)
    return np.array(out, dtype=np.int64)


def label_model(
    votes: np.ndarray, polarity: np.ndarray, y: np.ndarray, rounds: int = 60, mass: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row of ``votes``, the voters' firing rates and weights.

    ``votes`` is 1 where a voter fires and 0 where it abstains; an abstention says nothing.
    Voters of ``polarity`` 1 speak for class 1, of 0 against it. Rates given the latent
    class are fitted by expectation maximisation. The labels ``y`` enter as a prior of
    half the weight, which says which class is which. Voters that hang together within the
    classes would count the same evidence several times; every few rounds their
    correlations given the class are estimated, and a voter's weight becomes one over the
    sum of its positive correlations. ``mass`` is how many documents each row stands for, on
    average one; by default one each.
    """
    n, m = votes.shape
    y = y.astype(float)
    mass = np.ones(n) if mass is None else mass
    post, weight, rates = y.copy(), np.ones(m), np.full((2, m), 0.5)
    for step in range(rounds):
        for c in (0, 1):
            p = mass * ((post + y) / 2 if c else 1 - (post + y) / 2)
            rates[c] = (p @ votes + 0.05) / (p.sum() + 1.0)
        share = np.clip((mass * (post + y)).mean() / 2, 0.001, 0.999)
        if step % 10 == 0:
            within = np.zeros((m, m))
            for p, rate in ((mass * (1 - post), rates[0]), (mass * post, rates[1])):
                off = votes - rate
                cov = (off * p[:, None]).T @ off / max(p.sum(), 1e-9)
                scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
                within += (cov / np.outer(scale, scale)) * p.sum() / n
            within = np.where(within > 0.2, within, 0.0)
            np.fill_diagonal(within, 1.0)
            weight = 1.0 / within.sum(axis=1)
        evidence = np.log(rates[1] / rates[0])
        evidence = np.where(polarity == 1, np.maximum(evidence, 0), np.minimum(evidence, 0))
        score = np.log(share / (1 - share)) + votes @ (evidence * weight)
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-6:
            break
    return post, rates, weight


def _logistic(
    rows: np.ndarray, cols: np.ndarray, n: int, m: int, soft: np.ndarray, mass: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights of a logistic regression on 0/1 features, with soft labels, by gradient descent."""
    share = float((mass * soft).mean())
    weights, bias = np.zeros(m), float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    speed, bias_speed = np.full(m, 1e-6), 1e-6
    for _ in range(800):
        z = bias + np.bincount(rows, weights[cols], minlength=n)
        error = mass * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - soft) / n
        gradient = np.bincount(cols, error[rows], minlength=m) + 1e-5 * weights
        speed += gradient**2
        bias_speed += error.sum() ** 2
        weights -= 0.5 * gradient / np.sqrt(speed)
        bias -= 0.1 * error.sum() / np.sqrt(bias_speed)
    return weights, bias


def row_mass(y: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """How many documents each row stands for, one on average, so that each label has its share of ``totals``."""
    n = np.bincount(y, minlength=2)
    share = np.array([totals.get(c, 0) if n[c] else 0 for c in (0, 1)], dtype=float)
    share /= share.sum()
    return (share * len(y) / np.maximum(n, 1))[y]


def train(
    texts: list[str], labels: list[int], how: Supervision = Supervision(), totals: dict[int, int] | None = None
) -> ToxicityModel | None:
    """None without any text. ``totals``: all labelled documents of each label, by default the sample's."""
    if not texts:
        return None
    own = first_of_copies(*kernels.text_bytes(pa.array(texts)))
    texts, y = [texts[i] for i in own], np.array(labels, dtype=np.int64)[own]
    mass = row_mass(y, totals or dict(enumerate(np.bincount(labels, minlength=2).tolist())))
    rows, hashes, beginning = _indicators(pa.array(texts))
    known, cols = np.unique(hashes, return_inverse=True)
    begins = np.zeros(len(known), dtype=bool)
    begins[cols] = beginning
    positive = np.bincount(cols, y[rows], minlength=len(known))
    every = np.bincount(cols, minlength=len(known))
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    odds = np.log((positive + 0.5) / (n1 + 1)) - np.log((every - positive + 0.5) / (n0 + 1))
    # Chernoff's bound on the chance that a token's documents are as lopsided without a reason
    base, q = n1 / (n1 + n0), np.clip(positive / every, 1e-9, 1 - 1e-9)
    surprise = every * (q * np.log(q / base) + (1 - q) * np.log((1 - q) / (1 - base)))
    told = (surprise >= np.log(len(known) / how.by_chance)) & (np.abs(odds) >= how.odds)
    proposed = told & (odds > 0) & (positive >= how.support)
    if not proposed.any():
        share = float(np.clip((mass * y).mean(), 0.001, 0.999))
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    # each voter has tokens of about the same odds, so that strong ones are not watered down
    voter = np.full(len(known), -1)
    for kind, many, first in ((False, how.lexicon_voters, 0), (True, how.pattern_voters, how.lexicon_voters)):
        own = np.flatnonzero(proposed & (begins == kind))
        own = own[np.lexsort((own, -odds[own]))]
        voter[own] = first + np.arange(len(own)) * many // max(1, len(own))
    votes = np.zeros((len(texts), how.lexicon_voters + how.pattern_voters))
    hit = voter[cols] >= 0
    votes[rows[hit], voter[cols[hit]]] = 1
    # two voters against: no lexicon voter fires, no pattern voter fires
    silent = [~part.any(axis=1) for part in np.split(votes, [how.lexicon_voters], axis=1)]
    polarity = np.concatenate([np.ones(votes.shape[1]), np.zeros(2)])
    votes = np.column_stack([votes, *silent]).astype(float)
    used = votes.any(axis=0)
    post, _, _ = label_model(votes[:, used], polarity[used], y, how.rounds, mass)
    # the classifier sees the tokens that tell either class, the most telling ones if there are many
    chosen = np.flatnonzero(told)
    chosen = np.sort(chosen[np.argsort(-surprise[chosen], kind="stable")[: how.features]])
    place = np.full(len(known), -1)
    place[chosen] = np.arange(len(chosen))
    seen = place[cols] >= 0
    weights, bias = _logistic(rows[seen], place[cols[seen]], len(texts), len(chosen), post, mass)
    return ToxicityModel(known[chosen], weights, bias)


def score_kernel(model: ToxicityModel | None):
    """Scores of texts; the table finds a feature by the low bits of its hash."""
    bits = 20

    def kernel(texts: pa.Array) -> list:
        n = len(texts)
        if model is None:
            return [np.zeros(n)]
        z = np.full(n, model.bias)
        if len(model.hashes):
            raw, offsets = kernels.text_bytes(texts)
            low = np.zeros(1 << bits, dtype=bool)
            mask = np.uint64((1 << bits) - 1)
            low[(model.hashes & mask).astype(np.int64)] = True
            for hashes, text in tokens(raw, offsets):
                maybe = low[(hashes & mask).astype(np.int64)]
                hashes, text = hashes[maybe], text[maybe]
                at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
                found = model.hashes[at] == hashes
                pairs = np.unique(text[found] * len(model.hashes) + at[found])
                z += np.bincount(pairs // len(model.hashes), model.weights[pairs % len(model.hashes)], minlength=n)
        return [1 / (1 + np.exp(-np.clip(z, -30, 30)))]

    return kernel


def fit(docs: DataFrame, labels: DataFrame, how: Supervision = Supervision()) -> ToxicityModel | None:
    """Learn from the labelled documents that are not held out.

    All of them are counted for the labels' shares. Of a text over ``how.chars`` characters
    the sample has one seeded window, under the label of the whole text.

    A null label is none. Where a doc_id has several labels, 1 prevails.
    """
    rows = labels.where(~held_out() & F.col("toxic").isNotNull())
    one_each = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = labelled_sample(docs, one_each, "toxic", how.per_label, how.chars, how.seed)
    known = one_each.join(docs.where(F.col("text").isNotNull()).select("doc_id"), "doc_id", "left_semi")
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    return train(sample["text"].tolist(), sample["label"].tolist(), how, totals)


def toxicity(docs: DataFrame, labels: DataFrame, how: Supervision = Supervision()) -> DataFrame:
    """Every document with its score.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``; other
    columns are not read. Result: doc_id, held_out, score, predicted. A null text counts as
    empty, which scores as a text without any known word. Without any labelled row all
    scores are 0. Repeated rows are scored each. An empty table gives an empty result.
    """
    model = fit(docs, labels, how)
    scored = map_texts(docs, score_kernel(model), [("score", pa.float64())], slice_bytes=1 << 20)
    predicted = (F.col("score") >= how.threshold).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
