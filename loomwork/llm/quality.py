"""Quality rules by compression bands.

Text that repeats itself compresses far better than prose of its length, random text far
worse. The zstandard ratio of the whole document and those of its fixed chunks are held
against limits for their length, as short text always compresses badly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import kernels
from loomwork.llm.mapping import map_texts


@dataclass(frozen=True)
class Bands:
    level: int = 3
    chunk: int = 4096
    #: Share of a document's bytes in chunks out of band from which it is rejected.
    bad_share: float = 0.5
    #: From so many bytes on: the least and the largest ratio. Below the first, none.
    limits: tuple[tuple[int, float, float], ...] = (
        (64, 0.45, 1.30),
        (128, 0.33, 1.12),
        (256, 0.33, 0.97),
        (512, 0.32, 0.88),
        (1024, 0.30, 0.80),
        (2048, 0.28, 0.75),
        (4096, 0.26, 0.72),
        (8192, 0.24, 0.69),
        (16384, 0.20, 0.67),
        (65536, 0.16, 0.65),
    )


#: Symbols that are counted.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

FIELDS = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("ratio", pa.float64()),
    ("bad_chunks", pa.float64()),
]


def _repeat_words(w: kernels.Words) -> np.ndarray:
    """Words in windows that occur twice or more in their text."""
    n_words = np.diff(w.first)
    text = np.repeat(np.arange(len(n_words)), n_words)
    window = kernels.runs(w.hashes, WINDOW)
    at = np.flatnonzero(text[: len(window)] == text[WINDOW - 1 :]) if len(window) else np.zeros(0, np.int64)
    covered = np.zeros(len(text) + 1, dtype=np.int64)
    if len(at):
        key = kernels.mix(window[at] + kernels.mix(text[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        np.add.at(covered, at[again], 1)
        np.add.at(covered, at[again] + WINDOW, -1)
    inside = (np.cumsum(covered[:-1]) > 0).astype(np.int64)
    return kernels.per_text(inside, w.first)


def _dup_lines(raw: np.ndarray, offsets: np.ndarray, w: kernels.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(offsets) - 1
    feeds = np.flatnonzero(raw == 10)
    starts = np.concatenate([offsets[:-1], feeds + 1])
    stops = np.concatenate([offsets[1:], feeds])
    # a line ends at its feed or with its text; both lists pair up once sorted by text and place
    text = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, "right") - 1])
    starts = starts[np.lexsort((starts, text))]
    order = np.lexsort((stops, text))
    stops, text = stops[order], text[order]
    with_word = np.searchsorted(w.starts, stops) > np.searchsorted(w.starts, starts)
    starts, stops, text = starts[with_word], stops[with_word], text[with_word]
    hashes = kernels.content_hashes(raw, starts, stops)
    key = kernels.mix(hashes + kernels.mix(text.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(key, return_index=True)
    return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def quality_kernel(how: Bands):
    limits = np.array([(0, 0.0, np.inf), *how.limits])

    def within(size: int, ratio: float) -> bool:
        row = limits[np.searchsorted(limits[:, 0], size, "right") - 1]
        return bool(row[1] <= ratio <= row[2])

    def kernel(texts: pa.Array) -> list:
        import zstandard

        raw, offsets = kernels.text_bytes(texts)
        w = kernels.words(raw, offsets)
        symbols = np.isin(raw, np.frombuffer(SYMBOLS, np.uint8)).astype(np.int64)
        # a character begins with a byte that is no continuation; white space is all one byte
        chars = ((raw & 0xC0) != 0x80) & ~kernels._SPACE[raw]
        compressor = zstandard.ZstdCompressor(level=how.level)
        data = raw.tobytes()
        ratio, bad = np.full(len(texts), np.nan), np.zeros(len(texts))
        for i in range(len(texts)):
            begin, end = int(offsets[i]), int(offsets[i + 1])
            if begin == end:
                continue
            ratio[i] = len(compressor.compress(data[begin:end])) / (end - begin)
            if end - begin <= how.chunk:  # one chunk, the whole text
                bad[i] = 0.0 if within(end - begin, ratio[i]) else 1.0
                continue
            wrong = 0
            for at in range(begin, end, how.chunk):
                part = data[at : min(at + how.chunk, end)]
                if not within(len(part), len(compressor.compress(part)) / len(part)):
                    wrong += len(part)
            bad[i] = 1.0 if not within(end - begin, ratio[i]) else wrong / (end - begin)
        return [
            np.diff(w.first),
            kernels.per_text(chars.astype(np.int64), offsets),
            kernels.per_text(symbols, offsets),
            _dup_lines(raw, offsets, w),
            _repeat_words(w),
            pa.array(ratio, from_pandas=True),
            bad,
        ]

    return kernel


def quality(docs: DataFrame, how: Bands = Bands()) -> DataFrame:
    """Every document with its counts, its ratio and whether it is kept.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Result: doc_id,
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio (of
    the whole text; null if it is empty), bad_chunks (share of the bytes in chunks out of
    band; 1 if the whole text is), kept. A null text counts as empty, which fails the base
    rules. Repeated rows are judged each. An empty table gives an empty result.
    """
    rows = map_texts(docs, quality_kernel(how), FIELDS)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        *counts,
        failed.alias("base_failed"),
        "ratio",
        "bad_chunks",
        (~failed & (F.col("bad_chunks") < how.bad_share)).alias("kept"),
    )
