"""NumPy over a batch of texts as one array of bytes."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Fixed values of the splitmix64 finaliser.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: An odd base of the polynomial hash, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A good 64-bit hash of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, … modulo 2^64."""
    out = np.empty(n, dtype=np.uint64)
    if n:
        out[0] = 1
        filled = 1
        while filled < n:
            step = np.uint64(pow(base, filled, 1 << 64))
            more = min(filled, n - filled)
            out[filled : filled + more] = out[:more] * step
            filled += more
    return out


def inverse_powers(n: int) -> np.ndarray:
    """With which differences of running sums become hashes that do not depend on the place."""
    return powers(_INVERSE, n)


#: Two primes below 2^31 and a base for each: a hash of two remainders, as texts can be
#: written whose hashes modulo 2^64 are equal whatever the base.
PRIMES = ((2147483647, 1402024253), (2147483629, 862450871))


def _prime_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both primes the powers of the base and of its inverse; kept by the worker."""
    kept = sys.modules.setdefault("_llm_powers", types.ModuleType("_llm_powers")).__dict__
    if len(kept.get("tables", [[[]]])[0][0]) < n:
        size, tables = max(n, 1 << 20), []
        for prime, base in PRIMES:
            both = []
            for b in (base, pow(base, -1, prime)):
                out = np.ones(size, dtype=np.uint64)
                filled = 1
                while filled < size:
                    more = min(filled, size - filled)
                    step = np.uint64(pow(b, filled, prime))
                    out[filled : filled + more] = out[:more] * step % np.uint64(prime)
                    filled += more
                both.append(out)
            tables.append(tuple(both))
        kept["tables"] = tables
    return [(up[:n], down[:n]) for up, down in kept["tables"]]


def content_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 62-bit hash of each of the byte ranges, mixed to 64 bits."""
    n = len(raw)
    both = np.zeros(len(starts), dtype=np.uint64)
    for (prime, _), (up, down) in zip(PRIMES, _prime_powers(n + 1)):
        p, sums = np.uint64(prime), np.zeros(n + 1, dtype=np.uint64)
        terms = (raw.astype(np.uint64) + np.uint64(1)) * up[:n]
        if n > 1 << 24:  # else the sum of all terms fits into 64 bits
            terms %= p
        np.cumsum(terms, out=sums[1:])
        own = (sums[stops] - sums[starts]) % p * down[starts] % p
        both = (both << np.uint64(31)) | own
    return mix(both)


def row_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text, one row at least."""
    lengths = pa.compute.binary_length(texts).fill_null(0)
    sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield start, end
        start = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: none), and the n + 1 offsets of the texts in them."""
    texts = pa.compute.fill_null(texts, b"" if pa.types.is_large_binary(texts.type) else "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[raw]


def sums_of(raw: np.ndarray) -> np.ndarray:
    """Running sums from which ``spans`` hashes ranges."""
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(raw)), out=sums[1:])
    return sums


def spans(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each of the byte ranges."""
    sums = sums_of(raw) if sums is None else sums
    return mix((sums[stops] - sums[starts]) * powers(_INVERSE, len(raw) + 1)[starts])


@dataclass
class Words:
    """The words of a batch: runs of bytes other than ASCII white space, within a text."""

    starts: np.ndarray
    ends: np.ndarray
    #: The words of text i are first[i] to first[i + 1].
    first: np.ndarray
    hashes: np.ndarray


def words(raw: np.ndarray, offsets: np.ndarray, hashes: Callable = content_hashes) -> Words:
    n = len(raw)
    inside = np.empty(n + 1, dtype=bool)
    inside[:n] = ~_SPACE[raw]
    inside[n] = False
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    ends = inside[:n] & ~inside[1:]
    # a text's first byte begins a word, and its last one ends it, whatever stands next to them
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    begins[heads] = inside[heads]
    ends[tails] = inside[tails]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(starts, stops, np.searchsorted(starts, offsets), hashes(raw, starts, stops))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` hashes in a row; texts are not told apart."""
    if len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[: len(hashes) - k + 1].copy()
    for i in range(1, k):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - k + 1 + i])
    return out


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the bounds ``first``."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]
