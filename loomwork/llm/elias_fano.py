"""Elias-Fano coding of ascending numbers, with select.

A number's low bits are stored as they are; its high bits as the distance from those of
the number before, in unary. Together that is about ``2 + log2(range / count)`` bits a
number. The position of every 256th one of the unary part is kept, so ``select`` scans a
few bytes only.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 256


def _packed(values: np.ndarray, width: int) -> bytes:
    if width == 0 or len(values) == 0:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpacked(data: bytes, width: int, first: int, count: int) -> np.ndarray:
    if width == 0 or count == 0:
        return np.zeros(count, dtype=np.uint64)
    begin, end = first * width, (first + count) * width
    raw = np.frombuffer(data, np.uint8)[begin // 8 : -(-end // 8)]
    bits = np.unpackbits(raw, bitorder="little")[begin % 8 : begin % 8 + count * width]
    weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
    return (bits.reshape(count, width).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


def encode(values: np.ndarray) -> dict:
    """``values`` ascend (repeats allowed) from 0 on, as unsigned 64-bit integers."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // n).bit_length() - 1) if n else 0
    ones = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
    size = int(ones[-1]) + 1 if n else 0
    unary = np.zeros(size, dtype=np.uint8)
    unary[ones.astype(np.int64)] = 1
    low = values & np.uint64((1 << width) - 1)
    return {
        "n": n,
        "width": width,
        "low": _packed(low, width),
        "high": np.packbits(unary, bitorder="little").tobytes(),
        "samples": ones[::SAMPLE].astype("<u4").tobytes(),
    }


def decode(code: dict) -> np.ndarray:
    """All numbers."""
    n, width = int(code["n"]), int(code["width"])
    bits = np.unpackbits(np.frombuffer(code["high"], np.uint8), bitorder="little")
    ones = np.flatnonzero(bits)[:n].astype(np.uint64)
    high = ones - np.arange(n, dtype=np.uint64)
    return (high << np.uint64(width)) | _unpacked(code["low"], width, 0, n)


def select(code: dict, i: int) -> int:
    """The ``i``-th number, read from a few bytes."""
    n, width = int(code["n"]), int(code["width"])
    if not 0 <= i < n:
        raise IndexError(i)
    high = np.frombuffer(code["high"], np.uint8)
    at = int(np.frombuffer(code["samples"], "<u4")[i // SAMPLE])
    todo, byte = i % SAMPLE, at // 8
    first = np.unpackbits(high[byte : byte + 1], bitorder="little")
    first[: at % 8] = 0
    while True:
        ones = int(first.sum())
        if todo < ones:
            break
        todo -= ones
        byte += 1
        first = np.unpackbits(high[byte : byte + 1], bitorder="little")
    place = byte * 8 + int(np.flatnonzero(first)[todo])
    return ((place - i) << width) | int(_unpacked(code["low"], width, i, 1)[0])


def select_many(code: dict, at: np.ndarray) -> np.ndarray:
    """The numbers at the given places, each found from the sample before it.

    Ones are counted from a sample on, 256 at most; places that share a sample share the
    scan, which ends at the sample after it.
    """
    n, width = int(code["n"]), int(code["width"])
    at = np.asarray(at, dtype=np.int64)
    out = np.zeros(len(at), dtype=np.uint64)
    if len(at) and not (0 <= at.min() and at.max() < n):
        raise IndexError(int(at.min()) if at.min() < 0 else int(at.max()))
    high, samples = np.frombuffer(code["high"], np.uint8), np.frombuffer(code["samples"], "<u4").astype(np.int64)
    block = at // SAMPLE
    for k in np.unique(block).tolist():
        begin = int(samples[k])
        stop = int(samples[k + 1]) if k + 1 < len(samples) else 8 * len(high)
        bits = np.unpackbits(high[begin // 8 : -(-stop // 8)], bitorder="little")
        ones = np.flatnonzero(bits[begin % 8 :]) + begin
        own = np.flatnonzero(block == k)
        unary = ones[at[own] % SAMPLE] - at[own]
        first = k * SAMPLE
        low = _unpacked(code["low"], width, first, min(SAMPLE, n - first))[at[own] - first]
        out[own] = (unary.astype(np.uint64) << np.uint64(width)) | low
    return out
