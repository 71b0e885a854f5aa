"""Text columns: normalisation, word tokens and their hash values."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

# These decide which shingles and signatures come out.
STOP_WORDS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for"]
REMOVED_WORD = r"(?U)\breuter\b"
SEPARATORS = "[^a-z0-9]+"
PRIME = 2147483647


def strip(text: Column) -> Column:
    """``text`` without white space, line breaks included, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    """Lower-case words of letters a-z and digits, without the stop words."""
    lower = F.lower(text)
    # the pattern looks at every character, and few texts hold the word
    plain = F.when(lower.contains("reuter"), F.regexp_replace(lower, REMOVED_WORD, "")).otherwise(lower)
    words = F.split(plain, SEPARATORS)
    return F.filter(words, lambda w: (w != "") & ~w.isin(STOP_WORDS))


def digests(values: Column) -> Column:
    """The md5 digests of an array of texts, 16 bytes each, as one binary value."""
    return F.unhex(F.array_join(F.transform(values, F.md5), ""))


def hash_parameters(num_hashes: int, seed: int = 42) -> list[tuple[int, int]]:
    """``num_hashes`` pairs (a, b) of the hash family (a*x + b) mod 2^31-1."""
    draw = random.Random(seed)
    return [(draw.randint(1, PRIME - 1), draw.randint(0, PRIME - 1)) for _ in range(num_hashes)]
