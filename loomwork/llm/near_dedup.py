"""Near-duplicate documents by SetSketch registers.

Every shingle gives each register an exponentially distributed value; the register keeps
the exponent, to a base close to one, of the least value, truncated to 16 bits. Registers
of a union are the maxima of the registers, and two sets agree in a register about as
often as their Jaccard similarity. Bands of registers bring candidates together; the
likelihood of all registers, given both set sizes, rules out those far from the threshold;
the full sets of words confirm the rest.

What is wanted are the connected components of the links, so pairs that are already known
to be connected need no comparison. Two rounds find them without listing a group's pairs:

1. Every document of a bucket is compared with the bucket's smallest doc_id.
2. In buckets that still hold several components, all pairs across components are compared
   where their sketches and sets of 64-bit hashes lie, each pair in the first bucket that
   it shares. Of the links found only the best few of a document to each other component
   come out and are confirmed on words. Should words refuse any, the round is repeated with
   so many more links that the refused ones leave none out. After that no candidate link
   between components is missing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import kernels
from loomwork.llm.components import components
from loomwork.llm.mapping import key_runs, map_texts
from loomwork.shared import cut_lineage


@dataclass(frozen=True)
class Sketching:
    #: Words of a shingle.
    words: int = 5
    #: Percent of the union that the intersection must reach.
    percent: int = 80
    bands: int = 50
    rows: int = 5
    #: SetSketch's base and rate: 16 bits reach sets of any size with these.
    base: float = 1.001
    rate: float = 20.0
    #: Log likelihood by which the threshold must fall behind to rule a pair out: at 18, one
    #: in a billion pairs at the threshold.
    margin: float = 18.0
    #: Links of a document to another component that a bucket of round 2 gives; one would do,
    #: and there are more when words have refused some.
    partners: int = 2
    #: Documents of a bucket that one task compares with as many others.
    block: int = 1024
    seed: int = 42

    @property
    def registers(self) -> int:
        return self.bands * self.rows


TOP = 65_535
#: Pairs of sketches compared at a time.
PAIRS_AT_ONCE = 8192


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes text by text, and the n + 1 bounds of the texts in them.

    A text with fewer words has one shingle, its whole sequence of words; one without
    words has none.
    """
    raw, offsets = kernels.text_bytes(texts)
    w = kernels.words(kernels.lower(raw), offsets)
    n_words = np.diff(w.first)
    text = np.repeat(np.arange(len(n_words)), n_words)
    runs = kernels.runs(w.hashes, k)
    at = np.flatnonzero(text[: len(runs)] == text[k - 1 :]) if len(runs) else np.zeros(0, np.int64)
    hashes, owner = runs[at], text[at]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        whole = []
        for i in short:
            own = w.hashes[w.first[i] : w.first[i + 1]]
            whole.append(kernels.runs(own, len(own))[0] ^ np.uint64(len(own)))
        hashes = np.concatenate([hashes, np.array(whole, dtype=np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(n_words) + 1))


def sketches(hashes: np.ndarray, bounds: np.ndarray, how: Sketching) -> np.ndarray:
    """Registers of each set, one row a set; zeros for empty sets."""
    out = np.zeros((len(bounds) - 1, how.registers), dtype=np.uint16)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full) == 0:
        return out
    rng = np.random.default_rng(how.seed)
    factors = rng.integers(0, 1 << 31, how.registers, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, how.registers, dtype=np.uint32)
    folded = (kernels.mix(hashes) >> np.uint64(32)).astype(np.uint32)
    heads = bounds[:-1][full]
    least = np.empty((how.registers, len(full)), dtype=np.uint32)
    values = np.empty_like(folded)
    for i in range(how.registers):
        np.bitwise_xor(folded, shifts[i], out=values)
        np.multiply(values, factors[i], out=values)
        # the high bits of a product depend on all bits below them, the low ones do not
        np.minimum.reduceat(values, heads, out=least[i])
    uniform = (least.T.astype(np.float64) + 0.5) / 2.0**32
    exponential = -np.log1p(-uniform) / how.rate
    exponent = np.floor(1 - np.log(exponential) / np.log(how.base))
    out[full] = np.clip(exponent, 0, TOP).astype(np.uint16)
    return out


def log_likelihood(
    up: np.ndarray, down: np.ndarray, same: np.ndarray, u: np.ndarray, similarity: np.ndarray, base: float
) -> np.ndarray:
    """Of a similarity, given how many registers of one set are above, below and equal to
    the other's, and the share ``u`` that the one's size has in the sum of both."""
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    above, below = p(u - v * similarity), p(v - u * similarity)
    tie = np.clip(1 - above - below, 1e-12, 1)
    above, below = np.clip(above, 1e-12, 1), np.clip(below, 1e-12, 1)
    return up * np.log(above) + down * np.log(below) + same * np.log(tie)


def estimates(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, how: Sketching):
    """The likeliest similarity of each pair of sketches, and whether it may reach the threshold."""
    up, down = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    same, m = a.shape[-1] - up - down, a.shape[-1]
    # so few equal registers that the likelihood is sure to rule the pair out
    wanted = how.percent / 100
    close = same >= m * wanted - 10 * np.sqrt(m * wanted * (1 - wanted))
    best, may = np.zeros(len(same)), np.zeros(len(same), dtype=bool)
    best[close], may[close] = joint_estimates(up[close], down[close], same[close], na[close], nb[close], how)
    return best, may


def joint_estimates(up, down, same, na, nb, how: Sketching):
    na, nb = na.astype(float), nb.astype(float)
    u = na / (na + nb)
    most = np.minimum(na, nb) / np.maximum(na, nb)
    low, high = np.zeros_like(most), most.copy()
    golden = (5**0.5 - 1) / 2
    for _ in range(24):  # the likelihood has one maximum
        left, right = high - golden * (high - low), low + golden * (high - low)
        lower = log_likelihood(up, down, same, u, left, how.base) < log_likelihood(
            up, down, same, u, right, how.base
        )
        low, high = np.where(lower, left, low), np.where(lower, high, right)
    best = (low + high) / 2
    wanted = how.percent / 100
    lost = log_likelihood(up, down, same, u, best, how.base) - log_likelihood(
        up, down, same, u, np.minimum(wanted, most), how.base
    )
    return best, (most >= wanted - 1e-9) & ((best >= wanted) | (lost <= how.margin))


def features(docs: DataFrame, how: Sketching) -> DataFrame:
    """doc_id, n_shingles, digest (of the full set), sketch (registers, little-endian)."""

    def kernel(texts: pa.Array) -> list:
        hashes, bounds = shingle_sets(texts, how.words)
        registers = sketches(hashes, bounds, how).astype("<u2")
        raw = hashes.astype("<u8").tobytes()
        digests = [
            hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
        ]
        return [np.diff(bounds), digests, [row.tobytes() for row in registers]]

    fields = [("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())]
    return map_texts(docs, kernel, fields, slice_bytes=1 << 19)


def _likely(pairs: DataFrame, sets: DataFrame, how: Sketching) -> DataFrame:
    """Pairs (a, b) that the likelihood does not rule out."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    sized = 100 * F.least("na", "nb") >= how.percent * F.greatest("na", "nb")
    rows = pairs.join(one, "a").join(two, "b").where(sized)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sa, sb = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                for c in ("sa", "sb")
            )
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            may = pa.array(estimates(sa, sb, na, nb, how)[1])
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema)
            yield kept.filter(may)

    return rows.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _exact_set(text: str, k: int) -> set:
    words = text.encode().lower().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(k)]))


def _confirmed(pairs: DataFrame, texts: DataFrame, how: Sketching) -> DataFrame:
    """Pairs whose full sets of words reach the threshold."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    k, percent = how.words, how.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            may = []
            b_ids = batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                one = _exact_set(batch.column(2)[i].as_py(), k)
                if b_ids[i] != last:
                    last, known = b_ids[i], _exact_set(batch.column(3)[i].as_py(), k)
                both = len(one & known)
                may.append(100 * both >= percent * (len(one) + len(known) - both))
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema)
            yield kept.filter(pa.array(may, pa.bool_()))

    return rows.mapInArrow(run, "a bigint, b bigint")


#: Bytes of a shingle's hash that travel with a set.
HASH_BYTES = 6


def _hash_sets(docs: DataFrame, how: Sketching) -> DataFrame:
    """doc_id, shingles: the set as distinct ascending hashes of six bytes.

    There are fewer of them than shingles if some have the same six bytes.
    """

    def kernel(texts: pa.Array) -> list:
        hashes, bounds = shingle_sets(texts, how.words)
        short = hashes >> np.uint64(8 * (8 - HASH_BYTES))
        new = np.ones(len(short), dtype=bool)
        new[1:] = short[1:] != short[:-1]
        starts = bounds[:-1]
        new[starts[starts < len(short)]] = True
        cuts = np.concatenate([[0], np.cumsum(new)])[bounds].tolist()
        raw = short[new].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
        return [[raw[HASH_BYTES * a : HASH_BYTES * b] for a, b in zip(cuts, cuts[1:])]]

    return map_texts(docs, kernel, [("shingles", pa.binary())], slice_bytes=1 << 19)


def _whole_hashes(raw: bytes) -> np.ndarray:
    """The numbers that ``_hash_sets`` wrote."""
    out = np.zeros((len(raw) // HASH_BYTES, 8), dtype=np.uint8)
    out[:, :HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
    return out.view("<u8").ravel()


def _ranks(values: np.ndarray) -> np.ndarray:
    """32-bit numbers that are equal where the 64-bit ``values`` are."""
    order = np.argsort(values)
    new = np.zeros(len(values), dtype=np.uint32)
    new[1:] = values[order[1:]] != values[order[:-1]]
    out = np.empty_like(new)
    out[order] = np.cumsum(new, dtype=np.uint32)
    return out


def _common(x: np.ndarray, y: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The size of the intersection of sets x[i] and y[i], which lie in ``values`` from ``first``.

    ``values`` are below 2^32, and distinct within a set.
    """
    sizes = np.diff(first)
    both, pair = np.concatenate([x, y]), np.concatenate([np.arange(len(x))] * 2)
    lengths = sizes[both]
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    keys = values[np.repeat(first[both], lengths) + within].astype(np.uint64)
    keys |= np.repeat(pair, lengths).astype(np.uint64) << np.uint64(32)
    keys.sort()
    twice = keys[1:][keys[1:] == keys[:-1]]
    return np.bincount((twice >> np.uint64(32)).astype(np.int64), minlength=len(x))


def _cross_links(members: DataFrame, how: Sketching) -> DataFrame:
    """Links (a, b) across components within buckets, by sets of hashes.

    ``members`` has bucket, band, doc_id, component, n_shingles, sketch, shingles. A bucket
    of more than a block is dealt over pairs of blocks, so that a task holds two blocks at
    a time. A pair is compared in its first common band only.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / how.block).cast("int")
    dealt = members.join(sizes.select("bucket", blocks.alias("blocks")), "bucket")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "bucket",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "own",
        "band",
        "doc_id",
        "component",
        "n_shingles",
        "sketch",
        "shingles",
    )
    keys = ["bucket", "i", "j"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def opposite(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of a group and, for each, the later rows that it has to be compared with."""
        own = group["own"].to_numpy()
        comp, n = group["component"].to_numpy(), group["n_shingles"].to_numpy()
        split = own.min() != own.max()  # two blocks: the first is compared with the second
        for x in np.flatnonzero(own == own.min()) if split else range(len(own) - 1):
            rest = np.flatnonzero(own != own[x]) if split else np.arange(x + 1, len(own))
            large = np.maximum(n[rest], n[x])
            rest = rest[(comp[rest] != comp[x]) & (100 * np.minimum(n[rest], n[x]) >= how.percent * large)]
            if len(rest):
                yield np.full(len(rest), x), rest

    def judged(table: pa.Table, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        registers = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u2").reshape(table.num_rows, -1)
        raw = table["shingles"].to_pylist()
        values = _ranks(_whole_hashes(b"".join(raw))) if len(x) else np.zeros(0, np.uint32)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // HASH_BYTES
        first = np.concatenate([[0], np.cumsum(lengths)])
        ids, comp, n, band = (table[c].to_numpy() for c in ("doc_id", "component", "n_shingles", "band"))
        # so many common shingles at most can hide behind equal hashes
        hidden = n - lengths
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        for at in range(0, len(x), PAIRS_AT_ONCE):
            i, j = x[at : at + PAIRS_AT_ONCE], y[at : at + PAIRS_AT_ONCE]
            equal = (registers[i] == registers[j]).reshape(len(i), how.bands, how.rows).all(axis=2)
            here = equal.argmax(axis=1) == band[i]
            i, j = i[here], j[here]
            may = estimates(registers[i], registers[j], n[i], n[j], how)[1]
            i, j = i[may], j[may]
            both = _common(i, j, values, first) + np.minimum(hidden[i], hidden[j])
            link = 100 * both >= how.percent * (n[i] + n[j] - both)
            found.append((i[link], j[link], (both / (n[i] + n[j] - both))[link]))
        x, y, similar = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((-similar, comp[y], x))
        x, y = x[order], y[order]
        target = np.unique(np.stack([x, comp[y]], axis=1), axis=0, return_inverse=True)[1].ravel()
        best = np.arange(len(x)) - np.searchsorted(target, target) < how.partners
        low, high = np.minimum(ids[x], ids[y])[best], np.maximum(ids[x], ids[y])[best]
        return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, rows, pairs = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            x, y = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, int),) * 2
            return judged(pa.concat_tables(held), x, y)

        for group in key_runs(batches, keys):
            if group.num_rows < 2:
                continue
            held.append(group)
            for x, y in opposite(group):
                parts.append((x + rows, y + rows))
                pairs += len(x)
            rows += group.num_rows
            if pairs >= PAIRS_AT_ONCE or rows >= PAIRS_AT_ONCE:
                yield flush()
                held, parts, rows, pairs = [], [], 0, 0
        if held:
            yield flush()

    return ordered.mapInArrow(run, "a bigint, b bigint").distinct()


def _several(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with their components, of the buckets that hold several."""
    labelled = members.join(found, "doc_id", "left").select(
        "bucket", "band", "doc_id", F.coalesce("component_id", "doc_id").alias("component")
    )
    spans = labelled.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    )
    return cut_lineage(labelled.join(spans.where("least <> most").select("bucket"), "bucket"))


def near_components(docs: DataFrame, how: Sketching = Sketching()) -> DataFrame:
    """Every document with its component of near duplicates.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Words are lower-cased
    in A-Z only. Result: doc_id, n_shingles (size of the set), component_id (the smallest
    doc_id reachable over links), kept (doc_id = component_id). A null or blank text has an
    empty set and is linked with nothing. Rows that repeat a doc_id are expected to repeat
    its text, and get the same component. A null doc_id gets null and is not kept. An empty
    table gives an empty result.

    Documents with equal sets, by a 128-bit digest of the whole set, are one class with its
    smallest doc_id as representative; so copies are never paired.
    """
    made = cut_lineage(features(docs, how))
    filled = made.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    sets = cut_lineage(
        filled.join(classes, ["digest", "doc_id"], "left_semi")
        .select("doc_id", "n_shingles", "sketch")
        .dropDuplicates(["doc_id"])
    )
    width = 2 * how.rows
    keys = [F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width)) for i in range(how.bands)]
    banded = sets.select("doc_id", F.posexplode(F.array(*keys)).alias("band", "bucket"))
    heads = banded.groupBy("bucket").agg(F.min("doc_id").alias("head"), F.count("*").alias("n"))
    members = cut_lineage(
        banded.join(heads.where("n > 1"), "bucket").select("bucket", "band", "doc_id", "head")
    )
    texts = cut_lineage(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .join(members.select("doc_id").distinct(), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
    )
    pairs = members.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
    links = cut_lineage(_confirmed(_likely(pairs.distinct(), sets, how), texts, how))
    found = components(links)
    refused, how_many = None, how
    while True:
        several = _several(members, found)
        hashed = _hash_sets(texts.join(several.select("doc_id").distinct(), "doc_id", "left_semi"), how)
        crossing = _cross_links(several.join(sets.join(hashed, "doc_id"), "doc_id"), how_many)
        if refused is not None:
            crossing = crossing.join(refused, ["a", "b"], "left_anti")
        crossing = cut_lineage(crossing)
        wanted = crossing.count()
        if wanted == 0:
            break
        fresh = cut_lineage(_confirmed(crossing, texts, how))
        stars = found.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))
        found = components(stars.unionByName(fresh))
        if fresh.count() == wanted:
            break
        # equal hashes of different words: what was refused may have taken the place of true links
        missed = crossing.join(fresh, ["a", "b"], "left_anti")
        refused = cut_lineage(missed if refused is None else missed.unionByName(refused))
        how_many = replace(how, partners=how.partners + refused.count())
    named = classes.join(found, "doc_id", "left").select(
        "digest", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    linked = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        made.select("doc_id", "n_shingles", "digest")
        .join(named, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def drop_near_copies(docs: DataFrame, how: Sketching = Sketching()) -> DataFrame:
    """The rows of ``docs`` of one document of each component, with all their columns.

    A null or blank text stays, and so does every row with a null doc_id. Rows that repeat
    a doc_id stay or go together. An empty table stays empty.
    """
    gone = near_components(docs, how).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
