"""Repeated passages, byte for byte, by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with
a smaller doc_id. Suffixes are dealt to tasks so that those which share their first
``length`` bytes meet: by the least hash of the short strings inside these bytes, which
equal bytes have in common. Each task sorts its suffixes with the difference cover of
three - sampled triples are sorted and named, the names recursed on, the remaining
suffixes merged in - and compares the prefixes of neighbours.

Before that, hashes that occur in one document only are put aside, as no string with that
least hash can repeat. Nothing is dropped by it: every occurrence of a string has the same
least hash, so a string that starts in two documents keeps both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import kernels
from loomwork.llm.mapping import key_runs
from loomwork.llm.suffix_array import suffix_array
from loomwork.shared import cut_lineage, free_shuffles, release


@dataclass(frozen=True)
class Passages:
    #: Bytes of a string that counts as a passage.
    length: int = 50
    #: Bytes of the short strings whose least hash deals a suffix to its task.
    gram: int = 20
    #: Documents of a batch with a hash, from which on the batch answers for itself.
    answered: int = 8
    #: Documents from which on a hash is hot, and its strings are dealt one by one.
    hot: int = 100_000
    #: A hot hash also has at least this share of all entries, so their list is bounded.
    hot_share: float = 1e-6
    #: Bytes of text that a suffix array covers, or one hash with more; small ones stay in the cache.
    sorted_bytes: int = 1 << 17


_LOW = np.uint64(0xFFFFFFFF)
#: Strings that are hashed at a time.
_BLOCK = 1 << 16


def least_hashes(raw: np.ndarray, offsets: np.ndarray, how: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every string of ``length`` bytes within a text: its start, its text, its least hash."""
    n, k = len(raw), how.gram
    count = n - how.length + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, block = np.empty(count, dtype=np.uint64), min(count, _BLOCK)
    inverse = kernels.inverse_powers(block + how.length - k)
    # blocks stay in the cache; a hash does not depend on the place
    for begin in range(0, count, block):
        end = min(begin + block, count)
        sums = kernels.sums_of(raw[begin : end + how.length - 1])
        grams = kernels.mix((sums[k:] - sums[:-k]) * inverse[: len(sums) - k])
        low, span, width = grams, 1, how.length - k + 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: -(width - span)], low[width - span :])
        least[begin:end] = low
    sizes = np.diff(offsets)
    whole = np.maximum(sizes - how.length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), whole)
    starts = np.arange(len(text)) + np.repeat(offsets[:-1] - (np.cumsum(whole) - whole), whole)
    return starts, text, least[starts]


def keys_of(least: np.ndarray, shards: int) -> np.ndarray:
    """A shard in the upper bits, 32 bits of the hash in the lower."""
    shard = (least >> np.uint64(32)) % np.uint64(shards)
    return ((shard << np.uint64(32)) | (least & _LOW)).astype(np.int64)


def _deltas(ids: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences of the least width that holds them."""
    gaps = np.diff(ids, prepend=ids[:1]).astype(np.uint64)
    top = int(gaps.max()) if len(gaps) else 0
    for kind in (np.uint8, np.uint16, np.uint32):
        if top <= np.iinfo(kind).max:
            return gaps.astype(kind)
    return gaps


def _entries(docs: DataFrame, how: Passages, shards: int) -> DataFrame:
    """Rows for the shards: hashes that a batch has, and answers it can give itself.

    A hash that many documents of the batch have repeats for certain: they get their
    answer, and the shard only hears of the hash and how many have it. So a shard gets a
    bounded number of entries of a hash from each batch.
    """
    fields = [("shard", pa.int32()), ("doc_id", pa.int64()), ("width", pa.int32())]
    fields += [(c, pa.binary()) for c in ("hashes", "docs", "known", "counts")] + [("key", pa.int64())]
    schema = pa.schema(fields)

    def rows(keys: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(starts, append=len(keys))
        many = counts >= how.answered
        answered = np.repeat(many, counts)
        known, known_counts = keys[starts[many]], counts[many]
        if answered.any():
            n = int(answered.sum())
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((keys[answered] >> 32).astype(np.int32)), pa.array(ids[answered]),
                    pa.nulls(n, pa.int32()), none, none, none, none, pa.array(keys[answered]),
                ],
                schema=schema,
            )
        keys, ids = keys[~answered], ids[~answered]
        order = np.lexsort((keys, ids, keys >> 32))
        keys, ids = keys[order], ids[order]
        shard = keys >> 32
        out = []
        for s in np.unique(np.concatenate([shard, known >> 32])):
            a, b = np.searchsorted(shard, [s, s + 1])
            p, q = np.searchsorted(known >> 32, [s, s + 1])
            gaps = _deltas(ids[a:b])
            out.append(
                {
                    "shard": int(s),
                    "doc_id": int(ids[a]) if a < b else 0,
                    "width": gaps.itemsize,
                    "hashes": (keys[a:b] & 0xFFFFFFFF).astype("<u4").tobytes(),
                    "docs": gaps.tobytes(),
                    "known": (known[p:q] & 0xFFFFFFFF).astype("<u4").tobytes(),
                    "counts": known_counts[p:q].astype("<u4").tobytes(),
                }
            )
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_ids, held = [], [], 0
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for start, end in kernels.row_slices(batch.column(1), 1 << 20):
                raw, offsets = kernels.text_bytes(batch.column(1).slice(start, end - start))
                _, text, least = least_hashes(raw, offsets, how)
                fresh = np.ones(len(least), dtype=bool)
                fresh[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                keys, ids = keys_of(least[fresh], shards), own[start:end][text[fresh]]
                order = np.lexsort((keys, ids))
                keys, ids = keys[order], ids[order]
                once = np.ones(len(keys), dtype=bool)
                once[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
                held_keys.append(keys[once])
                held_ids.append(ids[once])
                held += len(held_keys[-1])
                if held >= 1 << 21:
                    yield from rows(np.concatenate(held_keys), np.concatenate(held_ids))
                    held_keys, held_ids, held = [], [], 0
        if held:
            yield from rows(np.concatenate(held_keys), np.concatenate(held_ids))

    ddl = "shard int, doc_id bigint, width int, hashes binary, docs binary, known binary, counts binary, key bigint"
    return docs.mapInArrow(run, ddl)


def _repeated(entries: DataFrame, how: Passages, shards: int) -> DataFrame:
    """doc_id, key for every document that has a hash which another document has too.

    Rows without doc_id tell how many documents have a key, where they are many.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])
    ordered = entries.repartition(shards, "shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, ["shard"]):
            shard = int(table["shard"][0].as_py())
            answers = table.filter(pa.compute.is_valid(table["key"]))
            if answers.num_rows:
                nulls = pa.nulls(answers.num_rows, pa.int64())
                yield from pa.table(
                    [answers["doc_id"], answers["key"], nulls], schema=schema
                ).to_batches()
            hashes, ids, known, counts = [], [], [], []
            for row in table.filter(pa.compute.is_null(table["key"])).to_pylist():
                hashes.append(np.frombuffer(row["hashes"], "<u4"))
                gaps = np.frombuffer(row["docs"], f"<u{row['width']}").astype(np.int64)
                ids.append(np.cumsum(gaps) + row["doc_id"])
                known.append(np.frombuffer(row["known"], "<u4"))
                counts.append(np.frombuffer(row["counts"], "<u4"))
            if not hashes:
                continue
            h, d = np.concatenate(hashes), np.concatenate(ids)
            k, c = np.concatenate(known), np.concatenate(counts).astype(np.int64)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            if len(h):
                starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                sizes = np.diff(starts, append=len(h))
                several = d[starts] != d[starts + sizes - 1]
                several |= np.isin(h[starts], k)
                kept = np.repeat(several, sizes)
                n = int(kept.sum())
                key = (np.int64(shard) << 32) | h[kept].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d[kept]), pa.array(key), pa.nulls(n, pa.int64())], schema=schema
                )
            # many: counted over the entries and what batches have answered themselves
            names, place = np.unique(np.concatenate([h, k]), return_inverse=True)
            weight = np.concatenate([np.ones(len(h), np.int64), c])
            total = np.bincount(place, weight, minlength=len(names)).astype(np.int64)
            large = total >= how.hot
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(int(large.sum()), pa.int64()),
                    pa.array((np.int64(shard) << 32) | names[large].astype(np.int64)),
                    pa.array(total[large]),
                ],
                schema=schema,
            )

    return ordered.mapInArrow(run, "doc_id bigint, key bigint, n bigint")


PIECES = "key bigint, doc_id bigint, start bigint, stop bigint, piece binary"
_PIECES = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("piece", pa.binary())]
)


def _pieces(asked: DataFrame, how: Passages, shards: int, hot: np.ndarray) -> DataFrame:
    """The stretches of text whose strings have a repeated least hash, with their key.

    ``asked`` has doc_id, text, keys. Strings in a row with one least hash are one piece.
    Of equal pieces in a batch only that of the smallest doc_id goes on; the others are
    covered by it, and come out without their bytes. Strings of hot keys are pieces of
    their own, dealt by their own hash, so that a hot key is not one task's work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for begin, end in kernels.row_slices(batch.column(1), 1 << 20):
                raw, offsets = kernels.text_bytes(batch.column(1).slice(begin, end - begin))
                starts, text, least = least_hashes(raw, offsets, how)
                if len(starts) == 0:
                    continue
                # strings next to each other mostly share their least hash
                change = np.ones(len(starts), dtype=bool)
                change[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                heads = np.flatnonzero(change)
                lengths = np.diff(heads, append=len(starts))
                keys = keys_of(least[heads], shards)
                lists = batch.column(2).slice(begin, end - begin)
                sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                flat = pa.compute.list_flatten(lists).to_numpy(zero_copy_only=False)
                # a key is asked for per text
                salt = kernels.mix(np.arange(len(sizes), dtype=np.uint64) + np.uint64(1))
                wanted = np.unique(kernels.mix(flat.astype(np.uint64)) ^ np.repeat(salt, sizes))
                is_asked = np.isin(kernels.mix(keys.astype(np.uint64)) ^ salt[text[heads]], wanted)
                keys = np.repeat(keys[is_asked], lengths[is_asked])
                is_asked = np.repeat(is_asked, lengths)
                starts, text = starts[is_asked], text[is_asked]
                if len(starts) == 0:
                    continue
                single = np.isin(keys, hot)
                first = np.ones(len(starts), dtype=bool)
                first[1:] = (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1) | single[1:]
                first[1:] |= text[1:] != text[:-1]
                heads = np.flatnonzero(first)
                lasts = np.concatenate([heads[1:], [len(starts)]]) - 1
                a, b = starts[heads], starts[lasts] + how.length
                hashes = kernels.spans(raw, a, b)
                key = np.where(single[heads], (hashes >> np.uint64(1)).astype(np.int64), keys[heads])
                ids = own[begin:end][text[heads]]
                order = np.lexsort((ids, hashes, key))
                data = raw.tobytes()
                shipped = np.ones(len(order), dtype=bool)
                same = (hashes[order][1:] == hashes[order][:-1]) & (key[order][1:] == key[order][:-1])
                owner = -1
                for at in np.flatnonzero(np.concatenate([[False], same])).tolist():
                    if shipped[at - 1]:
                        owner = order[at - 1]
                    x = order[at]
                    equal = data[a[x] : b[x]] == data[a[owner] : b[owner]]
                    shipped[at] = not (equal and ids[x] > ids[owner])
                local = offsets[text[heads]]
                sent, done = order[shipped], np.sort(order[~shipped])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[sent]), pa.array(ids[sent]), pa.array((a - local)[sent]),
                        pa.array((b - local)[sent]), pa.array([data[a[x] : b[x]] for x in sent], pa.binary()),
                    ],
                    schema=_PIECES,
                )
                if len(done) == 0:
                    continue
                # covered pieces in a row are one stretch; a text's pieces ascend in both ends
                apart = np.ones(len(done), dtype=bool)
                apart[1:] = (a[done][1:] > b[done][:-1]) | (local[done][1:] != local[done][:-1])
                first_of = np.flatnonzero(apart)
                last_of = np.concatenate([first_of[1:], [len(done)]]) - 1
                head = done[first_of]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[head]), pa.array(ids[head]), pa.array((a - local)[head]),
                        pa.array((b - local)[done[last_of]]), pa.nulls(len(head), pa.binary()),
                    ],
                    schema=_PIECES,
                )

    return asked.mapInArrow(run, PIECES)


def covered(ids: np.ndarray, starts: np.ndarray, data: np.ndarray, sizes: np.ndarray, how: Passages):
    """Stretches of the pieces whose strings also start in a piece of a smaller doc_id.

    ``data`` has the pieces' bytes one after the other. Gives the numbers of the pieces,
    and where in the document the stretches begin and end.
    """
    # a zero ends each piece; bytes count from 1
    text = np.zeros(len(data) + len(sizes), dtype=np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data
    ends = np.cumsum(sizes + 1) - 1
    symbols = text.astype(np.int64) + 2
    symbols[ends] = 1
    order = suffix_array(symbols, how.length)
    of_byte = np.repeat(np.arange(len(sizes)), sizes + 1)
    whole = np.zeros(len(text), dtype=bool)
    whole[: max(len(text) - how.length, 0)] = of_byte[: -how.length] == of_byte[how.length :]
    order = order[whole[order]]
    piece = of_byte[order]
    # neighbours in the order with the same first bytes, eight bytes at a time
    words = np.ndarray((max(len(text) - 7, 0),), "<u8", buffer=text, strides=(1,))
    same = np.ones(len(order), dtype=bool)
    same[:1] = False
    steps = [*range(0, how.length - 7, 8), how.length - 8] if how.length >= 8 else []
    for step in steps:
        word = words[order + step]
        same[1:] &= word[1:] == word[:-1]
    if not steps:
        for step in range(how.length):
            byte = text[order + step]
            same[1:] &= byte[1:] == byte[:-1]
    heads = np.flatnonzero(~same)
    if len(heads) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = np.repeat(np.minimum.reduceat(ids[piece], heads), np.diff(heads, append=len(order)))
    gone = np.sort(order[ids[piece] > least])
    if len(gone) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = of_byte[gone]
    first = np.ones(len(gone), dtype=bool)
    first[1:] = (gone[1:] > gone[:-1] + how.length) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(first)
    lasts = np.concatenate([heads[1:], [len(gone)]]) - 1
    at = owner[heads]
    shift = starts[at] - (ends[at] - sizes[at])
    return at, gone[heads] + shift, gone[lasts] + how.length + shift


def _stretches(pieces: DataFrame, how: Passages, tasks: int) -> DataFrame:
    """doc_id, start, stop of the bytes to remove, overlapping as they come."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
    ordered = pieces.repartition(tasks, "key").sortWithinPartitions("key")

    def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """The stretches among the rows of whole keys."""
        keys = table["key"].to_numpy()
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(heads, append=len(keys))
        # a piece that is alone with its key covers nothing
        table = table.filter(pa.array(np.repeat(counts > 1, counts))).combine_chunks()
        if table.num_rows == 0:
            return
        ids, starts = table["doc_id"].to_numpy(), table["start"].to_numpy()
        data, offsets = kernels.text_bytes(table["piece"].chunk(0).cast(pa.large_binary()))
        sizes = np.diff(offsets)
        # as many whole keys at a time as fit into a suffix array's bytes
        firsts = np.concatenate([[0], np.cumsum(counts[counts > 1])])
        at = 0
        while at < len(firsts) - 1:
            begin = firsts[at]
            at = max(at + 1, int(np.searchsorted(offsets[firsts], offsets[begin] + how.sorted_bytes, "right")) - 1)
            part = slice(begin, firsts[at])
            number, start, stop = covered(
                ids[part], starts[part], data[offsets[begin] : offsets[firsts[at]]], sizes[part], how
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[part][number]), pa.array(start), pa.array(stop)], schema=schema
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            done = pa.compute.is_null(batch.column("piece"))
            yield batch.filter(done).select(["doc_id", "start", "stop"])
            batch = batch.filter(pa.compute.invert(done))
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            keys = table["key"].to_numpy()
            # the last key may go on in the next batch
            last = int(np.searchsorted(keys, keys[-1]))
            yield from settled(table.slice(0, last)) if last else ()
            rest = table.slice(last)
        if rest is not None:
            yield from settled(rest)

    return ordered.mapInArrow(run, "doc_id bigint, start bigint, stop bigint")


def remaining(text: bytes, stretches: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text, and how many maximal runs are gone."""
    parts, at, runs = [], 0, 0
    for start, stop in sorted(stretches):
        if start > at or runs == 0:
            parts.append(text[at:start])
            runs += 1
        at = max(at, stop)
    parts.append(text[at:])
    return b"".join(parts), runs


def stretches(docs: DataFrame, how: Passages = Passages()) -> DataFrame:
    """doc_id, start, stop (in bytes) of what repeats an earlier document; overlaps possible.

    ``docs`` has ``doc_id`` and ``text``.
    """
    spark = docs.sparkSession
    rows = docs.where("doc_id IS NOT NULL AND octet_length(text) >= " + str(how.length)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    tasks = max(docs.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    shards = 4 * tasks
    answers = cut_lineage(_repeated(_entries(rows, how, shards), how, shards))
    entries = answers.count()
    # at most one in hot_share keys
    hot = answers.where(F.col("doc_id").isNull() & (F.col("n") > entries * how.hot_share))
    hot_keys = np.array([r.key for r in hot.select("key").distinct().collect()], dtype=np.int64)
    per_doc = (
        answers.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("keys"))
    )
    asked = rows.join(per_doc, "doc_id").select("doc_id", "text", "keys")
    found = cut_lineage(_stretches(_pieces(asked, how, shards, hot_keys), how, 2 * tasks))
    release(answers)
    return found


def suffix_dedup(docs: DataFrame, how: Passages = Passages()) -> DataFrame:
    """Every document with what is left of it.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Result: doc_id,
    n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes). A null
    text counts as empty. Strings are judged on the input and never cross texts. Rows that
    share a doc_id are one document as far as repeats go, and each loses what any of them
    loses; a null doc_id loses nothing. An empty table gives an empty result.
    """
    gone = stretches(docs, how)
    free_shuffles(docs.sparkSession)
    per_doc = gone.groupBy(F.col("doc_id").alias("__doc_id")).agg(
        F.collect_set(F.struct("start", "stop")).alias("gone")
    )
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).join(per_doc, F.col("doc_id") == F.col("__doc_id"), "left")
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")]
        + [("kept_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            sizes = pa.compute.list_value_length(batch.column(2)).fill_null(0)
            ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
            lost = pa.compute.list_flatten(batch.column(2))
            starts, stops = (pa.compute.struct_field(lost, k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for i in range(batch.num_rows):
                text = (batch.column(1)[i].as_py() or "").encode()
                own = slice(int(ends[i - 1]) if i else 0, int(ends[i]))
                left, spans = remaining(text, list(zip(starts[own].tolist(), stops[own].tolist())))
                digest = hashlib.sha256(left).hexdigest()
                made.append((len(text), len(text) - len(left), spans, digest))
            columns = list(zip(*made)) if made else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, schema.types[i + 1]) for i, c in enumerate(columns)]],
                schema=schema,
            )

    return rows.select("doc_id", "text", "gone").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
