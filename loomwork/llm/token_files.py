"""Token ids as files: concatenated ids with Elias-Fano encoded document boundaries.

A table of token files is a folder of Parquet files. A row is a segment: whole documents
in ascending doc_id order, their ids one after the other as little-endian unsigned
integers of ``id_bytes`` bytes, and two Elias-Fano codes: where each document ends in
the segment, and the doc_ids less the first one. Ordered by ``part`` and ``segment``,
the ids of all segments are the ids of all documents. Nothing stores 64-bit offsets; a
document's place is two selects within its segment.

Spark's own commit of written files makes a lost executor harmless.
"""

from __future__ import annotations

import string
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.llm import elias_fano
from loomwork.llm.kernels import row_slices
from loomwork.shared import working_path

END_ID = 0
#: A segment is closed by the first document with which it has so many ids.
SEGMENT_IDS = 1 << 18
#: Pieces whose ids a worker remembers.
CACHED_PIECES = 1_200_000
#: Bytes of text that are cut and looked up at once, or one text.
ENCODED_SLICE = 1 << 22
#: A space before other white space, for which pieces are not alone.
ODD_SPACE = r" [\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}]"
#: Characters of new pieces that are encoded at once.
ENCODED_AT_ONCE = 1 << 16

_CODE = "struct<n: int, width: int, low: binary, high: binary, samples: binary>"
SCHEMA = (
    "part int, segment int, n_docs int, n_ids bigint, id_bytes int, n_null int, first_doc bigint, "
    f"docs {_CODE}, ends {_CODE}, ids binary"
)


class Encoder:
    """Ids of whole texts by the tokenizers library, with a memory for repeated pieces.

    A text is cut at single spaces. Byte-level pre-tokenisation never joins what stands
    before a space with what stands behind, so the ids of the pieces, each with its space,
    are the ids of the text. Where a space is followed by more white space that does not
    hold, and the whole text is encoded at once. Nor does it join a letter or digit with
    punctuation behind it, so a piece is its stem and the punctuation at its end, and stems
    are what is remembered.

    The ids of all known stems lie in one array. A batch is cut and numbered in Arrow,
    only its distinct pieces are looked up, and its ids are taken by index.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.id_type = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        for token, i in vocabulary.items():
            # the alphabet has one character for each byte, but added tokens are plain text
            self.bytes_of[i] = len(token.encode()) if token in added else len(token)
        # an added token may join letters with punctuation, but not if its end is left alone
        self.tails = "".join(c for c in string.punctuation if not any(t.endswith(c) for t in added))
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype=self.id_type)
        self.ends = np.zeros(1 << 16, dtype=np.int64)  # of the known pieces in ids

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.id_type).tobytes()

    def _keep(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(self.places), len(pieces)
        used = int(self.ends[n - 1]) if n else 0
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.ends) < n + k:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used : used + len(ids)] = ids
        self.ends[n : n + k] = used + np.cumsum(lengths)
        self.places.update(zip(pieces, range(n, n + k)))

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces that neither begin nor end with white space, many in one text.

        The ids are cut where the pieces end.
        """
        start = 0
        while start < len(pieces):
            end, chars = start, 0
            while end < len(pieces) and chars < ENCODED_AT_ONCE:
                chars += len(pieces[end]) + 1
                end += 1
            own = pieces[start:end]
            text = " " + " ".join(own)
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.id_type)
            lengths = pc.binary_length(pa.array(own, pa.string())).to_numpy().astype(np.int64)
            cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(lengths + 1)) + 1
            self._keep(own, ids, np.diff(cuts, prepend=0))
            start = end

    def learn_alone(self, keys: list[str], texts: list[str]) -> None:
        """Encode texts one by one and keep them under the keys."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        lengths = np.fromiter((len(f.ids) for f in found), np.int64, len(found))
        self._keep(keys, np.array([i for f in found for i in f.ids], self.id_type), lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 bounds of the texts in them."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        per = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(per) - per
        flat = pc.list_flatten(cut).dictionary_encode()
        index, items = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary.to_pylist()
        # a text's first piece has no space before it, and an odd text is looked up as a whole;
        # keys with a space before them are no pieces
        whole = texts.take(pa.array(np.flatnonzero(odd))).to_pylist()
        heads, head_of = np.unique(index[firsts], return_inverse=True)
        alone = [items[i] for i in heads.tolist()] + whole
        inner = np.ones(len(index), dtype=bool)
        inner[firsts] = False
        used = np.zeros(len(items), dtype=bool)
        used[index[inner]] = True
        used = np.flatnonzero(used)
        stems, tails = self._stems([items[i] for i in used.tolist()])
        places = self._places(stems, alone + tails)
        # the batch's own table: an entry is a stem and its tail, or what stands alone and nothing
        entries = np.full((len(used) + len(alone), 2), self.places[" "])
        entries[: len(used), 0] = places[: len(used)]
        entries[: len(used), 1] = places[len(used) + len(alone) :]
        entries[len(used) :, 0] = places[len(used) : len(used) + len(alone)]
        ids, bounds = _taken(self.ids, self.ends, entries.ravel())
        at = np.zeros(len(items), dtype=np.int64)
        at[used] = np.arange(len(used))
        at = at[index]
        at[firsts] = len(used) + head_of
        at[firsts[odd]] = len(used) + len(heads) + np.arange(len(whole))
        found, reached = _taken(ids, bounds[2::2], at)
        return found, reached[np.concatenate([[0], np.cumsum(per)])]

    def _stems(self, pieces: list[str]) -> tuple[list[str], list[str]]:
        """Each piece up to the punctuation at its end, and that punctuation.

        Only behind a letter or digit, as elsewhere it may be one token with what is before.
        """
        stems = [p.rstrip(self.tails) for p in pieces]
        stems = [s if s[-1:].isalnum() else p for s, p in zip(stems, pieces)]
        return stems, [p[len(s) :] for s, p in zip(stems, pieces)]

    def _places(self, stems: list[str], alone: list[str]) -> np.ndarray:
        """Where all stems, and then all texts with no space before them, are known; learns new ones."""
        distinct = list(dict.fromkeys([*alone, ""]))
        known = np.fromiter(map(self.places.get, stems, repeat(-1)), np.int64, len(stems))
        new = list(dict.fromkeys(stems[i] for i in np.flatnonzero(known < 0).tolist()))
        if len(self.places) + len(new) + len(distinct) > CACHED_PIECES:
            self.forget()
            known[:] = -1
            new = list(dict.fromkeys(stems))
        plain = [p for p in new if p and p.strip() == p]
        self.learn(plain)
        if len(plain) < len(new):  # with white space at an end, which a next space could belong to
            rest = [p for p in new if p not in self.places]
            self.learn_alone(rest, [" " + p for p in rest])
        apart = [t for t in distinct if " " + t not in self.places]
        if apart:
            self.learn_alone([" " + t for t in apart], apart)
        missing = np.flatnonzero(known < 0).tolist()
        known[missing] = [self.places[stems[i]] for i in missing]
        place = {t: self.places[" " + t] for t in distinct}
        return np.concatenate([known, np.fromiter(map(place.get, alone), np.int64, len(alone))])


def _taken(ids: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries ``at``, one after the other, and the n + 1 bounds of the entries in them."""
    starts = np.where(at > 0, ends[at - 1], 0)
    lengths = ends[at] - starts
    reached = np.concatenate([[0], np.cumsum(lengths)])
    inside = np.arange(reached[-1]) + np.repeat(starts - reached[:-1], lengths)
    return ids[inside], reached


def _encoder(path: str) -> Encoder:
    """The worker's encoder, which later tasks of the same worker find again."""
    kept = sys.modules.setdefault("_llm_encoders", types.ModuleType("_llm_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path)
    return kept.__dict__[path]


class _Segment:
    def __init__(self):
        self.docs, self.lengths, self.ids, self.n_ids, self.n_null = [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes, n: int) -> None:
        if doc_id is None:
            self.n_null += 1
        else:
            self.docs.append(doc_id)
        self.lengths.append(n)
        self.ids.append(ids)
        self.n_ids += n

    def row(self, part: int, segment: int, id_bytes: int) -> dict:
        first = self.docs[0] if self.docs else 0
        gaps = np.array([d - first for d in self.docs], dtype=np.uint64)
        return {
            "part": part,
            "segment": segment,
            "n_docs": len(self.lengths),
            "n_ids": self.n_ids,
            "id_bytes": id_bytes,
            "n_null": self.n_null,
            "first_doc": first,
            "docs": elias_fano.encode(gaps),
            "ends": elias_fano.encode(np.cumsum(self.lengths, dtype=np.uint64)),
            "ids": b"".join(self.ids),
        }


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write them, in ascending doc_id order, to the new folder ``path``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null or empty text
    has the end id only. A null doc_id comes first; a repeated doc_id is written as often.
    An empty table gives a folder without segments. ``tokenizer`` is the path of a
    byte-level vocabulary file that every executor has. Texts shuffle once, by range.
    """
    struct = pa.struct(
        [("n", pa.int32()), ("width", pa.int32())] + [(c, pa.binary()) for c in ("low", "high", "samples")]
    )
    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64())]
        + [("id_bytes", pa.int32()), ("n_null", pa.int32()), ("first_doc", pa.int64())]
        + [("docs", struct), ("ends", struct), ("ids", pa.binary())]
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        size = int(encoder.id_type[-1])
        end = np.array([end_id], dtype=encoder.id_type).tobytes()
        segment = _Segment()
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for start, stop in row_slices(texts, ENCODED_SLICE):
                raw, bounds = encoder.encode(texts.slice(start, stop - start))
                ids = doc_ids.slice(start, stop - start).to_pylist()
                for doc_id, a, b in zip(ids, bounds.tolist(), bounds[1:].tolist()):
                    segment.add(doc_id, raw[a:b].tobytes() + end, b - a + 1)
                    if segment.n_ids >= SEGMENT_IDS:
                        yield pa.RecordBatch.from_pylist([segment.row(part, number, size)], schema)
                        segment, number = _Segment(), number + 1
        if segment.lengths:
            yield pa.RecordBatch.from_pylist([segment.row(part, number, size)], schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ascending = F.col("doc_id").asc_nulls_first()
    parts = max(rows.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(parts, ascending).sortWithinPartitions(ascending)
    # small row groups, as a reader holds one of them at a time
    ordered.mapInArrow(segments, SCHEMA).write.option("parquet.block.size", 16 << 20).parquet(path)


def documents_of(segment: dict) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """A segment's doc_ids, the ends of its documents, and its ids; all by select."""
    given, n_docs = segment["docs"], segment["n_docs"]
    ids = [int(d) + segment["first_doc"] for d in elias_fano.select_many(given, np.arange(given["n"])).tolist()]
    ends = elias_fano.select_many(segment["ends"], np.arange(n_docs)).astype(np.int64)
    return [None] * segment["n_null"] + ids, ends, np.frombuffer(segment["ids"], f"<u{segment['id_bytes']}")


def ids_at(segment: dict, i: int) -> np.ndarray:
    """The ids of a segment's ``i``-th document, by two selects."""
    size = segment["id_bytes"]
    start = elias_fano.select(segment["ends"], i - 1) if i else 0
    end = elias_fano.select(segment["ends"], i)
    return np.frombuffer(segment["ids"], f"<u{size}", end - start, start * size)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of token files: doc_id, start, n_tokens, ids_crc32, ids_bytes.

    ``start`` counts the ids of all documents before. ``ids_crc32`` is that of the ids as
    little-endian unsigned 32-bit integers. ``ids_bytes`` is the document's size on disk.
    """
    segments = spark.read.schema(SCHEMA).parquet(path)
    out = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int32()), ("segment", pa.int32()), ("inside", pa.int64())]
        + [("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids_bytes", pa.int64())]
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                segment = batch.slice(k, 1).to_pylist()[0]
                doc_ids, ends, ids = documents_of(segment)
                starts = np.concatenate([[0], ends[:-1]])
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(np.full(n, segment["part"], np.int32)),
                        pa.array(np.full(n, segment["segment"], np.int32)),
                        pa.array(starts),
                        pa.array(ends - starts),
                        pa.array(crc, pa.int64()),
                        pa.array((ends - starts) * segment["id_bytes"]),
                    ],
                    schema=out,
                )

    rows = segments.mapInArrow(
        documents,
        "doc_id bigint, part int, segment int, inside bigint, n_tokens bigint, ids_crc32 bigint, ids_bytes bigint",
    )
    # segments are summed within their part, and parts, one row each, over the table
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("part_start"))
    by_segment = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part", "segment", F.coalesce(F.sum("n_ids").over(by_segment), F.lit(0)).alias("segment_start")
    ).join(parts, "part")
    return rows.join(starts, ["part", "segment"]).select(
        "doc_id",
        (F.col("part_start") + F.col("segment_start") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "ids_bytes",
    )


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token files to a new working folder, and read them back."""
    path = working_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer)
    return read_token_files(docs.sparkSession, path)
