"""Alignment of two tokenizers: which ids of the one cover the same bytes as which of the other.

Tokenizer A is a byte-level vocabulary of the tokenizers library, B a sentencepiece model
that puts a space before a text; both encode a space and the text. Ends of tokens in
bytes go into one dictionary for each tokenizer. Ends that both dictionaries have cut the
two id lists into groups, and the links within a group join every two tokens whose bytes
overlap.

Neither tokenizer joins what stands before a single space with what stands behind it
(``Pair`` verifies that of B's vocabulary), so the alignment of a text is that of its
pieces between spaces, one after the other. A slice of texts is cut in Arrow, and only its
distinct pieces are encoded and aligned, many in one go. Texts with other runs of white
space are aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.kernels import row_slices
from loomwork.shared import cut_lineage

#: Bytes of text that are aligned as one slice, or one text.
SLICE = 8 << 20
#: Bytes of distinct pieces that are encoded at once.
ENCODED_AT_ONCE = 1 << 16
#: Fixed value: the character that stands for a space in B's pieces.
SPACE = "▁"
#: Fixed value: where byte-level vocabularies split a text before any merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes, in ascending
    order, for the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str):
    """The byte-level vocabulary of a tokenizers file as an encoder of the tiktoken library.

    It gives the same ids several times faster, and takes special tokens in a text for
    plain text. A file that says more than a rank for each id is an error.
    """
    import tiktoken

    model = json.loads(Path(path).read_text())
    split, rules = model["pre_tokenizer"], model["model"]
    alphabet = byte_alphabet()
    special = {t["content"] for t in model["added_tokens"]}
    ranks = {
        bytes(map(alphabet.__getitem__, token)): i for token, i in rules["vocab"].items() if token not in special
    }
    merges = [m.split(" ") if isinstance(m, str) else m for m in rules["merges"]]
    made = [rules["vocab"][a + b] for a, b in merges]
    plain = split == {**split, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if not plain or model["normalizer"] or rules["ignore_merges"] or made != sorted(made) or len(ranks) != 256 + len(made):
        raise ValueError(f"{path} is no plain byte-level vocabulary")
    return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = byte_level(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.bytes_b = [self._bytes_b(i) for i in range(self.b.vocab_size())]
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        #: Ids of A, then ids of B, as they are written within and at the end of their group.
        self.inner_b, self.last_a, self.last_b = (k * self.a.n_vocab for k in (2, 1, 2))
        self.last_b += self.b.vocab_size()
        self.written = pa.array(
            [f"{i}{sign}" for sign in ",|" for i in range(len(self.bytes_a))]
            + [f"{i}{sign}" for sign in ",;" for i in range(len(self.bytes_b))],
            pa.large_string(),
        )
        #: Whether a space always begins a piece of B, so that texts may be cut at spaces.
        self.separable = not any(
            SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(self.b.vocab_size())
        )

    def _bytes_b(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    def encode_a(self, text: str) -> list[int]:
        """Ids of a space and the text."""
        return self.a.encode_ordinary(" " + text)

    def encode_b(self, text: str) -> list[int]:
        """Ids of the text, before which B puts a space."""
        return self.b.encode([text], num_threads=1)[0]

    def same_bytes(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether both id lists spell a space and the text."""
        spelt = b" " + text.encode()
        a, b = self.bytes_a, self.bytes_b
        return b"".join([a[i] for i in ids_a]) == spelt and b"".join([b[i] for i in ids_b]) == spelt


@dataclass
class Aligned:
    """Groups and links of two id lists that spell the same bytes."""

    ends: np.ndarray  # of the groups, in bytes
    from_a: np.ndarray  # each group's first token of A, and their number at last
    from_b: np.ndarray
    link_a: np.ndarray  # place of A's token of each link, in the order of the bytes
    link_b: np.ndarray
    link_ends: np.ndarray  # where the bytes that both tokens cover end


def align(ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """Align two id lists by the sizes of their ids in bytes.

    The common keys of two end-to-index dictionaries are the ends of groups. Within a
    group no inner end is common, so every stretch between two neighbouring ends of
    either list is the overlap of exactly one token of A and one of B: a link.
    """
    ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b])
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = sorted(index_a.keys() & index_b.keys())
    stretches = np.union1d(ends_a, ends_b)
    return Aligned(
        np.array(common, dtype=np.int64),
        np.array([0, *map(index_a.__getitem__, common)], dtype=np.int64),
        np.array([0, *map(index_b.__getitem__, common)], dtype=np.int64),
        np.searchsorted(ends_a, stretches),
        np.searchsorted(ends_b, stretches),
        stretches,
    )


class Items:
    """What is known of a slice's distinct pieces and whole texts, item by item."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.ok = [np.zeros(0, dtype=bool)]
        self.counts = [np.zeros((0, 4), dtype=np.int64)]  # columns n_a, n_b, n_groups, n_links
        self.groups = [pa.array([], pa.large_string())]  # with a sign behind each group
        self.links = [np.zeros((2, 0), dtype=np.int64)]

    def add(self, pieces: pa.Array) -> None:
        """Encode and align pieces as one text in which spaces divide them.

        Where the ids do not spell that text, every piece is looked at alone, and one
        whose own ids do not spell it has no tokens.
        """
        pair, text = self.pair, " ".join(pieces.to_pylist())
        list_a, list_b = pair.encode_a(text), pair.encode_b(text)
        if not pair.same_bytes(text, list_a, list_b):
            if len(pieces) > 1:
                half = len(pieces) // 2
                self.add(pieces[:half])
                self.add(pieces[half:])
                return
            self.ok.append(np.zeros(1, dtype=bool))
            self.counts.append(np.zeros((1, 4), dtype=np.int64))
            self.groups.append(pa.array([""], pa.large_string()))
            return
        ids_a, ids_b = np.array(list_a, dtype=np.int64), np.array(list_b, dtype=np.int64)
        found = align(ids_a, ids_b, pair.sizes_a, pair.sizes_b)
        # each piece ends with a group, as its end is one of both tokenizers
        ends = np.cumsum(pc.binary_length(pieces).to_numpy() + 1)
        last = np.searchsorted(found.ends, ends) + 1
        if last[-1] != len(found.ends) or (found.ends[last - 1] != ends).any():
            raise ValueError("tokens cross the spaces between pieces")
        self.ok.append(np.ones(len(pieces), dtype=bool))
        links = np.searchsorted(found.link_ends, ends, "right")
        sizes = [found.from_a[last], found.from_b[last], last, links]
        self.counts.append(np.stack([np.diff(x, prepend=0) for x in sizes], axis=1))
        self.groups.append(self._written(ids_a, ids_b, found, last))
        self.links.append(np.stack([ids_a[found.link_a], ids_b[found.link_b]]))

    def _written(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Aligned, last: np.ndarray) -> pa.Array:
        """The groups of each piece: A's ids, then B's, with the sign that follows each."""
        pair, from_a, from_b = self.pair, found.from_a, found.from_b
        tokens = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        signs_a, signs_b = ids_a.copy(), ids_b + pair.inner_b
        signs_a[from_a[1:] - 1] += pair.last_a
        signs_b[from_b[1:] - 1] = ids_b[from_b[1:] - 1] + pair.last_b
        tokens[np.arange(len(ids_a)) + np.repeat(from_b[:-1], np.diff(from_a))] = signs_a
        tokens[np.arange(len(ids_b)) + np.repeat(from_a[1:], np.diff(from_b))] = signs_b
        taken = pair.written.take(pa.array(tokens))
        starts = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :]
        cuts = starts[np.concatenate([[0], from_a[last] + from_b[last]])]
        return pa.LargeStringArray.from_buffers(len(last), pa.py_buffer(cuts.tobytes()), taken.buffers()[2])

    def add_all(self, pieces: pa.Array) -> None:
        for start, end in row_slices(pieces, ENCODED_AT_ONCE):
            self.add(pieces[start:end])


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … of every range, one range after the other."""
    total = int(lengths.sum())
    ahead = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ahead, lengths)


def _pieces(texts: pa.Array, separable: bool) -> tuple[np.ndarray, pa.Array, np.ndarray, int]:
    """For texts without nulls: the item of every piece, the items (pieces, then whole
    texts), the texts' bounds, and the number of pieces among the items.

    An empty text has no piece. A text in which a space begins, ends or meets other white
    space is one item of its own.
    """
    cut = pc.split_pattern(texts, " ")
    flat = pc.list_flatten(cut).dictionary_encode()
    items, index = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    per = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    odd = pc.match_substring_regex(items, r"^$|^\s|\s$|^[\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}]|[\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}]$")
    odd = odd.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), per)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    whole = np.bincount(owner[odd[index]], minlength=len(texts)).astype(bool) & ~empty
    if not separable:
        whole = ~empty
    keep = ~(whole | empty)[owner]
    # items that only whole texts have are left out
    used = np.unique(index[keep])
    place = np.zeros(len(items), dtype=np.int64)
    place[used] = np.arange(len(used))
    rows = np.flatnonzero(whole)
    all_index = np.concatenate([place[index[keep]], len(used) + np.arange(len(rows))])
    all_owner = np.concatenate([owner[keep], rows])
    order = np.argsort(all_owner, kind="stable")
    per = np.bincount(all_owner, minlength=len(texts))
    taken = pa.concat_arrays([items.take(pa.array(used)), texts.take(pa.array(rows))])
    return all_index[order], taken, np.concatenate([[0], np.cumsum(per)]), len(used)


def align_slice(pair: Pair, texts: pa.Array) -> dict:
    """All that the corpus-wide step needs of a slice of texts.

    Per text n_a, n_b, n_groups, n_links and the digest of its groups; the distinct id
    pairs with the number of texts that hold them; and for each text its distinct pairs
    with the number of links.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    index, items, bounds, pieces = _pieces(texts, pair.separable)
    known = Items(pair)
    known.add_all(items[:pieces])
    for i in range(pieces, len(items)):
        known.add(items[i : i + 1])
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    counts, ok = np.concatenate(known.counts), np.concatenate(known.ok)
    links_a, links_b = np.concatenate(known.links, axis=1)
    # a text with one piece that the ids do not spell has no tokens at all
    spelt = np.bincount(owner[~ok[index]], minlength=n) == 0
    some = spelt & (np.diff(bounds) > 0)
    index, owner = index[spelt[owner]], owner[spelt[owner]]
    sums = [np.bincount(owner, weights=counts[index, k], minlength=n).astype(np.int64) for k in range(4)]

    # digests
    values = pa.concat_arrays(known.groups).take(pa.array(index))
    ends, written = np.zeros(1, np.int64), memoryview(b"")
    if len(values):
        ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        written = memoryview(values.buffers()[2])
    cuts = ends[np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])].tolist()
    # without the last sign that divides groups
    digests = [
        hashlib.sha256(written[i : j - 1]).hexdigest() if good else ""
        for i, j, good in zip(cuts, cuts[1:], some.tolist())
    ]

    # distinct pairs
    keys, local = np.unique((links_a << 32) | links_b, return_inverse=True)
    first = np.cumsum(counts[:, 3]) - counts[:, 3]
    lengths = counts[index, 3]
    held = local[_ragged(first[index], lengths)]
    found, times = np.unique(np.repeat(owner, lengths) * max(len(keys), 1) + held, return_counts=True)
    rows, pairs = np.divmod(found, max(len(keys), 1))
    return {
        "n_a": sums[0],
        "n_b": sums[1],
        "n_groups": sums[2],
        "n_links": sums[3],
        "groups_sha256": digests,
        "a": (keys >> 32).astype(np.int32),
        "b": (keys & 0xFFFFFFFF).astype(np.int32),
        "texts": np.bincount(pairs, minlength=len(keys)),
        "bounds": np.searchsorted(rows, np.arange(n + 1)),
        "pairs": pairs.astype(np.int32),
        "times": times.astype(np.int32),
    }


def _pair(path_a: str, path_b: str) -> Pair:
    """The worker's tokenizers, which later tasks of the same worker find again."""
    kept = sys.modules.setdefault("_llm_pairs", types.ModuleType("_llm_pairs"))
    if (path_a, path_b) not in kept.__dict__:
        kept.__dict__[path_a, path_b] = Pair(path_a, path_b)
    return kept.__dict__[path_a, path_b]


_TEXT = pa.struct(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string())]
)
_SLICE = pa.schema(
    [("slice", pa.int64()), ("documents", pa.list_(_TEXT))]
    + [(c, pa.list_(pa.int32())) for c in ("a", "b")]
    + [("texts", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("bounds", "pairs", "times")]
)
_SLICE_DDL = (
    "slice bigint, documents array<struct<doc_id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, "
    "n_links: bigint, groups_sha256: string>>, a array<int>, b array<int>, texts array<bigint>, "
    "bounds binary, pairs binary, times binary"
)


def aligned_slices(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row per slice of texts, as ``align_slice`` makes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = _pair(tokenizer_a, tokenizer_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, end in row_slices(batch.column(1), SLICE):
                made = align_slice(pair, batch.column(1).slice(start, end - start))
                ids = batch.column(0).slice(start, end - start)
                per_text = [pa.array(made[f.name], f.type) for f in list(_TEXT)[1:]]
                texts = pa.StructArray.from_arrays([ids, *per_text], fields=list(_TEXT))
                one = pa.array([0, end - start], pa.int32())
                span = pa.array([0, len(made["a"])], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.ListArray.from_arrays(one, texts)]
                    + [pa.ListArray.from_arrays(span, pa.array(made[c], pa.int32())) for c in ("a", "b")]
                    + [pa.ListArray.from_arrays(span, pa.array(made["texts"], pa.int64()))]
                    + [
                        pa.array([made[c].astype(kind).tobytes()], pa.binary())
                        for c, kind in (("bounds", "<i8"), ("pairs", "<i4"), ("times", "<i4"))
                    ],
                    schema=_SLICE,
                )
                number += 1

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _SLICE_DDL)


def pair_counts(slices: DataFrame) -> DataFrame:
    """a, b, n, best: how many texts hold each linked pair, and whether no pair of ``a`` is in more.

    Slices have summed their texts already, so a frequent pair has one row per slice.
    """
    pairs = slices.select(F.explode(F.arrays_zip("a", "b", "texts")).alias("p")).select("p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("texts").alias("n"))
    of_a = F.max("n").over(Window.partitionBy("a"))
    return counts.select("a", "b", "n", (F.col("n") == of_a).alias("best"))


def alignments(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null or empty
    text, and one that the ids of either tokenizer do not spell, has zeros and ''. A null
    doc_id stays, a repeated one has one row per text, and an empty table gives an empty
    one. The paths are those of vocabulary files that every executor has.

    Texts do not shuffle. What a slice knows of its texts is written once; its distinct
    pairs go to the corpus-wide counts and come back as one list per slice, which is no
    longer than the slice has links.
    """
    slices = cut_lineage(aligned_slices(docs, tokenizer_a, tokenizer_b))
    counts = pair_counts(slices)
    wanted = slices.select("slice", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p"))
    wanted = wanted.select("slice", "at", "p.a", "p.b")
    known = wanted.join(counts, ["a", "b"]).groupBy("slice")
    known = known.agg(F.collect_list(F.struct("at", "n", "best")).alias("known"))
    rows = slices.select("slice", "documents", "bounds", "pairs", "times").join(known, "slice", "left")
    out = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        + [("groups_sha256", pa.string())]
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                documents = batch.column("documents")[k].values
                pairs, times = (np.frombuffer(batch.column(c)[k].as_buffer(), "<i4") for c in ("pairs", "times"))
                bounds = np.frombuffer(batch.column("bounds")[k].as_buffer(), "<i8")
                listed = batch.column("known")[k].values
                n = np.zeros(0 if listed is None else len(listed), dtype=np.int64)
                best = np.zeros(len(n), dtype=np.int64)
                if len(n):
                    at = listed.field("at").to_numpy()
                    n[at] = listed.field("n").to_numpy()
                    best[at] = listed.field("best").to_numpy(zero_copy_only=False)
                sums = []
                for values in (best, n):
                    added = np.concatenate([[0], np.cumsum(values[pairs] * times)])
                    sums.append(pa.array(added[bounds[1:]] - added[bounds[:-1]], pa.int64()))
                fields = [documents.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([*fields, *sums, documents.field("groups_sha256")], schema=out)

    return rows.mapInArrow(
        finish,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
        "count_sum bigint, groups_sha256 string",
    )
