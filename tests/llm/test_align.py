"""Alignment of two tokenizers against whole texts, token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from loomwork.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def tokens(text):
    """Ids and bytes of both tokenizers, by the libraries that own the files; None if they spell other bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    if "own" not in tokens.__dict__:
        tokens.own = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        tokens.own[0].encode_special_tokens = True
    a, b = tokens.own
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    alphabet = align.byte_alphabet()
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)
    ]
    if not text or any(b"".join(x) != b" " + text.encode() for x in (bytes_a, bytes_b)):
        return None
    return ids_a, bytes_a, ids_b, bytes_b


def aligned(text):
    """The groups as text, and the id pairs of all links with their numbers."""
    found = tokens(text or "")
    if found is None:
        return None
    ids_a, bytes_a, ids_b, bytes_b = found

    def spans(pieces):
        at, out = 0, []
        for p in pieces:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    spans_a, spans_b = spans(bytes_a), spans(bytes_b)
    common = {e for _, e in spans_a} & {e for _, e in spans_b}
    groups, own_a, own_b, k = [], [], [], 0
    for (_, end), i in zip(spans_a, ids_a):
        own_a.append(str(i))
        if end in common:
            while True:
                own_b.append(str(ids_b[k]))
                k += 1
                if spans_b[k - 1][1] == end:
                    break
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
            own_a, own_b = [], []
    links, near = Counter(), 0
    for (start, end), i in zip(spans_a, ids_a):
        while spans_b[near][1] <= start:
            near += 1
        j = near
        while j < len(spans_b) and spans_b[j][0] < end:
            links[i, ids_b[j]] += 1
            j += 1
    return len(ids_a), len(ids_b), groups, links


def brute(texts):
    found = [aligned(t) for t in texts]
    counts, best = Counter(), defaultdict(int)
    for f in found:
        if f:
            counts.update(f[3].keys())
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append(
            (
                n_a,
                n_b,
                len(groups),
                sum(links.values()),
                sum(n for p, n in links.items() if counts[p] == best[p[0]]),
                sum(n * counts[p] for p, n in links.items()),
                hashlib.sha256(";".join(groups).encode()).hexdigest(),
            )
        )
    return out


HARD = [
    None,
    "",
    " ",
    "  ",
    "a",
    " a",
    "a ",
    "a  b",
    "a\n b",
    "a \nb",
    "a  b",
    "a  b c",
    "▁ own",
    "own▁sign here",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "😀 naïve ﬁ ́̂ 日本語 текст",
    "it's we'll ''s 's' 12345 1 2 3 ...!? --",
    "\x00 \x1c a\x1c b \x85 c",
    "x" * 5000,
    "tab\tseparated\tvalues and\r\nlines\n\n\nhere",
    "same words same words same words",
    "same words same words same words",
    "unité " * 400,
]


def rows(spark, texts, parts=3):
    data = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id bigint, text string").repartition(parts)


def result(df):
    return {r.doc_id: tuple(r[c] for c in [*FIELDS, "groups_sha256"]) for r in df.collect()}


def test_hard_texts_against_brute_force(spark):
    assert result(align.alignments(rows(spark, HARD), A, B)) == dict(enumerate(brute(HARD)))


def test_random_texts_against_brute_force(spark):
    rng = random.Random(5)
    signs = list("abcdeé日́ .,'\n\t▁0") + [" ", " ", " the", " of", " "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(400)]
    assert result(align.alignments(rows(spark, texts), A, B)) == dict(enumerate(brute(texts)))


def test_small_slices_and_chunks_give_the_same(spark, monkeypatch):
    whole = result(align.alignments(rows(spark, HARD), A, B))
    monkeypatch.setattr(align, "SLICE", 64)
    monkeypatch.setattr(align, "ENCODED_AT_ONCE", 16)
    assert result(align.alignments(rows(spark, HARD), A, B)) == whole


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = dict(zip(texts, brute(texts.values())))
    assert result(align.alignments(docs, A, B)) == expected


def test_empty_table_null_ids_and_clashing_columns(spark):
    empty = rows(spark, ["a"]).where("false")
    assert align.alignments(empty, A, B).collect() == []
    data = [(None, "a b", "x", 1), (None, "a b", "y", 2), (7, None, "z", 3)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, slice string, n_a int")
    found = align.alignments(docs, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    one = brute(["a b", "a b"])[0]
    assert sorted((tuple(r) for r in found.collect()), key=str) == [(7, *[0] * 6, ""), *[(None, *one)] * 2]


def test_another_kind_of_vocabulary_is_refused():
    with pytest.raises(ValueError):
        align.byte_level(public_tokenizers.path("word_bpe_49k.json"))
