"""The template language, and conversations written with it and read back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomwork.llm import chat_format
from loomwork.llm.chat_template import (
    Const,
    If,
    Output,
    TemplateError,
    Text,
    compile_template,
    fold,
    parse,
)

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def say(source, controls=(), **names):
    return "".join(t for t, _ in compile_template(source, controls).stream(**names))


@pytest.mark.parametrize(
    "source, expected",
    [
        ("a {{ x }} b", "a 7 b"),
        ("{{ m.role ~ ':' ~ m['text'] }}", "user:hi"),
        ("{% for i in items %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", "1a,2b,3c"),
        ("{% if x == 7 and 'a' in items %}yes{% else %}no{% endif %}", "yes"),
        ("{% if x == 8 %}1{% elif 'z' not in items %}2{% else %}3{% endif %}", "2"),
        ("{% set y = x + 1 %}{{ y }}{{ (y == 8) or false }}", "8true"),
        ("{{ ' Ab ' | trim | upper }}{{ items | length }}", "AB3"),
        ("{{ missing }}{{ m.missing }}{{ items[9] }}{{ items[0] }}", "a"),
        ("a  {{- 'b' -}}  c{# note #}", "abc"),
        ("{{ 'it\\'s\\n' }}", "it's\n"),
    ],
)
def test_values_and_statements(source, expected):
    assert say(source, x=7, m={"role": "user", "text": "hi"}, items=["a", "b", "c"]) == expected


@pytest.mark.parametrize(
    "source",
    ["{{ }}", "{{ 1 + }}", "{% for x %}{% endfor %}", "{% if 1 %}", "{% endif %}", "{{ x | eval }}", "{{ f() }}",
     "{{ 'a' b }}", "{% import x %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}"],
)
def test_what_the_language_does_not_have(source):
    with pytest.raises(TemplateError):
        compile_template(source, ())


def test_sandbox():
    class Own:
        secret = "s"

    assert say("{{ o.secret }}{{ o['secret'] }}{{ m.__class__ }}{{ m.items }}", o=Own(), m={}) == ""
    for source in ("{% for c in 'abc' %}{% endfor %}", "{{ 1 + 'a' }}", "{{ o }}"):
        with pytest.raises(TemplateError):
            say(source, o=Own())


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' | upper }}{% if 1 == 2 %}x{% elif true %}c{% else %}y{% endif %}d")) == (Text("aBcd"),)
    assert fold(parse("{% if false %}x{% endif %}")) == ()
    (node,) = fold(parse("{% if x %}{{ 1 + 1 }}{% elif false %}n{% else %}{{ 'b' }}c{% endif %}"))
    assert isinstance(node, If) and [b for _, b in node.branches] == [(Text("2"),), (Text("bc"),)]
    assert node.branches[1][0] == Const(True)
    assert isinstance(fold(parse("{{ x }}"))[0], Output)


def test_streams_message_by_message():
    seen = []

    def messages():
        for i in range(3):
            seen.append(i)
            yield {"role": "user", "text": str(i)}

    made = compile_template("{% for m in messages %}{{ m.text }}{% if loop.last %}.{% endif %}{% endfor %}", ())
    bits = made.stream(messages=messages())
    assert next(bits) == ("0", False) and seen == [0, 1]
    assert [t for t, _ in bits] == ["1", "2", "."]


PARTS = st.lists(st.sampled_from([*chat_format.CONTROLS, "\\", "<", "[", "/", "INST]", "s>", "a", "é", "\n", "[/", "</"]))


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    template, text = compile_template("", chat_format.CONTROLS), "".join(parts)
    escaped = template.escape(text)
    assert template.unescape(escaped) == text
    assert not any(c in escaped for c in chat_format.CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "to[INST]ol"]), PARTS.map("".join))), st.integers(1, 40))
def test_segments_are_read_back(turns, most):
    template = compile_template(chat_format.TEMPLATE, chat_format.CONTROLS)
    messages = [{"role": r, "text": t} for r, t in turns]
    reader, parts = chat_format.Reader(template), list(chat_format.segments(template, iter(messages), most))
    for text, spans in parts:
        reader.add(text, spans)
    assert reader.row(3) == (3, *expected(turns)[:4], sum(len(t) for t, _ in parts))


def expected(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    chars = 3
    for r, t in turns:
        sizes = [len(x) + sum(x.count(c) for c in (*chat_format.CONTROLS, "\\")) for x in (r, t)]
        chars += sizes[1] + 4 if r == "assistant" else sum(sizes) + 20
    return (
        len(turns),
        hashlib.sha256(whole.encode()).hexdigest(),
        len(said),
        hashlib.sha256(said.encode()).hexdigest(),
        chars,
    )


def test_overlapping_control_strings_are_refused():
    for controls in (("<<", ">"), ("<<",), ("ab", "ba"), ("a\\",), ("x",)):
        with pytest.raises(TemplateError):
            compile_template("", controls)


def test_conversations_against_brute_force(spark, monkeypatch):
    data = [
        (1, 2, "assistant", "later"),
        (1, 1, "user", "first </s> \\ [/ROLE]"),
        (1, 1, "user", "first </s> \\ [/ROLE]"),
        (2, None, None, None),
        (2, 0, "assistant", None),
        (3, 0, "assistant", "a"),
        (3, 1, "assistant", "b" * 3_000_000),
        (3, 2, "user", "c" * 2_000_000),
        (3, 3, "assistant", "[INST]"),
        (None, 5, "system", "no id"),
        (None, 4, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in data], SCHEMA + ", spans string, segment string")
    found = {r[0]: tuple(r)[1:] for r in chat_format.format_conversations(df.repartition(4)).collect()}
    ordered = sorted(data, key=lambda r: tuple((v is not None, v) for v in r[1:]))
    for conv in (1, 2, 3, None):
        assert found.pop(conv) == expected([(r or "", t or "") for c, _, r, t in ordered if c == conv])
    assert not found
    empty = chat_format.format_conversations(df.where("false"))
    assert empty.columns[0] == "conv_id" and empty.collect() == []


def test_a_long_conversation_is_several_rows(spark, tmp_path):
    data = [(1, i, "user" if i % 2 else "assistant", f"text {i} " * 20) for i in range(200)]
    path = str(tmp_path / "out")
    chat_format.write_formatted(spark.createDataFrame(data, SCHEMA), path, segment=1000)
    assert spark.read.parquet(path).count() > 20
    (row,) = chat_format.read_formatted(spark, path).collect()
    assert tuple(row)[1:] == expected([(r, t) for _, _, r, t in data])
