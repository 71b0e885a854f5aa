"""Conversations as training text with a loss mask, written as files and read back.

A file row is a segment of a conversation's output: its text, and the spans of it that are
generated, in code points. Segments end between two bits of output after about a million
characters, so nearly every conversation has one, and a conversation of any length is
written and read in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm.chat_template import Template, compile_template
from loomwork.llm.kernels import row_slices
from loomwork.shared import working_path

#: Roles, texts and turns are told apart by these.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[/ROLE]")
TEMPLATE = """\
{{ '<s>' }}
{%- for message in messages -%}
  {%- if message.role == 'assistant' -%}
    {% generation %}{{ message.text }}{% endgeneration %}{{ '</s>' }}
  {%- else -%}
    {{ '[INST]' }}{{ message.role }}{{ '[/ROLE]' }}{{ message.text }}{{ '[/INST]' }}
  {%- endif -%}
{%- endfor -%}
"""
#: Characters after which a segment ends.
SEGMENT = 1 << 20
#: Bytes of input that are held as Python objects at once.
HELD = 1 << 22

SCHEMA = "conv_id bigint, segment int, last boolean, text string, spans array<struct<start: bigint, end: bigint>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SEGMENT = pa.schema(
    [("conv_id", pa.int64()), ("segment", pa.int32()), ("last", pa.bool_()), ("text", pa.string())]
    + [("spans", pa.list_(_SPAN))]
)


def segments(template: Template, messages: Iterator[dict], most: int = SEGMENT) -> Iterator[tuple[str, list[dict]]]:
    """The output of a conversation in segments, each with its generated spans."""
    bits, size, spans = [], 0, []
    for text, generated in template.stream(messages=messages):
        if not text:
            continue
        if size and size + len(text) > most:
            yield "".join(bits), spans
            bits, size, spans = [], 0, []
        if generated:
            if spans and spans[-1]["end"] == size:
                spans[-1]["end"] = size + len(text)
            else:
                spans.append({"start": size, "end": size + len(text)})
        bits.append(text)
        size += len(text)
    yield "".join(bits), spans


def write_formatted(conversations: DataFrame, path: str, template: str = TEMPLATE, segment: int = SEGMENT) -> None:
    """Render every conversation and write it to the new folder ``path``.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    not read. Turns are in ascending order, null first; equal turns and repeated rows all
    stay, ordered by role and text. A null role or text is empty. Rows without conv_id
    are one conversation of their own. An empty table gives a folder without rows.

    Texts shuffle once, by conversation. A conversation's turns pass through one task,
    one after the other, as its digests need them in order; that task holds no more than
    a slice of input and a segment of output.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template, CONTROLS)

        def rows() -> Iterator[tuple[int | None, dict]]:
            for batch in batches:
                for start, end in row_slices(batch.column(2), HELD):
                    for conv, role, text in zip(*(c.slice(start, end - start).to_pylist() for c in batch.columns)):
                        yield conv, {"role": role or "", "text": text or ""}

        held, size = [], 0
        for conv, own in groupby(rows(), key=itemgetter(0)):
            before = None
            for number, (text, spans) in enumerate(segments(compiled, map(itemgetter(1), own), segment)):
                if before is not None:
                    held.append(before)
                before = {"conv_id": conv, "segment": number, "last": False, "text": text, "spans": spans}
                size += len(text)
                if size > HELD:
                    yield pa.RecordBatch.from_pylist(held, _SEGMENT)
                    held, size = [], len(text)
            held.append({**before, "last": True})
        if held:
            yield pa.RecordBatch.from_pylist(held, _SEGMENT)

    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), *order[1:])
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)
    dealt.select("conv_id", "role", "text").mapInArrow(run, SCHEMA).write.parquet(path)


class Reader:
    """Reads one conversation back from its output, segment by segment."""

    def __init__(self, template: Template):
        self.template = template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.role: str | None = None
        self.data: list[str] = []

    def _turn(self, role: str, text: str) -> None:
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1

    def add(self, text: str, spans: list[dict]) -> None:
        at = 0
        for control in self.template.controls_in(text):
            self.data.append(text[at : control.start()])
            at = control.end()
            said, self.data = self.template.unescape("".join(self.data)), []
            if control[0] == "[/ROLE]":
                self.role = said
            elif control[0] == "[/INST]":
                self._turn(self.role, said)
            elif control[0] == "</s>":
                self._turn("assistant", said)
            elif said:
                raise ValueError(f"text outside of turns: {said[:40]!r}")
        self.data.append(text[at:])
        self.chars += len(text)
        for span in spans:
            said = self.template.unescape(text[span["start"] : span["end"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)

    def row(self, conv_id: int | None) -> tuple:
        if any(self.data):
            raise ValueError(f"conversation {conv_id} breaks off")
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of written conversations.

    Only conversations of several segments are shuffled.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = compile_template("", CONTROLS)
        reader, conv = None, None
        for batch in batches:
            out = []
            for start, end in row_slices(batch.column(2), HELD):
                part = [c.slice(start, end - start).to_pylist() for c in batch.columns]
                for own, segment, text, spans in zip(*part):
                    if segment == 0:
                        if reader:
                            out.append(reader.row(conv))
                        reader, conv = Reader(template), own
                    reader.add(text, spans)
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], schema=schema)
        if reader:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(reader.row(conv), kinds)], schema=schema)

    written = spark.read.schema(SCHEMA).parquet(path)
    whole = (F.col("segment") == 0) & F.col("last")
    columns = ["conv_id", "segment", "text", "spans"]
    parts = written.where(~whole).repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    ddl = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    single = written.where(whole).select(*columns).mapInArrow(run, ddl)
    return single.unionByName(parts.select(*columns).mapInArrow(run, ddl))


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Write ``conversations`` to a new working folder and read them back."""
    path = working_path(conversations.sparkSession, "formatted")
    write_formatted(conversations, path, template)
    return read_formatted(conversations.sparkSession, path)
