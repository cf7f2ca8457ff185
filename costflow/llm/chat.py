"""Conversations as training texts with loss spans, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import map_batches
from costflow.llm.template import compile_template

#: The strings that steer a model; none of them is left whole in a role or text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")

TEMPLATE = """
{%- for m in messages -%}
<s>{{ m.role | escape }}[INST]
{%- if m.role == "assistant" -%}
  {%- generation -%}{{ m.text | escape }}{%- endgeneration -%}
{%- else -%}
  {{ m.text | escape }}
{%- endif -%}
[/INST]</s>
{%- endfor -%}
"""

_MARKED = re.compile(r"\\|[<\[](?=" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")")
_UNMARKED = re.compile(r"\\(.)|\\", re.DOTALL)
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.DOTALL)


def escape(text: str | None) -> str:
    """A backslash is doubled; one goes behind the first character of a control string."""
    return _MARKED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text or "")


def unescape(text: str) -> str:
    return _UNMARKED.sub(lambda m: m[1] or "", text)


def read_back(formatted: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[str, str]], str]:
    """(role, text) of each turn, and the text under the loss spans."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            raise ValueError(f"text between turns at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError(f"text after the last turn at {at}")
    return turns, "".join(unescape(formatted[a:b]) for a, b in spans)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _format_task(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, texts, spans = zip(*out, strict=True)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            pairs = [[{"start": a, "end": b} for a, b in s] for s in spans]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(pairs, kind)], ["conv_id", "formatted", "loss_spans"]
            )

        size = 0
        for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
            text, spans = render({"messages": [{"role": r[2] or "", "text": r[3] or ""} for r in rows]})
            out.append((conv_id, text, spans))
            size += len(text)
            if size > 1 << 22 or len(out) >= 2000:
                yield flush()
                size = 0
        if out:
            yield flush()

    return run


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, loss_spans) for `turns` (conv_id, turn, role, text).

    One row per conversation, its turns by (turn, role, text); spans are in code
    points, end exclusive. A task streams over sorted turns and holds one
    conversation at a time, which is also one row of the result. Null roles and
    texts are empty, a null conv_id is a conversation of its own, null turns come
    first, repeated rows stay. Other columns are not read. An empty table gives
    an empty one.
    """
    narrow = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        turns["role"].cast("string").alias("role"),
        turns["text"].cast("string").alias("text"),
    )
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>"
    return map_batches(dealt, _format_task(template), schema)


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for conv_id, formatted, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            turns, loss = read_back(formatted, [(s["start"], s["end"]) for s in spans])
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append(
                (conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted))
            )
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted texts back gives, as digests per conversation."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(formatted.select("conv_id", "formatted", "loss_spans"), _digest_task, schema)


def with_probe(turns: DataFrame) -> DataFrame:
    """`turns` plus conversation -1, whose two texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    probe = turns.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
