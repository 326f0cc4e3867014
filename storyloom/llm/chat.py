"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are context, only that reply is trainable.
An example is stored as the segment that it adds to the one before it, so a conversation of n turns takes space in
proportion to its length; `whole_examples` streams the examples whole, `read_back` reads the digests from these, and
`full_text` puts a single one together again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, small_batches

START, HEAD, END = "<s>[", "]\n", "</s>"
TRAINED = "assistant"
_ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\o", "]": "\\c"}
_BACK = {v[1]: k for k, v in _ESCAPES.items()}
_TURN = re.compile(r"<s>\[([^\]]*)\]\n([^<]*)</s>")
SEGMENTS = "conv_id bigint, example bigint, segment string, prefix_chars bigint, loss_start bigint, loss_chars bigint, last boolean"


def escape(text: str) -> str:
    """No '<', '[' or ']' is left, so no control string can stand in a text."""
    for raw, safe in _ESCAPES.items():
        text = text.replace(raw, safe)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.S)


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 256, chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Batches of size rows, or fewer where their strings reach chars code points."""
    held: list[tuple] = []
    room = chars
    for row in rows:
        held.append(row)
        room -= sum(len(v) for v in row if isinstance(v, str))
        if len(held) == size or room <= 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, room = [], chars
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_SEGMENT_SCHEMA = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("segment", pa.string()), ("prefix_chars", pa.int64()), ("loss_start", pa.int64()), ("loss_chars", pa.int64()), ("last", pa.bool_())])


def expand(turns: DataFrame) -> DataFrame:
    """conv_id, example, segment, prefix_chars, loss_start, loss_chars, last: a row for each assistant turn.

    prefix_chars: code points of the context before the segment.  loss_start, loss_chars: the reply within the
    segment, escaped, without its end mark.  Turns after the last reply make a row with no loss (loss_start null),
    as does a conversation without replies.  last marks a conversation's last row.  Rows come in order of turn,
    then role and text, nulls first; null texts and roles count as empty; rows of a null conv_id are one
    conversation; a repeated row is a turn of its own.  Other columns are ignored; no rows give no rows.
    Rows are streamed: memory holds the turns of one segment.
    """
    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, held = (), None  # held: a finished segment, given out once it is known whether it is the last
        for conv, role, text in _rows(batches, ("conv_id", "role", "text")):
            if (conv,) != at:
                if held:
                    yield (*held, True)
                elif at:
                    yield (at[0], example, "".join(parts), prefix, None, 0, True)
                at, held, parts, size, prefix, example = (conv,), None, [], 0, 0, 0
            if held:
                yield (*held, False)
                held = None
            head, body = START + escape(role) + HEAD, escape(text)
            parts += [head, body, END]
            size += len(head) + len(body) + len(END)
            if role == TRAINED:
                held = (conv, example, "".join(parts), prefix, size - len(END) - len(body), len(body))
                prefix, example, parts, size = prefix + size, example + 1, [], 0
        if held:
            yield (*held, True)
        elif at:
            yield (at[0], example, "".join(parts), prefix, None, 0, True)

    small_batches(spark)
    return rows.mapInArrow(lambda batches: _batched(segments(batches), _SEGMENT_SCHEMA), SEGMENTS)


def whole_examples(segments: DataFrame, rest: bool = False) -> DataFrame:
    """conv_id, example, text, loss_start, loss_chars: every example whole, context and reply, from expand()'s rows as they come.

    loss_start counts from the start of text.  Turns after the last reply are no example; with rest they too make a row,
    the whole conversation with no loss (loss_start null).  Must follow expand() with no shuffle between; memory holds one
    conversation and a batch of its examples.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_chars", pa.int64())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        text = ""
        for conv, example, segment, prefix, start, chars, last in _rows(batches, ("conv_id", "example", "segment", "prefix_chars", "loss_start", "loss_chars", "last")):
            text += segment
            if start is not None:
                yield conv, example, text, prefix + start, chars
            elif rest:
                yield conv, example, text, None, 0
            if last:
                text = ""

    return segments.mapInArrow(lambda batches: _batched(whole(batches), schema), "conv_id bigint, example bigint, text string, loss_start bigint, loss_chars bigint")


def full_text(segments: list[str], example: int) -> str:
    """The whole text of an example from its conversation's segments in order."""
    return "".join(segments[: example + 1])


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from expand()'s rows as they come.

    They are expanded to whole examples, and read from these.  Must follow expand() with no shuffle between.
    """
    return read_examples(whole_examples(segments, rest=True))


def read_examples(examples: DataFrame) -> DataFrame:
    """read_back()'s columns from whole_examples()' rows with rest, as they come.

    Every example must hold the one before it as the start of its context, and its loss must be its last turn's text; else
    this fails.  So a turn counts once, in the first example that holds it, and formatted_chars is the longest's length.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, text = (), ""
        for conv, example, whole, start, chars in _rows(batches, ("conv_id", "example", "text", "loss_start", "loss_chars")):
            if (conv,) != at:
                if at:
                    yield at[0], n, turns.hexdigest(), n_loss, losses.hexdigest(), len(text)
                at, text, turns, losses, n, n_loss = (conv,), "", hashlib.sha256(), hashlib.sha256(), 0, 0
            if not whole.startswith(text):
                raise ValueError(f"example {example} of conversation {conv} lacks the context of the one before it")
            end, text, span = len(text), whole, None
            while end < len(text):
                turn = _TURN.match(text, end)
                if not turn:
                    raise ValueError(f"example {example} of conversation {conv} has no turn at {end}")
                turns.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
                n, end, span = n + 1, turn.end(), turn.span(2)
            if start is not None:
                if span != (start, start + chars):
                    raise ValueError(f"the loss of example {example} of conversation {conv} is not its last turn")
                loss = unescape(text[start : start + chars])
                losses.update(loss.encode())
                n_loss += len(loss)
        if at:
            yield at[0], n, turns.hexdigest(), n_loss, losses.hexdigest(), len(text)

    return examples.mapInArrow(lambda batches: _batched(digests(batches), schema), "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
