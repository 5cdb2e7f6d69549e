"""Chat formatting: every assistant turn as a training example of its own."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import small_batches, shuffle_parts, text_of

# Strings that mark turns here or in other templates. Fixed values.
CONTROL = ["<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>"]
ESCAPE = "\\"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    """A text in which no control string occurs: the escape sign is doubled, then put behind
    the first sign of each control string. Every escape sign stands before a sign of the
    text, so ``unescape`` gives the text back."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return text


def unescape(text: str) -> str:
    parts, rest = [], text
    while ESCAPE in rest:
        before, _, rest = rest.partition(ESCAPE)
        parts += [before, rest[:1]]
        rest = rest[1:]
    return "".join([*parts, rest])


def turn_text(role: Column, text: Column) -> tuple[Column, Column]:
    """Head and body of a formatted turn; the body ends with the end mark."""
    return F.concat(F.lit("<|"), escape(role), F.lit("|>\n")), F.concat(
        escape(text), F.lit("<|end|>\n")
    )


END = "<|end|>\n"


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith("<|", at):
            raise ValueError("a turn must start with its role")
        close = text.index("|>\n", at)
        stop = text.index(END, close)
        turns.append((unescape(text[at + 2 : close]), unescape(text[close + 3 : stop])))
        at = stop + len(END)
    return turns


EXAMPLES = (
    "conv_id bigint, example bigint, n_turns bigint, text string, loss_start bigint,"
    " loss_end bigint, last boolean"
)


def prefix_examples(turns: DataFrame, target: str = TARGET_ROLE) -> DataFrame:
    """Every turn of the ``target`` role with all turns before it, only its own text trainable.

    ``turns`` has a row per turn (conv_id, turn, role, text). Rows: ``conv_id, example``
    (from 0), ``n_turns`` in the text, the formatted ``text``, and the code points
    ``loss_start`` to ``loss_end`` of it that are trained on (escaped, without marks). Turns
    after the last target turn belong to no example of a target; they are in one more row,
    whose loss span is null, so every turn is in the output. ``last`` marks a conversation's
    row that has all of its turns.

    Turns are spread by conversation, sorted, and passed through once; a task holds the
    text of one conversation so far, which is what its longest example has to hold anyway.

    Null texts and roles count as empty; rows with a null ``conv_id`` are one conversation;
    null turns come first; turns with the same number are in order of role and text, and
    repeated rows are turns of their own; an empty table gives no rows; other columns are
    ignored.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in EXAMPLES.split(",")]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        rows, held = [], 0

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        conv, example, n_turns, prefix, waiting = None, 0, 0, "", None

        def closed():
            """The conversation's last row."""
            if waiting and waiting[2] == n_turns:
                return [(*waiting[:6], True)]
            more = [(*waiting, False)] if waiting else []
            return [*more, (conv, example, n_turns, prefix, None, None, True)]

        for batch in small_batches(frames):
            for conv_id, is_target, head, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n_turns and conv_id != conv:
                    rows += closed()
                    example, n_turns, prefix, waiting = 0, 0, "", None
                conv = conv_id
                n_turns += 1
                start = len(prefix) + len(head)
                prefix += head + body
                if is_target:
                    if waiting:
                        rows.append((*waiting, False))
                        held += len(waiting[3])
                    waiting = (conv, example, n_turns, prefix, start, len(prefix) - len(END))
                    example += 1
                if held > 4_000_000 or len(rows) > 1000:
                    yield batch_of()
                    rows, held = [], 0
        if n_turns:
            rows += closed()
        if rows:
            yield batch_of()

    head, body = turn_text(text_of("role"), text_of("text"))
    ordered = (
        turns.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            text_of("role").alias("role"),
            text_of("text").alias("text"),
        )
        .repartition(shuffle_parts(turns), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", (F.col("role") == F.lit(target)).alias("is_target"), head.alias("head"), body.alias("body"))
    )
    return ordered.mapInArrow(run, EXAMPLES)


def read_back(examples: DataFrame) -> DataFrame:
    """Of each conversation: its turns' digest, its trained text and that text's digest.

    Each example is read by itself: its loss span, and for a conversation's last row all
    turns. Only these go through the shuffle that puts a conversation's loss texts in order.
    Rows: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` (of
    the conversation's whole formatted text).
    """
    import hashlib

    def spans(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(frames):
            out = []
            columns = batch.select(["conv_id", "example", "text", "loss_start", "loss_end", "last"])
            for conv, example, text, start, end, last in zip(*(c.to_pylist() for c in columns.columns), strict=True):
                loss = None if start is None else unescape(text[start:end])
                digest, n_turns = None, None
                if last:
                    parsed = parse(text)
                    n_turns = len(parsed)
                    joined = "".join(f"{role}\n{said}\n" for role, said in parsed)
                    digest = hashlib.sha256(joined.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((conv, example, loss, n_turns, digest, len(text) if last else None))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            names = ["conv_id", "example", "loss", "n_turns", "turns_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def whole(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, digest, chars, any_row = [], None, hashlib.sha256(), 0, False
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in small_batches(frames):
            for conv_id, _, loss, n_turns, turns, formatted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not any_row or conv_id != conv:
                    conv, digest, chars, any_row = conv_id, hashlib.sha256(), 0, True
                if loss is not None:
                    digest.update(loss.encode("utf-8", "surrogatepass"))
                    chars += len(loss)
                if n_turns is not None:  # the conversation's last row
                    out.append((conv, n_turns, turns, chars, digest.hexdigest(), formatted))
            if out:
                yield batch_of()
                out = []

    schema = "conv_id bigint, example bigint, loss string, n_turns bigint, turns_sha256 string, formatted_chars bigint"
    found = examples.mapInArrow(spans, schema)
    ordered = found.repartition(shuffle_parts(examples), "conv_id").sortWithinPartitions("conv_id", "example")
    return ordered.mapInArrow(
        whole,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint,"
        " loss_sha256 string, formatted_chars bigint",
    )
