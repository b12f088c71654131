"""Conversations as training examples: every assistant turn becomes an example of its own, with
all preceding turns as context and only that reply trainable.

A turn is written as `<|im_start|>role`, a line feed, the text, `<|im_end|>` and a line feed. In
texts and roles a backslash becomes `\\b` and the bar of `<|` becomes `\\p`, so no control string
is left in them; in roles a line feed becomes `\\n`. Three replacements undo that.

Example k is the conversation's formatted text up to the end of reply k, and is written out in
full with the span of its loss mask. The examples of a conversation together grow with the
square of its turns, so an example longer than `PART_CHARS` is written as several rows, its
parts: a row holds the turns that begin within one such stretch of the conversation and is made
with others like it by a join on conversation and stretch, however long the conversation. The
turns themselves are stored too, a row each with its place in code points; those after the last
reply are context of no example.

Turns are range-sorted and numbered within slices of balanced size; what a slice must add for
the conversation that it continues comes from sums over slices. So one conversation with a third
of all rows is shared by many tasks. Only its digest in the query is read by one, as a stream.

Rows: turns are in the order of `turn`, a missing one first, ties by role and digest of the text;
repeated rows are turns of their own; rows without conv_id are one conversation. A missing text
or role is empty. Every role but `assistant` is context. A conversation without assistant
turns gives no example. An empty table gives an empty result. Only the four columns are read, so
further columns cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import SLICE, by_slice, slice_offsets
from ..sources.staging import staged_path
from .common import column, doc_key, numbers, own_id, ship

START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"
_ESCAPES = (("\\", "\\b"), ("<|", "<\\p"))
_COUNTED = ("turns", "chars", "replies")
#: Turns that begin within so many code points of a conversation share a row of an example.
PART_CHARS = 1 << 16


def _replaced(value: Column, pairs) -> Column:
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def escaped(text: Column) -> Column:
    return _replaced(text, _ESCAPES)


def unescaped(text: Column) -> Column:
    return _replaced(text, (("\\n", "\n"), ("\\p", "|"), ("\\b", "\\")))


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """Each turn as formatted text, its length, where its text begins, whether it is trained."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), _replaced(escaped(role), [("\n", "\\n")]), F.lit("\n"))
    return conversations.select(
        doc_key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), F.md5(text).alias("tie"),
        F.concat(head, escaped(text), F.lit(END + "\n")).alias("formatted"),
        F.char_length(head).cast("long").alias("head"), (role == TRAINED).alias("trained"),
    ).withColumn("chars", F.char_length("formatted").cast("long"))


def _number(batches):
    """Turns, characters and replies before each row: within its slice, and in its conversation
    as far as the slice has it. Rows come in order."""
    part, last = TaskContext.get().partitionId(), None
    total, begun = np.zeros(3, np.int64), np.zeros(3, np.int64)
    for batch in batches:
        conv, rows = numbers(batch, "conv"), batch.num_rows
        if not rows:
            continue
        each = np.stack([np.ones(rows, np.int64), numbers(batch, "chars").astype(np.int64),
                         numbers(batch, "trained").astype(np.int64)])
        before = np.cumsum(each, axis=1) - each + total[:, None]
        new = np.ones(rows, bool)
        new[1:] = conv[1:] != conv[:-1]
        new[0] = conv[0] != last
        first = np.maximum.accumulate(np.where(new, np.arange(rows), -1))
        start = np.where(first >= 0, before[:, np.maximum(first, 0)], begun[:, None])
        added = {SLICE: pa.array(np.full(rows, part, np.int32))}
        for k, name in enumerate(_COUNTED):
            added[f"slice_{name}"] = pa.array(before[k])
            added[f"own_{name}"] = pa.array(before[k] - start[k])
        total, begun, last = before[:, -1] + each[:, -1], start[:, -1], conv[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()],
                                         [*batch.schema.names, *added])


def _carried(placed: DataFrame) -> DataFrame:
    """For each slice what its first conversation has in earlier slices."""
    ends = placed.groupBy(SLICE).agg(
        F.min("conv").alias("conv"), F.max("conv").alias("last"),
        F.count(F.lit(1)).alias("turns"), F.sum("chars").alias("chars"),
        F.sum(F.col("trained").cast("long")).alias("replies"),
        # Of the runs of a slice the last one begins furthest.
        *[F.max(F.col(f"slice_{c}") - F.col(f"own_{c}")).alias(f"last_{c}") for c in _COUNTED])
    before = slice_offsets(ends, _COUNTED).select(
        F.col(SLICE), *[F.col(c).alias(f"before_{c}") for c in _COUNTED])
    ends = ends.join(before, SLICE)
    begun = ends.groupBy(F.col("last").alias("conv")).agg(
        *[F.min(F.col(f"before_{c}") + F.col(f"last_{c}")).alias(f"begun_{c}")
          for c in _COUNTED])
    return ends.join(begun, "conv").select(SLICE, F.col("conv").alias("continued"), *[
        (F.col(f"before_{c}") - F.col(f"begun_{c}")).alias(f"carried_{c}") for c in _COUNTED]
        ).filter("carried_turns > 0")


def write_examples(conversations: DataFrame, folder: str, part_chars: int = PART_CHARS) -> None:
    """Format `conversations` (conv_id, turn, role, text) into a store at `folder`: the turns, and
    every example in full."""
    ship(conversations)
    spark = conversations.sparkSession
    order = ["conv", "turn", "role", "tie"]
    turns = (formatted_turns(conversations).repartitionByRange(*order)
             .sortWithinPartitions(*order).drop("turn", "role", "tie"))
    counts = ", ".join(f"slice_{c} long, own_{c} long" for c in _COUNTED)
    (turns.mapInArrow(_number, "conv long, formatted string, head long, trained boolean, "
                               f"chars long, {SLICE} int, {counts}")
     .write.parquet(f"{folder}/turns"))
    _carried(_placed(spark, folder)).write.parquet(f"{folder}/carried")
    # The texts of one conversation repeat each other: zstd finds that.
    (_example_parts(stored_turns(spark, folder), part_chars)
     .write.option("compression", "zstd").parquet(f"{folder}/examples"))


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/turns")


def stored_turns(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, position, example, start, chars, head, trained, formatted): the turns of a store.

    `position` counts from 0. `start` is where the turn begins in the conversation's formatted
    text, `example` the number of replies before it: the example whose reply or new context
    it is.
    """
    placed = by_slice(_placed(spark, folder), spark.read.parquet(f"{folder}/carried"))

    def whole(name):
        carried = F.when(F.col("conv") == F.col("continued"), F.col(f"carried_{name}"))
        return F.col(f"own_{name}") + F.coalesce(carried, F.lit(0))

    return placed.select(own_id("conv").alias("conv_id"), whole("turns").alias("position"),
                         whole("replies").alias("example"), whole("chars").alias("start"),
                         "chars", "head", "trained", "formatted")


def _spans() -> tuple[Column, Column, Column]:
    """Of a reply: where loss begins and ends, and where its example ends."""
    end = F.col("start") + F.col("chars")
    return F.col("start") + F.col("head"), end - len(END) - 1, end


def example_spans(turns: DataFrame) -> DataFrame:
    """One row for each assistant turn: its example is the conversation's formatted text up to
    `end`, of which `context_chars` are context; loss is taken from `loss_start` up to `loss_end`.
    """
    loss, loss_end, end = _spans()
    return turns.filter("trained").select(
        "conv_id", "example", "position", F.col("start").alias("context_chars"),
        loss.alias("loss_start"), loss_end.alias("loss_end"), end.alias("end"))


def _example_parts(turns: DataFrame, part_chars: int) -> DataFrame:
    """The examples in full, in rows of about `part_chars`: see `stored_examples`."""
    placed = turns.select(doc_key("conv_id").alias("conv"), "position", "example", "start",
                          "trained", "formatted", *[span.alias(name) for span, name in zip(
                              _spans(), ("loss_start", "loss_end", "end"))],
                          F.floor(F.col("start") / part_chars).alias("part"))
    reply = F.struct("position", "example", "loss_start", "loss_end", "end")
    pieces = F.sort_array(F.collect_list(F.struct("position", "formatted")))
    texts = placed.groupBy("conv", "part").agg(
        F.min("start").alias("start"), pieces.alias("pieces"),
        F.collect_list(F.when(F.col("trained"), reply)).alias("replies")).select(
        "conv", "part", "start", F.array_join("pieces.formatted", "").alias("text"), "replies")
    own = texts.select("conv", "part", "start", "text", F.explode("replies").alias("r")).select(
        "conv", "r.example", "r.position", "part", "start",
        F.col("text").substr(F.lit(1), (F.col("r.end") - F.col("start")).cast("int"))
        .alias("text"), "r.loss_start", "r.loss_end", F.lit(True).alias("last"))
    context = placed.filter("trained AND part > 0").select(
        "conv", "example", "position", "loss_start", "loss_end",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("part") - 1)).alias("part"))
    before = context.join(texts.drop("replies"), ["conv", "part"]).withColumn(
        "last", F.lit(False))
    return own.unionByName(before)


def stored_examples(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, example, position, part, start, text, loss_start, loss_end, last): the examples of
    a store.

    An example's whole text is the texts of its rows in the order of `start`, which is where the
    row begins in it; most have one. Loss is taken from `loss_start` up to `loss_end` of the whole
    text, a span of the row marked `last`: that of the reply, the turn at `position`.
    """
    examples = spark.read.parquet(f"{folder}/examples")
    return examples.select(own_id("conv").alias("conv_id"), *examples.columns[1:])


def whole_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): the examples written out in full. Their
    texts together are as long as replies times context: for conversations of bounded length."""
    spans = example_spans(turns).alias("e")
    parts = turns.select("conv_id", "position", "formatted").alias("p")
    joined = spans.join(parts, F.col("e.conv_id").eqNullSafe(F.col("p.conv_id"))
                        & (F.col("p.position") <= F.col("e.position")))
    pieces = F.sort_array(F.collect_list(F.struct("p.position", "p.formatted")))
    return joined.groupBy("e.conv_id", "example", "loss_start", "loss_end").agg(
        pieces.alias("_pieces")).select(
        "conv_id", "example", F.array_join("_pieces.formatted", "").alias("text"),
        "loss_start", "loss_end")


def read_back(turns: DataFrame) -> DataFrame:
    """The turns of a store as they were: (conv_id, position, role, text), with what the loss
    mask covers (`trained_text`, null for context), unescaped, and the characters of the turn and
    of its example."""
    def cut(first, length):
        return F.col("formatted").substr(first.cast("int"), length.cast("int"))

    head = F.col("head")
    text = unescaped(cut(head + 1, F.col("chars") - head - len(END) - 1))
    role = unescaped(cut(F.lit(len(START) + 1), head - len(START) - 1))
    loss, loss_end, end = (F.when(F.col("trained"), span) for span in _spans())
    under_mask = unescaped(cut(loss - F.col("start") + 1, loss_end - loss))
    return turns.select("conv_id", "position", role.alias("role"), text.alias("text"),
                        under_mask.alias("trained_text"), "chars", end.alias("example_chars"))


def _read_examples(examples: DataFrame) -> DataFrame:
    """Per example the text under its loss mask, unescaped, and the code points of its last
    row; per conversation those of all other rows."""
    size = F.char_length("text").cast("long")
    under_mask = F.col("text").substr((F.col("loss_start") - F.col("start") + 1).cast("int"),
                                      (F.col("loss_end") - F.col("loss_start")).cast("int"))
    replies = examples.filter("last").select(
        "conv_id", "position", unescaped(under_mask).alias("trained_text"),
        size.alias("example_chars"))
    others = examples.filter("NOT last").groupBy("conv_id").agg(
        F.sum(size).alias("example_chars"))
    return replies.unionByName(others, allowMissingColumns=True)


def _digest(batches):
    """One row for each conversation. Its turns and its replies under the mask come in order, in
    rows of their own or in one."""
    key, out = None, []
    state: list = []

    def closed():
        turns, loss, n, chars, formatted, examples, total = state
        out.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, examples,
                    total))

    def table():
        cells = list(zip(*out)) or [()] * 8
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if k in (2, 4) else pa.int64())
             for k, c in enumerate(cells)],
            ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
             "n_examples", "example_chars"])

    for batch in batches:
        for conv, role, text, trained, chars, example in zip(*(
                column(batch, c).to_pylist() for c in
                ("conv", "role", "text", "trained_text", "chars", "example_chars"))):
            if conv != key:
                if state:
                    closed()
                key, state = conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0, 0]
            if role is not None:
                state[0].update(f"{role}\n{text}\n".encode())
                state[2] += 1
                state[4] += chars
            if trained is not None:
                state[1].update(trained.encode())
                state[3] += len(trained)
                state[5] += 1
            state[6] += example or 0
        if len(out) >= 10_000:
            yield table()
            out.clear()
    if state:
        closed()
    yield table()


def conversation_digests(turns: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """Per conversation what is read back: turns, text under the loss mask, and lengths. What the
    mask covers comes from `examples`, if given, and else from the turns."""
    ship(turns)
    rows = read_back(turns)
    if examples is not None:
        rows = rows.drop("trained_text", "example_chars").unionByName(
            _read_examples(examples), allowMissingColumns=True)
    rows = rows.withColumn("conv", doc_key("conv_id")).drop("conv_id")
    found = (rows.repartition("conv").sortWithinPartitions("conv", "position").mapInArrow(
        _digest, "conv long, n_turns long, turns_sha256 string, loss_chars long, "
                 "loss_sha256 string, formatted_chars long, n_examples long, example_chars long"))
    return found.select(own_id("conv").alias("conv_id"), *found.columns[1:])


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """Write `conversations` as examples and give the digests of what is read back."""
    spark, folder = conversations.sparkSession, staged_path(conversations.sparkSession, "chat")
    write_examples(conversations, folder)
    return conversation_digests(stored_turns(spark, folder), stored_examples(spark, folder))
