"""CSV sources. Files whose quoted fields hold line breaks are read by many tasks, too.

Such a file is cut into byte ranges wherever its blocks lie, so a task does not know whether it
starts inside quotes. That is settled by the number of quotes before it: one pass counts the
quotes of every range, running sums over the ranges of a file give the parity at each start,
and a second pass then tells true row ends from line breaks inside quotes. Rows that lie in
several ranges come out in pieces, at most two a range, which are put together by a small
shuffle; all other rows never move.

Quotes are doubled inside quotes and nowhere else, so every row has an even number of them.
Rows end at a line feed, or a carriage return and a line feed, outside of quotes; empty rows
are skipped, and so is the first row of each file, its header.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import stage

#: Byte ranges that start inside quotes, three numbers each, are broadcast up to this many.
BROADCAST_RANGES = 1 << 19

# Stands for a missing value while reading: it cannot occur in text.
_MISSING = "\u0000"
_HEAD, _TAIL = 0, 1
_PIECES = "file string, range long, kind int, header boolean, text string"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType,
                 sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Header CSV, UTF-8, quotes doubled inside quotes.

    Nothing between separators is NULL, "" is an empty string. A row that does not fit
    the schema fails the read. Files are split between tasks, and a line break inside
    quotes is an error, unless `multi_line` allows it: files are then read twice, first to
    count quotes, and still split.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST",
               "nullValue": _MISSING, "emptyValue": "", "dateFormat": "yyyy-MM-dd"}
    if multi_line:
        # One row at a time, line breaks and all, with the same parser.
        row = F.from_csv("text", schema.toDDL(),
                         {**options, "multiLine": "true"})
        return quoted_rows(spark, path).select(row.alias("row")).select("row.*")
    return (spark.read.schema(schema).options(**options).option("header", True)
            .option("encoding", "UTF-8").csv(path))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the byte range they lie in; a range is read by one task, in order."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select("_metadata.file_path", "_metadata.file_block_start", "value")
            .toDF("file", "range", "line"))


def _inside_quotes(lines: DataFrame, quote: str) -> DataFrame:
    """The byte ranges that start inside quotes, as a written table."""
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit(quote), F.lit("")))
    counts = lines.groupBy("file", "range").agg(F.sum(quotes.cast("long")).alias("quotes"))
    before = (Window.partitionBy("file").orderBy("range")
              .rowsBetween(Window.unboundedPreceding, -1))
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return stage(counts.select(F.xxhash64("file").alias("file_id"), F.col("range").alias("starts"),
                               odd.alias("inside")).filter("inside"), "inside_quotes")


def _assemble(quote: str):
    """Lines of byte ranges to whole rows (`kind` null) and pieces of rows that cross an edge of
    their range. What it returns uses nothing of this module, so tasks need not import it."""
    def table(pieces: list, whole: pa.Array, at: tuple[str, int]) -> pa.RecordBatch:
        n = len(whole)
        cells = list(zip(*pieces)) or [()] * 5
        columns = [
            pa.array([*cells[0], *[at[0]] * n], pa.string()),
            pa.array([*cells[1], *[at[1]] * n], pa.int64()),
            pa.array([*cells[2], *[None] * n], pa.int32()),
            pa.array([*cells[3], *[False] * n], pa.bool_()),
            pa.concat_arrays([pa.array(cells[4], pa.string()), whole])]
        return pa.RecordBatch.from_arrays(columns, ["file", "range", "kind", "header", "text"])

    def flush(text: list[str], kind, at, header):
        return [*at, kind, header, "\n".join(text)]

    def assemble(batches):
        at, held, opened, inside = None, [], True, False
        header = False

        def ended():
            """What is held when a range ends: a row that goes on in the next one."""
            return [flush(held, _TAIL if opened else _HEAD, at, header)] if held else []

        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            line = batch.column(2)
            counts = pc.count_substring(line, quote).to_numpy(zero_copy_only=False)
            place = batch.column(1).to_numpy()
            files = batch.column(0).dictionary_encode()
            file_no = files.indices.to_numpy()
            edges = np.flatnonzero((np.diff(file_no) != 0) | (np.diff(place) != 0)) + 1
            bounds = [0, *edges.tolist(), rows]
            for low, high in zip(bounds, bounds[1:]):
                out = []
                here = (files.dictionary[int(file_no[low])].as_py(), int(place[low]))
                if here != at:
                    out += ended()
                    at, held = here, []
                    inside = bool(batch.column(3)[low].as_py())
                    opened, header = not inside, here[1] == 0
                odd = (np.cumsum(counts[low:high]) + inside) % 2 == 1     # after each line
                ends = np.flatnonzero(~odd) + 1
                part = line.slice(low, high - low)
                if len(ends):
                    first = [*held, *part.slice(0, ends[0]).to_pylist()]
                    out.append(flush(first, None if opened else _HEAD, at, header))
                    offsets = pa.array(ends.astype(np.int32))
                    whole = pc.binary_join(pa.ListArray.from_arrays(
                        offsets, part.cast(pa.string())), "\n")
                    held = part.slice(ends[-1]).to_pylist()
                    opened, header = True, False
                else:
                    whole = pa.array([], pa.string())
                    held = [*held, *part.to_pylist()]
                inside = bool(odd[-1])
                yield table(out, whole, at)
        yield table(ended(), pa.array([], pa.string()), at or ("", 0))
    return assemble


def quoted_rows(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """The rows below `path`, each as `text`, without headers and empty rows."""
    lines = _lines(spark, path)
    inside = _inside_quotes(lines, quote)
    if inside.count() <= BROADCAST_RANGES:
        marked = lines.join(F.broadcast(inside), (F.xxhash64("file") == F.col("file_id"))
                            & (F.col("range") == F.col("starts")), "left")
    else:
        place = ["file", "range"]
        marked = (lines.withColumn("order", F.monotonically_increasing_id())
                  .join(inside, (F.xxhash64("file") == F.col("file_id"))
                        & (F.col("range") == F.col("starts")), "left")
                  .repartition(*place).sortWithinPartitions(*place, "order"))
    marked = marked.select("file", "range", "line", F.coalesce("inside", F.lit(False)))
    parts = marked.mapInArrow(_assemble(quote), _PIECES)
    pieces = stage(parts.filter("kind IS NOT NULL"), "pieces")
    # A row begins with the tail of a range; later ranges go on with it until one ends it.
    begun = F.last(F.when(F.col("kind") == _TAIL, F.col("range")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("range", "kind"))
    joined = (pieces.withColumn("begun", begun).groupBy("file", "begun")
              .agg(F.sort_array(F.collect_list(F.struct("range", "kind", "text"))).alias("found"),
                   F.bool_or("header").alias("header"))
              .select("header", F.array_join("found.text", "\n").alias("text")))
    rows = parts.filter("kind IS NULL").select("header", "text").unionByName(joined)
    text = F.when(F.col("text").endswith("\r"), F.expr("left(text, char_length(text) - 1)")
                  ).otherwise(F.col("text"))
    return rows.filter(~F.col("header")).select(text.alias("text")).filter(F.col("text") != "")
