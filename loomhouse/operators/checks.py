"""Integrity rules as jobs that return the offending rows; empty means the rule holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_open
from .keys import next_row


#: Size of the sketches that count distinct values, and by how much an estimate may exceed
#: another one of equal true size: six standard errors of both.
SKETCH_BITS = 12
SKETCH_SLACK = 6 * 2 ** 0.5 * 1.04 / 2 ** (SKETCH_BITS / 2)
#: Rows of a table, times the pairs tested, that one task takes to report on dependencies.
REPORT_ROWS = 1 << 20


def _any(conditions: Sequence[Column]) -> Column:
    found = F.lit(False)
    for c in conditions:
        found = found | c
    return found


def _named(conditions: Mapping[str, Column]) -> Column:
    """Comma-separated names of the conditions that hold."""
    return F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in conditions.items()])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or hold a NULL, with their row count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter((F.col("n_rows") > 1) | _any([F.col(k).isNull() for k in key])))


def several_current(dim: DataFrame, bk: str) -> DataFrame:
    """Business keys with more than one current version."""
    return (dim.filter("is_current").groupBy(bk).agg(F.count(F.lit(1)).alias("n_current"))
            .filter(F.col("n_current") > 1))


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Foreign key values without a parent, with the number of child rows.

    Child rows are counted per value before the join, so a frequent value is one row by
    the time it is compared.
    """
    columns = list(on)
    values = (child.filter(~_any([F.col(c).isNull() for c in columns]))
              .groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")))
    known = parent.select(*[F.col(p).alias(c) for c, p in on.items()])
    return values.join(known, columns, "left_anti")


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column, and the names of those columns."""
    lacking = {c: F.col(c).isNull() for c in columns}
    return df.filter(_any(list(lacking.values()))).withColumn("missing", _named(lacking))


def oversize_values(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Rows with text longer than declared, and the names of those columns."""
    over = {c: F.coalesce(F.length(c) > n, F.lit(False)) for c, n in lengths.items()}
    return df.filter(_any(list(over.values()))).withColumn("oversize", _named(over))


def overflowing_numbers(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Rows whose value does not fit decimal(precision, scale)."""
    fitted = F.col(column).try_cast(f"decimal({precision},{scale})")
    return df.filter(F.col(column).isNotNull() & fitted.isNull())


def dependency_violations(df: DataFrame, determinant: Sequence[str],
                          dependents: Sequence[str]) -> DataFrame:
    """Determinant values with several dependent values; NULL counts as a value."""
    return (df.select(*determinant, *dependents).distinct()
            .groupBy(*determinant).agg(F.count(F.lit(1)).alias("n_variants"))
            .filter(F.col("n_variants") > 1))


def dependency_report(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """For each (X, Y): how many X values there are, how many break X -> Y, does it hold.

    A pair of non-key columns that holds is a transitive dependency to move out. All
    pairs are tested in one pass; rows shrink to distinct (pair, X, Y) before they move. Each row
    becomes one for every pair, so a table, however few files it lies in, is dealt to as many
    tasks as it takes for `REPORT_ROWS` of those each, before and after they shrink.
    """
    columns = sorted({c for pair in pairs for c in pair})
    df = df.select(*columns)
    tasks = df.count() * len(pairs) // REPORT_ROWS + 1
    if tasks > 1:
        df = df.repartition(tasks)
    sides = F.array(*[F.struct(F.lit(x).alias("determinant"), F.lit(y).alias("dependent"),
                               F.col(x).cast("string").alias("_x"),
                               F.col(y).cast("string").alias("_y")) for x, y in pairs])
    found = df.select(F.explode(sides).alias("_p")).select("_p.*").distinct()
    if tasks > 1:
        found = found.repartition(tasks, "determinant", "dependent", "_x")
    per_x = found.groupBy("determinant", "dependent", "_x").agg(F.count(F.lit(1)).alias("_n"))
    broken = F.sum((F.col("_n") > 1).cast("long"))
    return per_x.groupBy("determinant", "dependent").agg(
        F.count(F.lit(1)).alias("n_values"), broken.alias("n_broken"),
        (broken == 0).alias("holds"))


def possible_dependencies(df: DataFrame, columns: Sequence[str]) -> list[tuple[str, str]]:
    """Ordered pairs (X, Y) of columns for which X -> Y is not ruled out by sketches.

    One pass over the table counts the distinct values of every column and of every pair by
    mergeable sketches, combined in the map; NULL counts as a value. X -> Y means as many pairs
    as values of X, so a pair is ruled out if its estimate exceeds that of X by more than
    `SKETCH_SLACK`, six standard errors of both.
    """
    counts = {}
    for i, x in enumerate(columns):
        for y in columns[i:]:
            value = F.xxhash64(x) if x == y else F.xxhash64(x, y)
            counts[x, y] = F.hll_sketch_estimate(F.hll_sketch_agg(value, F.lit(SKETCH_BITS)))
    found = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(counts.values())]).first()
    size = dict(zip(counts, found))
    return [(x, y) for x in columns for y in columns if x != y
            and size[(x, y) if (x, y) in size else (y, x)] <= size[x, x] * (1 + SKETCH_SLACK)]


def dependencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The dependencies X -> Y among `columns`, each with the number of values of X.

    Sketches rule out most pairs in one pass; only the others are tested exactly, in a second.
    A dependency between columns outside of the key is a transitive one to move out.
    """
    pairs = possible_dependencies(df, columns)
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], "determinant string, dependent string, n_values long")
    return dependency_report(df, pairs).filter("holds").drop("holds", "n_broken")


def chain_breaks(dim: DataFrame, bk: str, sk: str) -> DataFrame:
    """Versions that break the chain of their key.

    `inverted`: ends before it starts; `gap` / `overlap`: the next version does not start
    on the following day; `unended`: the last version is closed.
    """
    rows = dim.select(bk, sk, "valid_from", "valid_to")
    linked = next_row(rows, [bk], ["valid_from", sk], ["valid_from"])
    following = F.date_add("valid_to", 1)
    nxt = F.col("next_valid_from")
    open_end = is_open(F.col("valid_to"))
    problems = {
        "inverted": F.col("valid_to") < F.col("valid_from"),
        "gap": nxt.isNotNull() & ~open_end & (nxt > following),
        "overlap": nxt.isNotNull() & (nxt <= F.col("valid_to")),
        "unended": nxt.isNull() & ~open_end,
    }
    return linked.withColumn("problem", _named(problems)).filter(F.col("problem") != "")


def non_atomic(df: DataFrame, delimiters: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows in which a cell still holds a delimiter, and the names of those columns."""
    found = {c: F.coalesce(_any([F.instr(F.col(c), d) > 0 for d in ds]), F.lit(False))
             for c, ds in delimiters.items()}
    return df.filter(_any(list(found.values()))).withColumn("non_atomic", _named(found))


def spelling_variants(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys written with several names: how many, and the first and last of them."""
    variants = df.select(key, name).filter(F.col(name).isNotNull()).distinct()
    return (variants.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_spellings"),
                 F.min(name).alias("first_spelling"), F.max(name).alias("last_spelling"))
            .filter(F.col("n_spellings") > 1))
