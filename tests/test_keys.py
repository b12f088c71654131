from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import rows
from loomhouse.operators.keys import SLICE, assign_sk, highest_sk, next_row, ordered_slices


def test_numbers_equal_row_number(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"),
                                  (F.col("id") % 3).alias("v"))
    expected = df.select((F.row_number().over(Window.orderBy("k")) + 100).alias("sk"), "k", "v")
    for unique in (True, False):
        got = assign_sk(df, ["k"], start=100, slices=7, unique=unique)
        assert rows(got) == rows(expected)
    assert highest_sk(got, "sk") == 5100


def test_one_frequent_value_spreads_over_slices(spark):
    df = spark.range(6000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"),
                                  "id")
    placed = ordered_slices(df, ["k"], slices=6)
    hot = placed.filter("k = 0").select(SLICE).distinct().count()
    assert hot >= 3
    numbered = assign_sk(df, ["k"], slices=6)
    assert rows(numbered.select("sk")) == rows(spark.range(1, 6001))
    wrong = numbered.filter("(k = 0 AND sk > 4000) OR (k > 0 AND sk <= 4000)")
    assert wrong.count() == 0


def test_any_order_is_dense_and_needs_no_shuffle(spark):
    df = spark.range(0, 999, 1, 5)
    got = assign_sk(df, [])
    assert rows(got.select("sk")) == rows(spark.range(1, 1000))
    assert got.select("id").distinct().count() == 999


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k int")
    assert assign_sk(empty, ["k"]).count() == 0
    assert highest_sk(empty, "k") == 0


def test_next_row_matches_lead_for_a_huge_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") * 31 % 3001).alias("t"))
    expected = df.withColumn("next_t", F.lead("t").over(Window.partitionBy("g").orderBy("t")))
    assert rows(next_row(df, ["g"], ["t"], ["t"], slices=6)) == rows(expected)


def test_sums_and_heads_climb_the_tree(spark, monkeypatch):
    from loomhouse.operators import keys

    monkeypatch.setattr(keys, "FAN_BITS", 2)  # runs of four slices: four levels for 200 slices
    per_slice = spark.range(0, 200).filter("id % 7 <> 3 AND NOT id BETWEEN 20 AND 90").select(
        F.col("id").cast("int").alias(SLICE), (F.col("id") * 13 % 31).alias("n"),
        F.struct("id").alias("head"))
    known = sorted((r[SLICE], r["n"]) for r in per_slice.collect())
    sums = {r[SLICE]: r["n"] for r in keys.slice_offsets(per_slice, ["n"]).collect()}
    assert sums == {s: sum(n for t, n in known if t < s) for s, _ in known}
    heads = {r[SLICE]: r["head"] and r["head"]["id"]
             for r in keys.following_heads(per_slice, "head").collect()}
    assert heads == {s: min((t for t, _ in known if t > s), default=None) for s, _ in known}


def test_neither_driver_nor_one_task_orders_all_slices(spark):
    df = spark.range(3000).select((F.col("id") % 10).alias("g"), "id")
    for found in (assign_sk(df, ["id"]), next_row(df, ["g"], ["id"], ["id"])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Literal" not in plan
