"""One key that holds a third of all rows, with thresholds low enough to act on it."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from loomhouse.operators.checks import duplicate_keys, orphans
from loomhouse.operators.fact import Link, match_current
from loomhouse.operators.normalize import decompose, resolve_fk
from loomhouse.operators.scd2 import Dimension, scd2_init
from loomhouse.operators.vault import load_link
from loomhouse.plans import marts

EAGER = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def eager(spark):
    before = {k: spark.conf.get(k, None) for k in EAGER}
    for k, v in EAGER.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def orders(spark, n=60000):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 8).select(
        "id", key.alias("student_email"), (F.col("id") % 97).alias("course_name"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_of_a_hot_key_is_split(eager):
    child = orders(eager)
    parent = eager.range(4000).select(F.col("id").alias("k"), (F.col("id") + 7).alias("sk"))
    for take in (None, {"student_sk": "sk"}):
        found = resolve_fk(child, parent, {"student_email": "k"}, take)
        assert "skew=true" in final_plan(found)
        assert found.count() == child.filter("student_email < 4000").count()


def test_fact_and_link_with_a_hot_key(eager):
    child = orders(eager)
    spec = Dimension("sk", "k", ("a",))
    dim = scd2_init(eager.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("a")),
                    spec, "2024-01-01")
    matched = match_current(child, Link(dim, spec, "student_email"))
    assert "skew=true" in final_plan(matched)
    assert matched.filter("sk <> student_email + 1").count() == 0
    assert matched.count() == 60000
    staged = child.withColumn("source_system", F.lit("S"))
    hub = eager.range(5000).select(F.col("id").cast("string").alias("student_email"))
    links = load_link(staged, "hk", [("a", "student_email"), ("b", "id")],
                      "2026-01-01 00:00:00", hubs=[hub, None])
    assert "skew=true" in final_plan(links)
    assert links.count() == 60000


def test_hot_groups_shrink_before_the_shuffle(eager):
    child = orders(eager)
    for df in (decompose(child, ["student_email"], ["course_name"]),
               duplicate_keys(child, ["student_email"]),
               orphans(child, eager.range(10), {"student_email": "id"})):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan
        assert "partial_" in final_plan(df) or "HashAggregate" in final_plan(df)
    assert rows(duplicate_keys(child, ["student_email"]).filter("student_email = 0")) == [
        (0, child.filter("student_email = 0").count())]
    others = marts.courses_of_students(child)
    assert others.filter("student_email = 0").count() == 97
