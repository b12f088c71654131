"""Files, folders and append sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A table written out in code, for fixtures and small references."""
    return spark.createDataFrame(list(rows), schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark can reach; empty if there is none."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(target)]


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_absent(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Append the rows whose key is not stored; the same key twice in `df` goes in once, with
    the greatest of its rows (compared column by column)."""
    others = [c for c in df.columns if c not in key]
    best = F.max(F.struct(*others)).alias("_best") if others else F.count("*").alias("_n")
    rows = df.groupBy(*key).agg(best).select(
        *key, *(["_best.*"] if others else [])).select(*df.columns)
    spark = df.sparkSession
    if path_exists(spark, path):
        stored = spark.read.schema(df.schema).parquet(path).select(*key)
        rows = rows.join(stored, list(key), "left_anti")
    append(rows, path)
