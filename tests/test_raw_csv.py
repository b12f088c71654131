"""CSV files cut into byte ranges at any place, against reading them whole."""

import csv
import random

import pytest
from frames import rows
from pyspark.sql import types as T

from loomhouse.plans import catalog
from loomhouse.sources import raw_csv
from loomhouse.sources.raw_csv import quoted_rows, read_raw_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()),
                       T.StructField("b", T.StringType())])


@pytest.fixture
def cut(spark):
    """Sets the bytes of a range."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for n, v in before.items():
        spark.conf.set(n, v)


def fields(draw, rows):
    parts = ["", "x", '"', '""', "\n", "\r\n", ",", "é", " y ", "\n\n", "long " * 30]
    return [(i, *("".join(draw.choice(parts) for _ in range(draw.randint(0, 5)))
                  for _ in range(2))) for i in range(rows)]


def write(path, rows, end="\n", last=True):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator=end)
        out.writerow(["id", "head\nline", "b"])
        out.writerows(rows)
    if not last:
        whole = path.read_bytes()
        path.write_bytes(whole[:-len(end)])


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_any_cut_gives_the_same_rows(spark, tmp_path, cut, size):
    cut(size)
    draw, want = random.Random(size), []
    for n, (end, last) in enumerate([("\n", True), ("\r\n", True), ("\n", False)]):
        rows = [(n * 1000 + i, a, b) for i, a, b in fields(draw, 25 if size < 64 else 60)]
        write(tmp_path / f"{n}.csv", rows, end, last)
        want += rows
    got = read_raw_csv(spark, str(tmp_path), SCHEMA, multi_line=True)
    assert found(got) == sorted(want)
    assert got.schema == SCHEMA


def test_ranges_beyond_the_broadcast(spark, tmp_path, cut, monkeypatch):
    cut(50)
    rows = fields(random.Random(1), 40)
    write(tmp_path / "t.csv", rows)
    monkeypatch.setattr(raw_csv, "BROADCAST_RANGES", -1)
    assert found(read_raw_csv(spark, str(tmp_path), SCHEMA, multi_line=True)) == sorted(rows)


def test_one_file_is_shared_and_one_row_may_span_ranges(spark, tmp_path, cut):
    cut(400)
    rows = [(1, "a\n" * 3000, "b"), (2, "", "c"), (3, '"' * 501, "\n")] + [
        (i, f"line {i}\nend", "x" * 50) for i in range(10, 200)]
    write(tmp_path / "t.csv", rows)
    assert quoted_rows(spark, str(tmp_path / "t.csv")).rdd.getNumPartitions() > 20
    assert found(read_raw_csv(spark, str(tmp_path / "t.csv"), SCHEMA, multi_line=True)) == rows


def test_nothing_but_a_header_and_empty_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,a,b\n\n\r\n1,"",\n\n')
    got = read_raw_csv(spark, str(tmp_path / "t.csv"), SCHEMA, multi_line=True)
    assert found(got) == [(1, "", None)]
    (tmp_path / "t.csv").write_text("id,a,b\n")
    assert found(read_raw_csv(spark, str(tmp_path / "t.csv"), SCHEMA, multi_line=True)) == []


def test_a_row_that_does_not_fit_fails(spark, tmp_path):
    for line in ("x,a,b", "1,a", "1,a,b,c"):
        (tmp_path / "t.csv").write_text(f"id,a,b\n{line}\n")
        for multi_line in (True, False):
            with pytest.raises(Exception):
                read_raw_csv(spark, str(tmp_path / "t.csv"), SCHEMA, multi_line=multi_line
                             ).collect()


def test_a_large_table_is_written_as_several_files(spark, tmp_path, monkeypatch):
    documents = spark.range(30).selectExpr("id AS doc_id", "'en' AS lang",
                                           "concat('a \"b\"', chr(10), id) AS text")
    documents.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "CSV_BYTES", 1)
    monkeypatch.setattr(catalog, "staged_path", lambda s, name: str(tmp_path / name))
    found = catalog.csv_load(spark, str(tmp_path))
    assert rows(found) == rows(documents)
    assert len(list((tmp_path / "csv").glob("part-*"))) > 1
