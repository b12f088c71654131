import datetime as dt
from decimal import Decimal

from frames import by_key, rows
from pyspark.sql import functions as F

from loomhouse.operators import checks

OPEN = dt.date(9999, 12, 31)


def test_keys_and_references(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    assert rows(checks.duplicate_keys(df, ["k", "v"])) == [(1, "a", 2), (2, None, 1)]
    parent = spark.createDataFrame([("a",)], "key string")
    assert rows(checks.orphans(df, parent, {"v": "key"})) == [("c", 1)]


def test_values(spark):
    df = spark.createDataFrame([("ab", None), ("abcd", 1), (None, 2)], "t string, n int")
    assert rows(checks.missing_values(df, ["t", "n"]), "t", "missing") == rows(
        spark.createDataFrame([("ab", "n"), (None, "t")], "a string, b string"))
    assert rows(checks.oversize_values(df, {"t": 3}), "t", "oversize") == [("abcd", "t")]
    money = spark.createDataFrame([(Decimal("99.99"),), (Decimal("100.00"),)], "m decimal(10,2)")
    assert rows(checks.overflowing_numbers(money, "m", 4, 2)) == [(Decimal("100.00"),)]
    cells = spark.createDataFrame([("a;b", "x"), ("a", "x|y"), ("a", None)], "p string, q string")
    assert rows(checks.non_atomic(cells, {"p": [";"], "q": ["|", ","]}), "non_atomic") == [
        ("p",), ("q",)]


def test_dependencies(spark):
    # Student, city, region: a transitive dependency; name is not one.
    df = spark.createDataFrame([
        (1, "Moscow", "Central", "I"), (2, "Moscow", "Central", "A"),
        (3, "Kazan", "Volga", "I"), (4, None, None, "B"), (5, None, "X", "B")],
        "id int, city string, region string, name string")
    report = by_key(checks.dependency_report(
        df, [("city", "region"), ("region", "city"), ("name", "city"), ("id", "name")]
    ).selectExpr("concat(determinant, '>', dependent) AS pair", "n_values", "n_broken", "holds"),
        "pair", "n_values", "n_broken", "holds")
    assert report == {"city>region": (3, 1, False), "region>city": (4, 0, True),
                      "name>city": (3, 1, False), "id>name": (5, 0, True)}
    assert rows(checks.dependency_violations(df, ["city"], ["region"])) == [(None, 2)]


def test_spellings(spark):
    df = spark.createDataFrame([
        ("s@m", "Сергей Иванов"), ("s@m", "С. Иванов"), ("s@m", "Иванов Сергей"),
        ("s@m", None), ("o@m", "О")], "mail string, name string")
    assert rows(checks.spelling_variants(df, "mail", "name")) == [
        ("s@m", 3, "Иванов Сергей", "Сергей Иванов")]


def test_chain_problems(spark):
    def d(day):
        return dt.date(2024, 1, day)

    dim = spark.createDataFrame([
        ("ok", 1, d(1), d(4), False), ("ok", 2, d(5), OPEN, True),
        ("gap", 3, d(1), d(4), False), ("gap", 4, d(7), OPEN, True),
        ("over", 5, d(1), d(6), False), ("over", 6, d(6), OPEN, True),
        ("end", 7, d(1), d(4), False),
        ("inv", 8, d(5), d(4), False), ("inv", 9, d(5), OPEN, True),
        ("two", 10, d(1), OPEN, True), ("two", 11, d(3), OPEN, True),
    ], "k string, sk int, valid_from date, valid_to date, is_current boolean")
    assert by_key(checks.chain_breaks(dim, "k", "sk"), "sk", "problem") == {
        3: "gap", 5: "overlap", 7: "unended", 8: "inverted", 10: "overlap"}
    assert rows(checks.several_current(dim, "k")) == [("two", 2)]


def test_dependencies_are_ruled_out_by_sketches_and_confirmed_exactly(spark):
    df = spark.range(20_000).select(
        "id", (F.col("id") % 500).alias("g"), F.floor(F.col("id") % 500 / 10).alias("h"),
        F.when(F.col("id") % 500 < 250, F.lit("a")).alias("half"),
        # Broken by a single row, which no sketch can see.
        F.when(F.col("id") == 77, F.lit(-1)).otherwise(F.col("id") % 500).alias("almost"))
    columns = df.columns
    rows_ = df.collect()
    want = {}
    for x in columns:
        for y in columns:
            if x != y and len({(r[x], r[y]) for r in rows_}) == len({r[x] for r in rows_}):
                want[x, y] = len({r[x] for r in rows_})
    found = checks.dependencies(df, columns)
    assert {(r["determinant"], r["dependent"]): r["n_values"] for r in found.collect()} == want
    assert ("g", "h") in want and ("g", "half") in want and ("g", "almost") not in want
    tried = checks.possible_dependencies(df, columns)
    assert ("g", "almost") in tried and ("h", "g") not in tried and ("g", "id") not in tried
    empty = checks.dependencies(df.limit(0), ["g", "h"])
    assert empty.columns == found.columns and empty.count() == 0


def test_one_file_of_rows_is_dealt_to_many_tasks(spark, monkeypatch):
    df = spark.range(100).selectExpr("id", "id % 5 a", "IF(id = 7, NULL, id % 5) b").coalesce(1)
    pairs = [("id", "a"), ("a", "b"), ("b", "a")]
    whole = rows(checks.dependency_report(df, pairs))
    monkeypatch.setattr(checks, "REPORT_ROWS", 20)
    found = checks.dependency_report(df, pairs)
    assert rows(found) == whole
    assert "RoundRobinPartitioning(16)" in found._jdf.queryExecution().executedPlan().toString()
