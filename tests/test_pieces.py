"""Parts of composite texts: the same as split_part, without an array of parts for each row."""

import pytest
from pyspark.sql import functions as F

from loomhouse.functions import piece_of
from loomhouse.operators.parse import Piece, parse_composite

TEXTS = [None, "", "a", ";", ";;", "a;b", "a;b;c;d|e", ";b", "a;", "é;日本|x;😀|y|z;", "a|b", "|;|;|",
         " a ; b ", "aa;;bb", "\n;\t;x"]


@pytest.mark.parametrize("path", [((";", 1),), ((";", 2),), ((";", 3),), ((";", 9),), ((";", -1),),
                                  ((";", 2), ("|", 1)), ((";", 3), ("|", 2)), ((";;", 2),),
                                  (("日", 2),), ()])
def test_pieces_equal_split_part(spark, path):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string").coalesce(1)
    plain = F.col("text")
    for delim, n in path:
        plain = F.split_part(plain, F.lit(delim), F.lit(n))
    found = rows.select(piece_of(F.col("text"), path).alias("found"), plain.alias("plain")).collect()
    assert [r["found"] for r in found] == [r["plain"] for r in found]


def test_no_array_of_parts_is_made(spark):
    rows = spark.createDataFrame([("a;1.5|c",)], "text string")
    parsed = parse_composite(rows, {"a": Piece("text", ((";", 1),)),
                                    "b": Piece("text", ((";", 2), ("|", 1)), type="decimal(5,2)")})
    assert "split" not in parsed._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [tuple(map(str, r)) for r in parsed.collect()] == [("a", "1.50")]


def test_unreadable_numbers_still_fail(spark):
    pieces = {"b": Piece("text", ((";", 2),), type="decimal(5,2)")}
    rows = spark.createDataFrame([("a;1",), (None,)], "text string")
    assert [r["b"] and str(r["b"]) for r in parse_composite(rows, pieces).collect()] == ["1.00", None]
    for text in ("a", "a;x"):
        bad = spark.createDataFrame([(text,)], "text string")
        with pytest.raises(Exception, match="b is not decimal"):
            parse_composite(bad, pieces).collect()
        assert parse_composite(bad, pieces, strict=False).first()["b"] is None
