import datetime as dt
from decimal import Decimal

import pytest
from frames import rows
from fixed_rows import ORDER_LINES, PARALLEL_LISTS
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomhouse.operators.explode import explode_by_index, explode_zip, list_length_report
from loomhouse.operators.parse import Piece, parse_composite, parse_rejects
from loomhouse.plans.relational import ORDER_LINE, to_1nf
from loomhouse.sources.contracts import RAW
from loomhouse.sources.files import append_absent, literal_rows, path_exists
from loomhouse.sources.raw_csv import read_raw_csv
from loomhouse.sources.staging import drop_staged, stage, staged_folder

LISTS = ["courses", "professors", "grades"]


def test_first_order_line_is_atomic(spark):
    raw = literal_rows(spark, ORDER_LINES[:1], RAW["courses_0nf"].schema())
    assert rows(to_1nf(raw)) == [(
        dt.date(2024, 1, 10), "ivan.petrov@mail.com", "Иван Петров", "+79990001122", "Москва",
        "Центральный", "SQL для начинающих", "Data", Decimal("15000.00"), "Сергей Иванов",
        "s.ivanov@mail.com", "Карта", "Оплачено")]


def test_missing_and_odd_pieces(spark):
    raw = literal_rows(spark, [
        (dt.date(2024, 1, 1), "a@x;A", "C|D|15000.555", "no mail", None),
        (dt.date(2024, 1, 2), "", "C|D|7", "T<t@x>>", "card|"),
    ], RAW["courses_0nf"].schema())
    got = rows(to_1nf(raw), "student_email", "student_name", "student_city", "course_price",
               "teacher_name", "teacher_email", "payment_method", "payment_status")
    assert got == rows(spark.createDataFrame([
        ("", "", "", Decimal("7.00"), "T", "t@x", "card", ""),
        ("a@x", "A", "", Decimal("15000.56"), "no mail", "", None, None),
    ], "a string, b string, c string, d decimal(10,2), e string, f string, g string, h string"))


def test_unreadable_price_fails_or_is_reported(spark):
    raw = literal_rows(spark, [
        (dt.date(2024, 1, 1), "a", "C|D|", "T<t>", "x|y"),
        (dt.date(2024, 1, 2), "b", "C|D|12345678901", "T<t>", "x|y"),
        (dt.date(2024, 1, 3), "c", "C|D|5", "T<t>", "x|y"),
    ], RAW["courses_0nf"].schema())
    with pytest.raises(Exception, match="course_price"):
        to_1nf(raw).collect()
    lenient = to_1nf(raw, strict=False)
    assert [r.course_price for r in lenient.orderBy("order_date").collect()] == [
        None, None, Decimal("5.00")]
    assert rows(parse_rejects(raw, ORDER_LINE), "student_info", "unreadable") == [
        ("a", "course_price"), ("b", "course_price")]
    texts_only = {"n": Piece("student_info", ((";", 1),))}
    assert parse_rejects(raw, texts_only).count() == 0
    assert parse_composite(raw, texts_only).count() == 3


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        'order_date,student_info,course_info,teacher_info,payment_info\n'
        '2024-01-10,"a;""Quoted"" Name;1;C|R","x, y|Data|1","T\nU<t>",p|q\n', encoding="utf-8")
    got = read_raw_csv(spark, str(tmp_path / "in.csv"), RAW["courses_0nf"].schema(),
                       multi_line=True)
    assert rows(got) == [(dt.date(2024, 1, 10), 'a;"Quoted" Name;1;C|R', "x, y|Data|1",
                          "T\nU<t>", "p|q")]
    (tmp_path / "bad.csv").write_text("order_date,a,b,c,d\nnot a date,1,2,3,4\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, str(tmp_path / "bad.csv"), RAW["courses_0nf"].schema()).collect()


def test_csv_tells_empty_from_missing(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        'order_date,student_info,course_info,teacher_info,payment_info\n'
        ',"",,x,\n', encoding="utf-8")
    got = read_raw_csv(spark, str(tmp_path / "in.csv"), RAW["courses_0nf"].schema())
    assert [tuple(r) for r in got.collect()] == [(None, "", None, "x", None)]


def test_staged_tables_can_be_dropped(spark):
    df = stage(spark.range(3))
    assert df.count() == 3
    assert path_exists(spark, staged_folder(spark))
    drop_staged(spark)
    assert not path_exists(spark, staged_folder(spark))


def test_append_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "A"), (2, "b")], "k int, v string")
    append_absent(df, path, ["k"])
    append_absent(df.unionByName(spark.createDataFrame([(3, "c")], df.schema)), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_both_tools_give_the_same_fourteen_rows(spark):
    df = literal_rows(spark, PARALLEL_LISTS, RAW["university_0nf"].schema())
    zipped = explode_zip(df, LISTS)
    indexed = explode_by_index(df, "courses", LISTS)
    assert zipped.count() == 14
    listed = [(r.student_record_id, r.pos) for r in explode_by_index(
        df, "courses", LISTS, order_by=["student_record_id"]).collect()]
    assert listed == sorted(listed)
    columns = ["student_record_id", "pos", "courses", "professors", "grades"]
    assert rows(zipped, *columns) == rows(indexed, *columns)
    assert rows(zipped.filter("student_record_id = 9"), *columns) == [
        (9, 1, "Математика", "Петров П.П.", "Математика:C"),
        (9, 2, "Физика", "Сидоров С.С.", "Физика:B")]
    assert list_length_report(df, LISTS).count() == 0


def test_unequal_lists(spark):
    df = spark.createDataFrame(
        [(1, "a;b", "x"), (2, None, "y"), (3, "", "z"), (4, "a", None), (5, None, None),
         (6, "a", "x;y"), (7, "a;", "x;")], "id int, l string, r string")
    assert rows(explode_zip(df, ["l", "r"]), "id", "pos", "l", "r") == sorted([
        (1, 1, "a", "x"), (1, 2, "b", None), (2, 1, None, "y"), (3, 1, None, "z"),
        (4, 1, "a", None), (6, 1, "a", "x"), (6, 2, None, "y"), (7, 1, "a", "x"),
        (7, 2, "", "")], key=lambda r: r[:2])
    assert rows(explode_by_index(df, "l", ["r"]), "id", "pos", "l", "r") == [
        (1, 1, "a", "x"), (1, 2, "b", None), (4, 1, "a", None), (6, 1, "a", "x"),
        (7, 1, "a", "x"), (7, 2, "", "")]
    assert rows(list_length_report(df, ["l", "r"])) == [
        (1, 2, 1), (2, 0, 1), (3, 0, 1), (4, 1, 0), (6, 1, 2)]


@pytest.mark.parametrize("delim", ["|", ".", "n", "::", "\\E", "^"])
def test_delimiters_are_literal(spark, delim):
    df = spark.createDataFrame([(f"1{delim}2{delim}3",)], "l string")
    assert [r.l for r in explode_zip(df, ["l"], delim).collect()] == ["1", "2", "3"]


item = st.text(alphabet=st.characters(exclude_characters=";", exclude_categories=["Cs"]),
               max_size=5)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(item, min_size=1, max_size=6), min_size=1, max_size=30))
def test_exploded_items_join_back(spark, lists):
    data = [(n, ";".join(items)) for n, items in enumerate(lists)]
    df = spark.createDataFrame(data, "id int, l string")
    back: dict[int, list] = {}
    for r in explode_zip(df, ["l"]).orderBy("id", "pos").collect():
        back.setdefault(r.id, []).append(r.l)
    assert back == {n: text.split(";") for n, text in data if text}
