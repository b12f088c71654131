import datetime as dt
from decimal import Decimal

import pytest
from frames import by_key, rows
from fixed_rows import LAYER_ROWS, ORDER_LINES
from pyspark.sql import functions as F

from loomhouse.operators import checks
from loomhouse.operators.fact import Link, build_fact, match_as_of
from loomhouse.operators.normalize import decompose, resolve_fk
from loomhouse.operators.scd2 import (
    Dimension,
    dim_as_of,
    scd2_apply,
    scd2_changes,
    scd2_classify,
    scd2_init,
    scd2_late,
    scd2_new,
    version_history,
)
from loomhouse.plans import marts, relational
from loomhouse.sources.contracts import HISTORY, RAW, TABLES, conform, violations
from loomhouse.sources.dimension_store import DimensionStore, refresh_stores
from loomhouse.sources.files import child_names, literal_rows
from loomhouse.sources.staging import stage

LOAD = "2024-02-01"
NEXT = "2024-03-01"
OPEN = dt.date(9999, 12, 31)
CITY, STUDENT, COURSE = relational.CITY, relational.STUDENT, relational.COURSE


def raw_lines(spark, lines=ORDER_LINES):
    return literal_rows(spark, lines, RAW["courses_0nf"].schema())


@pytest.fixture(scope="module")
def layers(spark):
    return relational.run_relational(raw_lines(spark), LOAD)


def refreshed(spark, layers, change, as_of=NEXT):
    """The history after the 2NF tables went through `change`."""
    nf2 = change({n: layers[n] for n in ("student_2nf", "course_2nf")})
    dims = {n: layers[n] for n in relational.DIMENSIONS}
    return relational.refresh_dimensions(nf2, dims, as_of)


def student_change(column, value, where):
    def change(nf2):
        student = nf2["student_2nf"]
        return nf2 | {"student_2nf": student.withColumn(
            column, F.when(F.expr(where), value).otherwise(F.col(column)))}
    return change


def course_change(column, value, where):
    def change(nf2):
        course = nf2["course_2nf"]
        return nf2 | {"course_2nf": course.withColumn(
            column, F.when(F.expr(where), value).otherwise(F.col(column)))}
    return change


def versions(dim, key, value):
    return [(r.valid_from, r.valid_to, r.is_current) for r in
            dim.filter(F.col(key) == value).orderBy("valid_from").collect()]


TWO = [(dt.date(2024, 2, 1), dt.date(2024, 2, 29), False), (dt.date(2024, 3, 1), OPEN, True)]


def test_row_counts_and_rules_of_every_layer(layers):
    assert {n: layers[n].count() for n in LAYER_ROWS} == LAYER_ROWS
    for name in LAYER_ROWS:
        for rule, bad in violations(layers, name).items():
            assert bad.count() == 0, (name, rule)
        shaped = conform(layers[name], TABLES[name])
        assert shaped.columns == TABLES[name].names()


def test_surrogate_keys_follow_business_keys(layers):
    cities = layers["cities_3nf_scd2"].orderBy("city_sk").collect()
    assert [r.city_sk for r in cities] == [1, 2, 3, 4]
    assert [r.city_name for r in cities] == sorted(r.city_name for r in cities)


def test_region_change_cascades_to_student(spark, layers):
    dims = refreshed(spark, layers, student_change(
        "student_region", F.lit("Новый"), "student_city = 'Казань'"))
    assert versions(dims["cities_3nf_scd2"], "city_name", "Казань") == TWO
    student = dims["student_3nf_scd2"]
    assert versions(student, "student_email", "alex.sidorov@mail.com") == TWO
    assert student.count() == 6
    sks = student.filter("student_email = 'alex.sidorov@mail.com'").orderBy("valid_from")
    assert [r.city_sk for r in sks.collect()][1] == 5
    for name in relational.DIMENSIONS:
        for rule, bad in violations(dims, name).items():
            assert bad.count() == 0, (name, rule)
        spec = relational.DIMENSIONS[name]
        assert checks.chain_breaks(dims[name], spec.bk, spec.sk).count() == 0


def test_second_refresh_does_not_flip_between_city_versions(spark, layers):
    change = student_change("student_region", F.lit("Новый"), "student_city = 'Казань'")
    dims = refreshed(spark, layers, change)
    nf2 = change({n: layers[n] for n in ("student_2nf", "course_2nf")})
    again = relational.refresh_dimensions(nf2, dims, "2024-04-01")
    for name, dim in dims.items():
        assert rows(again[name]) == rows(dim)


def test_teacher_rename_reaches_both_courses(spark, layers):
    dims = refreshed(spark, layers, course_change(
        "teacher_name", F.lit("С. Иванов"), "teacher_email = 's.ivanov@mail.com'"))
    courses = dims["courses_3nf_scd2"]
    assert versions(courses, "course_name", "Airflow") == TWO
    assert versions(courses, "course_name", "SQL для начинающих") == TWO
    assert courses.count() == 6


def test_price_change_keeps_old_facts(spark, layers):
    dims = refreshed(spark, layers, course_change(
        "course_price", F.lit(Decimal("19000.00")), "course_name = 'Power BI'"))
    orders = layers["orders_2nf"]
    before = relational.orders_fact(orders, dims, "as_of")
    after = relational.orders_fact(orders, dims, "current")
    price = by_key(dims["courses_3nf_scd2"], "course_sk", "course_price")
    power_bi = {r.course_sk for r in dims["courses_3nf_scd2"].filter(
        "course_name = 'Power BI'").collect()}
    assert {price[r.course_sk] for r in before.collect() if r.course_sk in power_bi} == {
        Decimal("18000.00")}
    assert {price[r.course_sk] for r in after.collect() if r.course_sk in power_bi} == {
        Decimal("19000.00")}
    revenue = marts.revenue_at_time(before, dims["courses_3nf_scd2"]).collect()
    assert [(r.order_month, r.n_orders, r.revenue) for r in revenue] == [
        ("2024-01", 12, Decimal("225000.00"))]


def test_nulls_new_keys_missing_keys(spark):
    spec = Dimension("sk", "k", ("a", "b"))
    schema = "k string, a string, b int"
    first = spark.createDataFrame([("x", "1", 1), ("n", None, 1), ("v", "1", None),
                                   ("gone", "1", 1)], schema)
    dim = scd2_init(first, spec, LOAD)
    second = spark.createDataFrame([("x", "1", 1), ("n", "now", 1), ("v", None, None),
                                    ("new", "1", 1), (None, "1", 1)], schema)
    assert rows(scd2_changes(second, dim, spec), "k", "a", "b") == rows(
        spark.createDataFrame([("n", "now", 1), ("v", None, None)], schema))
    assert rows(scd2_new(second, dim, spec)) == [("new", "1", 1)]
    state = scd2_apply(second, dim, spec, NEXT)
    assert versions(state, "k", "x") == [(dt.date(2024, 2, 1), OPEN, True)]
    assert versions(state, "k", "gone") == [(dt.date(2024, 2, 1), OPEN, True)]
    assert versions(state, "k", "n") == TWO
    assert versions(state, "k", "v") == TWO
    assert versions(state, "k", "new") == [(dt.date(2024, 3, 1), OPEN, True)]
    # Changed keys are numbered before new ones.
    assert [r.k for r in state.filter("sk > 4").orderBy("sk").collect()] == ["n", "v", "new"]
    assert rows(scd2_apply(second, state, spec, "2024-04-01")) == rows(state)
    back = scd2_apply(first, state, spec, "2024-05-01")
    assert checks.chain_breaks(back, "k", "sk").count() == 0
    assert checks.several_current(back, "k").count() == 0
    assert [r.k for r in version_history(back, "k").collect()] == sorted(
        r.k for r in back.collect())
    assert rows(dim_as_of(back, "2024-03-15"), "k", "a") == rows(
        state.filter("is_current"), "k", "a")


def test_same_day_change_overwrites_and_late_change_is_refused(spark):
    spec = Dimension("sk", "k", ("a",))
    dim = scd2_init(spark.createDataFrame([("x", "1"), ("y", "1")], "k string, a string"),
                    spec, LOAD)
    changed = spark.createDataFrame([("x", "2"), ("z", "9")], "k string, a string")
    today = scd2_apply(changed, dim, spec, LOAD)
    assert rows(today, "sk", "k", "a", "is_current") == [
        (1, "x", "2", True), (2, "y", "1", True), (3, "z", "9", True)]
    assert rows(scd2_apply(changed, dim, spec, "2024-01-01"), "k", "a") == [
        ("x", "1"), ("y", "1"), ("z", "9")]
    assert rows(scd2_late(changed, dim, spec, "2024-01-01"), "k", "a") == [("x", "2")]


def test_closed_only_key_is_not_new(spark):
    spec = Dimension("sk", "k", ("a",))
    dim = scd2_init(spark.createDataFrame([("x", "1")], "k string, a string"), spec, LOAD)
    closed = dim.withColumn("is_current", F.lit(False))
    src = spark.createDataFrame([("x", "1"), ("w", "1")], "k string, a string")
    assert rows(scd2_new(src, closed, spec), "k") == [("w",)]
    assert rows(scd2_apply(src, closed, spec, NEXT), "k", "is_current") == [
        ("w", True), ("x", False)]


def test_two_attribute_sets_for_a_key(spark):
    spec = Dimension("sk", "k", ("a",))
    src = spark.createDataFrame([("x", "1"), ("x", "2"), ("x", None)], "k string, a string")
    dim = scd2_init(src, spec, LOAD)
    assert rows(dim, "k", "a") == [("x", "2")]
    assert scd2_apply(src, dim, spec, NEXT).count() == 1
    assert rows(checks.dependency_violations(src, ["k"], ["a"])) == [("x", 3)]


def test_decompose_latest(spark):
    df = spark.createDataFrame([("c", 1, 10), ("c", 2, 12), ("d", 1, 5), ("d", 1, 7)],
                               "k string, day int, price int")
    assert rows(decompose(df, ["k"], ["price"])) == [
        ("c", 10), ("c", 12), ("d", 5), ("d", 7)]
    assert rows(decompose(df, ["k"], ["price"], latest_by="day")) == [("c", 12), ("d", 7)]


def test_unresolvable_children_drop_out(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    parent = spark.createDataFrame([("a", 10)], "key string, sk int")
    assert rows(resolve_fk(child, parent, {"k": "key"})) == [(1, "a")]
    assert rows(resolve_fk(child, parent, {"k": "key"}, {"parent_sk": "sk"}, drop_key=True)
                ) == [(1, 10)]


def _many_versions(spark):
    """One key with a version per day for 400 days, others with a single version."""
    start = "date'2020-01-01'"
    hot = spark.range(400).select(
        F.lit("hot").alias("k"), (F.col("id") + 1).alias("sk"), F.lit("x").alias("a"),
        F.expr(f"date_add({start}, cast(id as int))").alias("valid_from"),
        F.expr(f"if(id = 399, date'9999-12-31', date_add({start}, cast(id as int)))"
               ).alias("valid_to"), (F.col("id") == 399).alias("is_current"))
    cold = spark.range(5).select(
        F.concat(F.lit("c"), "id").alias("k"), (F.col("id") + 1000).alias("sk"),
        F.lit("x").alias("a"), F.expr("date'2020-06-01'").alias("valid_from"),
        F.expr("date'9999-12-31'").alias("valid_to"), F.lit(True).alias("is_current"))
    return hot.unionByName(cold)


@pytest.mark.parametrize("extend_first", [True, False])
def test_key_with_many_versions_matches_plain_rules(spark, extend_first):
    spec = Dimension("sk", "k", ("a",))
    dim = _many_versions(spark)
    events = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 != 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("k"),
        F.expr("date_add(date'2019-12-01', cast(id % 700 as int))").alias("order_date"))
    link = Link(dim, spec, "k")
    deep = match_as_of(events, link, "order_date", extend_first)
    assert match_as_of(events.limit(0), link, "order_date", extend_first).count() == 0
    others = events.filter("k <> 'hot'")
    assert rows(match_as_of(others, link, "order_date", extend_first)) == rows(
        deep.filter("k <> 'hot'"))
    brute = {}
    firsts = {}
    for r in dim.collect():
        brute.setdefault(r.k, []).append((r.valid_from, r.valid_to, r.sk))
        firsts[r.k] = min(firsts.get(r.k, r.valid_from), r.valid_from)
    expected = []
    for e in events.collect():
        for low, high, sk in brute.get(e.k, []):
            if extend_first and low == firsts[e.k]:
                low = dt.date.min
            if low <= e.order_date <= high:
                expected.append((e.id, sk))
    assert rows(deep, "id", "sk") == sorted(expected, key=lambda r: tuple(
        (True, str(v)) for v in r))


def test_unordered_fact_has_the_same_rows(layers):
    dims = {n: layers[n] for n in relational.DIMENSIONS}
    links = [Link(dims["student_3nf_scd2"], STUDENT, "student_email"),
             Link(dims["courses_3nf_scd2"], COURSE, "course_name")]
    loose = build_fact(layers["orders_2nf"], links, ordered=False)
    assert sorted(r.order_sk for r in loose.collect()) == list(range(1, 13))
    columns = ["order_date", "student_sk", "course_sk", "payment_method", "payment_status"]
    assert rows(loose, *columns) == rows(layers["orders_3nf_fact"], *columns)
    with pytest.raises(ValueError):
        build_fact(layers["orders_2nf"], links, mode="yesterday")


def test_star_and_questions(spark, layers):
    star = relational.orders_star(layers["orders_3nf_fact"], layers, layers)
    assert rows(star, "order_date", "student_email", "course_name", "payment_method",
                "payment_status") == rows(
        layers["orders_2nf"], "order_date", "student_email", "course_name", "payment_method",
        "payment_status")
    assert by_key(marts.students_per_city(layers["student_3nf"]), "student_city",
                  "n_students")["Москва"] == 2
    prices = by_key(marts.avg_price_by_category(layers["orders_3nf"], layers["course_3nf"]),
                    "course_category", "n_orders", "avg_price")
    assert prices["BI"] == (3, 18000.0)
    assert prices["Data"][0] == 9 and abs(prices["Data"][1] - 19000.0) < 1e-9
    assert rows(marts.teacher_count(layers["teachers_3nf"])) == [(3,)]
    others = marts.courses_of_students(layers["orders_3nf"])
    assert rows(others.filter("student_email = 'ivan.petrov@mail.com'"),
                "course_name", "n_others") == [
        ("Airflow", 2), ("Python ETL", 2), ("SQL для начинающих", 2)]
    assert by_key(marts.bought_with_best_seller(layers["orders_3nf"]), "course_name",
                  "n_students") == {"Power BI": 1, "Python ETL": 2, "SQL для начинающих": 1}
    assert rows(marts.teachers_by_category(layers["course_3nf"], layers["teachers_3nf"]),
                "course_category", "teacher_email") == [
        ("BI", "m.orlova@mail.com"), ("Data", "o.kuz@mail.com"), ("Data", "s.ivanov@mail.com")]
    assert rows(marts.duplicate_persons(layers["courses_1nf"])) == [(12, 5, 5)]


def test_lines_loaded_twice_break_the_key(spark):
    nf1 = relational.to_1nf(raw_lines(spark, ORDER_LINES * 2))
    assert violations({"courses_1nf": nf1}, "courses_1nf")["key"].count() == 12


def test_stores_cascade_like_frames(spark, layers, tmp_path):
    nf2 = {n: layers[n] for n in ("student_2nf", "course_2nf")}
    moved = student_change("student_region", F.lit("Новый"), "student_city = 'Казань'")(nf2)
    stores = {n: DimensionStore(spark, str(tmp_path / n), spec, HISTORY[n].schema())
              for n, spec in relational.DIMENSIONS.items()}
    for state, day in ((nf2, LOAD), (moved, NEXT)):
        refresh_stores(stores, relational.dimension_sources(state), relational.PARENTS, day)
    expected = relational.refresh_dimensions(
        moved, {n: layers[n] for n in relational.DIMENSIONS}, NEXT)
    for name, dim in expected.items():
        assert rows(stores[name].read()) == rows(dim)


def test_store_commits_a_refresh_as_one_step(spark, tmp_path):
    def city(*pairs):
        return spark.createDataFrame(list(pairs), "city_name string, region_name string")

    store = DimensionStore(spark, str(tmp_path / "city"), CITY,
                           HISTORY["cities_3nf_scd2"].schema())
    store.refresh(city(("A", "1"), ("B", "1")), LOAD)
    assert store.committed() == 1
    store.refresh(city(("A", "2"), ("C", "1")), NEXT)
    state = rows(store.read(), "city_sk", "city_name", "region_name", "is_current")
    assert state == [(1, "A", "1", False), (2, "B", "1", True), (3, "A", "2", True),
                     (4, "C", "1", True)]
    # A refresh that died after writing its closed versions is invisible and redone.
    half = spark.createDataFrame([(3, "A", "2", dt.date(2024, 3, 1), dt.date(2024, 3, 31),
                                   False)], store.schema)
    half.write.parquet(store._closed_path(3))
    assert rows(store.read(), "city_sk", "city_name", "region_name", "is_current") == state
    store.refresh(city(("A", "3")), NEXT)
    assert rows(store.read(), "city_sk", "region_name", "is_current") == [
        (1, "1", False), (2, "1", True), (3, "3", True), (4, "1", True)]
    assert store.read().schema.fieldNames() == HISTORY["cities_3nf_scd2"].names()


def many_cities(spark, n, region):
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("city_name"),
                                 region(F.col("id")).alias("region_name"))


def held_files(store):
    held, parts, _ = store._state(store.committed())
    return {k: (v, sorted(n for n in child_names(store.spark, store._current_path(v, k))
                          if n.endswith(".parquet"))) for k, v in held.items()}, parts


def test_parts_without_changes_keep_their_files(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "city"), CITY,
                           HISTORY["cities_3nf_scd2"].schema(), parts=16)
    store.refresh(many_cities(spark, 500, lambda i: F.lit("old")), LOAD)
    before, parts = held_files(store)
    assert parts == 16 == len(before)
    changed = many_cities(spark, 502, lambda i: F.when((i == 7) | (i == 8), "new").otherwise("old"))
    store.refresh(changed, NEXT)
    after, _ = held_files(store)
    touched = {k for k in before if after[k] != before[k]}
    assert 1 <= len(touched) <= 4 and {after[k][0] for k in touched} == {2}
    again = DimensionStore(spark, store.root, CITY, store.schema)      # parts as first settled
    plain = scd2_apply(changed, scd2_init(many_cities(spark, 500, lambda i: F.lit("old")),
                                          CITY, LOAD), CITY, NEXT)
    assert rows(again.read()) == rows(plain)
    again.refresh(changed, "2024-09-01")                               # nothing to do
    assert again.committed() == 3 and held_files(again)[0] == after


def test_a_source_of_some_keys_reads_and_writes_their_parts(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "city"), CITY,
                           HISTORY["cities_3nf_scd2"].schema(), parts=8)
    store.refresh(many_cities(spark, 200, lambda i: F.lit("old")), LOAD)
    some = spark.createDataFrame([("c5", "new"), ("c6", "old"), ("zz", "x")],
                                 "city_name string, region_name string")
    before, _ = held_files(store)
    store.refresh(some, NEXT)
    after, _ = held_files(store)
    assert sum(after[k] != before[k] for k in before) <= 2
    plain = scd2_apply(some, scd2_init(many_cities(spark, 200, lambda i: F.lit("old")), CITY, LOAD),
                       CITY, NEXT)
    assert rows(store.read()) == rows(plain)
    assert store.changes(1).collect()[0] == (plain.filter("city_name = 'c5' AND NOT is_current")
                                             .first()["city_sk"], 201)
    assert store.changes(2) is None


def test_children_follow_their_parents(spark, layers, tmp_path):
    nf2 = {n: layers[n] for n in ("student_2nf", "course_2nf")}
    moved = student_change("student_region", F.lit("Новый"), "student_city = 'Казань'")(nf2)
    names = ("cities_3nf_scd2", "student_3nf_scd2")
    given = [relational.dimension_sources(state) for state in (nf2, moved)]
    found = []
    for second in (names, names[:1]):          # with students in the second delivery, and without
        stores = {n: DimensionStore(spark, str(tmp_path / str(len(second)) / n),
                                    relational.DIMENSIONS[n], HISTORY[n].schema()) for n in names}
        refresh_stores(stores, {n: given[0][n] for n in names}, relational.PARENTS, LOAD)
        refresh_stores(stores, {n: given[1][n] for n in second}, relational.PARENTS, NEXT)
        found.append(rows(stores["student_3nf_scd2"].read()))
    assert found[0] == found[1] and any(not r[-1] for r in found[0])
    # A call that died between a parent and its child is made up for by the next one.
    late = {n: DimensionStore(spark, str(tmp_path / "late" / n), relational.DIMENSIONS[n],
                              HISTORY[n].schema()) for n in names}
    refresh_stores(late, {n: given[0][n] for n in names}, relational.PARENTS, LOAD)
    late[names[0]].refresh(given[1][names[0]], NEXT)
    refresh_stores(late, {}, relational.PARENTS, NEXT)
    assert rows(late["student_3nf_scd2"].read()) == found[0]


def test_states_nobody_reads_any_more_are_deleted(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "city"), CITY,
                           HISTORY["cities_3nf_scd2"].schema(), parts=2)
    for n in range(5):
        store.refresh(many_cities(spark, 20, lambda i: F.lit(f"r{n}")), f"2024-0{n + 1}-01")
        slow_reader = store.current() if n == 3 else None if n < 3 else slow_reader
    assert sorted(child_names(spark, f"{store.root}/current")) == ["version=4", "version=5"]
    assert sorted(child_names(spark, f"{store.root}/commits")) == ["version=4", "version=5"]
    assert {r["region_name"] for r in slow_reader.collect()} == {"r3"}
    assert store.read().count() == 100


def test_a_refresh_joins_current_versions_once(spark):
    old = stage(scd2_init(many_cities(spark, 300, lambda i: F.lit("old")), CITY, LOAD))
    new = many_cities(spark, 300, lambda i: F.when(i % 3 == 0, "new").otherwise("old"))
    plan = scd2_classify(new, old, CITY, NEXT, closed_only=False)._jdf.queryExecution(
        ).optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Join FullOuter" in plan
