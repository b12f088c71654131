"""Every operator as a query over a folder of the order tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks
from ..operators.explode import explode_by_index, explode_zip, list_length_report
from ..operators.fact import Link, match_as_of
from ..operators.keys import assign_sk
from ..operators.normalize import decompose, extract_dictionary
from ..operators.parse import parse_rejects
from ..operators.scd2 import (
    VERSION_COLUMNS,
    Dimension,
    dim_as_of,
    opened_versions,
    scd2_apply,
    scd2_cascade,
    scd2_changes,
    scd2_close,
    scd2_delta,
    scd2_late,
    scd2_new,
    version_history,
    with_parent_sk,
)
from ..operators.vault import (
    key_rejects,
    latest_satellite,
    satellite_conflicts,
    satellite_rejects,
)
from ..sources.contracts import HISTORY, violations
from ..sources.dimension_store import DimensionStore, refresh_stores
from ..sources.files import append_absent, stored_bytes
from ..sources.raw_csv import read_raw_csv
from ..sources.staging import stage, staged_path
from ..sources.vault_store import VaultStore
from ..streaming.vault_stream import vault_stream
from . import driver_views as views
from . import marts, relational, vault
from .driver_views import (
    FIRST_BATCH,
    FIRST_LOAD,
    SECOND_BATCH,
    SECOND_LOAD,
    THIRD_BATCH,
)

Query = Callable[[SparkSession, str], DataFrame]
Dims = dict[str, DataFrame]

CITIES, STUDENTS = "cities_3nf_scd2", "student_3nf_scd2"
TEACHERS, COURSES = "teachers_3nf_scd2", "courses_3nf_scd2"
FED_BY = {"student_2nf": (CITIES, STUDENTS), "course_2nf": (TEACHERS, COURSES)}
LISTS = ["lines", "sentences", "label"]
# Orders of a zone in stores filled by queries.
ZONE_WIDTH = 1 << 13
# Stored bytes of a table that go into one CSV file.
CSV_BYTES = 1 << 28
# Files of a stream, which come in two batches; an order lies in one file.
STREAM_FILES = 24
# Bytes of a row group in them: a task reads one at least.
ROW_GROUP_BYTES = 1 << 24
# Parts of the dimensions that queries store.
STORE_PARTS = 4
LINE_BREAK = "\n"
A_DAY_BETWEEN = "1997-06-30"
A_LATER_LOAD = "2000-01-01"


def _portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as double: alike in every SQL engine."""
    columns = []
    for f in df.schema.fields:
        kind = f.dataType
        if isinstance(kind, (T.DateType, T.TimestampNTZType)):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(kind, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


# --- raw to normal forms -------------------------------------------------------------

def _nf1(spark, folder):
    return relational.to_1nf(views.raw_orders(spark, folder))


def _nf2(spark, folder):
    nf1 = stage(_nf1(spark, folder), "courses_1nf")
    return relational.to_2nf(nf1)


def nf3_city(spark, folder):
    return relational.cities_3nf(relational.student_2nf(_nf1(spark, folder)))


def nf3_teacher(spark, folder):
    return relational.teachers_3nf(relational.course_2nf(_nf1(spark, folder)))


def _nf3_dictionary(column: str) -> Query:
    return lambda spark, folder: extract_dictionary(
        relational.orders_2nf(_nf1(spark, folder)), column)


def nf3_student(spark, folder):
    student = stage(relational.student_2nf(_nf1(spark, folder)), "student_2nf")
    return relational.student_3nf(student, stage(relational.cities_3nf(student), "cities_3nf"))


def _course_and_teachers(spark, folder) -> tuple[DataFrame, DataFrame]:
    course = stage(relational.course_2nf(_nf1(spark, folder)), "course_2nf")
    return course, stage(relational.teachers_3nf(course), "teachers_3nf")


def nf3_course(spark, folder):
    return relational.course_3nf(*_course_and_teachers(spark, folder))


def nf3_orders(spark, folder):
    return relational.to_3nf(relational.stage_all(_nf2(spark, folder)))["orders_3nf"]


def csv_load(spark, folder):
    """Documents written as CSV, a large table as several files, and read again by several tasks:
    quotes and line breaks included."""
    documents = views.table(spark, folder, "documents").select("doc_id", "lang", "text")
    path = staged_path(spark, "csv")
    files = 1 + stored_bytes(spark, f"{folder.rstrip('/')}/documents.parquet") // CSV_BYTES
    (documents.coalesce(files).write.option("header", True).option("quote", '"').option("escape", '"')
     .option("quoteAll", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_raw_csv(spark, path, documents.schema, multi_line=True)


def absent_append(spark, folder):
    """Customers appended in two overlapping deliveries, the second with another segment: rows
    already stored stay."""
    people = views.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = staged_path(spark, "customers")
    append_absent(people.filter("c_custkey % 3 <> 0"), path, ["c_custkey"])
    renamed = people.filter("c_custkey % 2 = 0 OR c_custkey % 3 = 0").withColumn(
        "c_mktsegment", F.lower("c_mktsegment"))
    append_absent(renamed.unionByName(renamed), path, ["c_custkey"])
    return spark.read.schema(people.schema).parquet(path)


def explode_zip_lists(spark, folder):
    return explode_zip(views.parallel_lists(spark, folder), LISTS, LINE_BREAK)


def explode_index_lists(spark, folder):
    return explode_by_index(views.parallel_lists(spark, folder), "lines", LISTS, LINE_BREAK)


def explode_index_sparse(spark, folder):
    return explode_by_index(views.parallel_lists(spark, folder), "label", LISTS, LINE_BREAK,
                            order_by=["doc_id"])


def list_lengths(spark, folder):
    return list_length_report(views.parallel_lists(spark, folder), LISTS, LINE_BREAK)


def course_latest(spark, folder):
    """Both course deliveries as dated lines; each course keeps its newest attributes."""
    first, second = (views.course_snapshot(spark, folder, s) for s in (False, True))
    dated = first.withColumn("order_date", F.lit(FIRST_LOAD).cast("date")).unionByName(
        second.withColumn("order_date", F.lit(SECOND_LOAD).cast("date")))
    attrs = [c for c in first.columns if c != "course_name"]
    return decompose(dated, ["course_name"], attrs, latest_by="order_date")


def numbered_orders(spark, folder):
    return assign_sk(views.order_lines(spark, folder),
                     ["order_date", "o_custkey", "l_partkey"], "order_sk")


# --- history -------------------------------------------------------------------------

def _load(spark, folder, names: Sequence[str], second: bool, dims: Dims, as_of: str) -> Dims:
    wanted = [n2 for n2, fed in FED_BY.items() if any(n in fed for n in names)]
    sources = relational.dimension_sources(views.snapshot(spark, folder, second, wanted))
    specs = {n: relational.DIMENSIONS[n] for n in names}
    return scd2_cascade(sources, dims, specs, relational.PARENTS, as_of)


def _first(spark, folder, names) -> Dims:
    return _load(spark, folder, names, False, {}, FIRST_LOAD)


def _both(spark, folder, names) -> Dims:
    return _load(spark, folder, names, True, _first(spark, folder, names), SECOND_LOAD)


def _dimension(*names: str) -> Query:
    return lambda spark, folder: _both(spark, folder, names)[names[-1]]


def _initial(*names: str) -> Query:
    return lambda spark, folder: _first(spark, folder, names)[names[-1]]


def _second_students(spark, folder) -> tuple[DataFrame, DataFrame]:
    """The second delivery of students, with city keys, and the students of the first."""
    first = _first(spark, folder, [CITIES, STUDENTS])
    cities = _load(spark, folder, [CITIES], True, first, SECOND_LOAD)[CITIES]
    students = with_parent_sk(views.student_snapshot(spark, folder, True), cities,
                              relational.CITY, "student_city")
    return students, first[STUDENTS]


def scd2_changed(spark, folder):
    return scd2_changes(*_second_students(spark, folder), relational.STUDENT)


def scd2_new_keys(spark, folder):
    return scd2_new(*_second_students(spark, folder), relational.STUDENT)


def scd2_closed(spark, folder):
    src, dim = _second_students(spark, folder)
    changed = scd2_changes(src, dim, relational.STUDENT)
    return scd2_close(dim, changed, relational.STUDENT, SECOND_LOAD)


def _opened(spark, folder) -> tuple[DataFrame, DataFrame]:
    src, dim = _second_students(spark, folder)
    delta = scd2_delta(src, dim, relational.STUDENT, SECOND_LOAD)
    return dim, opened_versions(delta, relational.STUDENT, SECOND_LOAD)


def scd2_opened(spark, folder):
    return _opened(spark, folder)[1]


def scd2_idempotent(spark, folder):
    """The second delivery once more, later: nothing may change."""
    names = [CITIES, STUDENTS]
    return _load(spark, folder, names, True, _both(spark, folder, names), A_LATER_LOAD)[STUDENTS]


def scd2_same_day(spark, folder):
    """The second delivery on the day of the first: versions are corrected in place."""
    names = [CITIES, STUDENTS]
    return _load(spark, folder, names, True, _first(spark, folder, names), FIRST_LOAD)[STUDENTS]


def dimension_store(spark, folder):
    """Cities refreshed twice through the folder layout."""
    store = DimensionStore(spark, staged_path(spark, "cities"),
                           relational.CITY, HISTORY[CITIES].schema())
    for second, day in ((False, FIRST_LOAD), (True, SECOND_LOAD)):
        nf2 = views.snapshot(spark, folder, second, ["student_2nf"])
        store.refresh(relational.dimension_sources(nf2)[CITIES], day)
    return store.read()


def store_cascade(spark, folder):
    """Students refreshed in their store after the cities they point to, with the region that
    each version points to."""
    return _stored_students(spark, folder, [CITIES, STUDENTS])


def store_follow(spark, folder):
    """The same where the second delivery has cities only: the students of those that changed
    follow."""
    return _stored_students(spark, folder, [CITIES])


def _stored_students(spark, folder, second_delivery):
    stores = {n: DimensionStore(spark, staged_path(spark, n), relational.DIMENSIONS[n],
                                HISTORY[n].schema(), STORE_PARTS)
              for n in (CITIES, STUDENTS)}
    for second, day in ((False, FIRST_LOAD), (True, SECOND_LOAD)):
        sources = relational.dimension_sources(views.snapshot(spark, folder, second,
                                                              ["student_2nf"]))
        given = second_delivery if second else [CITIES, STUDENTS]
        refresh_stores(stores, {n: sources[n] for n in given}, relational.PARENTS, day)
    cities = stores[CITIES].read().select("city_sk", "city_name", "region_name")
    return stores[STUDENTS].read().join(cities, "city_sk").drop("city_sk", "student_sk")


def late_changes(spark, folder):
    """The first delivery once more, dated before the versions the second one opened."""
    dims = _both(spark, folder, [CITIES, STUDENTS])
    students = with_parent_sk(views.student_snapshot(spark, folder, False), dims[CITIES],
                              relational.CITY, "student_city")
    return scd2_late(students, dims[STUDENTS], relational.STUDENT, A_DAY_BETWEEN)


def broken_contracts(spark, folder):
    """Rows against each rule of two tables: students after half a refresh, with cities missing,
    and courses whose promotion prices are too large for their type."""
    dim, opened = _opened(spark, folder)
    cities = _both(spark, folder, [CITIES])[CITIES].filter("region_name <> 'AMERICA'")
    price = F.col("course_price").cast("decimal(18,2)")
    courses = views.course_snapshot(spark, folder, False).withColumn(
        "course_price", F.when(F.col("course_category") == "PROMO", price + F.lit(10**9))
        .otherwise(price).cast("decimal(18,2)"))
    tables = {STUDENTS: stage(dim.unionByName(opened), "students"), CITIES: cities,
              "course_3nf": courses}
    counts = [rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), "n_rows")
        for name in (STUDENTS, "course_3nf") for rule, rows in violations(tables, name).items()]
    return reduce(DataFrame.unionByName, counts)


def unreadable_lines(spark, folder):
    """Courses whose price cannot be read, and how many raw lines have them."""
    course = F.col("course_info")
    lost = F.concat(F.split_part(course, F.lit("|"), F.lit(1)), F.lit("|PROMO|n/a"))
    raw = views.raw_orders(spark, folder).withColumn(
        "course_info", F.when(course.contains("|PROMO|"), lost).otherwise(course))
    return (parse_rejects(raw, relational.ORDER_LINE).groupBy("course_info", "unreadable")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def student_history(spark, folder):
    return version_history(_both(spark, folder, [CITIES, STUDENTS])[STUDENTS], "student_email")


def students_as_of(spark, folder):
    return dim_as_of(_both(spark, folder, [CITIES, STUDENTS])[STUDENTS], A_DAY_BETWEEN)


def _fact(spark, folder, mode, ordered=True) -> tuple[DataFrame, Dims, Dims]:
    dims = _both(spark, folder, [CITIES, STUDENTS, TEACHERS, COURSES])
    orders = stage(views.orders_2nf(spark, folder), "orders_2nf")
    refs = relational.stage_all(relational.references(orders))
    return relational.orders_fact(orders, dims, mode, refs=refs, ordered=ordered), dims, refs


def fact_current(spark, folder):
    return _fact(spark, folder, "current")[0]


def fact_as_of(spark, folder):
    return _fact(spark, folder, "as_of")[0]


def fact_as_of_deep(spark, folder):
    """Order lines by the version, on their shipping day, of a dimension whose few keys have a
    version for every day with orders: the largest order of a priority."""
    orders = views.table(spark, folder, "orders")
    days = orders.groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("valid_from")
                          ).agg(F.max(F.col("o_totalprice").cast("decimal(12,2)")).alias("largest"))
    later = F.lead("valid_from").over(Window.partitionBy("o_orderpriority").orderBy("valid_from"))
    dim = days.select(
        F.concat_ws("|", "o_orderpriority", "valid_from").alias("priority_sk"), "o_orderpriority",
        "largest", "valid_from",
        F.coalesce(F.date_sub(later, 1), F.lit("9999-12-31").cast("date")).alias("valid_to"),
        later.isNull().alias("is_current"))
    lines = views.table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("order_date"))
    events = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"),
                        "l_orderkey")
    link = Link(dim, Dimension("priority_sk", "o_orderpriority", ("largest",)), "o_orderpriority")
    return (match_as_of(events, link, "order_date").groupBy("priority_sk")
            .agg(F.count("*").alias("n_lines"), F.min("order_date").cast("string").alias("first_day")))


def sat_conflicts(spark, folder):
    """Attribute sets of order lines that lose against a greater one of their pair."""
    return satellite_conflicts(views.staged_orders(spark, folder), ["order_id", "product_id"],
                               vault.LINK_SATELLITES["sat_order_product"][2])


def star(spark, folder):
    fact, dims, refs = _fact(spark, folder, "as_of")
    return relational.orders_star(fact, dims, refs)


def revenue_at_time(spark, folder):
    fact, dims, _ = _fact(spark, folder, "as_of", ordered=False)
    return marts.revenue_at_time(fact, dims[COURSES])


def _digits(column):
    return F.sum(F.conv(F.substring(column, 1, 5), 16, 10).cast("long"))


def relational_layers(spark, folder):
    """Rows of every layer, and sums over digests of their business columns."""
    tables = relational.run_relational(views.raw_orders(spark, folder), SECOND_LOAD)
    found = []
    for name, df in tables.items():
        columns = [c for c in df.columns if not c.endswith("_sk") and c not in VERSION_COLUMNS]
        row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-"))
                                       for c in sorted(columns)]))
        found.append(df.agg(F.count(F.lit(1)).alias("n_rows"), _digits(row).alias("contents"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "contents"))
    return reduce(DataFrame.unionByName, found)


# --- vault ---------------------------------------------------------------------------

def _contents(tables: Dims) -> DataFrame:
    """Rows of each vault table, and sums over the first digits of its digests: its own key and,
    for a satellite, the attributes."""
    found = []
    for name, df in tables.items():
        attributes = _digits("hash_diff") if "hash_diff" in df.columns else F.lit(0).cast("long")
        found.append(df.agg(F.count(F.lit(1)).alias("n_rows"), _digits(df.columns[0]).alias("keys"),
                            attributes.alias("attributes"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "keys", "attributes"))
    return reduce(DataFrame.unionByName, found)


def _hub(name: str) -> Query:
    return lambda spark, folder: vault.hub(views.staged_orders(spark, folder), name, FIRST_BATCH)


def _staged(spark, folder, *columns: str) -> DataFrame:
    """Staging rows with the columns a query needs, written once for its several readers."""
    return stage(views.staged_orders(spark, folder).select(*columns), "stg_orders",
                 codec="zstd")


LINE_COLUMNS = ("order_id", "product_id", "qty", "price", "source_system")


def _link(name: str) -> Query:
    """With the existence check against hubs that an earlier load filled."""
    def run(spark, folder):
        ends = vault.LINKS[name][1]
        stg = _staged(spark, folder, *[vault.HUBS[h][1] for h in ends], "source_system")
        hubs = {h: stage(vault.hub(stg, h, FIRST_BATCH), h) for h in ends}
        return vault.link(stg, name, FIRST_BATCH, hubs=hubs)
    return run


def _satellite(name: str) -> Query:
    return lambda spark, folder: vault.satellite(
        views.staged_orders(spark, folder), name, FIRST_BATCH)


def sat_known_orders(spark, folder):
    """Attributes of all orders, of which a hub filled earlier holds only the early ones."""
    hub = stage(vault.hub(_early_batch(spark, folder), "hub_order", FIRST_BATCH), "hub")
    return vault.satellite(views.staged_orders(spark, folder), "sat_order", SECOND_BATCH,
                           parent=hub)


def vault_key_rejects(spark, folder):
    """Rows that lack a key: pending orders have no customer yet, promotions no product."""
    stg = views.staged_orders(spark, folder)
    lacking = stg.withColumns({
        "customer_id": F.when(F.col("order_status") != "P", F.col("customer_id")),
        "product_id": F.when(F.col("product_category") != "PROMO", F.col("product_id"))})
    return key_rejects(lacking, ["customer_id", "order_id", "product_id"])


def vault_increment(spark, folder):
    """A store that holds all orders but the last hundredth, after a batch of the last two
    hundredths: half of it is stored already, and only its zones are read."""
    stg = stage(views.staged_orders(spark, folder), "stg_orders", codec="zstd")
    last = stg.agg(F.max("order_id")).first()[0]
    store = VaultStore(spark, staged_path(spark, "vault"), ZONE_WIDTH)
    vault.load_vault(stg.filter(F.col("order_id") <= last - last // 100), store, FIRST_BATCH,
                     written=True)
    vault.load_vault(stg.filter(F.col("order_id") > last - last // 50), store, SECOND_BATCH,
                     written=True)
    return _contents({name: store.read(name) for name in vault.TABLES})


def sat_order_product(spark, folder):
    stg = _staged(spark, folder, *LINE_COLUMNS)
    # The satellite looks up the link's own key only.
    links = stage(vault.link(stg, "link_order_product", FIRST_BATCH).select(
        vault.LINKS["link_order_product"][0]), "links")
    return vault.link_satellite(stg, "sat_order_product", FIRST_BATCH, parent=links)


def sat_link_second_batch(spark, folder):
    """Lines of the first orders, then all lines against them."""
    stg = _staged(spark, folder, *LINE_COLUMNS, "load_dts")
    first = stage(vault.link_satellite(views.before_second_load(stg), "sat_order_product",
                                       FIRST_BATCH), "sat", codec="zstd")
    return first.unionByName(vault.link_satellite(stg, "sat_order_product", SECOND_BATCH, first))


def _early_batch(spark, folder):
    """Orders before the second load, as they first arrived: all of them new."""
    fresh = views.staged_orders(spark, folder, status=lambda c: F.lit("NEW"))
    return views.before_second_load(fresh)


def _two_batches(spark, folder) -> DataFrame:
    first = stage(vault.satellite(_early_batch(spark, folder), "sat_order", FIRST_BATCH), "sat")
    second = vault.satellite(views.staged_orders(spark, folder), "sat_order", SECOND_BATCH, first)
    return first.unionByName(second)


def hub_second_batch(spark, folder):
    first = stage(vault.hub(_early_batch(spark, folder), "hub_order", FIRST_BATCH), "hub")
    second = vault.hub(views.staged_orders(spark, folder), "hub_order", SECOND_BATCH, first)
    return first.unionByName(second)


def sat_latest(spark, folder):
    return latest_satellite(_two_batches(spark, folder), "hk_order")


def sat_returning(spark, folder):
    """The first batch a second time: by the newest row, its values are new again."""
    stored = stage(_two_batches(spark, folder), "sat")
    return vault.satellite(_early_batch(spark, folder), "sat_order", THIRD_BATCH, stored,
                           compare="latest")


def sat_rejects(spark, folder):
    """Pending orders arrive without a status and cannot be hashed."""
    stg = views.staged_orders(spark, folder, status=lambda c: F.when(c != "P", c))
    return satellite_rejects(stg, ["order_id"], vault.SATELLITES["sat_order"][1])


def vault_layers(spark, folder):
    stg = stage(views.staged_orders(spark, folder), "stg_orders")
    return _contents(vault.run_vault(stg, FIRST_BATCH))


def _streamed(spark, folder) -> VaultStore:
    """Staged orders as a stream of files, loaded into a store."""
    root = staged_path(spark, "vault")
    # So many parts that each file gets whole ones: they are joined into files without a shuffle.
    each = math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / STREAM_FILES)
    staged = views.staged_orders(spark, folder, partitions=each * STREAM_FILES)
    (staged.coalesce(STREAM_FILES).write.option("compression", "zstd")
     .option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{root}/incoming"))
    stream = (spark.readStream.schema(staged.schema)
              .option("maxFilesPerTrigger", STREAM_FILES // 2)
              .parquet(f"{root}/incoming"))
    store = VaultStore(spark, f"{root}/vault")
    vault_stream(stream, store, f"{root}/progress", lambda _: FIRST_BATCH, written=True
                 ).awaitTermination()
    return store


def streamed_vault(spark, folder):
    """What the order satellite holds after a stream."""
    return _streamed(spark, folder).read("sat_order")


def streamed_layers(spark, folder):
    """What all tables hold after a stream."""
    store = _streamed(spark, folder)
    return _contents({name: store.read(name) for name in vault.TABLES})


# --- checks --------------------------------------------------------------------------

def dq_pk(spark, folder):
    return checks.duplicate_keys(views.table(spark, folder, "lineitem"),
                                 ["l_orderkey", "l_linenumber"])


def dq_one_current(spark, folder):
    """Versions opened, old ones never closed: what half a refresh leaves behind."""
    dim, opened = _opened(spark, folder)
    return checks.several_current(dim.unionByName(opened), "student_email")


def dq_fk(spark, folder):
    return checks.orphans(views.orders_2nf(spark, folder),
                          views.student_snapshot(spark, folder, False),
                          {"student_email": "student_email"})


def dq_not_null(spark, folder):
    return checks.missing_values(views.student_snapshot(spark, folder, False, everyone=True),
                                 ["student_email", "student_phone"])


def dq_length(spark, folder):
    documents = views.table(spark, folder, "documents")
    return checks.oversize_values(documents, {"text": 2000, "lang": 50}).select(
        "doc_id", "oversize")


def dq_decimal(spark, folder):
    orders = views.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    return checks.overflowing_numbers(orders, "o_totalprice", 7, 2)


def dq_fd(spark, folder):
    return checks.dependency_violations(views.table(spark, folder, "part"),
                                        ["p_name"], ["p_type"])


def dq_transitive(spark, folder):
    pairs = [("student_city", "student_region"), ("student_region", "student_city"),
             ("student_phone", "student_city"), ("student_name", "student_phone")]
    return checks.dependency_report(
        views.student_snapshot(spark, folder, False, everyone=True), pairs)


def dq_dependencies(spark, folder):
    """All dependencies among the columns of parts, each part with its supplier, and a column
    that is empty for half of them."""
    parts = views.courses(spark, folder).select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "s_suppkey", "s_name",
        "s_nationkey", F.when(F.col("p_size") > 25, F.col("p_type")).alias("large_type"))
    return checks.dependencies(parts, parts.columns)


def dq_chain(spark, folder):
    """Ends of closed versions moved: some a month early, the others one day late."""
    dim = _both(spark, folder, [CITIES, STUDENTS])[STUDENTS]
    moved = (F.when(F.col("student_phone") == "BUILDING", F.date_sub("valid_to", 30))
             .otherwise(F.date_add("valid_to", 1)))
    broken = dim.withColumn("valid_to", F.when(F.col("is_current"), F.col("valid_to"))
                            .otherwise(moved))
    return checks.chain_breaks(broken, "student_email", "student_sk")


def dq_atomic(spark, folder):
    pages = views.table(spark, folder, "pages")
    return checks.non_atomic(pages, {"url": ["?", "#"], "html": ["<li>"]}).select(
        "page_id", "non_atomic")


def dq_spelling(spark, folder):
    named = [views.course_snapshot(spark, folder, s).select("teacher_email", "teacher_name")
             for s in (False, True)]
    return checks.spelling_variants(named[0].unionByName(named[1]),
                                    "teacher_email", "teacher_name")


# --- questions -----------------------------------------------------------------------

def students_per_city(spark, folder):
    """From composite strings through the normal forms to a count."""
    return marts.students_per_city(nf3_student(spark, folder))


def avg_price_by_category(spark, folder):
    nf2 = _nf2(spark, folder)
    return marts.avg_price_by_category(nf2["orders_2nf"], nf2["course_2nf"])


def preview(spark, folder):
    return marts.preview(views.orders_2nf(spark, folder),
                         ["order_date", "student_email", "course_name", "payment_method",
                          "payment_status"])


def teacher_count(spark, folder):
    return marts.teacher_count(nf3_teacher(spark, folder))


def co_purchases(spark, folder):
    return marts.courses_of_students(views.orders_2nf(spark, folder))


def best_seller_company(spark, folder):
    return marts.bought_with_best_seller(views.orders_2nf(spark, folder))


def teachers_by_category(spark, folder):
    course, teachers = _course_and_teachers(spark, folder)
    return marts.teachers_by_category(relational.course_3nf(course, teachers), teachers)


def dup_persons(spark, folder):
    return marts.duplicate_persons(_nf1(spark, folder))


CATALOG: dict[str, Query] = {
    "csv_load": csv_load,
    "absent_append": absent_append,
    "parse_1nf": _nf1,
    "explode_zip": explode_zip_lists,
    "explode_by_index": explode_index_lists,
    "explode_by_index_sparse": explode_index_sparse,
    "list_length_report": list_lengths,
    "nf2_student": lambda s, f: relational.student_2nf(_nf1(s, f)),
    "nf2_course": lambda s, f: relational.course_2nf(_nf1(s, f)),
    "nf2_orders": lambda s, f: relational.orders_2nf(_nf1(s, f)),
    "nf2_course_latest": course_latest,
    "nf3_city": nf3_city,
    "nf3_teacher": nf3_teacher,
    "nf3_dict_method": _nf3_dictionary("payment_method"),
    "nf3_dict_status": _nf3_dictionary("payment_status"),
    "nf3_student": nf3_student,
    "nf3_course": nf3_course,
    "nf3_orders": nf3_orders,
    "preview": preview,
    "assign_sk": numbered_orders,
    "scd2_init_city": _initial(CITIES),
    "scd2_init_customer": _initial(CITIES, STUDENTS),
    "scd2_changed": scd2_changed,
    "scd2_new": scd2_new_keys,
    "scd2_closed": scd2_closed,
    "scd2_opened": scd2_opened,
    "scd2_city": _dimension(CITIES),
    "scd2_customer": _dimension(CITIES, STUDENTS),
    "scd2_teacher": _dimension(TEACHERS),
    "scd2_part": _dimension(TEACHERS, COURSES),
    "scd2_idempotent": scd2_idempotent,
    "scd2_same_day": scd2_same_day,
    "scd2_late": late_changes,
    "dimension_store": dimension_store,
    "store_cascade": store_cascade,
    "store_follow": store_follow,
    "contract_violations": broken_contracts,
    "parse_rejects": unreadable_lines,
    "dim_history": student_history,
    "dim_as_of": students_as_of,
    "fact_current": fact_current,
    "fact_as_of": fact_as_of,
    "fact_as_of_deep": fact_as_of_deep,
    "sat_conflicts": sat_conflicts,
    "star_view": star,
    "relational_layers": relational_layers,
    "hub_customer": _hub("hub_customer"),
    "hub_order": _hub("hub_order"),
    "hub_product": _hub("hub_product"),
    "hub_second_batch": hub_second_batch,
    "link_customer_order": _link("link_customer_order"),
    "link_order_product": _link("link_order_product"),
    "sat_customer": _satellite("sat_customer"),
    "sat_order": _satellite("sat_order"),
    "sat_product": _satellite("sat_product"),
    "sat_order_product": sat_order_product,
    "sat_second_batch": _two_batches,
    "sat_link_second_batch": sat_link_second_batch,
    "sat_latest": sat_latest,
    "sat_returning": sat_returning,
    "sat_rejects": sat_rejects,
    "sat_known_orders": sat_known_orders,
    "vault_key_rejects": vault_key_rejects,
    "vault_increment": vault_increment,
    "vault_layers": vault_layers,
    "vault_stream": streamed_vault,
    "vault_stream_layers": streamed_layers,
    "dq_pk": dq_pk,
    "dq_one_current": dq_one_current,
    "dq_fk": dq_fk,
    "dq_not_null": dq_not_null,
    "dq_length": dq_length,
    "dq_decimal": dq_decimal,
    "dq_fd": dq_fd,
    "dq_transitive": dq_transitive,
    "dq_dependencies": dq_dependencies,
    "dq_chain": dq_chain,
    "dq_atomic": dq_atomic,
    "dq_spelling": dq_spelling,
    "students_per_city": students_per_city,
    "avg_price_by_category": avg_price_by_category,
    "teacher_count": teacher_count,
    "co_purchases": co_purchases,
    "best_seller_company": best_seller_company,
    "teachers_by_category": teachers_by_category,
    "revenue_at_time": revenue_at_time,
    "dup_persons": dup_persons,
}


def portable_queries() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, folder: _portable(query(spark, folder))
    return {name: wrap(query) for name, query in CATALOG.items()}
