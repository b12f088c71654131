"""The warehouse inputs, derived from the order tables in a data folder.

student = customer, city = nation, course = part, teacher = supplier, order line =
lineitem with its order. Everything runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dates of the two loads of every dimension.
FIRST_LOAD = "1995-01-01"
SECOND_LOAD = "1998-01-01"
# Times of the vault batches.
FIRST_BATCH = "2026-06-01 10:00:00"
SECOND_BATCH = "2026-06-02 10:00:00"
THIRD_BATCH = "2026-06-03 10:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def lineitem(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*columns)


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _course_price() -> Column:
    return F.col("p_retailprice").cast("decimal(10,2)")


def courses(spark: SparkSession, folder: str) -> DataFrame:
    """part with its teacher: suppliers are numbered from 0 without holes, so the
    remainder gives every part exactly one."""
    supplier = table(spark, folder, "supplier")
    teachers = supplier.agg(F.count(F.lit(1))).scalar()
    part = table(spark, folder, "part").withColumn(
        "s_suppkey", F.pmod(F.col("p_partkey"), teachers))
    return part.join(supplier, "s_suppkey")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """customer with city and region; the two geography tables are fixed and tiny."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, folder, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey"))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (customer, part, day, payment) of all order lines, before any attribute
    is joined, so that the widest table is shuffled on few narrow columns."""
    orders = table(spark, folder, "orders")
    lines = lineitem(spark, folder, "l_orderkey", "l_partkey")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_custkey", "l_partkey", F.col("o_orderdate").cast("date").alias("order_date"),
                    "o_orderpriority", "o_orderstatus").distinct())


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Composite text fields, one row per order line."""
    student = customers(spark, folder).select(
        F.col("c_custkey").alias("o_custkey"),
        _joined(F.col("c_custkey"), ";", F.col("c_name"), ";", F.col("c_mktsegment"), ";",
                F.col("n_name"), "|", F.col("r_name")).alias("student_info"))
    course = courses(spark, folder).select(
        F.col("p_partkey").alias("l_partkey"),
        _joined(F.col("p_partkey"), "|", F.col("p_type"), "|", _course_price()
                ).alias("course_info"),
        _joined(F.col("s_name"), "<", F.col("s_suppkey"), ">").alias("teacher_info"))
    payment = _joined(F.col("o_orderpriority"), "|", F.col("o_orderstatus"))
    return (order_lines(spark, folder).join(student, "o_custkey").join(course, "l_partkey")
            .select("order_date", "student_info", "course_info", "teacher_info",
                    payment.alias("payment_info")))


def parallel_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts as lists parted by line breaks: lines, sentences and a label
    list that is NULL, empty or one item long. The three differ in length by nature."""
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    text = F.col("text")
    label = (F.when(F.col("toxic").isNull(), F.lit(None).cast("string"))
             .when(F.col("toxic") == 1, F.lit("")).otherwise(F.col("lang")))
    return table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        "doc_id", "source", text.alias("lines"),
        F.replace(text, F.lit(". "), F.lit("\n")).alias("sentences"),
        label.alias("label"))


def student_snapshot(spark: SparkSession, folder: str, second: bool, everyone: bool = False
                     ) -> DataFrame:
    """2NF students as delivered at the first or second load.

    First: customers who had ordered before the second load, machinery customers still
    without a segment (`everyone`: those who had not ordered too). Second: all customers; a
    segment renamed and two regions merged.
    """
    people = customers(spark, folder)
    segment, region = F.col("c_mktsegment"), F.col("r_name")
    if second:
        segment = F.when(segment == "BUILDING", F.lit("CONSTRUCTION")).otherwise(segment)
        region = F.when(region.isin("AFRICA", "MIDDLE EAST"),
                        F.lit("AFRICA AND MIDDLE EAST")).otherwise(region)
    else:
        segment = F.when(segment != "MACHINERY", segment)
        if not everyone:
            early = table(spark, folder, "orders").filter(
                F.col("o_orderdate") < F.lit(SECOND_LOAD).cast("timestamp_ntz"))
            people = people.join(early, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return people.select(
        F.col("c_custkey").alias("student_email"), F.col("c_name").alias("student_name"),
        segment.alias("student_phone"), F.col("n_name").alias("student_city"),
        region.alias("student_region"))


def course_snapshot(spark: SparkSession, folder: str, second: bool) -> DataFrame:
    """2NF courses as delivered at the first or second load.

    First: without the largest sizes. Second: all parts, promotions 10% cheaper, indebted
    suppliers renamed.
    """
    rows = courses(spark, folder)
    price, teacher = _course_price(), F.col("s_name")
    if second:
        price = F.when(F.col("p_type") == "PROMO", (price * F.lit("0.9").cast("decimal(2,1)"))
                       .cast("decimal(10,2)")).otherwise(price)
        teacher = F.when(F.col("s_acctbal") < 0, _joined(teacher, " (in debt)")).otherwise(teacher)
    else:
        rows = rows.filter(F.col("p_size") <= 45)
    return rows.select(
        F.col("p_partkey").alias("course_name"), F.col("p_type").alias("course_category"),
        price.alias("course_price"), teacher.alias("teacher_name"),
        F.col("s_suppkey").alias("teacher_email"))


SNAPSHOTS = {"student_2nf": student_snapshot, "course_2nf": course_snapshot}


def snapshot(spark: SparkSession, folder: str, second: bool,
             names: Iterable[str] = tuple(SNAPSHOTS)) -> dict[str, DataFrame]:
    return {n: SNAPSHOTS[n](spark, folder, second) for n in names}


def orders_2nf(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their natural keys."""
    return order_lines(spark, folder).select(
        "order_date", F.col("o_custkey").alias("student_email"),
        F.col("l_partkey").alias("course_name"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("payment_status"))


def staged_orders(spark: SparkSession, folder: str,
                  status: Callable[[Column], Column] = lambda c: c,
                  partitions: int | None = None) -> DataFrame:
    """Vault staging rows; `status` alters the order status of a batch.

    Orders meet their customers and lines their parts before lines meet orders: customers are
    moved once an order, not once a line, and the rows end up together by order, in as many
    `partitions` if given.
    """
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    line = lineitem(spark, folder, "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
                    ).join(part, F.col("l_partkey") == F.col("p_partkey"))
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "n_name")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    order = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate",
        F.when(urgent, F.lit("CRM")).otherwise(F.lit("WEB")).alias("source_system")).join(
        customer, F.col("o_custkey") == F.col("c_custkey"))
    if partitions:
        line = line.repartition(partitions, "l_orderkey")
        order = order.repartition(partitions, "o_orderkey")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("customer_city"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("order_amount"),
        status(F.col("o_orderstatus")).alias("order_status"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        "source_system",
        F.col("o_orderdate").alias("load_dts"))


def before_second_load(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("load_dts") < F.lit(SECOND_LOAD).cast("timestamp_ntz"))
