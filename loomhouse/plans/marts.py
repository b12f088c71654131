"""Business questions on the normalised and historised tables.

Event rows are counted per key before any join, so a frequent student or course is one
row by the time it meets its attributes. What is needed twice is written once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage


def preview(df: DataFrame, order_by: Sequence[str], n: int = 3) -> DataFrame:
    """The first rows in an order, each task passing on `n` rows at most."""
    return df.orderBy(*order_by).limit(n)


def students_per_city(student: DataFrame) -> DataFrame:
    return student.groupBy("student_city").agg(F.count(F.lit(1)).alias("n_students"))


def avg_price_by_category(orders: DataFrame, course: DataFrame) -> DataFrame:
    """Average price over orders, not over courses."""
    sold = orders.groupBy("course_name").agg(F.count(F.lit(1)).alias("_n"))
    priced = sold.join(course.select("course_name", "course_category", "course_price"),
                       "course_name")
    revenue = F.sum(F.col("course_price") * F.col("_n"))
    return priced.groupBy("course_category").agg(
        F.sum("_n").alias("n_orders"), revenue.alias("revenue"),
        (revenue.cast("double") / F.sum("_n")).alias("avg_price"))


def teacher_count(teachers: DataFrame) -> DataFrame:
    return teachers.agg(F.count_distinct("teacher_email").alias("n_teachers"))


def courses_of_students(orders: DataFrame) -> DataFrame:
    """Per student the courses bought and how many others they bought besides.

    Answers "which other courses did this student buy" for every student at once, one
    row per student and course: no pairs of courses are formed.
    """
    bought = stage(orders.groupBy("student_email", "course_name").agg(
        F.count(F.lit(1)).alias("n_orders")), "bought")
    breadth = bought.groupBy("student_email").agg((F.count(F.lit(1)) - 1).alias("n_others"))
    return bought.join(breadth.filter(F.col("n_others") > 0), "student_email").select(
        "student_email", "course_name", "n_orders", "n_others")


def bought_with_best_seller(orders: DataFrame) -> DataFrame:
    """What the students of the most sold course bought besides it.

    The best seller is the course with most students, the least name on a tie.
    """
    bought = stage(orders.select("student_email", "course_name").distinct(), "bought")
    best = (bought.groupBy("course_name").agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.min(F.struct((-F.col("_n")).alias("_less"), "course_name")).alias("_top"))
            .select("_top.course_name"))
    buyers = bought.join(best, "course_name", "left_semi").select("student_email")
    others = bought.join(best, "course_name", "left_anti")
    return (others.join(buyers, "student_email", "left_semi")
            .groupBy("course_name").agg(F.count(F.lit(1)).alias("n_students")))


def teachers_by_category(course: DataFrame, teachers: DataFrame) -> DataFrame:
    taught = course.select("course_category", "teacher_email").distinct()
    return taught.join(teachers, "teacher_email").select(
        "course_category", "teacher_email", "teacher_name")


def revenue_at_time(fact: DataFrame, course_dim: DataFrame) -> DataFrame:
    """Revenue per month at the price of the version each fact points to."""
    month = F.date_format(F.trunc("order_date", "month"), "yyyy-MM").alias("order_month")
    sold = fact.groupBy(month, "course_sk").agg(F.count(F.lit(1)).alias("_n"))
    priced = sold.join(course_dim.select("course_sk", "course_price"), "course_sk")
    return priced.groupBy("order_month").agg(
        F.sum("_n").alias("n_orders"),
        F.sum(F.col("course_price") * F.col("_n")).alias("revenue"))


def duplicate_persons(nf1: DataFrame) -> DataFrame:
    """How often persons appear in the raw lines, and how many persons there are."""
    return (nf1.groupBy("student_email").agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.sum("_n").alias("n_rows"), F.count("student_email").alias("n_persons"),
                 F.sum((F.col("_n") > 1).cast("long")).alias("n_repeated")))
