"""The relational branch: raw composites to normal forms, history and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.fact import Link, build_fact, star_view
from ..operators.normalize import (
    decompose,
    extract_bridge,
    extract_dictionary,
    extract_transitive,
    resolve_fk,
)
from ..operators.parse import Piece, parse_composite
from ..operators.scd2 import Dimension, Parent, scd2_cascade
from ..sources.staging import at_once, stage

Tables = dict[str, DataFrame]

# Where each atomic column sits in the raw order line.
ORDER_LINE = {
    "student_email": Piece("student_info", ((";", 1),)),
    "student_name": Piece("student_info", ((";", 2),)),
    "student_phone": Piece("student_info", ((";", 3),)),
    "student_city": Piece("student_info", ((";", 4), ("|", 1))),
    "student_region": Piece("student_info", ((";", 4), ("|", 2))),
    "course_name": Piece("course_info", (("|", 1),)),
    "course_category": Piece("course_info", (("|", 2),)),
    "course_price": Piece("course_info", (("|", 3),), type="decimal(10,2)"),
    "teacher_name": Piece("teacher_info", (("<", 1),)),
    "teacher_email": Piece("teacher_info", (("<", 2),), strip=">"),
    "payment_method": Piece("payment_info", (("|", 1),)),
    "payment_status": Piece("payment_info", (("|", 2),)),
}

CITY = Dimension("city_sk", "city_name", ("region_name",))
STUDENT = Dimension("student_sk", "student_email", ("student_name", "student_phone", "city_sk"))
TEACHER = Dimension("teacher_sk", "teacher_email", ("teacher_name",))
COURSE = Dimension("course_sk", "course_name",
                   ("course_category", "course_price", "teacher_sk"))

DIMENSIONS = {
    "cities_3nf_scd2": CITY,
    "student_3nf_scd2": STUDENT,
    "teachers_3nf_scd2": TEACHER,
    "courses_3nf_scd2": COURSE,
}
PARENTS = {
    "student_3nf_scd2": (Parent("cities_3nf_scd2", "student_city"),),
    "courses_3nf_scd2": (Parent("teachers_3nf_scd2", "teacher_email"),),
}


def stage_all(tables: Mapping[str, DataFrame]) -> Tables:
    names = list(tables)
    return dict(zip(names, at_once(lambda n: stage(tables[n], n), names)))


def to_1nf(raw: DataFrame, strict: bool = True) -> DataFrame:
    return parse_composite(raw, ORDER_LINE, keep=["order_date"], strict=strict)


def student_2nf(nf1: DataFrame) -> DataFrame:
    return decompose(nf1, ["student_email"],
                     ["student_name", "student_phone", "student_city", "student_region"])


def course_2nf(nf1: DataFrame) -> DataFrame:
    return decompose(nf1, ["course_name"],
                     ["course_category", "course_price", "teacher_name", "teacher_email"])


def orders_2nf(nf1: DataFrame) -> DataFrame:
    return extract_bridge(nf1, ["order_date", "student_email", "course_name"],
                          ["payment_method", "payment_status"])


def to_2nf(nf1: DataFrame) -> Tables:
    return {
        "student_2nf": student_2nf(nf1),
        "course_2nf": course_2nf(nf1),
        "orders_2nf": orders_2nf(nf1),
    }


def cities_3nf(student: DataFrame) -> DataFrame:
    return extract_transitive(student, "student_city", ["student_region"])


def teachers_3nf(course: DataFrame) -> DataFrame:
    return extract_transitive(course, "teacher_email", ["teacher_name"])


def student_3nf(student: DataFrame, cities: DataFrame) -> DataFrame:
    return resolve_fk(student, cities, "student_city").select(
        "student_email", "student_name", "student_phone", "student_city")


def course_3nf(course: DataFrame, teachers: DataFrame) -> DataFrame:
    return resolve_fk(course, teachers, "teacher_email").select(
        "course_name", "course_category", "course_price", "teacher_email")


def to_3nf(nf2: Mapping[str, DataFrame]) -> Tables:
    """Parents are written before their children are joined to them: a child is then
    shuffled only for parents too large to broadcast."""
    student, course, orders = nf2["student_2nf"], nf2["course_2nf"], nf2["orders_2nf"]
    result = stage_all({
        "cities_3nf": cities_3nf(student),
        "teachers_3nf": teachers_3nf(course),
        "payment_methods_3nf": extract_dictionary(orders, "payment_method"),
        "payment_statuses_3nf": extract_dictionary(orders, "payment_status"),
    })
    result.update(stage_all({
        "student_3nf": student_3nf(student, result["cities_3nf"]),
        "course_3nf": course_3nf(course, result["teachers_3nf"]),
    }))
    linked = orders
    for parent, key in (("payment_methods_3nf", "payment_method"),
                        ("payment_statuses_3nf", "payment_status"),
                        ("student_3nf", "student_email"), ("course_3nf", "course_name")):
        linked = resolve_fk(linked, result[parent], key)
    result["orders_3nf"] = linked.select(*orders.columns)
    return result


def dimension_sources(nf2: Mapping[str, DataFrame]) -> Tables:
    """What each dimension is loaded from: the 2NF tables under the dimension's names."""
    sources = {}
    if "student_2nf" in nf2:
        student = nf2["student_2nf"]
        sources["cities_3nf_scd2"] = student.select("student_city", "student_region").toDF(
            "city_name", "region_name")
        sources["student_3nf_scd2"] = student
    if "course_2nf" in nf2:
        course = nf2["course_2nf"]
        sources["teachers_3nf_scd2"] = course.select("teacher_email", "teacher_name")
        sources["courses_3nf_scd2"] = course
    return sources


def refresh_dimensions(nf2: Mapping[str, DataFrame], dims: Mapping[str, DataFrame],
                       as_of: dt.date | str) -> Tables:
    """First load where `dims` lacks a dimension, refresh where it has it."""
    return scd2_cascade(dimension_sources(nf2), dims, DIMENSIONS, PARENTS, as_of)


def references(orders: DataFrame) -> Tables:
    return {
        "payment_methods_3nf_ref": extract_dictionary(orders, "payment_method"),
        "payment_statuses_3nf_ref": extract_dictionary(orders, "payment_status"),
    }


def orders_fact(orders: DataFrame, dims: Mapping[str, DataFrame], mode: str = "current",
                extend_first: bool = True, refs: Mapping[str, DataFrame] | None = None,
                ordered: bool = True) -> DataFrame:
    links = [Link(dims["student_3nf_scd2"], STUDENT, "student_email"),
             Link(dims["courses_3nf_scd2"], COURSE, "course_name")]
    refs = refs or references(orders)
    values = [(refs["payment_methods_3nf_ref"], "payment_method"),
              (refs["payment_statuses_3nf_ref"], "payment_status")]
    return build_fact(orders, links, values, mode, extend_first=extend_first, ordered=ordered)


def orders_star(fact: DataFrame, dims: Mapping[str, DataFrame],
                refs: Mapping[str, DataFrame]) -> DataFrame:
    return star_view(
        fact,
        [(dims["student_3nf_scd2"], "student_sk", ["student_email"]),
         (dims["courses_3nf_scd2"], "course_sk", ["course_name"])],
        [(refs["payment_methods_3nf_ref"], "payment_method"),
         (refs["payment_statuses_3nf_ref"], "payment_status")])


def run_relational(raw: DataFrame, as_of: dt.date | str,
                   dims: Mapping[str, DataFrame] | None = None,
                   fact_mode: str = "current", ordered_fact: bool = True) -> Tables:
    """Raw lines to every layer. Layers with several readers are written once."""
    nf1 = stage(to_1nf(raw), "courses_1nf")
    nf2 = stage_all(to_2nf(nf1))
    result = {"courses_1nf": nf1, **nf2, **to_3nf(nf2)}
    # The same values as in the orders, from tables of a few rows.
    refs = stage_all({f"{name}_ref": extract_dictionary(result[name], column) for name, column in (
        ("payment_methods_3nf", "payment_method"), ("payment_statuses_3nf", "payment_status"))})
    history = refresh_dimensions(nf2, dims or {}, as_of)
    result.update(refs)
    result.update(history)
    result["orders_3nf_fact"] = orders_fact(nf2["orders_2nf"], history, fact_mode, refs=refs,
                                            ordered=ordered_fact)
    return result
