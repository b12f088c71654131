"""Declared tables: columns, types, lengths, keys and references.

Spark does not enforce these on DataFrames. `conform` shapes a table to its contract and
`violations` runs the matching checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import OPEN_DATE, OPEN_TIMESTAMP
from ..operators import checks


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    length: int | None = None
    default: object = None
    comment: str = ""


@dataclass(frozen=True)
class Contract:
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    current_key: str | None = None
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        fields = []
        for c in self.columns:
            notes = {"comment": c.comment} if c.comment else {}
            if c.length:
                notes["length"] = c.length
            fields.append(T.StructField(c.name, c.type, not c.required, notes))
        return T.StructType(fields)

    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length}

    def numbers(self) -> dict[str, T.DecimalType]:
        return {c.name: c.type for c in self.columns if isinstance(c.type, T.DecimalType)}

    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]


def text(name: str, length: int | None = None, required: bool = False,
         comment: str = "") -> Column:
    return Column(name, T.StringType(), required, length, None, comment)


def of(name: str, kind: T.DataType, required: bool = False, comment: str = "") -> Column:
    return Column(name, kind, required, None, None, comment)


DATE = T.DateType()
LONG = T.LongType()
INT = T.IntegerType()
MOMENT = T.TimestampNTZType()
PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)
DIGEST = 32

ORDER_KEY = ("student_email", "course_name", "order_date")


def _period() -> tuple[Column, ...]:
    return (
        Column("valid_from", DATE, True, comment="first day of the version"),
        Column("valid_to", DATE, True, default=OPEN_DATE, comment="last day of the version"),
        Column("is_current", T.BooleanType(), True, default=True),
    )


# Names, types, lengths, keys and references of the modelled tables.
RAW = {
    "courses_0nf": Contract((
        of("order_date", DATE),
        text("student_info", comment="email;name;phone;city|region"),
        text("course_info", comment="name|category|price"),
        text("teacher_info", comment="name<email>"),
        text("payment_info", comment="method|status"),
    )),
    "university_0nf": Contract((
        of("student_record_id", INT),
        text("student_full_name"),
        text("student_email"),
        text("courses", comment="list, parallel to professors and grades"),
        text("professors", comment="list, parallel to courses"),
        text("semester"),
        text("grades", comment="list, parallel to courses"),
    )),
}

NORMAL_FORMS = {
    "courses_1nf": Contract((
        of("order_date", DATE, True, "day of the order"),
        text("student_email", 100, comment="identifies the student"),
        text("student_name", 100),
        text("student_phone", 20),
        text("student_city", 50),
        text("student_region", 50),
        text("course_name", 100),
        text("course_category", 50),
        of("course_price", PRICE),
        text("teacher_name", 100),
        text("teacher_email", 100, comment="identifies the teacher"),
        text("payment_method", 50),
        text("payment_status", 50),
    ), key=ORDER_KEY),
    "student_2nf": Contract((
        text("student_email", 100),
        text("student_name", 100),
        text("student_phone", 20),
        text("student_city", 50),
        text("student_region", 50),
    ), key=("student_email",)),
    "course_2nf": Contract((
        text("course_name", 100),
        text("course_category", 50),
        of("course_price", PRICE),
        text("teacher_name", 100),
        text("teacher_email", 100),
    ), key=("course_name",)),
    "orders_2nf": Contract((
        of("order_date", DATE, True),
        text("student_email", 100),
        text("course_name", 100),
        text("payment_method", 50),
        text("payment_status", 50),
    ), key=ORDER_KEY, references={
        "student_email": ("student_2nf", "student_email"),
        "course_name": ("course_2nf", "course_name"),
    }),
    "cities_3nf": Contract((
        text("student_city", 50),
        text("student_region", 50),
    ), key=("student_city",)),
    "student_3nf": Contract((
        text("student_email", 100),
        text("student_name", 100),
        text("student_phone", 20),
        text("student_city", 50),
    ), key=("student_email",), references={"student_city": ("cities_3nf", "student_city")}),
    "teachers_3nf": Contract((
        text("teacher_email", 100),
        text("teacher_name", 100),
    ), key=("teacher_email",)),
    "course_3nf": Contract((
        text("course_name", 100),
        text("course_category", 50),
        of("course_price", PRICE),
        text("teacher_email", 100),
    ), key=("course_name",), references={"teacher_email": ("teachers_3nf", "teacher_email")}),
    "payment_methods_3nf": Contract((text("payment_method", 50),), key=("payment_method",)),
    "payment_statuses_3nf": Contract((text("payment_status", 50),), key=("payment_status",)),
    "orders_3nf": Contract((
        of("order_date", DATE, True),
        text("student_email", 100),
        text("course_name", 100),
        text("payment_method", 50),
        text("payment_status", 50),
    ), key=ORDER_KEY, references={
        "student_email": ("student_3nf", "student_email"),
        "course_name": ("course_3nf", "course_name"),
        "payment_method": ("payment_methods_3nf", "payment_method"),
        "payment_status": ("payment_statuses_3nf", "payment_status"),
    }),
}

HISTORY = {
    "cities_3nf_scd2": Contract((
        of("city_sk", LONG, True, "version of the city"),
        text("city_name", 50, True, "business key"),
        text("region_name", 50),
        *_period(),
    ), key=("city_sk",), unique=(("city_name", "valid_from"),), current_key="city_name"),
    "student_3nf_scd2": Contract((
        of("student_sk", LONG, True, "version of the student"),
        text("student_email", 100, True, "business key"),
        of("city_sk", LONG, True),
        text("student_name", 100, True),
        text("student_phone", 20, True),
        *_period(),
    ), key=("student_sk",), unique=(("student_email", "valid_from"),),
        current_key="student_email", references={"city_sk": ("cities_3nf_scd2", "city_sk")}),
    "teachers_3nf_scd2": Contract((
        of("teacher_sk", LONG, True, "version of the teacher"),
        text("teacher_email", 50, True, "business key"),
        text("teacher_name", 50, True),
        *_period(),
    ), key=("teacher_sk",), unique=(("teacher_email", "valid_from"),),
        current_key="teacher_email"),
    "courses_3nf_scd2": Contract((
        of("course_sk", LONG, True, "version of the course"),
        text("course_name", 50, True, "business key"),
        text("course_category", 50, True),
        of("course_price", PRICE, True),
        of("teacher_sk", LONG, True),
        *_period(),
    ), key=("course_sk",), unique=(("course_name", "valid_from"),), current_key="course_name",
        references={"teacher_sk": ("teachers_3nf_scd2", "teacher_sk")}),
    "payment_methods_3nf_ref": Contract((text("payment_method", 50),), key=("payment_method",)),
    "payment_statuses_3nf_ref": Contract((text("payment_status", 50),), key=("payment_status",)),
    "orders_3nf_fact": Contract((
        of("order_sk", LONG, True),
        of("order_date", DATE, True),
        of("student_sk", LONG),
        of("course_sk", LONG),
        text("payment_method", 50),
        text("payment_status", 50),
    ), key=("order_sk",), references={
        "student_sk": ("student_3nf_scd2", "student_sk"),
        "course_sk": ("courses_3nf_scd2", "course_sk"),
        "payment_method": ("payment_methods_3nf_ref", "payment_method"),
        "payment_status": ("payment_statuses_3nf_ref", "payment_status"),
    }),
}

STAGING = {
    "stg_orders": Contract((
        of("customer_id", INT),
        text("customer_name", 100),
        text("customer_city", 100),
        of("order_id", INT),
        of("order_amount", AMOUNT),
        text("order_status", 50),
        of("product_id", INT),
        text("product_name", 100),
        text("product_category", 100),
        of("qty", INT),
        of("price", AMOUNT),
        text("source_system", 50),
        of("load_dts", MOMENT),
    )),
}


def _hub(hk: str, bk: str) -> Contract:
    return Contract((text(hk, DIGEST, True), text(bk, 100, True),
                     of("load_dts", MOMENT, True), text("record_source", 50, True)), key=(hk,))


def _link(hk: str, *ends: str) -> Contract:
    return Contract((text(hk, DIGEST, True), *[text(e, DIGEST, True) for e in ends],
                     of("load_dts", MOMENT, True), text("record_source", 50, True)), key=(hk,))


def _sat(hk: str, *attrs: Column, end_dated: bool = True) -> Contract:
    ends = (Column("end_date", MOMENT, True, default=OPEN_TIMESTAMP),) if end_dated else ()
    return Contract((text(hk, DIGEST, True), text("hash_diff", DIGEST, True), *attrs,
                     of("load_dts", MOMENT, True), *ends), key=(hk, "load_dts"))


VAULT = {
    "hub_customer": _hub("hk_customer", "customer_id"),
    "hub_order": _hub("hk_order", "order_id"),
    "hub_product": _hub("hk_product", "product_id"),
    "link_customer_order": _link("hk_customer_order", "hk_customer", "hk_order"),
    "link_order_product": _link("hk_order_product", "hk_order", "hk_product"),
    "sat_customer": _sat("hk_customer", text("name", 200), text("city", 200)),
    "sat_order": _sat("hk_order", of("amount", AMOUNT), text("status", 50)),
    "sat_product": _sat("hk_product", text("name", 200), text("category", 100)),
    "sat_order_product": _sat("hk_order_product_link", of("qty", INT), of("price", AMOUNT),
                              end_dated=False),
}

TABLES = {**RAW, **NORMAL_FORMS, **HISTORY, **STAGING, **VAULT}


def conform(df: DataFrame, contract: Contract, beside: Sequence[str] = ()) -> DataFrame:
    """Columns by name, in declared order and type; absent ones take their default.

    An absent column that is required and has no default is an error. Columns `beside` the
    contract follow unchanged.
    """
    lacking = [c for c in contract.required() if c not in df.columns
               and next(d.default for d in contract.columns if d.name == c) is None]
    if lacking:
        raise ValueError(f"required columns are absent: {', '.join(lacking)}")
    columns = []
    for c in contract.columns:
        value = F.col(c.name) if c.name in df.columns else F.lit(c.default)
        columns.append(value.cast(c.type).alias(c.name))
    return df.select(*columns, *beside)


def _always_fits(kind: T.DataType, declared: T.DecimalType) -> bool:
    return (isinstance(kind, T.DecimalType) and kind.scale <= declared.scale
            and kind.precision - kind.scale <= declared.precision - declared.scale)


def violations(tables: Mapping[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """One DataFrame of offending rows per declared rule of a table."""
    contract, df = TABLES[name], tables[name]
    found: dict[str, DataFrame] = {}
    if contract.key:
        found["key"] = checks.duplicate_keys(df, contract.key)
    for columns in contract.unique:
        found["unique " + ",".join(columns)] = checks.duplicate_keys(df, columns)
    if contract.current_key:
        found["one current"] = checks.several_current(df, contract.current_key)
    if contract.required():
        found["required"] = checks.missing_values(df, contract.required())
    if contract.lengths():
        found["length"] = checks.oversize_values(df, contract.lengths())
    for column, kind in contract.numbers().items():
        # A number of a narrower type need not be tried row by row.
        if column in df.columns and not _always_fits(df.schema[column].dataType, kind):
            found[f"fits {column}"] = checks.overflowing_numbers(
                df, column, kind.precision, kind.scale)
    for column, (parent, parent_column) in contract.references.items():
        if parent in tables:
            found[f"reference {column}"] = checks.orphans(
                df, tables[parent], {column: parent_column})
    return found
