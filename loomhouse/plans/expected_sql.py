"""The catalogue in plain SQL (DuckDB dialect), to compare results with."""

from __future__ import annotations

import re

from .driver_views import (
    FIRST_BATCH,
    FIRST_LOAD,
    SECOND_BATCH,
    SECOND_LOAD,
    THIRD_BATCH,
)

OPEN = "DATE '9999-12-31'"
OPEN_MOMENT = "'9999-12-31 00:00:00'"


def _history(name: str, sk: str, bk: str, attrs: list[str], first: str, second: str
             ) -> dict[str, str]:
    """CTEs for both loads of a dimension: <name>_v1, _delta, _opened, _dim."""
    a = ", ".join(attrs)
    sa = ", ".join(f"s.{x}" for x in attrs)
    va = ", ".join(f"v.{x}" for x in attrs)
    differs = " OR ".join(f"s.{x} IS DISTINCT FROM v.{x}" for x in attrs)
    return {
        f"{name}_v1": f"""
            SELECT row_number() OVER (ORDER BY {bk}) AS {sk}, {bk}, {a}
            FROM (SELECT DISTINCT {bk}, {a} FROM {first})""",
        f"{name}_delta": f"""
            SELECT v.{sk} AS old_sk, CASE WHEN v.{sk} IS NULL THEN 1 ELSE 0 END AS kind,
                   s.{bk}, {sa}
            FROM (SELECT DISTINCT {bk}, {a} FROM {second}) s
            LEFT JOIN {name}_v1 v ON s.{bk} = v.{bk}
            WHERE v.{sk} IS NULL OR {differs}""",
        f"{name}_opened": f"""
            SELECT (SELECT max({sk}) FROM {name}_v1)
                   + row_number() OVER (ORDER BY kind, {bk}) AS {sk}, {bk}, {a},
                   DATE '{SECOND_LOAD}' AS valid_from, {OPEN} AS valid_to, true AS is_current
            FROM {name}_delta""",
        f"{name}_closed": f"""
            SELECT v.{sk}, v.{bk}, {va}, DATE '{FIRST_LOAD}' AS valid_from,
                   CASE WHEN d.old_sk IS NULL THEN {OPEN}
                        ELSE CAST(DATE '{SECOND_LOAD}' - INTERVAL 1 DAY AS DATE) END AS valid_to,
                   d.old_sk IS NULL AS is_current
            FROM {name}_v1 v LEFT JOIN {name}_delta d ON v.{sk} = d.old_sk""",
        f"{name}_dim": f"""
            SELECT * FROM {name}_closed UNION ALL SELECT * FROM {name}_opened""",
    }


_PART_COLUMNS = ("p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "s_suppkey",
                 "s_name", "s_nationkey", "large_type")

CTES: dict[str, str] = {
    "customers": """
        SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "courses": """
        SELECT * FROM part JOIN supplier
        ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)""",
    "part_columns": """
        SELECT *, CASE WHEN p_size > 25 THEN p_type END AS large_type FROM courses""",
    "lines": """
        SELECT DISTINCT o_custkey, l_partkey, CAST(o_orderdate AS DATE) AS order_date,
               o_orderpriority, o_orderstatus
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    # What parsing must bring back: the columns the composite texts were made of.
    "nf1": """
        SELECT order_date, CAST(c_custkey AS VARCHAR) AS student_email,
               c_name AS student_name, c_mktsegment AS student_phone,
               n_name AS student_city, r_name AS student_region,
               CAST(p_partkey AS VARCHAR) AS course_name, p_type AS course_category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS course_price,
               s_name AS teacher_name, CAST(s_suppkey AS VARCHAR) AS teacher_email,
               o_orderpriority AS payment_method, o_orderstatus AS payment_status
        FROM lines JOIN customers ON o_custkey = c_custkey
        JOIN courses ON l_partkey = p_partkey""",
    "student2": """
        SELECT DISTINCT student_email, student_name, student_phone, student_city,
               student_region FROM nf1""",
    "course2": """
        SELECT DISTINCT course_name, course_category, course_price, teacher_name,
               teacher_email FROM nf1""",
    "orders2": """
        SELECT order_date, student_email, course_name, payment_method, payment_status
        FROM nf1""",
    "city3": "SELECT DISTINCT student_city, student_region FROM student2",
    "teacher3": "SELECT DISTINCT teacher_email, teacher_name FROM course2",
    "method3": "SELECT DISTINCT payment_method FROM orders2",
    "status3": "SELECT DISTINCT payment_status FROM orders2",
    "student3": """
        SELECT s.student_email, s.student_name, s.student_phone, c.student_city
        FROM student2 s JOIN city3 c ON s.student_city = c.student_city""",
    "course3": """
        SELECT c.course_name, c.course_category, c.course_price, t.teacher_email
        FROM course2 c JOIN teacher3 t ON c.teacher_email = t.teacher_email""",
    "orders3": """
        SELECT o.order_date, s.student_email, c.course_name, m.payment_method,
               p.payment_status
        FROM orders2 o JOIN student3 s ON o.student_email = s.student_email
        JOIN course3 c ON o.course_name = c.course_name
        JOIN method3 m ON o.payment_method = m.payment_method
        JOIN status3 p ON o.payment_status = p.payment_status""",
    "lists": """
        SELECT doc_id, source, text AS lines, replace(text, '. ', chr(10)) AS sentences,
               CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 1 THEN '' ELSE lang END AS label
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "arrays": """
        SELECT doc_id, source,
               CASE WHEN coalesce(lines, '') = '' THEN CAST([] AS VARCHAR[])
                    ELSE string_split(lines, chr(10)) END AS a,
               CASE WHEN coalesce(sentences, '') = '' THEN CAST([] AS VARCHAR[])
                    ELSE string_split(sentences, chr(10)) END AS b,
               CASE WHEN coalesce(label, '') = '' THEN CAST([] AS VARCHAR[])
                    ELSE string_split(label, chr(10)) END AS c
        FROM lists""",
    "stu1": f"""
        SELECT c_custkey AS student_email, c_name AS student_name,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS student_phone,
               n_name AS student_city, r_name AS student_region
        FROM customers WHERE c_custkey IN
            (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{SECOND_LOAD}')""",
    "stu_all1": """
        SELECT c_custkey AS student_email, c_name AS student_name,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS student_phone,
               n_name AS student_city, r_name AS student_region
        FROM customers""",
    "stu2": """
        SELECT c_custkey AS student_email, c_name AS student_name,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION'
                    ELSE c_mktsegment END AS student_phone,
               n_name AS student_city,
               CASE WHEN r_name IN ('AFRICA', 'MIDDLE EAST') THEN 'AFRICA AND MIDDLE EAST'
                    ELSE r_name END AS student_region
        FROM customers""",
    "cou1": """
        SELECT p_partkey AS course_name, p_type AS course_category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS course_price,
               s_name AS teacher_name, s_suppkey AS teacher_email
        FROM courses WHERE p_size <= 45""",
    "cou2": """
        SELECT p_partkey AS course_name, p_type AS course_category,
               CASE WHEN p_type = 'PROMO'
                    THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.9 AS DECIMAL(2,1))
                              AS DECIMAL(10,2))
                    ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS course_price,
               CASE WHEN s_acctbal < 0 THEN s_name || ' (in debt)' ELSE s_name END
                   AS teacher_name, s_suppkey AS teacher_email
        FROM courses""",
    "city_src1": """
        SELECT DISTINCT student_city AS city_name, student_region AS region_name FROM stu1""",
    "city_src2": """
        SELECT DISTINCT student_city AS city_name, student_region AS region_name FROM stu2""",
    **_history("city", "city_sk", "city_name", ["region_name"], "city_src1", "city_src2"),
    "student_src1": """
        SELECT s.*, c.city_sk FROM stu1 s JOIN city_v1 c ON s.student_city = c.city_name""",
    "student_src2": """
        SELECT s.*, c.city_sk FROM stu2 s
        JOIN city_dim c ON s.student_city = c.city_name AND c.is_current""",
    **_history("student", "student_sk", "student_email",
               ["student_name", "student_phone", "city_sk"], "student_src1", "student_src2"),
    **_history("teacher", "teacher_sk", "teacher_email", ["teacher_name"], "cou1", "cou2"),
    "course_src1": """
        SELECT c.*, t.teacher_sk FROM cou1 c
        JOIN teacher_v1 t ON c.teacher_email = t.teacher_email""",
    "course_src2": """
        SELECT c.*, t.teacher_sk FROM cou2 c
        JOIN teacher_dim t ON c.teacher_email = t.teacher_email AND t.is_current""",
    **_history("course", "course_sk", "course_name",
               ["course_category", "course_price", "teacher_sk"], "course_src1", "course_src2"),
    "city_same": """
        SELECT coalesce(v.city_sk, (SELECT max(city_sk) FROM city_v1) + row_number() OVER
                   (PARTITION BY v.city_sk IS NULL ORDER BY s.city_name)) AS city_sk,
               s.city_name
        FROM city_src2 s LEFT JOIN city_v1 v ON s.city_name = v.city_name""",
    "student_same": """
        SELECT coalesce(v.student_sk, (SELECT max(student_sk) FROM student_v1)
                   + row_number() OVER (PARTITION BY v.student_sk IS NULL
                                        ORDER BY s.student_email)) AS student_sk,
               s.student_email, s.student_name, s.student_phone, c.city_sk
        FROM stu2 s JOIN city_same c ON s.student_city = c.city_name
        LEFT JOIN student_v1 v ON s.student_email = v.student_email""",
    "fact_now": """
        SELECT row_number() OVER (ORDER BY order_date, o_custkey, l_partkey, o_orderpriority,
                                  o_orderstatus) AS order_sk,
               order_date, s.student_sk, c.course_sk, o_orderpriority AS payment_method,
               o_orderstatus AS payment_status
        FROM lines
        JOIN student_dim s ON o_custkey = s.student_email AND s.is_current
        JOIN course_dim c ON l_partkey = c.course_name AND c.is_current""",
    "student_periods": """
        SELECT *, CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY student_email)
                       THEN DATE '0001-01-01' ELSE valid_from END AS since FROM student_dim""",
    "course_periods": """
        SELECT *, CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY course_name)
                       THEN DATE '0001-01-01' ELSE valid_from END AS since FROM course_dim""",
    "fact_then": """
        SELECT row_number() OVER (ORDER BY order_date, o_custkey, l_partkey, o_orderpriority,
                                  o_orderstatus) AS order_sk,
               order_date, s.student_sk, c.course_sk, o_orderpriority AS payment_method,
               o_orderstatus AS payment_status
        FROM lines
        JOIN student_periods s ON o_custkey = s.student_email
             AND order_date BETWEEN s.since AND s.valid_to
        JOIN course_periods c ON l_partkey = c.course_name
             AND order_date BETWEEN c.since AND c.valid_to""",
    "stg": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS customer_city,
               o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(12,2)) AS order_amount,
               o_orderstatus AS order_status, p_partkey AS product_id, p_name AS product_name,
               p_type AS product_category, CAST(l_quantity AS INTEGER) AS qty,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'CRM' ELSE 'WEB' END
                   AS source_system, o_orderdate AS load_dts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey""",
    "stg_early": f"SELECT * FROM stg WHERE load_dts < TIMESTAMP '{SECOND_LOAD}'",
    "sat_b1": f"""
        SELECT DISTINCT md5(CAST(order_id AS VARCHAR)) AS hk_order,
               md5(CAST(order_amount AS VARCHAR) || '|NEW') AS hash_diff,
               CAST(order_amount AS DOUBLE) AS amount, 'NEW' AS status,
               '{FIRST_BATCH}' AS load_dts, {OPEN_MOMENT} AS end_date
        FROM stg_early""",
    "sat_b2": f"""
        SELECT DISTINCT md5(CAST(order_id AS VARCHAR)) AS hk_order,
               md5(CAST(order_amount AS VARCHAR) || '|' || order_status) AS hash_diff,
               CAST(order_amount AS DOUBLE) AS amount, order_status AS status,
               '{SECOND_BATCH}' AS load_dts, {OPEN_MOMENT} AS end_date
        FROM stg
        WHERE NOT EXISTS (SELECT 1 FROM sat_b1 x
            WHERE x.hk_order = md5(CAST(order_id AS VARCHAR))
              AND x.hash_diff = md5(CAST(order_amount AS VARCHAR) || '|' || order_status))""",
    "sat_two": "SELECT * FROM sat_b1 UNION ALL SELECT * FROM sat_b2",
    "sat_newest": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
            (PARTITION BY hk_order ORDER BY load_dts DESC) AS rn FROM sat_two) WHERE rn = 1""",
    "teacher_names": """
        SELECT teacher_email, teacher_name FROM cou1
        UNION SELECT teacher_email, teacher_name FROM cou2""",
    "moved": """
        SELECT student_email, student_sk, valid_from,
               CASE WHEN is_current THEN valid_to
                    WHEN student_phone = 'BUILDING'
                    THEN CAST(valid_to - INTERVAL 30 DAY AS DATE)
                    ELSE CAST(valid_to + INTERVAL 1 DAY AS DATE) END AS valid_to
        FROM student_dim""",
    "chained": """
        SELECT *, lead(valid_from) OVER (PARTITION BY student_email
                                         ORDER BY valid_from, student_sk) AS nxt FROM moved""",
}


def _needed(body: str) -> list[str]:
    """CTEs a text refers to, directly or through others, in definition order."""
    wanted: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTES.keys() - wanted:
            wanted.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in wanted]


def _statement(body: str) -> str:
    parts = [f"{name} AS ({CTES[name]})" for name in _needed(body)]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


_DAY = "CAST({0} AS VARCHAR) AS {0}"


def _days(*columns: str) -> str:
    return ", ".join(_DAY.format(c) for c in columns)


_PERIOD = _days("valid_from", "valid_to") + ", is_current"
_CITY = f"city_sk, city_name, region_name, {_PERIOD}"
_STUDENT = f"student_sk, student_email, student_name, student_phone, city_sk, {_PERIOD}"
_COURSE = ("course_sk, course_name, course_category, "
           f"CAST(course_price AS DOUBLE) AS course_price, teacher_sk, {_PERIOD}")
_FACT = ("order_sk, CAST(order_date AS VARCHAR) AS order_date, student_sk, course_sk, "
         "payment_method, payment_status")
_ORDERS = ("CAST(order_date AS VARCHAR) AS order_date, student_email, course_name, "
           "payment_method, payment_status")
_FIRST_PERIOD = (f"'{FIRST_LOAD}' AS valid_from, '9999-12-31' AS valid_to, "
                 "true AS is_current")


def _exploded(length: str) -> str:
    return f"""
        SELECT doc_id, source, pos, a[pos] AS lines, b[pos] AS sentences, c[pos] AS label
        FROM (SELECT *, CAST(unnest(generate_series(1, {length})) AS INTEGER) AS pos
              FROM arrays)"""


def _hub_sql(hk: str, bk: str) -> str:
    return f"""
        SELECT md5(CAST({bk} AS VARCHAR)) AS {hk}, CAST({bk} AS VARCHAR) AS {bk},
               '{FIRST_BATCH}' AS load_dts, min(source_system) AS record_source
        FROM stg GROUP BY {bk}"""


def _link_sql(hk: str, hk1: str, bk1: str, hk2: str, bk2: str) -> str:
    return f"""
        SELECT md5(CAST({bk1} AS VARCHAR) || '|' || CAST({bk2} AS VARCHAR)) AS {hk},
               md5(CAST({bk1} AS VARCHAR)) AS {hk1}, md5(CAST({bk2} AS VARCHAR)) AS {hk2},
               '{FIRST_BATCH}' AS load_dts, min(source_system) AS record_source
        FROM stg GROUP BY {bk1}, {bk2}"""


def _sat_sql(hk: str, bk: str, one: str, one_as: str, two: str, two_as: str,
             kind: str = "VARCHAR") -> str:
    return f"""
        SELECT DISTINCT md5(CAST({bk} AS VARCHAR)) AS {hk},
               md5(CAST({one} AS VARCHAR) || '|' || {two}) AS hash_diff,
               CAST({one} AS {kind}) AS {one_as}, {two} AS {two_as},
               '{FIRST_BATCH}' AS load_dts, {OPEN_MOMENT} AS end_date
        FROM stg"""


def _dependency(source: str, x: str, y: str) -> str:
    return f"""
        SELECT '{x}' AS determinant, '{y}' AS dependent, count(*) AS n_values,
               CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_broken,
               count(*) FILTER (WHERE n > 1) = 0 AS holds
        FROM (SELECT {x}, count(*) AS n FROM (SELECT DISTINCT {x}, {y} FROM {source})
              GROUP BY {x})"""


BODIES: dict[str, str] = {
    "csv_load": "SELECT doc_id, lang, text FROM documents",
    "absent_append": """
        SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment
                                       ELSE lower(c_mktsegment) END AS c_mktsegment
        FROM customer""",
    "parse_1nf": """
        SELECT CAST(order_date AS VARCHAR) AS order_date, student_email, student_name,
               student_phone, student_city, student_region, course_name, course_category,
               CAST(course_price AS DOUBLE) AS course_price, teacher_name, teacher_email,
               payment_method, payment_status FROM nf1""",
    "explode_zip": _exploded("greatest(len(a), len(b), len(c))"),
    "explode_by_index": _exploded("len(a)"),
    "explode_by_index_sparse": _exploded("len(c)"),
    "list_length_report": """
        SELECT doc_id, source, CAST(len(a) AS INTEGER) AS n_lines,
               CAST(len(b) AS INTEGER) AS n_sentences, CAST(len(c) AS INTEGER) AS n_label
        FROM arrays WHERE len(a) <> len(b) OR len(a) <> len(c)""",
    "nf2_student": "SELECT * FROM student2",
    "nf2_course": """
        SELECT course_name, course_category, CAST(course_price AS DOUBLE) AS course_price,
               teacher_name, teacher_email FROM course2""",
    "nf2_orders": f"SELECT {_ORDERS} FROM orders2",
    "nf2_course_latest": """
        SELECT course_name, course_category, CAST(course_price AS DOUBLE) AS course_price,
               teacher_name, teacher_email FROM cou2""",
    "nf3_city": "SELECT * FROM city3",
    "nf3_teacher": "SELECT * FROM teacher3",
    "nf3_dict_method": "SELECT * FROM method3",
    "nf3_dict_status": "SELECT * FROM status3",
    "nf3_student": "SELECT * FROM student3",
    "nf3_course": """
        SELECT course_name, course_category, CAST(course_price AS DOUBLE) AS course_price,
               teacher_email FROM course3""",
    "nf3_orders": f"SELECT {_ORDERS} FROM orders3",
    "preview": """
        SELECT CAST(order_date AS VARCHAR) AS order_date, o_custkey AS student_email,
               l_partkey AS course_name, o_orderpriority AS payment_method,
               o_orderstatus AS payment_status
        FROM lines ORDER BY order_date, o_custkey, l_partkey, o_orderpriority, o_orderstatus
        LIMIT 3""",
    "assign_sk": """
        SELECT row_number() OVER (ORDER BY order_date, o_custkey, l_partkey, o_orderpriority,
                                  o_orderstatus) AS order_sk,
               o_custkey, l_partkey, CAST(order_date AS VARCHAR) AS order_date,
               o_orderpriority, o_orderstatus FROM lines""",
    "scd2_init_city": f"""
        SELECT city_sk, city_name, region_name, {_FIRST_PERIOD} FROM city_v1""",
    "scd2_init_customer": f"""
        SELECT student_sk, student_email, student_name, student_phone, city_sk,
               {_FIRST_PERIOD} FROM student_v1""",
    "scd2_changed": """
        SELECT old_sk AS student_sk, student_email, student_name, student_phone, city_sk
        FROM student_delta WHERE kind = 0""",
    "scd2_new": """
        SELECT student_email, student_name, student_phone, city_sk
        FROM student_delta WHERE kind = 1""",
    "scd2_closed": f"SELECT {_STUDENT} FROM student_closed",
    "scd2_opened": f"SELECT {_STUDENT} FROM student_opened",
    "scd2_city": f"SELECT {_CITY} FROM city_dim",
    "scd2_customer": f"SELECT {_STUDENT} FROM student_dim",
    "scd2_teacher": f"""
        SELECT teacher_sk, teacher_email, teacher_name, {_PERIOD} FROM teacher_dim""",
    "scd2_part": f"SELECT {_COURSE} FROM course_dim",
    "scd2_idempotent": f"SELECT {_STUDENT} FROM student_dim",
    "scd2_same_day": f"SELECT *, {_FIRST_PERIOD} FROM student_same",
    "scd2_late": """
        SELECT d.student_sk, s.student_email, s.student_name, s.student_phone, c.city_sk,
               CAST(d.valid_from AS VARCHAR) AS valid_from
        FROM stu1 s JOIN city_dim c ON s.student_city = c.city_name AND c.is_current
        JOIN student_dim d ON d.student_email = s.student_email AND d.is_current
        WHERE d.valid_from > DATE '1997-06-30'
          AND (s.student_name IS DISTINCT FROM d.student_name
               OR s.student_phone IS DISTINCT FROM d.student_phone
               OR c.city_sk IS DISTINCT FROM d.city_sk)""",
    "dimension_store": f"SELECT {_CITY} FROM city_dim",
    "store_cascade": """
        SELECT CAST(student_email AS VARCHAR) AS student_email, student_name, student_phone,
               city_name, region_name, CAST(s.valid_from AS VARCHAR) AS valid_from,
               CAST(s.valid_to AS VARCHAR) AS valid_to, s.is_current
        FROM student_dim s JOIN city_dim USING (city_sk)""",
    "store_follow": f"""
        SELECT CAST(student_email AS VARCHAR) AS student_email, student_name, student_phone,
               city_name, region_name, '{FIRST_LOAD}' AS valid_from,
               CAST(c.valid_to AS VARCHAR) AS valid_to, c.is_current
        FROM student_v1 s JOIN city_closed c USING (city_sk)
        UNION ALL
        SELECT CAST(student_email AS VARCHAR), student_name, student_phone, n.city_name,
               n.region_name, '{SECOND_LOAD}', CAST(n.valid_to AS VARCHAR), true
        FROM student_v1 s JOIN city_closed c USING (city_sk)
        JOIN city_opened n ON n.city_name = c.city_name
        WHERE NOT c.is_current""",
    "contract_violations": """
        SELECT 'student_3nf_scd2' AS table_name, rule, n_rows FROM (
            SELECT 'key' AS rule, 0 AS n_rows
            UNION ALL SELECT 'unique student_email,valid_from', 0
            UNION ALL SELECT 'length', 0
            UNION ALL SELECT 'one current', count(*) FROM (
                SELECT student_email FROM (SELECT student_email FROM student_v1
                                           UNION ALL SELECT student_email FROM student_opened)
                GROUP BY student_email HAVING count(*) > 1)
            UNION ALL SELECT 'required', count(*) FROM (
                SELECT student_phone FROM student_v1
                UNION ALL SELECT student_phone FROM student_opened) WHERE student_phone IS NULL
            UNION ALL SELECT 'reference city_sk', count(DISTINCT city_sk) FROM (
                SELECT city_sk FROM student_v1 UNION ALL SELECT city_sk FROM student_opened)
                WHERE city_sk NOT IN (SELECT city_sk FROM city_dim WHERE region_name <> 'AMERICA'))
        UNION ALL SELECT 'course_3nf', 'key', 0
        UNION ALL SELECT 'course_3nf', 'length', 0
        UNION ALL SELECT 'course_3nf', 'fits course_price', count(*) FROM cou1
            WHERE course_category = 'PROMO'""",
    "parse_rejects": """
        SELECT course_name || '|PROMO|n/a' AS course_info, 'course_price' AS unreadable,
               count(*) AS n_rows
        FROM nf1 WHERE course_category = 'PROMO' GROUP BY course_name""",
    "dim_history": f"SELECT {_STUDENT} FROM student_dim ORDER BY student_email, valid_from",
    "dim_as_of": f"""
        SELECT {_STUDENT} FROM student_dim
        WHERE DATE '1997-06-30' BETWEEN student_dim.valid_from AND student_dim.valid_to""",
    "fact_current": f"SELECT {_FACT} FROM fact_now",
    "fact_as_of": f"SELECT {_FACT} FROM fact_then",
    "star_view": """
        SELECT order_sk, CAST(order_date AS VARCHAR) AS order_date, payment_method,
               payment_status, student_email, course_name
        FROM fact_then f JOIN student_dim s ON f.student_sk = s.student_sk
        JOIN course_dim c ON f.course_sk = c.course_sk""",
    "hub_customer": _hub_sql("hk_customer", "customer_id"),
    "hub_order": _hub_sql("hk_order", "order_id"),
    "hub_product": _hub_sql("hk_product", "product_id"),
    "hub_second_batch": f"""
        SELECT md5(CAST(order_id AS VARCHAR)) AS hk_order,
               CAST(order_id AS VARCHAR) AS order_id,
               CASE WHEN min(load_dts) < TIMESTAMP '{SECOND_LOAD}' THEN '{FIRST_BATCH}'
                    ELSE '{SECOND_BATCH}' END AS load_dts,
               min(source_system) AS record_source
        FROM stg GROUP BY order_id""",
    "link_customer_order": _link_sql("hk_customer_order", "hk_customer", "customer_id",
                                     "hk_order", "order_id"),
    "link_order_product": _link_sql("hk_order_product", "hk_order", "order_id",
                                    "hk_product", "product_id"),
    "sat_customer": _sat_sql("hk_customer", "customer_id", "customer_name", "name",
                             "customer_city", "city"),
    "sat_order": _sat_sql("hk_order", "order_id", "order_amount", "amount",
                          "order_status", "status", "DOUBLE"),
    "sat_product": _sat_sql("hk_product", "product_id", "product_name", "name",
                            "product_category", "category"),
    "sat_order_product": f"""
        SELECT md5(CAST(order_id AS VARCHAR) || '|' || CAST(product_id AS VARCHAR))
                   AS hk_order_product_link,
               md5(CAST(qty AS VARCHAR) || '|' || CAST(price AS VARCHAR)) AS hash_diff,
               qty, CAST(price AS DOUBLE) AS price, '{FIRST_BATCH}' AS load_dts
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                           ORDER BY qty DESC, price DESC) AS rn FROM stg)
        WHERE rn = 1""",
    "sat_second_batch": "SELECT * FROM sat_two",
    "sat_link_second_batch": f"""
        SELECT md5(CAST(order_id AS VARCHAR) || '|' || CAST(product_id AS VARCHAR))
                   AS hk_order_product_link,
               md5(CAST(qty AS VARCHAR) || '|' || CAST(price AS VARCHAR)) AS hash_diff,
               qty, CAST(price AS DOUBLE) AS price,
               CASE WHEN load_dts < TIMESTAMP '{SECOND_LOAD}' THEN '{FIRST_BATCH}'
                    ELSE '{SECOND_BATCH}' END AS load_dts
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                           ORDER BY qty DESC, price DESC) AS rn FROM stg)
        WHERE rn = 1""",
    "sat_latest": "SELECT * FROM sat_newest",
    "sat_returning": f"""
        SELECT b.* REPLACE ('{THIRD_BATCH}' AS load_dts) FROM sat_b1 b
        WHERE NOT EXISTS (SELECT 1 FROM sat_newest n
                          WHERE n.hk_order = b.hk_order AND n.hash_diff = b.hash_diff)""",
    "sat_conflicts": """
        SELECT DISTINCT order_id, product_id, qty, CAST(price AS DOUBLE) AS price
        FROM (SELECT *, dense_rank() OVER (PARTITION BY order_id, product_id
                                           ORDER BY qty DESC, price DESC) AS rn FROM stg)
        WHERE rn > 1""",
    "fact_as_of_deep": """
        SELECT d.o_orderpriority || '|' || CAST(coalesce(d.valid_from, f.first) AS VARCHAR)
                   AS priority_sk,
               count(*) AS n_lines, CAST(min(e.day) AS VARCHAR) AS first_day
        FROM (SELECT o_orderpriority, CAST(l_shipdate AS DATE) AS day
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) e
        JOIN (SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS first
              FROM orders GROUP BY o_orderpriority) f USING (o_orderpriority)
        ASOF JOIN (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS valid_from
                   FROM orders) d
        ON e.o_orderpriority = d.o_orderpriority AND greatest(e.day, f.first) >= d.valid_from
        GROUP BY 1""",
    "sat_rejects": """
        SELECT DISTINCT order_id, CAST(order_amount AS DOUBLE) AS amount,
               CAST(NULL AS VARCHAR) AS status
        FROM stg WHERE order_status = 'P'""",
    "sat_known_orders": f"""
        SELECT * REPLACE ('{SECOND_BATCH}' AS load_dts) FROM ({_sat_sql(
            "hk_order", "order_id", "order_amount", "amount", "order_status", "status", "DOUBLE")}
        WHERE load_dts < TIMESTAMP '{SECOND_LOAD}')""",
    "vault_key_rejects": """
        SELECT customer_id, order_id, product_id, source_system,
               concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id' END,
                         CASE WHEN product_id IS NULL THEN 'product_id' END) AS missing,
               count(*) AS n_rows
        FROM (SELECT order_id, source_system,
                     CASE WHEN order_status <> 'P' THEN customer_id END AS customer_id,
                     CASE WHEN product_category <> 'PROMO' THEN product_id END AS product_id
              FROM stg)
        WHERE customer_id IS NULL OR product_id IS NULL
        GROUP BY ALL""",
    "vault_stream": _sat_sql("hk_order", "order_id", "order_amount", "amount",
                             "order_status", "status", "DOUBLE"),
    "dq_pk": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "dq_one_current": """
        SELECT student_email, count(*) AS n_current FROM
            (SELECT student_email FROM student_v1
             UNION ALL SELECT student_email FROM student_opened)
        GROUP BY student_email HAVING count(*) > 1""",
    "dq_fk": """
        SELECT o_custkey AS student_email, count(*) AS n_rows FROM lines
        WHERE o_custkey NOT IN (SELECT student_email FROM stu1) GROUP BY o_custkey""",
    "dq_not_null": """
        SELECT *, concat_ws(',', CASE WHEN student_email IS NULL THEN 'student_email' END,
                            CASE WHEN student_phone IS NULL THEN 'student_phone' END)
               AS missing
        FROM stu_all1 WHERE student_email IS NULL OR student_phone IS NULL""",
    "dq_length": """
        SELECT doc_id, concat_ws(',', CASE WHEN length(text) > 2000 THEN 'text' END,
                                 CASE WHEN length(lang) > 50 THEN 'lang' END) AS oversize
        FROM documents WHERE length(text) > 2000 OR length(lang) > 50""",
    "dq_decimal": """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE)
               AS o_totalprice
        FROM orders WHERE TRY_CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(7,2))
                          IS NULL AND o_totalprice IS NOT NULL""",
    "dq_fd": """
        SELECT p_name, count(*) AS n_variants FROM (SELECT DISTINCT p_name, p_type FROM part)
        GROUP BY p_name HAVING count(*) > 1""",
    "dq_transitive": " UNION ALL ".join(
        _dependency("stu_all1", x, y) for x, y in (
            ("student_city", "student_region"), ("student_region", "student_city"),
            ("student_phone", "student_city"), ("student_name", "student_phone"))),
    "dq_dependencies": " UNION ALL ".join(f"""
        SELECT '{x}' AS determinant, '{y}' AS dependent, count(*) AS n_values
        FROM (SELECT x, count(*) AS n FROM (SELECT DISTINCT {x} AS x, {y} AS y FROM part_columns)
              GROUP BY x) HAVING max(n) = 1"""
        for x in _PART_COLUMNS for y in _PART_COLUMNS if x != y),
    "dq_chain": f"""
        SELECT student_email, student_sk, {_days("valid_from", "valid_to")},
               CAST(nxt AS VARCHAR) AS next_valid_from, problem
        FROM (SELECT *, concat_ws(',',
                CASE WHEN valid_to < valid_from THEN 'inverted' END,
                CASE WHEN valid_to <> {OPEN} AND nxt > valid_to + 1 THEN 'gap' END,
                CASE WHEN nxt <= valid_to THEN 'overlap' END,
                CASE WHEN nxt IS NULL AND valid_to <> {OPEN} THEN 'unended' END) AS problem
              FROM chained) WHERE problem <> ''""",
    "dq_atomic": """
        SELECT page_id, concat_ws(',',
                   CASE WHEN contains(url, '?') OR contains(url, '#') THEN 'url' END,
                   CASE WHEN contains(html, '<li>') THEN 'html' END) AS non_atomic
        FROM pages
        WHERE contains(url, '?') OR contains(url, '#') OR contains(html, '<li>')""",
    "dq_spelling": """
        SELECT teacher_email, count(*) AS n_spellings, min(teacher_name) AS first_spelling,
               max(teacher_name) AS last_spelling
        FROM teacher_names GROUP BY teacher_email HAVING count(*) > 1""",
    "students_per_city": """
        SELECT student_city, count(*) AS n_students FROM student3 GROUP BY student_city""",
    "avg_price_by_category": """
        SELECT course_category, count(*) AS n_orders,
               CAST(sum(course_price) AS DOUBLE) AS revenue,
               CAST(sum(course_price) AS DOUBLE) / count(*) AS avg_price
        FROM orders2 JOIN course2 USING (course_name) GROUP BY course_category""",
    "teacher_count": "SELECT count(DISTINCT teacher_email) AS n_teachers FROM teacher3",
    "co_purchases": """
        SELECT o_custkey AS student_email, l_partkey AS course_name, count(*) AS n_orders,
               count(*) OVER (PARTITION BY o_custkey) - 1 AS n_others
        FROM lines GROUP BY o_custkey, l_partkey
        QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1""",
    "best_seller_company": """
        SELECT l_partkey AS course_name, count(DISTINCT o_custkey) AS n_students FROM lines
        WHERE o_custkey IN (SELECT o_custkey FROM lines WHERE l_partkey =
                (SELECT l_partkey FROM lines GROUP BY l_partkey
                 ORDER BY count(DISTINCT o_custkey) DESC, l_partkey LIMIT 1))
          AND l_partkey <> (SELECT l_partkey FROM lines GROUP BY l_partkey
                 ORDER BY count(DISTINCT o_custkey) DESC, l_partkey LIMIT 1)
        GROUP BY l_partkey""",
    "teachers_by_category": """
        SELECT DISTINCT course_category, t.teacher_email, teacher_name
        FROM course3 c JOIN teacher3 t ON c.teacher_email = t.teacher_email""",
    "revenue_at_time": """
        SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS n_orders,
               CAST(sum(course_price) AS DOUBLE) AS revenue
        FROM fact_then f JOIN course_dim c ON f.course_sk = c.course_sk GROUP BY ALL""",
    "dup_persons": """
        SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(student_email) AS n_persons,
               CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_repeated
        FROM (SELECT student_email, count(*) AS n FROM nf1 GROUP BY student_email)""",
}


def _digits(column: str) -> str:
    return f"CAST(sum(CAST('0x' || substr({column}, 1, 5) AS BIGINT)) AS BIGINT)"


def _contents(keys: dict[str, str]) -> str:
    """Rows and digests of vault tables, given by name with their own hash keys."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {_digits(hk)} AS keys, "
        + (_digits("hash_diff") if name.startswith("sat_") else "CAST(0 AS BIGINT)")
        + f" AS attributes FROM ({BODIES[name]})" for name, hk in keys.items())


BODIES["vault_layers"] = BODIES["vault_stream_layers"] = BODIES["vault_increment"] = _contents({
    "hub_customer": "hk_customer", "hub_order": "hk_order", "hub_product": "hk_product",
    "link_customer_order": "hk_customer_order", "link_order_product": "hk_order_product",
    "sat_customer": "hk_customer", "sat_order": "hk_order", "sat_product": "hk_product",
    "sat_order_product": "hk_order_product_link"})


def _layer(name: str, source: str, *columns: str) -> str:
    """Rows of a table, and a sum over digests of its business columns in order of their names."""
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return (f"SELECT '{name}' AS table_name, count(*) AS n_rows, "
            f"{_digits(f'md5(concat_ws({chr(39)}|{chr(39)}, {texts}))')} AS contents FROM {source}")


_COURSE_2 = ("course_category", "course_name", "course_price")
_STUDENT_2 = ("student_email", "student_name", "student_phone")
_ORDER_2 = ("course_name", "order_date", "payment_method", "payment_status", "student_email")
_TEACHER = ("teacher_email", "teacher_name")
BODIES["relational_layers"] = " UNION ALL ".join([
    _layer("courses_1nf", "nf1", *_COURSE_2, "order_date", "payment_method", "payment_status",
           "student_city", *_STUDENT_2, "student_region", *_TEACHER),
    _layer("student_2nf", "student2", "student_city", *_STUDENT_2, "student_region"),
    _layer("course_2nf", "course2", *_COURSE_2, *_TEACHER),
    _layer("orders_2nf", "orders2", *_ORDER_2),
    _layer("cities_3nf", "city3", "student_city", "student_region"),
    _layer("student_3nf", "student3", "student_city", *_STUDENT_2),
    _layer("teachers_3nf", "teacher3", *_TEACHER),
    _layer("course_3nf", "course3", *_COURSE_2, "teacher_email"),
    _layer("payment_methods_3nf", "method3", "payment_method"),
    _layer("payment_statuses_3nf", "status3", "payment_status"),
    _layer("orders_3nf", "orders3", *_ORDER_2),
    _layer("payment_methods_3nf_ref", "method3", "payment_method"),
    _layer("payment_statuses_3nf_ref", "status3", "payment_status"),
    _layer("cities_3nf_scd2", "city3", "student_city", "student_region"),
    _layer("student_3nf_scd2", "student3", *_STUDENT_2),
    _layer("teachers_3nf_scd2", "teacher3", *_TEACHER),
    _layer("courses_3nf_scd2", "course3", *_COURSE_2),
    _layer("orders_3nf_fact", "orders3", "order_date", "payment_method", "payment_status")])


def expected_sql() -> dict[str, str]:
    return {name: _statement(body) for name, body in BODIES.items()}
