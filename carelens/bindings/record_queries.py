"""Identifier, lookup, capture and expression operators over the other test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens.bindings.tables import PICKUP_END, table
from carelens.functions import (
    age_at_start as start_age,
)
from carelens.functions import (
    age_years as years,
)
from carelens.functions import (
    blank_to_null as blanks,
)
from carelens.functions import (
    composite_key as text_key,
)
from carelens.functions import (
    day,
    deceased_flag,
    newest,
    recode,
    vl_indication,
)
from carelens.functions import (
    fill_where as fill,
)
from carelens.functions import (
    format_date as written,
)
from carelens.functions import (
    full_name as whole_name,
)
from carelens.functions import (
    parse_date as parsed,
)
from carelens.functions import (
    strip_zeros as stripped,
)
from carelens.operators import filters, lookups, rows, summaries
from carelens.plans.report_columns import SEX


def _number():
    return F.regexp_replace("c_name", "[^0-9]", "")


def _customer(spark, sf):
    return table(spark, sf, "customer")


def attach_identifiers(spark, sf):
    customer = _customer(spark, sf)
    key = F.col("c_custkey").alias("patient_id")
    patients = customer.select(key, (F.col("c_acctbal") < 0).cast("int").alias("voided"))
    kinds = F.array(*[F.lit(k) for k in (4, 5, 6, 8)])
    ids = customer.select(
        key, F.explode(kinds).alias("identifier_type"), _number().alias("digits"),
        "c_mktsegment", (F.col("c_acctbal") > 9000).cast("int").alias("voided"))
    ids = ids.withColumn("identifier", F.when(
        (F.col("identifier_type") == 5) | (F.col("c_mktsegment") > "BUILDING"),
        F.concat(F.col("identifier_type").cast("string"), F.lit("-"), "digits")))
    return lookups.attach_identifiers(patients, ids)


def rollup_by_identifier(spark, sf):
    shared = _customer(spark, sf).withColumn("hospital_no", F.when(
        F.col("c_mktsegment") != "FURNITURE", F.floor(F.col("c_custkey") / 2)))
    return summaries.rollup_by_identifier(
        shared, "hospital_no", ["c_acctbal", "c_nationkey"], ["c_name", "c_mktsegment"],
        by="c_custkey")


def full_name(spark, sf):
    family = F.when(F.col("c_nationkey") != 3, F.col("c_name"))
    return _customer(spark, sf).select(
        "c_custkey", whole_name(F.col("c_mktsegment"), family).alias("full_name"))


def composite_key(spark, sf):
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return _customer(spark, sf).select("c_custkey", text_key(
        F.col("c_nationkey"), segment, stripped(_number())).alias("key"))


def strip_zeros(spark, sf):
    mixed = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(_number())
    return _customer(spark, sf).select("c_custkey", stripped(mixed).alias("identifier"))


def blank_to_null(spark, sf):
    cell = F.when(F.col("c_nationkey") < 5, "").otherwise(F.col("c_mktsegment"))
    return blanks(_customer(spark, sf).select("c_custkey", cell.alias("cell"), "c_name"))


def number_rows(spark, sf):
    ordered = _customer(spark, sf).select("c_custkey", "c_mktsegment", "c_name")
    return rows.number_rows(ordered, ["c_mktsegment", "c_name"])


def drop_all_duplicates(spark, sf):
    keyed = _customer(spark, sf).withColumn("band", F.floor(F.col("c_acctbal") / 500))
    return rows.drop_all_duplicates(keyed, ["c_nationkey", "c_mktsegment", "band"])


def suffix_duplicates(spark, sf):
    keyed = _customer(spark, sf).select(
        "c_custkey", text_key(F.col("c_nationkey"), F.col("c_mktsegment")).alias("key"))
    return rows.suffix_duplicates(keyed, "key", ["c_custkey"])


def suffix_repeated_rows(spark, sf):
    keyed = _customer(spark, sf).select(
        "c_custkey", text_key(F.col("c_nationkey"), F.col("c_mktsegment")).alias("key"))
    numbered = rows.number_rows(keyed.unionByName(keyed), ["c_custkey"], out="n")
    return rows.suffix_duplicates(numbered, "key", ["n"])


def suffix_many_duplicates(spark, sf):
    keyed = _customer(spark, sf).select("c_custkey", F.col("c_mktsegment").alias("key"))
    return rows.suffix_duplicates(keyed, "key", ["c_custkey"])


def lookup_dimension(spark, sf):
    return lookups.attach_facility(
        _customer(spark, sf), table(spark, sf, "nation"), "c_nationkey", "n_nationkey",
        {"State": "n_name", "LGA": "n_regionkey"})


def lookup_unique(spark, sf):
    customer = _customer(spark, sf).withColumn(
        "home", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")))
    nation = table(spark, sf, "nation").withColumn(
        "home", F.when(F.col("n_nationkey") != 24, F.col("n_nationkey")))
    return lookups.lookup_unique(customer, nation, "home", ["n_name", "n_regionkey"])


def two_hop_lookup(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 5000).alias("creator"))
    users = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_nationkey").cast("long").alias("person_id"))
    nation = table(spark, sf, "nation")
    names = nation.select(
        F.col("n_nationkey").cast("long").alias("person_id"), F.lit("Dr").alias("given_name"),
        F.col("n_name").alias("family_name"), (F.col("n_regionkey") == 2).cast("int").alias("voided"))
    return lookups.attach_entered_by(orders, users, names)


def broadcast_parameters(spark, sf):
    settings = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("string").alias("property"), F.col("r_name").alias("property_value"))
    return lookups.attach_parameters(
        _customer(spark, sf).select("c_custkey"), settings,
        {"first": "0", "second": "1", "missing": "none"})


def scalar_subquery_filter(spark, sf):
    attributes = _customer(spark, sf).select(
        F.col("c_custkey").alias("person_id"),
        F.col("c_nationkey").alias("person_attribute_type_id"), F.col("c_name").alias("value"))
    kinds = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("person_attribute_type_id"), F.col("n_name").alias("name"))
    return lookups.phone_numbers(attributes, kinds, "person_id", type_name="NATION_7")


def exists_flag(spark, sf):
    large = table(spark, sf, "lineitem").filter(F.col("l_extendedprice") > 100000)
    return lookups.flag_exists(
        table(spark, sf, "supplier"), large, "s_suppkey", "l_suppkey", "has_large")


def _captures(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("patient_Id"), F.col("l_shipdate").alias("date_created"),
        F.col("l_returnflag").alias("fingerPosition"),
        F.when(F.col("l_discount") < 0.1, F.col("l_quantity")).alias("imageQuality"))


def filter_not_prefix(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 5, F.col("p_name")).alias("template"),
        F.when(F.col("p_size") < 45, F.encode("p_type", "UTF-8")).alias("new_template"))
    return filters.invalid_template(parts, prefix="S").select("p_partkey", "template")


def capture_quality(spark, sf):
    return summaries.capture_quality(_captures(spark, sf), threshold=25)


def distinct_first(spark, sf):
    return summaries.first_capture(_captures(spark, sf))


def age_years(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", years("o_orderdate", PICKUP_END).alias("age"))


def age_at_start(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("start"))
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    whole, months = start_age(F.date_sub(F.col("o_orderdate").cast("date"), 1800), "start")
    return joined.select("o_orderkey", whole.alias("years"), months.alias("months"))


def format_date(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", written("o_orderdate").alias("short"),
        written("o_orderdate", "dd/mm/yyyy").alias("numeric"))


def parse_date(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", written("o_orderdate")).when(
        F.col("o_orderstatus") == "O", written("o_orderdate", "dd/mm/yyyy")).when(
        F.col("o_orderpriority") == "1-URGENT", "unknown").otherwise(
        F.col("o_orderdate").cast("date").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", parsed(text).alias("parsed"))


def newest_date(spark, sf):
    ship = F.when(F.col("l_discount") < 0.08, F.col("l_shipdate"))
    fixed = F.when(F.col("l_tax") < 0.07, F.expr("timestamp_ntz'1998-06-15'"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", newest(ship, fixed).alias("newest"))


def threshold_band(spark, sf):
    seen = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    value = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 250)
    return table(spark, sf, "orders").select("o_orderkey", vl_indication(seen, value).alias("band"))


def recode_values(spark, sf):
    code = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "F").when(
        F.col("c_mktsegment") == "MACHINERY", "M").otherwise(F.col("c_mktsegment"))
    return _customer(spark, sf).select("c_custkey", recode(code, SEX).alias("sex"))


def flag_columns(spark, sf):
    flag, when = deceased_flag(
        (F.col("c_acctbal") > 9000).cast("int"), F.date_add(day("2001-01-01"), F.col("c_nationkey")))
    return _customer(spark, sf).select("c_custkey", flag.alias("flag"), when.alias("died"))


def fill_where(spark, sf):
    return fill(_customer(spark, sf), "c_mktsegment", F.col("c_acctbal") < 0, "IN DEBT")


QUERIES = {f.__name__: f for f in (
    attach_identifiers, rollup_by_identifier, full_name, composite_key, strip_zeros, blank_to_null,
    number_rows, drop_all_duplicates, suffix_duplicates, suffix_repeated_rows, suffix_many_duplicates,
    lookup_dimension,
    lookup_unique, two_hop_lookup, broadcast_parameters, scalar_subquery_filter, exists_flag,
    filter_not_prefix, capture_quality, distinct_first, age_years, age_at_start, format_date,
    parse_date, newest_date, threshold_band, recode_values, flag_columns, fill_where)}

_DIGITS = "regexp_replace(c_name, '[^0-9]', '', 'g')"
_STRIP = "regexp_replace({0}, '^0+', '')"


def _identifier(kind: int) -> str:
    allowed = "TRUE" if kind == 5 else "c_mktsegment > 'BUILDING'"
    return (f"CASE WHEN c_acctbal >= 0 AND c_acctbal <= 9000 AND {allowed} "
            f"THEN '{kind}-' || {_DIGITS} END")


def _suffix(key: str) -> str:
    return f"""
SELECT c_custkey, CASE WHEN n = 1 THEN key WHEN r <= 26 THEN key || '_' || chr(CAST(64 + r AS INTEGER)) END AS key
FROM (SELECT c_custkey, {key} AS key, count(*) OVER (PARTITION BY {key}) AS n,
             row_number() OVER (PARTITION BY {key} ORDER BY c_custkey) AS r FROM customer)"""


ORACLE = {
    "attach_identifiers": f"""
SELECT c_custkey AS patient_id, CAST(c_acctbal < 0 AS INTEGER) AS voided,
  {_identifier(5)} AS "PatientHospitalNo", {_identifier(4)} AS "PatientUniqueID",
  {_identifier(6)} AS "ANCNoIdentifier", {_identifier(8)} AS "HTSNo" FROM customer""",
    "rollup_by_identifier": """
SELECT hospital_no, top AS c_acctbal, home AS c_nationkey, c_name, c_mktsegment
FROM (SELECT hospital_no, c_name, c_mktsegment, max(c_acctbal) OVER same AS top,
             max(c_nationkey) OVER same AS home,
             row_number() OVER (PARTITION BY hospital_no ORDER BY c_custkey) AS place
      FROM (SELECT *, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey // 2 END AS hospital_no
            FROM customer) WINDOW same AS (PARTITION BY hospital_no)) WHERE place = 1""",
    "full_name": """
SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_mktsegment || ' ' || c_name END AS full_name
FROM customer""",
    "composite_key": f"""
SELECT c_custkey, c_nationkey || CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'nan' END
  || {_STRIP.format(_DIGITS)} AS key FROM customer""",
    "strip_zeros": f"""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE {_STRIP.format(_DIGITS)} END
  AS identifier FROM customer""",
    "blank_to_null": """
SELECT c_custkey, CASE WHEN c_nationkey >= 5 THEN c_mktsegment END AS cell, c_name FROM customer""",
    "number_rows": """
SELECT row_number() OVER (ORDER BY c_mktsegment, c_name) AS row_number, c_custkey, c_mktsegment, c_name
FROM customer""",
    "drop_all_duplicates": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, band FROM (
  SELECT *, CAST(floor(c_acctbal / 500) AS BIGINT) AS band,
         count(*) OVER (PARTITION BY c_nationkey, c_mktsegment, floor(c_acctbal / 500)) AS n
  FROM customer) WHERE n = 1""",
    "suffix_duplicates": _suffix("(c_nationkey || c_mktsegment)"),
    "suffix_repeated_rows": """
SELECT n, c_custkey, CASE WHEN r <= 26 THEN key || '_' || chr(CAST(64 + r AS INTEGER)) END AS key
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n) AS r
      FROM (SELECT c_custkey, c_nationkey || c_mktsegment AS key, row_number() OVER (ORDER BY c_custkey) AS n
            FROM customer CROSS JOIN range(2)))""",
    "suffix_many_duplicates": _suffix("c_mktsegment"),
    "lookup_dimension": """
SELECT customer.*, n_name AS "State", n_regionkey AS "LGA" FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "lookup_unique": """
SELECT c.*, n_name, n_regionkey
FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS home FROM customer) c
LEFT JOIN (SELECT *, CASE WHEN n_nationkey <> 24 THEN n_nationkey END AS other FROM nation) n
ON c.home IS NOT DISTINCT FROM n.other""",
    "two_hop_lookup": """
SELECT o_orderkey, CAST(floor(o_totalprice / 5000) AS BIGINT) AS creator,
  CASE WHEN n_regionkey <> 2 THEN 'Dr ' || n_name END AS "EnteredBy"
FROM orders LEFT JOIN supplier ON s_suppkey = floor(o_totalprice / 5000)
LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "broadcast_parameters": """
SELECT c_custkey, (SELECT r_name FROM region WHERE r_regionkey = 0) AS first,
  (SELECT r_name FROM region WHERE r_regionkey = 1) AS second, CAST(NULL AS VARCHAR) AS missing
FROM customer""",
    "scalar_subquery_filter": """
SELECT c_custkey AS person_id, c_name AS "Phone_No" FROM customer
WHERE c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7')""",
    "exists_flag": """
SELECT supplier.*, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey
  AND l_extendedprice > 100000) THEN 'Yes' ELSE 'No' END AS has_large FROM supplier""",
    "filter_not_prefix": """
SELECT p_partkey, template FROM (
  SELECT p_partkey, CASE WHEN p_size > 5 THEN p_name END AS template,
         CASE WHEN p_size < 45 THEN p_type END AS new_template FROM part)
WHERE template NOT LIKE 'S%' OR new_template NOT LIKE 'S%'""",
    "capture_quality": """
SELECT l_suppkey AS "patient_Id", max(l_shipdate) AS recapture_date, count(l_returnflag) AS n_fingers,
  min(q) AS lowest_quality, CAST(ceil(avg(q)) AS BIGINT) AS average_quality,
  count(CASE WHEN q < 25 THEN 1 END) AS n_low, count(CASE WHEN q < 25 THEN NULL ELSE 1 END) AS n_not_low
FROM (SELECT *, CASE WHEN l_discount < 0.1 THEN l_quantity END AS q FROM lineitem) GROUP BY 1""",
    "distinct_first": """
SELECT l_suppkey AS "patient_Id", min(l_shipdate) AS first_capture FROM lineitem GROUP BY 1""",
    "age_years": f"""
SELECT o_orderkey, CAST(CASE WHEN o_orderdate <= DATE '{PICKUP_END}'
  THEN 2001 - year(o_orderdate) - CAST(strftime(o_orderdate, '%m%d') > '0630' AS INTEGER)
  ELSE 0 END AS INTEGER) AS age FROM orders""",
    "age_at_start": """
WITH spans AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1800 AS dob, CAST(max(l_shipdate) AS DATE) AS start
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
months AS (
  SELECT o_orderkey, (year(start) - year(dob)) * 12 + month(start) - month(dob)
    + CASE WHEN start >= dob AND day(start) < day(dob) THEN -1
           WHEN start < dob AND day(start) > day(dob) THEN 1 ELSE 0 END AS m FROM spans)
SELECT o_orderkey, CAST(CASE WHEN m >= 60 THEN m // 12 ELSE 0 END AS INTEGER) AS years,
  CAST(CASE WHEN m < 60 THEN m END AS INTEGER) AS months FROM months""",
    "format_date": """
SELECT o_orderkey, strftime(o_orderdate, '%d-%b-%Y') AS short, strftime(o_orderdate, '%d/%m/%Y') AS numeric
FROM orders""",
    "parse_date": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
  ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
    "newest_date": """
SELECT l_orderkey, l_linenumber, l_quantity, CASE
  WHEN a IS NULL THEN b WHEN b IS NULL THEN a WHEN a > b THEN a ELSE b END AS newest
FROM (SELECT *, CASE WHEN l_discount < 0.08 THEN l_shipdate END AS a,
             CASE WHEN l_tax < 0.07 THEN TIMESTAMP '1998-06-15' END AS b FROM lineitem)""",
    "threshold_band": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN NULL
  WHEN o_totalprice / 250 <= 1000 THEN 'Routine - Routine' ELSE 'Targeted - Post EAC' END AS band
FROM orders""",
    "recode_values": """
SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Female' WHEN 'MACHINERY' THEN 'Male'
  ELSE c_mktsegment END AS sex FROM customer""",
    "flag_columns": """
SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 'Dead' ELSE '' END AS flag,
  CASE WHEN c_acctbal > 9000 THEN DATE '2001-01-01' + c_nationkey END AS died FROM customer""",
    "fill_where": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_acctbal < 0 THEN 'IN DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
}
