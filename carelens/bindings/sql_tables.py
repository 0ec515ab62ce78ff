"""The same derivations as common table expressions for the SQL checks."""

from carelens.bindings.tables import ANSWER_NAMES, CHILD_IDS, CODES, EVENT_CONCEPTS, EVENT_IDS

K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"

OBS = f"""
obs AS (
  SELECT event_id AS obs_id, user_id AS person_id, event_type AS concept_id,
         ts AS obs_datetime, value AS value_numeric,
         CAST(floor({K} / 4.0) AS INTEGER) AS value_coded,
         event_id AS encounter_id, CAST(value < 5 AS INTEGER) AS voided
  FROM events),
encounter AS (
  SELECT event_id AS encounter_id, user_id AS patient_id,
         CASE WHEN {K} < 34 THEN 13 ELSE 27 END AS form_id,
         CASE WHEN {K} BETWEEN 20 AND 70 THEN 13 ELSE 11 END AS encounter_type,
         ts AS encounter_datetime, CAST(value > 200 AS INTEGER) AS voided
  FROM events)
"""

PICKUPS = """
pickups AS (
  SELECT o_custkey AS person_id, o_orderkey AS obs_id, o_orderdate AS obs_datetime,
         CAST(o_totalprice < 20000 AS INTEGER) AS voided,
         CASE WHEN o_orderstatus = 'P' THEN 13 ELSE 27 END AS form_id
  FROM orders),
refills AS (
  SELECT l_orderkey AS group_id, CAST(max(l_quantity) * 7 AS INTEGER) AS child_value
  FROM lineitem GROUP BY 1)
"""


def _list(values) -> str:
    return "[" + ", ".join(str(v) for v in values) + "]"


_CODES = _list(CODES)
_CONCEPTS = _list(EVENT_CONCEPTS)
_ANSWERS = " ".join(f"WHEN {p} THEN '{n}'" for p, n in ANSWER_NAMES.items())


def _code(position: str) -> str:
    return f"{_CODES}[{position} + 1]"


_BAND = "CAST(floor(o_totalprice / 20001) AS INTEGER)"
_ENDING = "(CASE WHEN o_totalprice < 370000 THEN 13 WHEN o_totalprice < 440000 THEN 14 ELSE 15 END)"
_VISIT_AT = "o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 9 HOUR ELSE INTERVAL 0 HOUR END"
_EVENT_AT = "ts - INTERVAL 23 YEAR + INTERVAL 165 DAY"
_DIGITS = "regexp_replace(c_name, '[^0-9]', '', 'g')"
_PRIORITY = "left(o_orderpriority, 1)"


def _by_priority(*values) -> str:
    cases = " ".join(f"WHEN '{i + 1}' THEN {v}" for i, v in enumerate(values[:4]))
    return f"(CASE {_PRIORITY} {cases} ELSE {values[4]} END)"


_EXTRA_CONCEPT = (
    "CASE WHEN o_orderstatus = 'P' THEN "
    + _by_priority("CASE WHEN o_totalprice > 300000 THEN 165470 ELSE 165889 END",
                   165469, 165460, 165775, 165916)
    + " ELSE " + _by_priority(160540, 165242, 5089, 1659, 165727) + " END")
_EXTRA_CODE = (
    "CASE WHEN o_orderstatus = 'P' THEN "
    + _by_priority(_code(_ENDING), "NULL", _code(_BAND), "NULL", "NULL")
    + " ELSE " + _by_priority(_code(_BAND), _code("16"), "NULL", _code(_BAND),
                              _code("(CASE WHEN o_totalprice > 250000 THEN 12 ELSE 11 END)"))
    + " END")
_LINE_CODE = _by_priority(*[_code(str(p)) for p in (17, 18, 19, 20, 21)])
_REGIMEN = _by_priority(164506, 164513, 164507, 165702, 165703)

CLINICAL = f"""
patient AS (
  SELECT c_custkey AS patient_id, CAST(c_acctbal < -900 AS INTEGER) AS voided FROM customer),
patient_identifier AS (
  SELECT * FROM (
    SELECT c_custkey AS patient_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN lpad(CAST(c_custkey // 2 AS VARCHAR), 6, '0')
                WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 500 THEN NULL
                ELSE {_DIGITS} END AS identifier,
           5 AS identifier_type, 'h-' || c_custkey AS uuid,
           CAST(c_acctbal BETWEEN 1000 AND 1200 AS INTEGER) AS voided FROM customer
    UNION ALL
    SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') END,
           4, 'u-' || c_custkey, CAST(c_acctbal BETWEEN 1200 AND 1300 AS INTEGER) FROM customer
    UNION ALL
    SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ANC' || c_custkey END,
           6, 'a-' || c_custkey, 0 FROM customer
    UNION ALL
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'HTS/' || c_custkey END,
           8, 't-' || c_custkey, 0 FROM customer)
  WHERE identifier IS NOT NULL),
global_property AS (
  SELECT CASE r_regionkey WHEN 0 THEN 'facility_datim_code' WHEN 1 THEN 'Facility_Name'
              ELSE r_name END AS property, r_name AS property_value FROM region),
datim_mapping AS (
  SELECT r_name AS datim_code, r_name || ' State' AS state_name, r_name || ' LGA' AS lga_name
  FROM region),
obs AS (
  SELECT o_orderkey * 4 AS obs_id, o_custkey AS person_id, 165708 AS concept_id,
         o_orderkey AS encounter_id, CAST(NULL AS BIGINT) AS obs_group_id,
         {_VISIT_AT} AS obs_datetime, CAST(NULL AS DOUBLE) AS value_numeric,
         {_LINE_CODE} AS value_coded, CAST(NULL AS TIMESTAMP) AS value_datetime,
         CAST(NULL AS VARCHAR) AS value_text, CAST(o_totalprice < 20000 AS INTEGER) AS voided
  FROM orders
  UNION ALL
  SELECT o_orderkey * 4 + 1, o_custkey, 162240, o_orderkey, NULL, {_VISIT_AT}, NULL, NULL, NULL,
         NULL, CAST(o_totalprice < 20000 AS INTEGER) FROM orders
  UNION ALL
  SELECT o_orderkey * 4 + 2, o_custkey, {_REGIMEN}, o_orderkey, NULL, {_VISIT_AT}, NULL,
         {_code(_BAND)}, NULL, NULL, CAST(o_totalprice < 20000 AS INTEGER) FROM orders
  UNION ALL
  SELECT o_orderkey * 4 + 3, o_custkey, {_EXTRA_CONCEPT}, o_orderkey, NULL, {_VISIT_AT},
         floor(o_totalprice / 5000), {_EXTRA_CODE}, {_VISIT_AT} + INTERVAL 5 DAY,
         'note ' || o_orderpriority, CAST(o_totalprice < 20000 AS INTEGER) FROM orders
  UNION ALL
  SELECT {CHILD_IDS} + l_orderkey * 8 + l_linenumber, o_custkey, 159368, o_orderkey,
         o_orderkey * 4 + 1, {_VISIT_AT}, q * 3, NULL, NULL, NULL, CAST(q >= 49 AS INTEGER)
  FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
  JOIN orders ON l_orderkey = o_orderkey
  UNION ALL
  SELECT {EVENT_IDS} + event_id, user_id,
         {_CONCEPTS}[CAST(floor({K} / 4.0) AS INTEGER) + 1], event_id, NULL, {_EVENT_AT}, value * 20,
         CASE event_type WHEN 'purchase' THEN {_code('12')} WHEN 'signup' THEN {_code('16')}
              ELSE {_code('least(CAST(floor(value / 5) AS INTEGER), 24)')} END,
         CAST(CAST({_EVENT_AT} AS DATE) - {K} AS TIMESTAMP), event_type || '-' || {K},
         CAST(value < 2 AS INTEGER) FROM events),
concept_name AS (
  SELECT {_code('n_nationkey')} AS concept_id,
         CASE n_nationkey {_ANSWERS} ELSE n_name END || suffix AS name, locale,
         CASE WHEN kind = 1 THEN CAST(n_nationkey <> 24 AS INTEGER) WHEN kind = 2 THEN 1 ELSE 0 END
           AS locale_preferred
  FROM nation CROSS JOIN (VALUES (1, '', 'en'), (2, ' (fr)', 'fr'), (3, ' old', 'en'))
       AS forms(kind, suffix, locale)),
encounter AS (
  SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
         CASE WHEN o_orderstatus = 'P' THEN 13 ELSE 27 END AS form_id,
         CASE WHEN o_orderpriority <= '3-MEDIUM' THEN 13 ELSE 11 END AS encounter_type,
         o_orderdate AS encounter_datetime, o_orderdate + INTERVAL 1 DAY AS date_created,
         CAST(floor(o_totalprice / 5000) AS BIGINT) AS creator,
         CAST(o_totalprice > 490000 AS INTEGER) AS voided
  FROM orders),
person AS (
  SELECT c_custkey AS person_id,
         CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE', 'BUILDING') THEN 'F' ELSE 'M' END AS gender,
         DATE '1950-01-01' + CAST(floor((c_acctbal + 1000) * 1.6) AS INTEGER) AS birthdate,
         CAST(c_acctbal > 9500 AS INTEGER) AS dead,
         CAST(DATE '2000-01-01' + c_nationkey * 30 AS TIMESTAMP) AS death_date,
         CAST(c_acctbal BETWEEN 9900 AND 9950 AS INTEGER) AS voided
  FROM customer),
person_name AS (
  SELECT c_custkey AS person_id, c_mktsegment AS given_name,
         CASE WHEN c_nationkey <> 24 THEN c_name END AS family_name,
         CAST(c_acctbal < -800 AS INTEGER) AS voided FROM customer),
person_attribute AS (
  SELECT c_custkey AS person_id, CASE WHEN c_nationkey < 22 THEN 8 ELSE 7 END AS person_attribute_type_id,
         '080' || {_DIGITS} AS value, 0 AS voided FROM customer),
person_attribute_type AS (
  SELECT r_regionkey + 5 AS person_attribute_type_id,
         CASE WHEN r_regionkey = 3 THEN 'Telephone Number' ELSE r_name END AS name FROM region),
person_address AS (
  SELECT c_custkey AS person_id, 'Ward ' || c_nationkey AS address1 FROM customer),
patient_program AS (
  SELECT c_custkey AS patient_id, CASE WHEN c_nationkey < 20 THEN 1 ELSE 2 END AS program_id,
         CAST(DATE '1995-01-01' + c_nationkey * 10 AS TIMESTAMP) AS date_enrolled, 0 AS voided
  FROM customer),
biometricinfo AS (
  SELECT o_custkey AS patient_id, o_orderdate AS date_created,
         CASE WHEN o_totalprice > 60000 THEN 'Rk1S' ELSE 'Zz1S' END || o_orderkey AS template,
         CASE WHEN o_orderstatus <> 'O' THEN
           CASE WHEN o_totalprice < 440000 THEN 'Rk1S' ELSE 'Zz1S' END || o_orderkey END AS new_template
  FROM orders),
biometricverificationinfo AS (
  SELECT o_custkey AS patient_id, o_orderdate AS date_created,
         CAST(floor(o_totalprice / 100000) AS INTEGER) AS recapture_count,
         o_orderstatus AS finger,
         CASE WHEN o_totalprice <= 400000 THEN CAST(floor(o_totalprice / 4000) AS INTEGER) END AS quality
  FROM orders),
users AS (SELECT s_suppkey AS user_id, s_suppkey AS person_id FROM supplier),
names AS (
  SELECT concept_id, max(name) AS name FROM concept_name
  WHERE locale = 'en' AND locale_preferred = 1 GROUP BY 1)
"""
