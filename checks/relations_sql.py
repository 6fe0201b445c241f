"""The models' input relations as DuckDB CTEs over the raw test tables."""

from __future__ import annotations

from rxtrail.sources.derived import CATEGORIES, HIERARCHY, NO_CATEGORY, PRODUCTS

# Fixed values, stated here once more so that a wrong id in the library shows.
FIXED_IDS: dict[str, set[int]] = {
    "joint_diet": {56},
    "urinalysis": {60},
    "exam": {7},
    "vaccine": {16},
    "analgesic": {78},
    "anticonvulsant": {207, 208},
    "antidepressant": {209},
    "dmoad": {251},
    "sedative": {260, 261},
    "nsaid_category": {274},
    "supplement": {285},
}

# Members of the test installation's sets, likewise.
SAMPLE_SETS: dict[str, set[int]] = {
    "anesthesia_hospitalization": {301, 302},
    "analgesic_tag": {78},
    "invalid_pain": {207, 208, 209, 260, 261, 310},
    "alternative_therapy": {320, 321},
    "anti_inflammatory": {330},
    "antihistamine": {340},
    "immunotherapy": {350},
    "skin_topical": {360},
    "opiate": {370},
    "derm_steroid": {380},
    "mab": {390},
    "gabapentin_tramadol": {400, 401},
    "nsaid": {274},
    "antibiotic": {410},
    "steroid": {420},
    "dental_and_surgery": {430, 431},
}


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)


def id_list(*names: str) -> str:
    ids = set().union(*[SAMPLE_SETS.get(n) or FIXED_IDS[n] for n in names])
    return "(" + ", ".join(map(str, sorted(ids))) + ")"


_HIERARCHY = [(slot, *ids) for slots, ids in HIERARCHY for slot in slots]
_LEAF, _L3, _L2, _TOP = NO_CATEGORY
_PRODUCTS = [(key, *product) for key, product in enumerate(PRODUCTS)]

# Name of every id set with each of its members.
_CLASSES = [
    (tag, name) for name, ids in [*SAMPLE_SETS.items(), *FIXED_IDS.items()] for tag in sorted(ids)
]

LINES = """
line AS (
  SELECT l.*, o.o_orderdate, o.o_custkey // 5 AS pid
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
)"""

TAG_CLASS = f"""
tag_class(tag, class) AS ({values(_CLASSES)})"""

CHRONIC_INPUTS = f"""{LINES},
hier(slot, leaf, l3, l2, top) AS ({values(_HIERARCHY)}),
transactions AS (
  SELECT pid % 3 AS server_odu_id, 100 + pid % 25 AS practice_odu_id, pid AS patient_odu_id,
    o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS transaction_datetime,
    l_shipdate AS odu_updated_at_utc, l_orderkey AS invoice_odu_id,
    ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey
      AS transaction_odu_id,
    1 AS catalog_source_server_odu_id, l_partkey AS catalog_odu_id,
    coalesce(leaf, {_LEAF}) AS leaf, coalesce(l3, {_L3}) AS l3,
    coalesce(l2, {_L2}) AS l2, coalesce(top, {_TOP}) AS top,
    CASE WHEN l_quantity < 3 THEN 'Service DECLINED by owner'
         WHEN l_quantity >= 5 THEN 'Line ' || l_partkey END AS description,
    l_discount < 0.10 AS is_revenue
  FROM line LEFT JOIN hier ON slot = l_partkey % 80
),
customer_patient AS (SELECT DISTINCT c_custkey // 5 AS pid FROM customer),
patients AS (
  SELECT pid % 3 AS server_odu_id, pid AS patient_odu_id,
    CASE WHEN pid % 5 = 0 THEN 'equine' WHEN pid % 5 < 3 THEN 'feline' ELSE 'canine' END AS species,
    CASE WHEN pid % 17 <> 0
         THEN DATE '1985-01-01' + CAST(pid * 37 % 5600 AS INTEGER) END AS birth_date
  FROM customer_patient
),
practice_info AS (
  SELECT DISTINCT pid % 3 AS server_odu_id, 100 + pid % 25 AS practice_odu_id,
    timeframe, patient_type
  FROM customer_patient,
    (VALUES ('Current Year'), ('Previous Year')) t(timeframe),
    (VALUES ('Non Home Delivery'), ('Home Delivery')) d(patient_type)
  WHERE timeframe = 'Previous Year' OR practice_odu_id <> 124
),
catalog_tags AS (
  SELECT 1 AS catalog_source_server_odu_id, p_partkey AS catalog_odu_id, 56 AS catalog_tag_odu_id,
    TIMESTAMP '1999-06-01' AS odu_updated_at_utc
  FROM part WHERE p_partkey % 80 BETWEEN 40 AND 42
  UNION ALL
  SELECT 1, p_partkey, 60, TIMESTAMP '2000-06-01' FROM part WHERE p_partkey % 80 IN (42, 43)
  UNION ALL
  SELECT 1, p_partkey, 99, TIMESTAMP '2000-06-01' FROM part
)"""

PAIN_PURCHASES = f"""{LINES},
product(k, product_name, drug, is_brand_name) AS ({values(_PRODUCTS)}),
category(digit, category_name) AS ({values(list(enumerate(CATEGORIES)))}),
pain_purchases AS (
  SELECT 100 + pid % 25 AS practice_odu_id,
    ['north', 'east', 'south', 'west'][pid % 4 + 1] AS region,
    ['urban', 'rural'][pid % 2 + 1] AS location_type,
    pid % 3 = 0 AS is_corporate_group,
    ['small', 'medium', 'large'][pid % 3 + 1] AS practice_size,
    pid % 2 = 0 AS has_hd, pid % 7 <> 0 AS projection_practice,
    pid AS patient_odu_id,
    CASE WHEN l_partkey % 11 = 0 THEN 'Acute' ELSE 'Chronic' END AS pain_type,
    ['young', 'adult', 'senior'][pid % 3 + 1] AS age_group,
    'canine' AS species, 'Current Year' AS timeframe, category_name,
    product_name, drug, is_brand_name,
    o_orderdate AS transaction_datetime, l_extendedprice AS revenue
  FROM line
  JOIN product ON k = (pid + l_partkey // 400 + l_partkey % 3) % 10
  JOIN category ON digit = l_partkey % 10
)"""
