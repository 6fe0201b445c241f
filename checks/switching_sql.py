"""The switching model in DuckDB SQL, with joins where the Spark version uses arrays."""

from __future__ import annotations

from checks.relations_sql import PAIN_PURCHASES

_COLUMNS = """practice_odu_id, region, location_type, is_corporate_group, practice_size, has_hd,
    projection_practice, patient_odu_id, pain_type, age_group, species, timeframe, category_name,
    product_name, drug, is_brand_name, transaction_datetime, revenue"""

# One order for all windows: rows of the same patient and time would have none otherwise.
_ORDER = ", ".join(
    f"{column} NULLS FIRST"
    for column in (
        "transaction_datetime",
        "practice_odu_id",
        "species",
        "product_name",
        "drug",
        "is_brand_name",
        "revenue",
        "previous_drug",
        "age_group",
        "has_hd",
        "is_corporate_group",
        "location_type",
        "practice_size",
        "projection_practice",
        "region",
        "timeframe",
    )
)

_MODEL = f"""WITH {PAIN_PURCHASES},
cohort AS (
  SELECT * FROM pain_purchases
  -- Fixed values: the category, and the names that stand for no product.
  WHERE pain_type = 'Chronic' AND category_name = 'NSAIDs'
    AND product_name NOT IN ('Other NSAID', 'Other NSAID Inj')
),
named AS (
  SELECT *, replace(product_name, ' Inj', '') AS base FROM (SELECT DISTINCT * FROM cohort)
),
combo AS (
  SELECT a.practice_odu_id, a.patient_odu_id, a.transaction_datetime, a.product_name,
    string_agg(DISTINCT b.product_name, ', ' ORDER BY b.product_name) AS combined
  FROM named a JOIN named b USING (practice_odu_id, patient_odu_id, transaction_datetime)
  WHERE a.base <> b.base
  GROUP BY ALL
),
earlier AS (
  SELECT a.practice_odu_id, a.patient_odu_id, a.transaction_datetime,
    max(b.transaction_datetime) AS previous_purchase_date
  FROM named a JOIN named b USING (practice_odu_id, patient_odu_id)
  WHERE b.transaction_datetime < a.transaction_datetime
  GROUP BY ALL
),
seen AS (
  SELECT n.*, coalesce(combined, '') AS same_day_products, previous_purchase_date
  FROM named n
  LEFT JOIN combo USING (practice_odu_id, patient_odu_id, transaction_datetime, product_name)
  LEFT JOIN earlier USING (practice_odu_id, patient_odu_id, transaction_datetime)
),
paired AS (
  SELECT {", ".join("a." + c.strip() for c in _COLUMNS.split(","))}, b.drug AS previous_drug,
    coalesce(bool_or(b.drug <> a.drug), false) AS switch_yn,
    coalesce(bool_or(b.drug = a.drug AND b.is_brand_name), false) AS brand_name_switch_yn
  FROM seen a
  LEFT JOIN seen b ON b.practice_odu_id = a.practice_odu_id AND b.patient_odu_id = a.patient_odu_id
    AND b.transaction_datetime = a.previous_purchase_date AND b.base <> a.base
    AND a.same_day_products NOT ILIKE concat('%', b.product_name, '%')
    AND b.same_day_products NOT ILIKE concat('%', a.product_name, '%')
  GROUP BY ALL
),
looked_back AS (
  SELECT *,
    lag(transaction_datetime) OVER (PARTITION BY patient_odu_id, species ORDER BY {_ORDER})
      AS previous_purchase,
    lag(transaction_datetime) OVER (
      PARTITION BY patient_odu_id, species, product_name ORDER BY {_ORDER}
    ) AS last_purchase_of_product
  FROM paired
),
island AS (
  SELECT *, CAST(sum(CASE WHEN last_purchase_of_product = previous_purchase THEN 0 ELSE 1 END)
      OVER (PARTITION BY patient_odu_id ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS island_id
  FROM looked_back
),
length AS (
  SELECT patient_odu_id, island_id, count(*) AS previous_purchases FROM island GROUP BY ALL
)"""

_FLAGS = f"{_COLUMNS}, previous_drug, switch_yn, brand_name_switch_yn"



def over_tables(query: str) -> str:
    """The same query over a table ``pain_purchases``."""
    return QUERIES[query].replace(PAIN_PURCHASES + ",", "")


QUERIES: dict[str, str] = {
    "chronic_nsaid_cohort": f"{_MODEL} SELECT {_COLUMNS} FROM cohort",
    "same_day_combos": f"{_MODEL} SELECT {_COLUMNS}, same_day_products FROM seen",
    "previous_purchase_date": f"{_MODEL} SELECT {_COLUMNS}, previous_purchase_date FROM seen",
    "switch_pairs": f"{_MODEL} SELECT {_FLAGS} FROM paired",
    "product_islands": f"""{_MODEL}
        SELECT {_FLAGS}, previous_purchase, last_purchase_of_product, island_id FROM island""",
    "island_lengths": f"{_MODEL} SELECT * FROM length",
    "nsaid_switching": f"""{_MODEL}
        SELECT i.* EXCLUDE (previous_purchase, last_purchase_of_product, island_id),
          n.previous_purchases
        FROM island i
        LEFT JOIN length n ON n.patient_odu_id = i.patient_odu_id
          AND n.island_id = i.island_id - 1 AND (i.switch_yn OR i.brand_name_switch_yn)
        ORDER BY i.patient_odu_id, i.transaction_datetime""",
}
QUERIES["stored_switch_report"] = QUERIES["nsaid_switching"]
