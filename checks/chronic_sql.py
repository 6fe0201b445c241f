"""The chronic model in DuckDB SQL, with joins where the Spark version uses frames."""

from __future__ import annotations

from checks.relations_sql import CHRONIC_INPUTS, TAG_CLASS, id_list, values

ILLNESS = [
    "dental_and_surgery",
    "urinalysis",
    "invalid_pain",
    "antibiotic",
    "antihistamine",
    "skin_topical",
    "steroid",
    "derm_steroid",
]

# (bought, trigger, first day, last day, species): trigger day relative to purchase day.
NEAR_RULES = (
    [
        (bought, trigger, -7, 7, "any")
        for bought in (
            "nsaid",
            "anti_inflammatory",
            "analgesic",
            "gabapentin_tramadol",
            "alternative_therapy",
        )
        for trigger in ILLNESS
    ]
    + [("analgesic", "exam", 0, 14, "any"), ("gabapentin_tramadol", "exam", 0, 14, "any")]
    + [("opiate", "dental_and_surgery", -7, 7, "any"), ("opiate", "antibiotic", -7, 7, "any")]
    + [("opiate", "urinalysis", -14, 14, "canine")]
)

# (bought, trigger on the same invoice)
INVOICE_RULES = [
    ("nsaid", "anesthesia_hospitalization"),
    ("nsaid", "vaccine"),
    ("anti_inflammatory", "anesthesia_hospitalization"),
    ("anti_inflammatory", "vaccine"),
    ("supplement", "invalid_pain"),
    ("supplement", "immunotherapy"),
    ("analgesic", "anesthesia_hospitalization"),
    ("analgesic", "vaccine"),
    ("gabapentin_tramadol", "anesthesia_hospitalization"),
    ("gabapentin_tramadol", "anticonvulsant"),
    ("gabapentin_tramadol", "antidepressant"),
    ("gabapentin_tramadol", "sedative"),
    ("opiate", "anesthesia_hospitalization"),
    ("alternative_therapy", "anesthesia_hospitalization"),
]

# (label, its tags, its place)
RULES = [
    ("Pain Diet", "joint_diet", 1),
    ("DMOAD", "dmoad", 2),
    ("NSAIDs", "nsaid", 3),
    ("Supplements", "supplement", 4),
    ("Monoclonal Antibody", "mab", 5),
    ("Analgesic", "analgesic_tag", 6),
    ("Gabapentin & Tramadol", "gabapentin_tramadol", 7),
    ("Anti-Inflammatory", "anti_inflammatory", 8),
    ("Opiate", "opiate", 9),
    ("Alternative Therapies", "alternative_therapy", 10),
]

VALIDATORS = id_list(
    "joint_diet",
    "analgesic",
    "dmoad",
    "nsaid_category",
    "supplement",
    "anti_inflammatory",
    "mab",
    "gabapentin_tramadol",
)

_KEPT = f"""(t.catalog_tag_odu_id IS NOT NULL OR l3 = 274 OR l2 = 251 OR top = 16
    OR leaf IN {id_list("analgesic", "gabapentin_tramadol", "supplement", "anti_inflammatory",
                        "mab", "opiate", "alternative_therapy", "anesthesia_hospitalization",
                        "invalid_pain", "antihistamine", "skin_topical", "derm_steroid", "exam")}
    OR l2 IN {id_list("antibiotic", "steroid")} OR top IN {id_list("dental_and_surgery")})"""

_TAG = f"""CASE
    WHEN t.catalog_tag_odu_id IS NOT NULL THEN t.catalog_tag_odu_id
    WHEN leaf IN {id_list("anesthesia_hospitalization", "exam", "analgesic_tag", "invalid_pain",
                          "alternative_therapy", "anti_inflammatory", "antihistamine",
                          "immunotherapy", "skin_topical", "opiate", "supplement",
                          "derm_steroid", "mab", "gabapentin_tramadol")} THEN leaf
    WHEN l3 IN {id_list("nsaid")} THEN l3
    WHEN l2 IN {id_list("antibiotic", "dmoad", "steroid")} THEN l2
    WHEN top IN {id_list("dental_and_surgery", "vaccine")} THEN top END"""

_STAMP = "greatest(x.odu_updated_at_utc, coalesce(t.odu_updated_at_utc, x.odu_updated_at_utc))"

_TAG_JOIN = """LEFT JOIN (SELECT * FROM catalog_tags WHERE catalog_tag_odu_id IN (56, 60)) t
    USING (catalog_source_server_odu_id, catalog_odu_id)"""

_KEY = "server_odu_id, patient_odu_id, transaction_odu_id"


def model(as_of: str = "2001-08-01", suffix: str = "") -> str:
    """CTEs of all stages of one run; ``suffix`` keeps two runs apart."""
    s = suffix
    return f"""
near_rule{s}(bought, trigger, lo, hi, animal) AS ({values(NEAR_RULES)}),
invoice_rule{s}(bought, trigger) AS ({values(INVOICE_RULES)}),
rule_label{s}(rule, class, place) AS ({values(RULES)}),
universe{s} AS (
  SELECT x.*, p.species, p.birth_date, t.catalog_tag_odu_id, {_STAMP} AS stamp, {_TAG} AS tag
  FROM transactions x
  JOIN patients p USING (server_odu_id, patient_odu_id)
  SEMI JOIN (SELECT * FROM practice_info
             WHERE timeframe = 'Current Year' AND patient_type = 'Non Home Delivery') w
    USING (server_odu_id, practice_odu_id)
  {_TAG_JOIN}
  WHERE transaction_datetime >= DATE '{as_of}' - INTERVAL 49 MONTH
    AND transaction_datetime < DATE '{as_of}'
    AND is_revenue AND species IN ('canine', 'feline')
    AND coalesce(description, '') NOT ILIKE '%declined%'
    AND {_KEPT}
),
tagged{s} AS (
  SELECT DISTINCT server_odu_id, practice_odu_id, patient_odu_id, species, birth_date,
    transaction_datetime, stamp AS odu_updated_at_utc, invoice_odu_id, transaction_odu_id, tag
  FROM universe{s}
),
by_window{s} AS (
  SELECT DISTINCT b.server_odu_id, b.patient_odu_id, b.transaction_odu_id
  FROM tagged{s} b
  JOIN tag_class bc ON bc.tag = b.tag
  JOIN near_rule{s} r ON r.bought = bc.class AND r.animal IN ('any', b.species)
  JOIN tag_class tc ON tc.class = r.trigger
  JOIN tagged{s} t ON t.server_odu_id = b.server_odu_id AND t.patient_odu_id = b.patient_odu_id
    AND t.tag = tc.tag
    AND date_diff('day', b.transaction_datetime, t.transaction_datetime) BETWEEN r.lo AND r.hi
),
by_invoice{s} AS (
  SELECT DISTINCT b.server_odu_id, b.patient_odu_id, b.transaction_odu_id
  FROM tagged{s} b
  JOIN tag_class bc ON bc.tag = b.tag
  JOIN invoice_rule{s} r ON r.bought = bc.class
  JOIN tag_class tc ON tc.class = r.trigger
  JOIN tagged{s} t ON t.server_odu_id = b.server_odu_id AND t.patient_odu_id = b.patient_odu_id
    AND t.invoice_odu_id = b.invoice_odu_id AND t.tag = tc.tag
),
invalid{s} AS (SELECT * FROM by_window{s} UNION SELECT * FROM by_invoice{s}),
labelled{s} AS (
  SELECT g.*, l.rule FROM tagged{s} g JOIN tag_class c ON c.tag = g.tag
  JOIN rule_label{s} l ON l.class = c.class
  QUALIFY row_number() OVER (PARTITION BY g.server_odu_id, g.practice_odu_id, g.patient_odu_id,
    g.species, g.birth_date, g.transaction_datetime, g.odu_updated_at_utc, g.invoice_odu_id,
    g.transaction_odu_id, g.tag ORDER BY l.place) = 1
),
survivor{s} AS (SELECT * FROM labelled{s} ANTI JOIN invalid{s} USING ({_KEY})),
corroborated{s} AS (
  SELECT v.server_odu_id, v.practice_odu_id, v.patient_odu_id,
    CAST(date_diff('year', v.birth_date, v.transaction_datetime) AS INTEGER) AS patient_age,
    v.species, v.transaction_odu_id, v.transaction_datetime, v.odu_updated_at_utc,
    v.invoice_odu_id, v.rule,
    count(DISTINCT o.transaction_odu_id)
      FILTER (WHERE v.tag IN {id_list("alternative_therapy")}) AS validating_purchases
  FROM survivor{s} v
  LEFT JOIN tagged{s} o ON o.server_odu_id = v.server_odu_id
    AND o.patient_odu_id = v.patient_odu_id AND o.tag IN {VALIDATORS}
    AND date_diff('month', o.transaction_datetime, v.transaction_datetime) BETWEEN 0 AND 12
  GROUP BY ALL
),
gated{s} AS (
  SELECT * FROM corroborated{s}
  WHERE rule <> 'Alternative Therapies' OR patient_age >= 3 OR validating_purchases >= 2
),
repeated{s} AS (
  SELECT a.patient_odu_id, a.server_odu_id, a.practice_odu_id, a.species, a.transaction_odu_id,
    a.odu_updated_at_utc, a.invoice_odu_id, a.transaction_datetime, a.rule,
    max(b.odu_updated_at_utc) AS updated_at,
    count(DISTINCT CAST(b.transaction_datetime AS DATE)) AS purchases
  FROM gated{s} a
  LEFT JOIN gated{s} b ON b.server_odu_id = a.server_odu_id
    AND b.patient_odu_id = a.patient_odu_id AND b.rule = a.rule
    AND b.transaction_odu_id <> a.transaction_odu_id
    AND CAST(b.transaction_datetime AS DATE) <> CAST(a.transaction_datetime AS DATE)
    AND date_diff('month', a.transaction_datetime, b.transaction_datetime) BETWEEN -11 AND 11
    -- Fixed values: rules whose repeats are counted.
    AND a.rule IN ('NSAIDs', 'Analgesic', 'Gabapentin & Tramadol', 'Supplements', 'Opiate', 'Alternative Therapies')
  WHERE a.transaction_datetime >= DATE '{as_of}' - INTERVAL 36 MONTH
  GROUP BY ALL
),
chronic{s} AS (
  SELECT patient_odu_id, server_odu_id, practice_odu_id, species, transaction_odu_id,
    greatest(odu_updated_at_utc, updated_at) AS odu_updated_at_utc, invoice_odu_id,
    transaction_datetime, rule, purchases
  FROM repeated{s}
  -- Fixed values: rules that must repeat, once or twice.
  WHERE rule NOT IN ('NSAIDs', 'Anti-Inflammatory', 'Analgesic', 'Gabapentin & Tramadol', 'Supplements', 'Opiate', 'Alternative Therapies')
    OR rule IN ('NSAIDs', 'Anti-Inflammatory', 'Analgesic', 'Gabapentin & Tramadol', 'Supplements', 'Opiate') AND purchases > 1
    OR rule IN ('Alternative Therapies') AND purchases > 2
)"""


def _over_model(select: str) -> str:
    return f"WITH {CHRONIC_INPUTS},{TAG_CLASS},{model()}\n{select}"


def over_tables(query: str) -> str:
    """The same query over tables that already have the models' input columns."""
    return QUERIES[query].replace(CHRONIC_INPUTS + ",", "")


_REFRESHED = f"""WITH {CHRONIC_INPUTS},{TAG_CLASS},{model()},{model("2001-05-01", "_before")},
        news AS (
          SELECT DISTINCT {_KEY}, rule FROM chronic WHERE odu_updated_at_utc >=
            (SELECT max(odu_updated_at_utc) - INTERVAL 24 HOUR FROM chronic_before)
        ),
        emitted AS (SELECT c.* FROM chronic c SEMI JOIN news USING ({_KEY}, rule))"""


QUERIES: dict[str, str] = {
    "pain_universe": _over_model(
        """SELECT DISTINCT server_odu_id, practice_odu_id, patient_odu_id, species,
          transaction_datetime, transaction_odu_id, catalog_tag_odu_id, leaf AS revenue_category_odu_id,
          l3 AS level_3_revenue_category_id, l2 AS level_2_revenue_category_id,
          top AS top_revenue_category_id FROM universe"""
    ),
    "practice_whitelist": f"""WITH {CHRONIC_INPUTS},{TAG_CLASS}
        SELECT DISTINCT server_odu_id, practice_odu_id, patient_odu_id, transaction_odu_id
        FROM transactions
        JOIN practice_info USING (server_odu_id, practice_odu_id)
        WHERE timeframe = 'Current Year' AND patient_type = 'Non Home Delivery'""",
    "tag_assignment": f"""WITH {CHRONIC_INPUTS},{TAG_CLASS}
        SELECT DISTINCT server_odu_id, patient_odu_id, transaction_odu_id, {_TAG} AS tag,
          {_STAMP} AS odu_updated_at_utc
        FROM transactions x {_TAG_JOIN}""",
    "tagged_events": _over_model("SELECT * FROM tagged"),
    "invalid_by_invoice": _over_model("SELECT * FROM by_invoice"),
    "invalid_by_window": _over_model("SELECT * FROM by_window"),
    "invalid_purchases": _over_model("SELECT * FROM invalid"),
    "surviving_purchases": _over_model(
        f"""SELECT DISTINCT {_KEY}, practice_odu_id, species, transaction_datetime, tag
        FROM survivor"""
    ),
    "therapy_rule": _over_model(f"SELECT DISTINCT {_KEY}, tag, rule FROM labelled"),
    "age_at_event": _over_model(
        f"""SELECT DISTINCT {_KEY}, transaction_datetime, birth_date,
          CAST(year(transaction_datetime) - year(birth_date) AS INTEGER) AS patient_age
        FROM labelled"""
    ),
    "corroboration_count": _over_model("SELECT * FROM corroborated"),
    "alt_therapy_gate": _over_model("SELECT * FROM gated"),
    "repeat_purchases": _over_model(
        f"SELECT DISTINCT {_KEY}, transaction_datetime, rule, purchases FROM repeated"
    ),
    "freshness_stamp": _over_model(
        f"""SELECT DISTINCT {_KEY}, rule, odu_updated_at_utc, updated_at,
          greatest(odu_updated_at_utc, updated_at) AS newest_at FROM repeated"""
    ),
    "chronic_purchases": _over_model("SELECT * FROM chronic"),
    "incremental_refresh": f"""{_REFRESHED}
        SELECT *, true AS is_refreshed FROM emitted
        UNION ALL
        SELECT *, false FROM chronic_before ANTI JOIN emitted USING ({_KEY}, rule)""",
    "stored_refresh": f"""{_REFRESHED}
        SELECT * FROM emitted
        UNION ALL
        SELECT * FROM chronic_before ANTI JOIN emitted USING ({_KEY}, rule)""",
}

# The same rows by another way.
OTHER_WAYS: dict[str, str] = {"daystate_merge": QUERIES["chronic_purchases"]}
