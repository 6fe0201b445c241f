"""The models' input relations, derived from the star-schema test tables.

All of ``lineitem`` becomes purchase lines: five customers make one patient, and a line's
part decides its place in the category hierarchy and its product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtrail.sources.relations import ChronicInputs, conform

# Members of the category sets in the derived inputs.
SAMPLE_SETS: dict[str, frozenset[int]] = {
    "anesthesia_hospitalization": frozenset({301, 302}),
    "analgesic_tag": frozenset({78}),
    "invalid_pain": frozenset({207, 208, 209, 260, 261, 310}),
    "alternative_therapy": frozenset({320, 321}),
    "anti_inflammatory": frozenset({330}),
    "antihistamine": frozenset({340}),
    "immunotherapy": frozenset({350}),
    "skin_topical": frozenset({360}),
    "opiate": frozenset({370}),
    "derm_steroid": frozenset({380}),
    "mab": frozenset({390}),
    "gabapentin_tramadol": frozenset({400, 401}),
    "nsaid": frozenset({274}),
    "antibiotic": frozenset({410}),
    "steroid": frozenset({420}),
    "dental_and_surgery": frozenset({430, 431}),
}


# slot of a part -> (leaf, level 3, level 2, top) category; other slots have none.
HIERARCHY: list[tuple[tuple[int, ...], tuple[int, int, int, int]]] = [
    ((0, 1, 2, 3), (1001, 274, 200, 10)),
    ((4, 5), (1002, 500, 251, 10)),
    ((6, 7), (78, 501, 201, 10)),
    ((8, 9, 10), (285, 502, 202, 11)),
    ((11,), (320, 503, 203, 11)),
    ((12, 13), (321, 503, 203, 11)),
    ((14,), (330, 504, 204, 10)),
    ((15, 16), (370, 505, 205, 10)),
    ((17, 18), (390, 506, 206, 10)),
    ((19, 21), (400, 507, 210, 10)),
    ((20,), (401, 507, 210, 10)),
    ((22,), (7, 510, 211, 12)),
    ((23,), (1003, 511, 212, 16)),
    ((24,), (301, 512, 213, 13)),
    ((25,), (207, 513, 214, 13)),
    ((26,), (260, 513, 214, 13)),
    ((27,), (340, 514, 215, 13)),
    ((28,), (360, 515, 216, 13)),
    ((29,), (380, 516, 217, 13)),
    ((30,), (1004, 517, 410, 14)),
    ((31,), (1005, 518, 420, 14)),
    ((32,), (1006, 519, 218, 430)),
    ((33,), (1007, 519, 218, 431)),
    ((34,), (350, 520, 219, 16)),
    ((35,), (209, 513, 214, 13)),
]
NO_CATEGORY = (2000, 2001, 2002, 2003)

# product key -> (product, drug, brand)
PRODUCTS: list[tuple[str, str | None, bool]] = [
    ("Alphafen", "alpha", True),
    ("Alphafen Inj", "alpha", True),
    ("Generic Alpha", "alpha", False),
    ("Betacox", "beta", True),
    ("Betacox Inj", "beta", True),
    ("Gammacam", "gamma", True),
    ("Generic Gamma", "gamma", False),
    ("Other NSAID", None, False),
    ("Other NSAID Inj", None, False),
    ("Deltafen", "delta", True),
]

# last digit of a part -> category of the pain product
CATEGORIES = ["NSAIDs"] * 4 + ["Opiate"] * 2 + ["Supplements"] * 2 + ["Pain Diet"] * 2


# Columns read from the test tables; stating them saves a look into every file.
TABLES = {
    "customer": "c_custkey BIGINT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ""",
    "part": "p_partkey BIGINT",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _pick(key: Column, choices: list) -> Column:
    return F.element_at(F.array(*[F.lit(choice) for choice in choices]), key.cast("int") + 1)


def _patient(customer: str) -> Column:
    return F.expr(f"{customer} div 5")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", _patient("o_custkey").alias("pid")
    )
    return _table(spark, folder, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    by_slot = {slot: ids for slots, ids in HIERARCHY for slot in slots}

    def level(position: int) -> Column:
        ids = [by_slot.get(slot, NO_CATEGORY)[position] for slot in range(80)]
        return F.expr(f"element_at(array({', '.join(map(str, ids))}), int(l_partkey % 80) + 1)")

    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    frame = _lines(spark, folder).select(
        (F.col("pid") % 3).alias("server_odu_id"),
        (100 + F.col("pid") % 25).alias("practice_odu_id"),
        F.col("pid").alias("patient_odu_id"),
        (
            F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
        ).alias("transaction_datetime"),
        F.col("l_shipdate").alias("odu_updated_at_utc"),
        F.col("l_orderkey").alias("invoice_odu_id"),
        ((line * 100000 + F.col("l_partkey")) * 10000 + F.col("l_suppkey")).alias(
            "transaction_odu_id"
        ),
        F.lit(1).cast("long").alias("catalog_source_server_odu_id"),
        F.col("l_partkey").alias("catalog_odu_id"),
        level(0).alias("revenue_category_odu_id"),
        level(1).alias("level_3_revenue_category_id"),
        level(2).alias("level_2_revenue_category_id"),
        level(3).alias("top_revenue_category_id"),
        F.when(F.col("l_quantity") < 3, "Service DECLINED by owner")
        .when(F.col("l_quantity") < 5, F.lit(None))
        .otherwise(F.concat(F.lit("Line "), F.col("l_partkey")))
        .alias("description"),
        (F.col("l_discount") < 0.10).alias("is_revenue"),
    )
    return conform(frame, "transactions")


def _patients(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").select(_patient("c_custkey").alias("pid")).distinct()


def patients(spark: SparkSession, folder: str) -> DataFrame:
    pid = F.col("pid")
    born = F.date_add(F.to_date(F.lit("1985-01-01")), (pid * 37 % 5600).cast("int"))
    frame = _patients(spark, folder).select(
        (pid % 3).alias("server_odu_id"),
        pid.alias("patient_odu_id"),
        _pick(pid % 5, ["equine", "feline", "feline", "canine", "canine"]).alias("species"),
        F.when(pid % 17 != 0, born).alias("birth_date"),
    )
    return conform(frame, "patients")


def practice_info(spark: SparkSession, folder: str) -> DataFrame:
    pid = F.col("pid")
    # One practice in 25 has no data for the current year.
    timeframes = F.when(
        F.col("practice_odu_id") == 124, F.array(F.lit("Previous Year"))
    ).otherwise(F.array(F.lit("Current Year"), F.lit("Previous Year")))
    types = F.array(F.lit("Non Home Delivery"), F.lit("Home Delivery"))
    frame = (
        _patients(spark, folder)
        .select(
            (pid % 3).alias("server_odu_id"), (100 + pid % 25).alias("practice_odu_id")
        )
        .distinct()
        .withColumn("timeframe", F.explode(timeframes))
        .withColumn("patient_type", F.explode(types))
    )
    return conform(frame, "syndicated_practice_info")


def catalog_tags(spark: SparkSession, folder: str) -> DataFrame:
    part = F.col("p_partkey")
    tags = F.array_compact(
        F.array(
            F.when((part % 80).isin(40, 41, 42), 56),
            F.when((part % 80).isin(42, 43), 60),
            F.lit(99),
        )
    )
    updated = F.when(F.col("catalog_tag_odu_id") == 56, "1999-06-01").otherwise("2000-06-01")
    frame = (
        _table(spark, folder, "part")
        .select(
            F.lit(1).cast("long").alias("catalog_source_server_odu_id"),
            part.alias("catalog_odu_id"),
            F.explode(tags).alias("catalog_tag_odu_id"),
        )
        .withColumn("odu_updated_at_utc", updated.cast("timestamp_ntz"))
    )
    return conform(frame, "catalog_tag_mappings")


def chronic_inputs(spark: SparkSession, folder: str) -> ChronicInputs:
    return ChronicInputs(
        transactions=transactions(spark, folder),
        patients=patients(spark, folder),
        practice_info=practice_info(spark, folder),
        catalog_tags=catalog_tags(spark, folder),
    )


def pain_purchases(spark: SparkSession, folder: str) -> DataFrame:
    pid, part = F.col("pid"), F.col("l_partkey")
    product = (pid + F.expr("l_partkey div 400") + part % 3) % 10
    names, drugs, brands = zip(*PRODUCTS)
    frame = _lines(spark, folder).select(
        (100 + pid % 25).alias("practice_odu_id"),
        _pick(pid % 4, ["north", "east", "south", "west"]).alias("region"),
        _pick(pid % 2, ["urban", "rural"]).alias("location_type"),
        (pid % 3 == 0).alias("is_corporate_group"),
        _pick(pid % 3, ["small", "medium", "large"]).alias("practice_size"),
        (pid % 2 == 0).alias("has_hd"),
        (pid % 7 != 0).alias("projection_practice"),
        pid.alias("patient_odu_id"),
        F.when(part % 11 == 0, "Acute").otherwise("Chronic").alias("pain_type"),
        _pick(pid % 3, ["young", "adult", "senior"]).alias("age_group"),
        F.lit("canine").alias("species"),
        F.lit("Current Year").alias("timeframe"),
        _pick(part % 10, CATEGORIES).alias("category_name"),
        _pick(product, list(names)).alias("product_name"),
        _pick(product, list(drugs)).alias("drug"),
        _pick(product, list(brands)).alias("is_brand_name"),
        F.col("o_orderdate").alias("transaction_datetime"),
        F.col("l_extendedprice").alias("revenue"),
    )
    return conform(frame, "syndicated_pain_all_pain_purchases")
