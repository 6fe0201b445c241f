"""Input relations: their columns, and a check of them when they are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ID, CODE, TEXT, FLAG = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
TIME, DATE, AMOUNT = T.TimestampNTZType(), T.DateType(), T.DoubleType()


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


RELATIONS: dict[str, T.StructType] = {
    "transactions": _columns(
        server_odu_id=ID,
        practice_odu_id=ID,
        patient_odu_id=ID,
        transaction_datetime=TIME,
        odu_updated_at_utc=TIME,
        invoice_odu_id=ID,
        transaction_odu_id=ID,
        catalog_source_server_odu_id=ID,
        catalog_odu_id=ID,
        revenue_category_odu_id=CODE,
        level_3_revenue_category_id=CODE,
        level_2_revenue_category_id=CODE,
        top_revenue_category_id=CODE,
        description=TEXT,
        is_revenue=FLAG,
    ),
    "patients": _columns(server_odu_id=ID, patient_odu_id=ID, species=TEXT, birth_date=DATE),
    "syndicated_practice_info": _columns(
        server_odu_id=ID, practice_odu_id=ID, timeframe=TEXT, patient_type=TEXT
    ),
    "catalog_tag_mappings": _columns(
        catalog_source_server_odu_id=ID,
        catalog_odu_id=ID,
        catalog_tag_odu_id=CODE,
        odu_updated_at_utc=TIME,
    ),
    "syndicated_pain_all_pain_purchases": _columns(
        practice_odu_id=ID,
        region=TEXT,
        location_type=TEXT,
        is_corporate_group=FLAG,
        practice_size=TEXT,
        has_hd=FLAG,
        projection_practice=FLAG,
        patient_odu_id=ID,
        pain_type=TEXT,
        age_group=TEXT,
        species=TEXT,
        timeframe=TEXT,
        category_name=TEXT,
        product_name=TEXT,
        drug=TEXT,
        is_brand_name=FLAG,
        transaction_datetime=TIME,
        revenue=AMOUNT,
    ),
    "chronic_purchases": _columns(
        patient_odu_id=ID,
        server_odu_id=ID,
        practice_odu_id=ID,
        species=TEXT,
        transaction_odu_id=ID,
        odu_updated_at_utc=TIME,
        invoice_odu_id=ID,
        transaction_datetime=TIME,
        rule=TEXT,
        purchases=ID,
    ),
}

_ALSO_ACCEPTED = {("double", "decimal"), ("bigint", "int"), ("int", "bigint")}


@dataclass(frozen=True)
class ChronicInputs:
    transactions: DataFrame
    patients: DataFrame
    practice_info: DataFrame
    catalog_tags: DataFrame


def conform(frame: DataFrame, relation: str) -> DataFrame:
    """The relation's columns of ``frame``; raises if one is missing or of another type."""
    problems = []
    found = {field.name: field.dataType for field in frame.schema}
    for field in RELATIONS[relation]:
        if field.name not in found:
            problems.append(f"{field.name} is missing")
            continue
        wanted, got = field.dataType.simpleString(), found[field.name].simpleString()
        if wanted != got and (wanted, got.split("(")[0]) not in _ALSO_ACCEPTED:
            problems.append(f"{field.name} is {got}, not {wanted}")
    if problems:
        raise ValueError(f"{relation}: " + "; ".join(problems))
    return frame.select(*RELATIONS[relation].names)


def read_relation(
    spark: SparkSession, relation: str, path: str | None = None, table: str | None = None
) -> DataFrame:
    """Read a relation from a Parquet folder, or from a catalog table (by default its name)."""
    frame = spark.read.parquet(path) if path else spark.table(table or relation)
    return conform(frame, relation)


def read_chronic_inputs(spark: SparkSession, folder: str) -> ChronicInputs:
    """The four inputs of the chronic model, each a Parquet folder named after it."""
    return ChronicInputs(
        transactions=read_relation(spark, "transactions", f"{folder}/transactions"),
        patients=read_relation(spark, "patients", f"{folder}/patients"),
        practice_info=read_relation(
            spark, "syndicated_practice_info", f"{folder}/syndicated_practice_info"
        ),
        catalog_tags=read_relation(spark, "catalog_tag_mappings", f"{folder}/catalog_tag_mappings"),
    )
