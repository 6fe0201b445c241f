"""Small random or hand-made inputs, given to Spark and DuckDB alike."""

from __future__ import annotations

import datetime as dt
import random

import duckdb

from rxtrail.sources.relations import RELATIONS, ChronicInputs

AS_OF = dt.date(2001, 8, 1)
LEVELS = {
    "leaf": "revenue_category_odu_id",
    "l3": "level_3_revenue_category_id",
    "l2": "level_2_revenue_category_id",
    "top": "top_revenue_category_id",
}
LEAVES = [7, 78, 207, 209, 260, 285, 301, 310, 320, 321, 330, 340, 350, 360, 370, 380, 390, 400]
CHRONIC_TABLES = {
    "transactions": "transactions",
    "patients": "patients",
    "practice_info": "syndicated_practice_info",
    "catalog_tags": "catalog_tag_mappings",
}


def moment(day: dt.date | str, hour: int = 0) -> dt.datetime:
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return dt.datetime.combine(day, dt.time(hour))


def line(patient: int, when: dt.datetime, transaction: int, **other) -> dict:
    """A purchase line with neutral values where none are given."""
    given = {
        "server_odu_id": 1,
        "practice_odu_id": 10,
        "patient_odu_id": patient,
        "transaction_datetime": when,
        "odu_updated_at_utc": when,
        "invoice_odu_id": transaction,
        "transaction_odu_id": transaction,
        "catalog_source_server_odu_id": 1,
        "catalog_odu_id": 0,
        "leaf": 2000,
        "l3": 2001,
        "l2": 2002,
        "top": 2003,
        "description": "x",
        "is_revenue": True,
    }
    return given | other


# Where a tag comes from: leaf unless listed here.
TAG_LEVEL = {274: "l3", 251: "l2", 410: "l2", 420: "l2", 430: "top", 431: "top", 16: "top"}


def tagged_line(tag: int, patient: int, when: dt.datetime, transaction: int, **other) -> dict:
    """A line that gets this tag; catalog items 56 and 60 carry the tags 56 and 60."""
    if tag in (56, 60):
        return line(patient, when, transaction, catalog_odu_id=tag, **other)
    return line(patient, when, transaction, **{TAG_LEVEL.get(tag, "leaf"): tag}, **other)


def whole_tables(lines: list[dict], patients: list[dict] | None = None) -> dict[str, list[dict]]:
    """Lines with everything needed for them to count."""
    ids = sorted({row["patient_odu_id"] for row in lines})
    return {
        "transactions": lines,
        "patients": patients or [patient(id) for id in ids],
        "practice_info": [
            {
                "server_odu_id": 1,
                "practice_odu_id": 10,
                "timeframe": "Current Year",
                "patient_type": "Non Home Delivery",
            }
        ],
        "catalog_tags": [
            {
                "catalog_source_server_odu_id": 1,
                "catalog_odu_id": tag,
                "catalog_tag_odu_id": tag,
                "odu_updated_at_utc": moment("1999-01-01"),
            }
            for tag in (56, 60)
        ],
    }


def patient(id: int, species: str = "canine", birth_date=dt.date(1990, 1, 1)) -> dict:
    return {
        "server_odu_id": 1,
        "patient_odu_id": id,
        "species": species,
        "birth_date": birth_date,
    }


def _frame(spark, relation: str, rows: list[dict]):
    schema = RELATIONS[relation]
    names = {long: short for short, long in LEVELS.items()}
    tuples = [tuple(row[names.get(f.name, f.name)] for f in schema) for row in rows]
    return spark.createDataFrame(tuples, schema)


def chronic_inputs(spark, tables: dict[str, list[dict]]) -> ChronicInputs:
    return ChronicInputs(
        **{name: _frame(spark, rel, tables[name]) for name, rel in CHRONIC_TABLES.items()}
    )


_SQL_TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR"}
_SQL_TYPES |= {"TimestampNTZType": "TIMESTAMP", "DateType": "DATE", "BooleanType": "BOOLEAN"}
_SQL_TYPES |= {"DoubleType": "DOUBLE"}


def _load(connection, table: str, relation: str, rows: list[dict]) -> None:
    names = {long: short for short, long in LEVELS.items()}
    schema = RELATIONS[relation]
    columns = [(names.get(f.name, f.name), _SQL_TYPES[type(f.dataType).__name__]) for f in schema]
    connection.execute(f"CREATE TABLE {table} ({', '.join(' '.join(c) for c in columns)})")
    marks = ", ".join("?" * len(columns))
    connection.executemany(
        f"INSERT INTO {table} VALUES ({marks})", [[row[c] for c, _ in columns] for row in rows]
    )


def chronic_in_duckdb(tables: dict[str, list[dict]]):
    connection = duckdb.connect()
    for name, relation in CHRONIC_TABLES.items():
        _load(connection, name, relation, tables[name])
    return connection


def purchases_in_duckdb(rows: list[dict]):
    connection = duckdb.connect()
    _load(connection, "pain_purchases", "syndicated_pain_all_pain_purchases", rows)
    return connection


def purchases_frame(spark, rows: list[dict]):
    return _frame(spark, "syndicated_pain_all_pain_purchases", rows)


def random_chronic_tables(seed: int, n_lines: int = 1500) -> dict[str, list[dict]]:
    """Untidy inputs: copies, shared ids, missing keys, repeated patients and tags."""
    pick = random.Random(seed)
    start = dt.date(1997, 3, 1)
    lines = []
    for number in range(n_lines):
        # One patient has a third of all lines.
        id = 0 if pick.random() < 0.33 else pick.randrange(1, 12)
        when = moment(start + dt.timedelta(days=pick.randrange(1640)), pick.randrange(24))
        levels = {
            "leaf": pick.choice([*LEAVES, *LEAVES, 401, 261, 2000, None]),
            "l3": pick.choice([274, 2001, 2001, None]),
            "l2": pick.choice([251, 410, 420] + [2002] * 12),
            "top": pick.choice([16, 430, 431] + [2003] * 15),
        }
        row = line(id, when, pick.choice([number, number, number, pick.randrange(40), None]), **levels)
        row["practice_odu_id"] = pick.choice([10, 10, 10, 11, 12])
        row["server_odu_id"] = pick.choice([1, 1, 1, 2])
        row["invoice_odu_id"] = pick.choice([number // 4, pick.randrange(30), None])
        row["catalog_odu_id"] = pick.choice([None, 0, 56, 60, 57, 58])
        texts = [None, "pill", "Declined", "owner DECLINED it"] + ["y"] * 9
        row["description"] = pick.choice(texts)
        row["is_revenue"] = pick.choice([True] * 9 + [False, None])
        row["odu_updated_at_utc"] = when + dt.timedelta(days=pick.randrange(200))
        lines += [row] * pick.choice([1, 1, 1, 2])
    patients = [
        {
            "server_odu_id": server,
            "patient_odu_id": id,
            "species": pick.choice(["canine", "canine", "feline", "equine"]) if id else "canine",
            "birth_date": pick.choice([None, dt.date(1999, 2, 1), dt.date(1990, 5, 5)]),
        }
        for server in (1, 2)
        for id in [*range(12), 3, 0]
    ]
    practices = [
        {"server_odu_id": s, "practice_odu_id": p, "timeframe": t, "patient_type": d}
        for s in (1, 2)
        for p in (10, 11)
        for t in ("Current Year", "Current Year", "Previous Year")
        for d in ("Non Home Delivery", "Home Delivery")
    ]
    tags = [(56, 56), (60, 60), (57, 56), (57, 60), (57, 56), (58, 99)]
    mappings = [
        {
            "catalog_source_server_odu_id": 1,
            "catalog_odu_id": item,
            "catalog_tag_odu_id": tag,
            "odu_updated_at_utc": moment("1999-06-01") + dt.timedelta(days=n),
        }
        for n, (item, tag) in enumerate(tags)
    ]
    return {
        "transactions": lines,
        "patients": patients,
        "practice_info": practices,
        "catalog_tags": mappings,
    }


PRODUCTS = [
    ("Alphafen", "alpha", True),
    ("Alphafen Inj", "alpha", True),
    ("Generic Alpha", "alpha", False),
    ("Alpha_en", None, None),
    ("Betacox", "beta", True),
    ("Betacox Inj", "beta", None),
    ("beta", "beta", False),
    ("Gamma%", "gamma", True),
    ("Other NSAID", None, False),
    (None, "gamma", True),
    ("Beta\\cox", "beta", True),
    ("Delta\\", "delta", False),
    ("Other NSAID Chew", "alpha", False),
]


def purchase(patient: int, when: dt.datetime, product: int, **other) -> dict:
    name, drug, brand = PRODUCTS[product]
    given = {
        "practice_odu_id": 10,
        "region": "north",
        "location_type": "urban",
        "is_corporate_group": True,
        "practice_size": "small",
        "has_hd": False,
        "projection_practice": True,
        "patient_odu_id": patient,
        "pain_type": "Chronic",
        "age_group": "adult",
        "species": "canine",
        "timeframe": "Current Year",
        "category_name": "NSAIDs",
        "product_name": name,
        "drug": drug,
        "is_brand_name": brand,
        "transaction_datetime": when,
        "revenue": 1.0,
    }
    return given | other


def random_purchases(seed: int, n_rows: int = 700) -> list[dict]:
    pick = random.Random(seed)
    rows = []
    for _ in range(n_rows):
        id = 0 if pick.random() < 0.33 else pick.randrange(1, 9)
        day = dt.date(1999, 1, 1) + dt.timedelta(days=pick.randrange(60) * 5)
        if id == 0 and pick.random() < 0.3:
            row = purchase(id, moment("1999-03-01"), pick.randrange(2))  # a busy visit
        else:
            hour = pick.choice([0, 0, 0, 9])
            row = purchase(id, moment(day, hour), pick.randrange(len(PRODUCTS)))
            row["practice_odu_id"] = pick.choice([10, 10, 10, 11, None])
            row["species"] = pick.choice(["canine", "canine", "feline", None])
        row["revenue"] = float(pick.randrange(4))
        row["pain_type"] = pick.choice(["Chronic"] * 8 + ["Acute", None])
        row["region"] = pick.choice(["north", "south"])
        row["timeframe"] = pick.choice(["Current Year", "Previous Year"])
        rows += [row] * pick.choice([1, 1, 2])
    return rows
