"""Repeat purchases of the same therapy, and the chronic decision built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.functions.dates import month_index, months_before
from rxtrail.functions.stamps import newest
from rxtrail.operators.skew import HotKeys, lookup_join, per_key
from rxtrail.operators.therapy import ALTERNATIVE
from rxtrail.operators.universe import PATIENT
from rxtrail.sources.staging import Staging

THERAPY = (*PATIENT, "rule")

# Rules whose purchases must repeat.
REPEATING = ("NSAIDs", "Analgesic", "Gabapentin & Tramadol", "Supplements", "Opiate", ALTERNATIVE)
ANTI_INFLAMMATORY = "Anti-Inflammatory"


def counted_rules(config: ChronicConfig) -> list[str]:
    return [*REPEATING, ANTI_INFLAMMATORY] if config.count_anti_inflammatory else [*REPEATING]


def repeat_dates(dates: DataFrame, config: ChronicConfig, *kept: str) -> DataFrame:
    """Per therapy date: the number of other dates in reach, and the newest stamp on them.

    There is one row per date, so a frame never holds more rows than there are days, and
    summing ``is_counted`` counts distinct dates. Purchases without an id are never another
    purchase: they count no date and lend no stamp.
    """
    reach = config.repeat_months - 1
    months = Window.partitionBy(*THERAPY).orderBy("month")
    same_month = Window.partitionBy(*THERAPY, "month").orderBy("event_date")
    others = [
        same_month.rowsBetween(Window.unboundedPreceding, -1),
        same_month.rowsBetween(1, Window.unboundedFollowing),
    ]
    if reach > 0:
        others += [months.rangeBetween(-reach, -1), months.rangeBetween(1, reach)]
    return dates.withColumn("month", month_index(F.col("event_date"))).select(
        *THERAPY,
        "event_date",
        *kept,
        (F.sum("is_counted").over(months.rangeBetween(-reach, reach)) - F.col("is_counted")).alias("purchases"),
        F.greatest(*[F.max("stamp").over(frame) for frame in others]).alias("updated_at"),
    )


def repeats_in_place(survivors: DataFrame, is_wanted: Column, config: ChronicConfig) -> DataFrame:
    """Wanted rows with their repeats, after a single shuffle by patient."""
    inside = F.struct(*[c for c in survivors.columns if c not in (*THERAPY, "event_date")])
    dates = (
        survivors.repartition(*PATIENT)
        .groupBy(*THERAPY, "event_date")
        .agg(
            *_of_purchases(),
            F.collect_list(F.when(is_wanted, inside)).alias("rows"),
        )
    )
    rows = repeat_dates(dates, config, "rows").select("*", F.inline("rows")).drop("rows")
    return _where_counted(rows, F.col("rule").isin(*counted_rules(config)))


def _of_purchases() -> list[Column]:
    """Of a date: the newest stamp of purchases with an id, and whether there is any."""
    has_id = F.col("transaction_odu_id").isNotNull()
    return [
        F.max(F.when(has_id, F.col("odu_updated_at_utc"))).alias("stamp"),
        F.max(has_id.cast("long")).alias("is_counted"),
    ]


def _where_counted(rows: DataFrame, is_counted: Column) -> DataFrame:
    """Repeats of rows that have an id and meet the condition; none for others."""
    is_counted = is_counted & F.col("transaction_odu_id").isNotNull()
    return rows.withColumn(
        "purchases", F.when(is_counted, F.coalesce("purchases", F.lit(0))).otherwise(0).cast("long")
    ).withColumn("updated_at", F.when(is_counted, F.col("updated_at")))


def repeats_by_lookup(
    survivors: DataFrame, is_wanted: Column, hot_patients: HotKeys, config: ChronicConfig
) -> DataFrame:
    """Wanted rows with their repeats, for patients of any size."""
    dates = (
        survivors.where(F.col("rule").isin(*counted_rules(config)))
        .groupBy(*THERAPY, "event_date")
        .agg(*_of_purchases())
    )
    key = [*THERAPY, "event_date"]
    rows = survivors.where(is_wanted)
    return _where_counted(lookup_join(rows, repeat_dates(dates, config), key, hot_patients), F.lit(True))


def two_newest(of_ids: DataFrame, hot_patients: HotKeys | None) -> DataFrame:
    """Of each date the newest stamp, and the newest one of a purchase with another id.

    Both are partial aggregates, the second one over the rows that the first did not pick, so a
    date with any number of purchases is spread over tasks like any other rows.
    """
    date = [*THERAPY, "event_date"]
    best = F.max(F.struct("stamp", "transaction_odu_id")).alias("best")
    newest = of_ids.groupBy(*date).agg(best)
    others = lookup_join(of_ids, newest, date, hot_patients).where(
        F.col("transaction_odu_id") != F.col("best.transaction_odu_id")
    )
    second = others.drop("best").groupBy(*date).agg(best)
    return newest.unionByName(second).select(*date, "best.*")


def repeats_of_shared_ids(
    survivors: DataFrame,
    rows: DataFrame,
    hot_patients: HotKeys | None,
    config: ChronicConfig,
    staging: Staging,
) -> DataFrame:
    """Repeats for purchase ids that occur on several dates.

    Such a purchase must not count itself on its other dates. Two stamps per date, of
    different purchases, are enough to leave any one purchase out, so a therapy's dates fit
    one bounded array.
    """
    counted = survivors.where(F.col("rule").isin(*counted_rules(config))).where(
        F.col("transaction_odu_id").isNotNull()
    )
    sharing = rows.select(*THERAPY).distinct()
    of_ids = (
        lookup_join(counted, sharing, THERAPY, hot_patients, how="left_semi")
        .groupBy(*THERAPY, "event_date", "transaction_odu_id")
        .agg(F.max("odu_updated_at_utc").alias("stamp"))
    )
    two = two_newest(staging.write(of_ids, "stamps_of_ids"), hot_patients)
    dates = two.groupBy(*THERAPY).agg(
        F.collect_list(F.struct("event_date", "transaction_odu_id", "stamp")).alias("dates")
    )
    reach = config.repeat_months - 1

    def is_other(date):
        months_apart = month_index(date.event_date) - month_index(F.col("event_date"))
        return (
            (date.event_date != F.col("event_date"))
            & (date.transaction_odu_id != F.col("transaction_odu_id"))
            & (F.abs(months_apart) <= reach)
        )

    others = F.filter("dates", is_other)
    return (
        lookup_join(rows, dates, THERAPY, hot_patients)
        .withColumn("dates", others)
        .withColumn(
            "purchases",
            F.size(F.array_distinct(F.transform("dates", lambda date: date.event_date))),
        )
        .withColumn("purchases", F.greatest(F.col("purchases"), F.lit(0)).cast("long"))
        .withColumn("updated_at", F.array_max(F.transform("dates", lambda date: date.stamp)))
        .drop("dates")
    )


def with_repeats(
    survivors: DataFrame, hot_patients: HotKeys | None, config: ChronicConfig, staging: Staging
) -> DataFrame:
    """Purchases of the output months with their repeats, taken over all input months."""
    since = months_before(config.today(), config.output_months)
    is_recent = F.col("transaction_datetime") >= since
    is_single = is_recent & ~F.col("several_dates")

    def repeats(rows: DataFrame, is_hot: bool) -> DataFrame:
        if is_hot:
            return repeats_by_lookup(rows, is_single, hot_patients, config)
        return repeats_in_place(rows, is_single, config)

    single = per_key(survivors, hot_patients, repeats)
    shared = survivors.where(is_recent & F.col("several_dates"))
    if shared.isEmpty():
        return single
    return single.unionByName(repeats_of_shared_ids(survivors, shared, hot_patients, config, staging))


def is_chronic(config: ChronicConfig):
    """Repeats required by rule; rules outside the list need none."""
    rule, purchases = F.col("rule"), F.col("purchases")
    must_repeat = rule.isin(*REPEATING, ANTI_INFLAMMATORY)
    enough = F.when(rule == ALTERNATIVE, config.min_repeats_alternative).otherwise(
        config.min_repeats
    )
    return ~must_repeat | (purchases >= enough)


def chronic_purchases(repeats: DataFrame, config: ChronicConfig) -> DataFrame:
    """Purchases judged chronic, stamped with the newest update they depend on."""
    stamp = newest(F.col("odu_updated_at_utc"), F.col("updated_at"), config.null_stamps_win)
    return (
        repeats.where(is_chronic(config))
        .select(
            "patient_odu_id",
            "server_odu_id",
            "practice_odu_id",
            "species",
            "transaction_odu_id",
            stamp.alias("odu_updated_at_utc"),
            "invoice_odu_id",
            "transaction_datetime",
            "rule",
            "purchases",
        )
        .distinct()
    )
