"""Writing both models' output, and refreshing that of the chronic model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.operators.skew import equi_join
from rxtrail.plans.chronic import ChronicModel
from rxtrail.plans.daystate import DayState, StateModel
from rxtrail.plans.switching import SwitchModel
from rxtrail.sources.relations import ChronicInputs, read_relation
from rxtrail.sources.staging import Staging
from rxtrail.sources.versions import MONTH, MonthlyVersions

KEY = ["server_odu_id", "patient_odu_id", "transaction_odu_id", "rule"]


def is_fresh(target: DataFrame, config: ChronicConfig) -> Column:
    """True for stamps up to the overlap before the target's newest; all on a first run."""
    overlap = F.make_dt_interval(hours=F.lit(config.overlap_hours))
    newest = target.agg(F.max("odu_updated_at_utc") - overlap).scalar()
    first_run = target.agg(F.count(F.lit(1)) == 0).scalar()
    return first_run | (F.col("odu_updated_at_utc") >= newest)


def rows_with_news(result: DataFrame, target: DataFrame | None, config: ChronicConfig) -> DataFrame:
    """The rows of every purchase and rule of which a row is fresh."""
    if target is None:
        return result
    has_news = F.max(is_fresh(target, config)).over(Window.partitionBy(*KEY))
    return result.withColumn("has_news", has_news).where("has_news").drop("has_news")


def refreshed_rows(
    inputs: ChronicInputs,
    target: DataFrame | None,
    config: ChronicConfig,
    staging: Staging,
    state: DayState | None = None,
) -> DataFrame:
    """All current rows of purchases and rules that have a fresh one.

    Those rows replace the stored ones, so the ones that aren't fresh come along. A row's
    stamp is that of a line of its patient, so only patients with a fresh line are run. With a
    ``state`` lines are read that have come since it was last advanced, instead of all.
    """
    fresh = None if target is None else is_fresh(target, config)
    if state is None:
        model = ChronicModel(inputs, config, staging, only_patients_with=fresh)
    else:
        model = StateModel(state, inputs, config, staging, only_patients_with=fresh)
    return rows_with_news(model.chronic_purchases(), target, config)


def merged(target: DataFrame | None, emitted: DataFrame) -> DataFrame:
    """The target with emitted rows in place of those of the same purchase and rule."""
    if target is None:
        return emitted
    kept = equi_join(target, emitted.select(*KEY).distinct(), KEY, "left_anti", null_safe=True)
    return kept.unionByName(emitted)


def write_output(frame: DataFrame, path: str, spread: Sequence[str] = KEY) -> None:
    """Write purchases by month of event, large months over several files by ``spread``."""
    (
        with_month(frame)
        .repartitionByRange(MONTH, *spread)
        .sortWithinPartitions(MONTH, "patient_odu_id", "transaction_datetime")
        .write.partitionBy(MONTH)
        .parquet(path)
    )


def with_month(frame: DataFrame) -> DataFrame:
    return frame.withColumn(MONTH, F.date_format("transaction_datetime", "yyyy-MM"))


def write_switching_report(model: SwitchModel, path: str) -> None:
    """Write the switching report; the run's intermediate tables are removed, also on failure."""
    with model.staging:
        visit = ["patient_odu_id", "transaction_datetime", "product_name", "revenue"]
        write_output(model.nsaid_switching(ordered=False), path, visit)


def refresh_table(
    inputs: ChronicInputs,
    config: ChronicConfig,
    staging: Staging,
    new_path: str,
    old_path: str | None = None,
) -> None:
    """Write the next version of the output beside the previous one, which is left alone.

    The run's intermediate tables are removed, also on failure.
    """
    spark = inputs.transactions.sparkSession
    target = read_relation(spark, "chronic_purchases", old_path) if old_path else None
    with staging:
        emitted = staging.write(refreshed_rows(inputs, target, config, staging), "emitted")
        write_output(merged(target, emitted), new_path)


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What makes ``new`` of ``old``: whole rows and their ``change``.

    Old rows are "replaced" if other rows of their purchase and rule are new, else "removed"; new
    ones are "replacing" or "inserted". Rows are compared by all their columns and counted in one
    partial aggregate, so copies and NULLs count too, and only rows that differ move on.
    """
    columns = old.columns
    sides = old.withColumn("n", F.lit(-1)).unionByName(new.select(*columns).withColumn("n", F.lit(1)))
    differing = sides.groupBy(*columns).agg(F.sum("n").alias("n")).where("n != 0")
    same = Window.partitionBy(*KEY)
    both = (F.max("n").over(same) > 0) & (F.min("n").over(same) < 0)
    change = (
        F.when(F.col("n") < 0, F.when(both, "replaced").otherwise("removed"))
        .when(both, "replacing")
        .otherwise("inserted")
    )
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("n"))).alias("time")
    return differing.select(*columns, "n", change.alias("change")).select(*columns, "change", times).drop("time")


def rebuild_changes(
    inputs: ChronicInputs, target: DataFrame, config: ChronicConfig, staging: Staging
) -> DataFrame:
    """What a full rebuild would change of ``target``.

    Beside a refresh, which never removes a row: these are also the rows that no longer qualify.
    """
    rebuilt = staging.write(ChronicModel(inputs, config, staging).chronic_purchases(), "rebuilt")
    return changes(target, rebuilt)


def refresh_store(
    inputs: ChronicInputs,
    config: ChronicConfig,
    staging: Staging,
    store: MonthlyVersions,
    state: DayState | None = None,
) -> int:
    """Make the next version of a store; returns its number.

    Emitted rows are held against the stored ones that they replace. Only months that hold a row
    of either side without an equal on the other are written; all others stay the files they are.
    The run's intermediate tables are removed, also on failure.
    """
    base = store.current()
    with staging:
        if not base:
            first = refreshed_rows(inputs, None, config, staging, state)
            return store.publish(lambda path: write_output(first, path), None, base)
        target = store.read(base)
        emitted = staging.write(refreshed_rows(inputs, target, config, staging, state), "emitted")
        keys = emitted.select(*KEY).distinct()
        replaced = equi_join(target, keys, KEY, "left_semi", null_safe=True)
        # As many as there are months of output.
        months = with_month(changes(replaced, emitted)).select(MONTH).distinct()
        touched = {row[MONTH] for row in months.collect()}
        news = with_month(emitted).where(F.col(MONTH).isin(*touched)).drop(MONTH)
        kept = equi_join(store.read(base, only=touched), keys, KEY, "left_anti", null_safe=True)
        rows = kept.unionByName(news)
        return store.publish(lambda path: write_output(rows, path), touched, base)
