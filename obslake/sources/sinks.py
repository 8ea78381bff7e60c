"""Sinks: CSV with sorted columns, one-object reports, publication frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import decimal_text
from ..operators.reconcile import one_row, summarise_checks
from .append import append_bucketed


def write_csv(df: DataFrame, path: str) -> list[str]:
    """CSV with a header of the columns in name order; decimals as plain text."""
    cols = sorted(df.columns)
    types = dict(df.dtypes)
    out = df.select(
        *[decimal_text(F.col(c)).alias(c) if types[c].startswith("decimal") else F.col(c) for c in cols]
    )
    out.write.mode("overwrite").csv(path, header=True)
    return cols


def union_columns(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of row shapes; columns are the sorted union, absent ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*sorted(out.columns))


def run_report(
    run_id: str, gate: DataFrame, checks: DataFrame, rows: DataFrame, period: str, warnings: str | None = None
) -> DataFrame:
    """One row for a run: gate, coverage, failed checks per name, warnings per period.

    Everything is reduced per check name or per period before it meets in the
    one row, so the row grows with names and periods and not with the data.
    """
    failed = summarise_checks(checks).agg(
        F.sort_array(F.collect_list(F.struct("check_name", "checks_failed", "worst_rel_error"))).alias("checks")
    )
    cover = rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(period).alias("first_period"), F.max(period).alias("last_period")
    )
    frames = [gate, cover, failed]
    if warnings:
        frames.append(
            rows.filter(F.size(warnings) > 0)
            .select(F.col(period).cast("string").alias("p"), F.explode(warnings).alias("w"))
            .groupBy("p", "w").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("p").agg(F.sort_array(F.collect_list(F.struct("w", "n"))).alias("ws"))
            .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p", "ws")))).alias("warnings"))
        )
    return one_row(*frames).withColumn("run_id", F.lit(run_id))


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def frame_export(df: DataFrame, series: str, index: Column, value: Column) -> DataFrame:
    """`{index: [...], columns: {value: [...]}}` per series, in index order, nulls dropped.

    One row per (series, period) goes in, so an array is as long as a series
    has periods.
    """
    pts = (
        df.select(F.col(series), index.alias("x"), value.alias("y"))
        .filter("y IS NOT NULL")
        .groupBy(series)
        .agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("pts"))
    )
    payload = F.struct(
        F.transform("pts", lambda p: p["x"]).alias("index"),
        F.struct(F.transform("pts", lambda p: p["y"]).alias("value")).alias("columns"),
    )
    return pts.select(series, F.size("pts").cast("bigint").alias("n_points"), F.to_json(payload).alias("frame"))


#: Columns of the publication and their types, the same for every series and market.
DERIVED_TYPES = {
    "series_id": "string", "series_key": "string", "entity_id": "string", "obs_date": "date", "freq": "string", "value": "double",
    "unit": "string", "definition_version": "string", "basis": "string", "basis_note": "string", "source_url": "string",
    "source_doc": "string", "retrieved_at": "timestamp", "vintage": "date", "run_id": "string",
}
DERIVED_COLUMNS = tuple(DERIVED_TYPES)
#: What tells published figures apart; a correction is a new vintage.
DERIVED_KEY = ("series_key", "entity_id", "obs_date", "definition_version", "vintage")


def common_schema(df: DataFrame, market: str | None = None, **constants: str) -> DataFrame:
    """Project to the publication schema; absent columns are nulls of their type, constants fill in."""
    have = set(df.columns)
    cols = [
        (F.lit(constants[c]) if c in constants else F.col(c) if c in have else F.lit(None)).cast(kind).alias(c)
        for c, kind in DERIVED_TYPES.items()
    ]
    out = df.select(*cols)
    return out.withColumn("market", F.lit(market)) if market else out


def publish(df: DataFrame, table: str, buckets: int = 16) -> None:
    """Add figures to a published store; one that is there under its natural key stays, so a second run adds nothing."""
    append_bucketed(df, table, DERIVED_KEY, ["retrieved_at"], buckets)


def write_published(df: DataFrame, path: str) -> None:
    """Publication table: one folder per series, sorted for look-ups by entity and date."""
    (
        df.repartitionByRange("series_id", "entity_id", "obs_date")
        .sortWithinPartitions("series_id", "entity_id", "obs_date")
        .write.mode("append").partitionBy("series_id").parquet(path)
    )
