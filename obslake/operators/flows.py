"""Calculus on period series: YTD and flow, rolling sums, changes, gaps, splices.

Inputs are series with one row per (key, period), so a window per key holds at
most one row per calendar period. Aggregate to periods first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import calendar as cal


def ytd_to_flow(df: DataFrame, keys: Sequence[str], period: str, ytd: str) -> DataFrame:
    """Monthly flow from a year-to-date figure.

    January (or any first month that is January) keeps its value. After a
    missing month the flow is null and `months_covered` tells how many months
    the difference would span, so it cannot pass for a one-month flow.
    """
    w = W.partitionBy(*keys, F.year(period)).orderBy(period)
    prev, prev_period = F.lag(ytd).over(w), F.lag(period).over(w)
    span = F.when(prev_period.isNull(), F.month(period)).otherwise(
        cal.month_index(F.col(period)) - cal.month_index(prev_period)
    )
    flow = F.when(prev_period.isNull(), F.col(ytd)).otherwise(F.col(ytd) - prev)
    return df.withColumn("months_covered", span.cast("int")).withColumn(
        "flow", F.when(span == 1, flow).otherwise(None)
    )


def flow_to_ytd(df: DataFrame, keys: Sequence[str], period: str, flow: str, dtype: str) -> DataFrame:
    w = W.partitionBy(*keys, F.year(period)).orderBy(period).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn("ytd", F.sum(flow).over(w).cast(dtype))


def rolling_sum(
    df: DataFrame, keys: Sequence[str], period: str, value: str, months: int, dtype: str
) -> DataFrame:
    """Sum over the last `months` calendar months; a gap does not stretch the window."""
    w = W.partitionBy(*keys).orderBy(cal.month_index(F.col(period))).rangeBetween(-(months - 1), 0)
    return df.withColumn(f"roll_{months}", F.sum(value).over(w).cast(dtype)).withColumn(
        f"n_{months}", F.count(value).over(w)
    )


def change_vs_year_end(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Change against the prior month and against the prior December; null where absent."""
    w = W.partitionBy(*keys).orderBy(cal.month_index(F.col(period)))
    prior = F.max(value).over(w.rangeBetween(-1, -1))
    # the prior December lies between 1 and 12 months back
    year = F.year(period)
    decembers = F.max(F.when(F.month(period) == 12, F.struct(F.col(period).alias("p"), F.col(value).alias("v")))).over(
        w.rangeBetween(-12, -1)
    )
    year_end = F.when(F.year(decembers.getField("p")) == year - 1, decembers.getField("v"))
    return df.withColumn("change_prior_month", F.col(value) - prior).withColumn(
        "change_prior_year_end", F.col(value) - year_end
    )


def four_quarter_sum(df: DataFrame, keys: Sequence[str], period: str, value: str, dtype: str) -> DataFrame:
    """Annualised four-quarter sum of a monthly series, only where four quarters exist."""
    q = (
        df.groupBy(*keys, F.trunc(period, "quarter").alias("obs_quarter"))
        .agg(F.sum(value).cast(dtype).alias("quarter_value"))
    )
    idx = F.year("obs_quarter") * 4 + F.quarter("obs_quarter")
    w = W.partitionBy(*keys).orderBy(idx).rangeBetween(-3, 0)
    full = F.count("quarter_value").over(w) == 4
    return q.withColumn("four_quarter_sum", F.when(full, F.sum("quarter_value").over(w)).cast(dtype))


def coverage(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """First, last, expected and present periods per key."""
    months = cal.month_index(F.col("last_period")) - cal.month_index(F.col("first_period")) + 1
    return (
        df.groupBy(*keys)
        .agg(
            F.min(period).alias("first_period"),
            F.max(period).alias("last_period"),
            F.countDistinct(period).alias("present"),
        )
        .withColumn("expected", months.cast("bigint"))
        .withColumn("missing", F.col("expected") - F.col("present"))
    )


def missing_periods(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Every month between a key's first and last that has no row.

    The gap after each present month is expanded from its successor, so no
    full calendar spine is built and nothing is joined.
    """
    present = df.select(*keys, period).distinct()
    nxt = F.lead(period).over(W.partitionBy(*keys).orderBy(period))
    gaps = present.withColumn("_next", nxt).filter(F.add_months(period, 1) < F.col("_next"))
    step = F.expr("interval 1 month")
    return gaps.select(
        *keys,
        F.explode(F.sequence(F.add_months(period, 1), F.add_months("_next", -1), step)).alias("missing_period"),
    )


def splice(
    sparse: DataFrame, dense: DataFrame, keys: Sequence[str], period: str, cutover: Column, basis: str = "basis"
) -> DataFrame:
    """Sparse series before the cutover, dense series from it on.

    Where the two parts of a key carry different bases, its rows are marked
    'spliced' and keep their own basis in `source_basis`.
    """
    parts = sparse.filter(F.col(period) < cutover).unionByName(dense.filter(F.col(period) >= cutover))
    w = W.partitionBy(*keys)
    mixed = F.min(basis).over(w) != F.max(basis).over(w)
    return parts.withColumn("_mixed", mixed).select(
        *[F.col(c) for c in parts.columns if c != basis],
        F.col(basis).alias("source_basis"),
        F.when(F.col("_mixed"), F.lit("spliced")).otherwise(F.col(basis)).alias(basis),
    )


def period_end_pick(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, period: Column, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Closing value of each period: the last observation in it."""
    return df.groupBy(*keys, period.alias("obs_period")).agg(
        F.max_by(value, F.struct(ts, *tie_break)).alias("closing_value"), F.max(ts).alias("closing_ts")
    )
