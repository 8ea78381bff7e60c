"""Aggregates over period series: benchmarks, means, backfill, ordered text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import join_null_safe


def percentile_benchmark(
    df: DataFrame, keys: Sequence[str], period: str, value: str, first: str, last: str, q: float = 0.9
) -> DataFrame:
    """Continuous percentile of month-end values in a fixed window; one value per key and month goes in."""
    inside = df.filter(F.col(period).between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    return inside.groupBy(*keys).agg(
        F.percentile(F.col(value).cast("double"), F.lit(q)).alias("benchmark"), F.count(F.lit(1)).alias("n_months")
    )


def year_mean_of(value: str) -> Column:
    """Aggregate: mean of the values present, divided as doubles."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def year_mean(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Mean of the month-ends of each calendar year."""
    return df.groupBy(*keys, F.year(period).alias("year")).agg(
        year_mean_of(value).alias("year_mean"), F.count(value).alias("n_months")
    )


def month_mean_vs_history(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Mean of a month's days against the mean of all days up to November of the year before.

    Days are reduced to (sum, count) per month at once; the history is a
    running sum over years.
    """
    month = (
        df.groupBy(*keys, F.trunc(day, "MM").alias("obs_month"))
        .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    )
    december = F.month("obs_month") == 12
    year = month.groupBy(*keys, F.year("obs_month").alias("_y")).agg(
        F.sum("_s").alias("_ys"), F.sum("_n").alias("_yn"),
        F.sum(F.when(december, F.col("_s"))).alias("_ds"), F.sum(F.when(december, F.col("_n"))).alias("_dn"),
    )
    before = W.partitionBy(*keys).orderBy("_y").rangeBetween(W.unboundedPreceding, -1)
    last = W.partitionBy(*keys).orderBy("_y").rangeBetween(-1, -1)

    def history(total: str, dec: str) -> Column:
        return F.sum(total).over(before) - F.coalesce(F.sum(dec).over(last), F.lit(0))

    hist = year.select(*keys, "_y", history("_ys", "_ds").alias("_hs"), history("_yn", "_dn").alias("_hn"))
    joined = join_null_safe(month.withColumn("_y", F.year("obs_month")), hist, [*keys, "_y"], "left")
    mean = F.col("_s").cast("double") / F.col("_n")
    past = F.try_divide(F.col("_hs").cast("double"), F.col("_hn").cast("double"))
    return joined.select(
        *keys, "obs_month", mean.alias("month_mean"), past.alias("history_mean"), (mean - past).alias("difference")
    )


def regression_backfill(df: DataFrame, keys: Sequence[str], y: str, x: str, z: float = 1.96) -> DataFrame:
    """Fill undisclosed `y` from a per-key regression on `x`, with a prediction interval.

    Disclosed values stay; filled rows carry basis 'estimated' and the interval.
    """
    a = dict(
        _n=F.regr_count(y, x), _b=F.regr_slope(y, x), _a=F.regr_intercept(y, x), _mx=F.regr_avgx(y, x),
        _sxx=F.regr_sxx(y, x), _syy=F.regr_syy(y, x), _sxy=F.regr_sxy(y, x),
    )
    fit = df.groupBy(*keys).agg(*[c.alias(n) for n, c in a.items()])
    j = join_null_safe(df, fit, keys, "left")
    est = F.col("_a") + F.col("_b") * F.col(x)
    s2 = F.try_divide(F.col("_syy") - F.col("_b") * F.col("_sxy"), (F.col("_n") - 2).cast("double"))
    dx = F.col(x) - F.col("_mx")
    half = F.lit(z) * F.sqrt(s2 * (F.lit(1.0) + F.try_divide(F.lit(1.0), F.col("_n").cast("double")) + F.try_divide(dx * dx, F.col("_sxx"))))
    missing = F.col(y).isNull()
    return j.select(
        *df.columns,
        F.coalesce(F.col(y), est).alias("value"),
        F.when(missing, F.lit("estimated")).otherwise(F.lit("disclosed")).alias("basis"),
        F.when(missing, est - half).alias("ci_low"),
        F.when(missing, est + half).alias("ci_high"),
    )


def ordered_text(
    df: DataFrame, keys: Sequence[str], position: str, text: Column, sep: str, chunk: int = 1000
) -> DataFrame:
    """Texts of a key joined in position order, `chunk` positions to a row.

    A key with few positions gives one row (chunk_no 0); a very long one is
    returned whole over several rows instead of as one oversized string.
    """
    piece = F.struct(F.col(position).alias("p"), text.alias("t"))
    return (
        df.filter(text.isNotNull())
        .groupBy(*keys, F.floor(F.col(position) / chunk).cast("bigint").alias("chunk_no"))
        .agg(F.sort_array(F.collect_list(piece)).alias("_a"))
        .select(*keys, "chunk_no", F.array_join(F.transform("_a", lambda s: s["t"]), sep).alias("text"),
                F.size("_a").cast("bigint").alias("n_parts"))
    )
