"""Point-in-time reads over a store in which a correction is a new vintage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import first_per_key


def _newest(vintage: str, tie_break: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in (vintage, *tie_break)]


def latest_vintage(
    df: DataFrame, keys: Sequence[str], vintage: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The row of the newest vintage per natural key; `tie_break` makes the order total."""
    return first_per_key(df, keys, _newest(vintage, tie_break))


def asof_vintage(
    df: DataFrame, keys: Sequence[str], vintage: str, known_on: Column, tie_break: Sequence[str] = ()
) -> DataFrame:
    """What was known on a date: newest vintage not after it. The filter reaches the scan."""
    return latest_vintage(df.filter(F.col(vintage) <= known_on), keys, vintage, tie_break)


def set_aside(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that hold more than one row, and how many rows a reader of one row per key sets aside."""
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n_set_aside"))
    return counted.filter("n_set_aside > 0")


def revisions(
    df: DataFrame, keys: Sequence[str], vintage: str, value: str, tie_break: Sequence[str] = (), arrival: str | None = None
) -> DataFrame:
    """Change between successive vintages of one key.

    (key, vintage) is unique in a vintaged store; reducing to it first bounds a
    key's history by the number of publication dates, whatever the row count.
    Of several rows the first to arrive stays; without an `arrival` column the
    largest value does. `set_aside` over (key, vintage) counts the others.
    """
    order = [F.col(c).desc_nulls_last() for c in (value, *tie_break)]
    if arrival is not None:
        order = [F.col(arrival).asc_nulls_last(), *order]
    one = first_per_key(df, [*keys, vintage], order)
    w = W.partitionBy(*keys).orderBy(vintage)
    prev = F.lag(value).over(w)
    return one.select(
        *keys,
        vintage,
        F.col(value),
        F.row_number().over(w).alias("revision_no"),
        prev.alias("previous_value"),
        (F.col(value) - prev).alias("revision"),
    )


def pick_by_priority(
    df: DataFrame, keys: Sequence[str], column: str, priority: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key from the first channel (or basis) of `priority` that has one.

    Rows of an unlisted channel are never picked.
    """
    rank = F.lit(None).cast("int")
    for i, name in enumerate(priority):
        rank = F.when(F.col(column) == name, F.lit(i)).otherwise(rank)
    ranked = df.withColumn("_p", rank).filter(F.col("_p").isNotNull())
    return first_per_key(ranked, keys, [F.col("_p").asc(), *[F.col(c).asc() for c in tie_break]]).drop("_p")


def last_write_wins(df: DataFrame, keys: Sequence[str], field: str, position: str, value: str) -> DataFrame:
    """Per (keys, field) the value of the highest position: later sources replace earlier ones."""
    return df.groupBy(*keys, field).agg(
        F.max_by(value, position).alias(value), F.max(position).alias(position)
    )


def rank_entities(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w))


def basis_segments(
    df: DataFrame, keys: Sequence[str], period: str, basis: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Number the runs of equal basis along a series and flag each break.

    The series has one observation per (key, period); reducing to it first
    bounds a key's history by the number of periods. `tie_break` orders rows by
    arrival; `set_aside` over (key, period) counts those that do not stay.
    """
    one = first_per_key(df, [*keys, period], [F.col(c).asc_nulls_last() for c in (*tie_break, basis)])
    w = W.partitionBy(*keys).orderBy(period)
    prev = F.lag(basis).over(w)
    is_break = ((F.row_number().over(w) > 1) & ~F.col(basis).eqNullSafe(prev)).cast("int")
    flagged = one.withColumn("is_break", is_break)
    running = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    return flagged.withColumn("segment", (F.sum("is_break").over(running) + 1).cast("int"))
