"""Ordered operators that stay safe when one key holds a large share of the rows.

A plain window over a hot key sorts that key in one task. The carries here
split every key's timeline into buckets: rows are windowed per (key, bucket),
each bucket's sources are reduced to one row before the shuffle, and only
those, one per bucket, are windowed per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Spark limits each key to one row map-side, before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def key_struct(keys: Sequence[str]) -> Column:
    """All key columns as one value. Structs compare nulls as equal, so joins and
    windows on it are null-safe and share one partitioning."""
    return F.struct(*keys).alias("_key")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named keys, where a null key part equals a null key part."""
    l, r = left.withColumn("_key", key_struct(keys)), right.withColumn("_key", key_struct(keys)).drop(*keys)
    return l.join(r, "_key", how).drop("_key")


def _carry_in(spine: DataFrame, sources: DataFrame, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """(key, bucket, payload of the last source in an earlier bucket) for the buckets of `spine`."""
    pos = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    last = sources.groupBy("_key", "_b").agg(*[F.max_by(p, pos).alias(p) for p in payload])
    marks = spine.select("_key", "_b").distinct().withColumn("_has", F.lit(0)).unionByName(
        last.withColumn("_has", F.lit(1)), allowMissingColumns=True
    )
    # a bucket's own sources come after its spine row
    before = W.partitionBy("_key").orderBy("_b", "_has").rowsBetween(W.unboundedPreceding, W.currentRow)
    got = F.last(F.when(F.col("_has") == 1, F.struct(*payload)), ignorenulls=True).over(before)
    return marks.withColumn("_carry", got).filter("_has = 0 AND _carry IS NOT NULL").select("_key", "_b", "_carry")


def _carry(
    rows: DataFrame, spine: DataFrame, sources: DataFrame, order: Sequence[str], payload: Sequence[str], prefix: str
) -> DataFrame:
    here = W.partitionBy("_key", "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    within = rows.withColumn(
        "_in", F.last(F.when(F.col("_src"), F.struct(*payload)), ignorenulls=True).over(here)
    )
    joined = within.join(_carry_in(spine, sources, order, payload), ["_key", "_b"], "left")
    got = F.coalesce("_in", "_carry")
    return joined.withColumns({prefix + p: got.getField(p) for p in payload})


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    is_source: Column,
    payload: Sequence[str],
    bucket: Column,
    prefix: str = "last_",
) -> DataFrame:
    """Give every row the payload of the last source row at or before it.

    `bucket` must be a non-decreasing, non-null function of `order`, such as the
    hour of the timestamp. `order` must be total within a key; keys are null-safe.
    """
    source = F.coalesce(is_source, F.lit(False))
    bucketed = df.withColumns({"_key": key_struct(keys), "_b": bucket})
    rows = bucketed.withColumn("_src", source)
    out = _carry(rows, bucketed.filter(~source), bucketed.filter(source), order, payload, prefix)
    return out.select(*df.columns, *[prefix + p for p in payload])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_order: str,
    right_order: str,
    payload: Sequence[str],
    bucket: Callable[[Column], Column],
    prefix: str = "asof_",
) -> DataFrame:
    """Attach the latest right row at or before each left row.

    No range join: both sides are stacked and carried, and a hot key is spread
    over its time buckets. `bucket` maps the order column to its bucket. Right
    rows of one key must differ in `right_order`; keys are null-safe.
    """
    l = left.withColumns({"_key": key_struct(keys), "_t": F.col(left_order), "_b": bucket(F.col(left_order))})
    r = right.select(
        key_struct(keys), F.col(right_order).alias("_t"), bucket(F.col(right_order)).alias("_b"),
        *[F.col(p).alias(f"_p_{p}") for p in payload],
    )
    rows = l.withColumns({"_side": F.lit(1), "_src": F.lit(False)}).unionByName(
        r.withColumns({"_side": F.lit(0), "_src": F.lit(True)}), allowMissingColumns=True
    )
    # on equal times the right row comes first
    cols = [f"_p_{p}" for p in payload]
    out = _carry(rows, l, r.withColumn("_side", F.lit(0)), ["_t", "_side"], cols, "_g")
    return out.filter(F.col("_side") == 1).select(
        *left.columns, *[F.col(f"_g_p_{p}").alias(prefix + p) for p in payload]
    )
