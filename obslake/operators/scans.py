"""Running balances with a floor and a cap, as a scan that any bucket of rows can begin.

A step adds something to a balance and then holds it between a floor and a cap. Two such steps in a row are again one
step of that form, so steps are combined without knowing the balance they start from: within buckets of each key's
timeline, then over the buckets, one row each. Both scans double their reach each round by looking back 1, 2, 4, ...
rows in one ordering, so a round is one more column and no shuffle, and no array of a key's history is ever built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ordered import key_struct

_NONE, _ALL = float("-inf"), float("inf")


def held(x: Column, low: Column, high: Column) -> Column:
    """x, not below `low`, and in any case not above `high`."""
    return F.least(F.greatest(x, low), high)


def step(add: Column, floor: Column | None = None, cap: Column | None = None) -> Column:
    """One step; null parts do nothing, so a step of nulls leaves every balance as it is."""
    part = lambda c, none: F.lit(none) if c is None else F.coalesce(c.cast("double"), F.lit(none))
    return F.struct(part(add, 0.0).alias("shift"), part(floor, _NONE).alias("low"), part(cap, _ALL).alias("high"))


def then(first: Column, second: Column) -> Column:
    """Both steps as one; a null step does nothing."""
    both = F.struct(
        (first["shift"] + second["shift"]).alias("shift"),
        held(first["low"] + second["shift"], second["low"], second["high"]).alias("low"),
        held(first["high"] + second["shift"], second["low"], second["high"]).alias("high"),
    )
    return F.when(first.isNull(), second).when(second.isNull(), first).otherwise(both)


def applied(steps: Column, balance: Column) -> Column:
    return F.when(steps.isNull(), balance).otherwise(held(balance + steps["shift"], steps["low"], steps["high"]))


def _running(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, rows: int) -> DataFrame:
    """`col` combined with all before it in its group of at most `rows` rows."""
    w = W.partitionBy(*by).orderBy(*order)
    reach = 1
    while reach < rows:
        df = df.withColumn(col, then(F.lag(col, reach).over(w), F.col(col)))
        reach *= 2
    return df


def clamped_scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Column, opening: Column, bucket: Column, bucket_rows: int,
    before: str = "before", after: str = "after",
) -> DataFrame:
    """Every row with the balance before and after its step.

    `bucket` is a non-decreasing, non-null function of `order` that gives at most `bucket_rows` rows of a key the same
    value; more of them are an error, not a wrong balance. `opening` is read from each key's first row. Keys are
    null-safe; `order` must be total within a key.
    """
    ensure_checkpoint_dir(df.sparkSession)
    inside = W.partitionBy("_key", "_b").orderBy(*order)
    rows = df.withColumns({"_key": key_struct(keys), "_b": bucket, "_s": steps, "_open": opening.cast("double")})
    rows = _running(rows.withColumn("_i", F.row_number().over(inside)), ["_key", "_b"], order, "_s", bucket_rows)
    rows = rows.withColumn("_last", F.lag("_s").over(inside))

    # one row a bucket: all its steps, and the opening balance of the key's first
    at = F.struct(*order) if len(order) > 1 else F.col(order[0])
    whole = rows.groupBy("_key", "_b").agg(F.max_by("_s", at).alias("_s"), F.min_by("_open", at).alias("_open"), F.max("_i").alias("_n")).checkpoint()
    sizes = whole.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).head()
    most = whole.agg(F.max("_n").alias("n")).head()["n"] or 0
    if most > bucket_rows:
        raise ValueError(f"a bucket has {most} rows, more than bucket_rows={bucket_rows}")
    line = W.partitionBy("_key").orderBy("_b")
    carried = _running(whole, ["_key"], ["_b"], "_s", sizes["n"] or 0)
    start = F.first("_open").over(line)
    carried = carried.select("_key", "_b", applied(F.lag("_s").over(line), start).alias("_start"))

    out = rows.drop("_open").join(carried, ["_key", "_b"])
    out = out.withColumns({before: applied(F.col("_last"), F.col("_start")), after: applied(F.col("_s"), F.col("_start"))})
    return out.select(*df.columns, before, after)
