"""Reconciliation identities that can fail a run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_TOLERANCE = 0.03
ROUNDING_ALLOWANCE_MN = 150.0


@dataclass(frozen=True)
class Check:
    """lhs should equal rhs.

    Passes within the relative `tolerance`, or within `abs_tolerance` where one
    is given; `relative=False` judges by `abs_tolerance` alone. A null on
    either side emits no row: absent inputs suppress a check.
    """

    name: str
    lhs: Column
    rhs: Column
    tolerance: float = DEFAULT_TOLERANCE
    abs_tolerance: float | None = None
    relative: bool = True
    unit: str = "ratio"


def rel_error(lhs: Column, rhs: Column) -> Column:
    return F.abs(lhs - rhs) / F.when(rhs != 0, F.abs(rhs)).otherwise(F.lit(1.0))


def _row(c: Check) -> Column:
    lhs, rhs = c.lhs.cast("double"), c.rhs.cast("double")
    rel = rel_error(lhs, rhs)
    ok = (rel <= c.tolerance) if c.relative else F.lit(False)
    if c.abs_tolerance is not None:
        ok = ok | (F.abs(lhs - rhs) <= c.abs_tolerance)
    return F.when(
        lhs.isNotNull() & rhs.isNotNull(),
        F.struct(
            F.lit(c.name).alias("check_name"),
            lhs.alias("lhs"),
            rhs.alias("rhs"),
            F.lit(float(c.tolerance)).alias("tolerance"),
            F.round(rel, 6).alias("rel_error"),
            ok.alias("passed"),
            F.lit(c.unit).alias("unit"),
        ),
    )


def reconcile(df: DataFrame, checks: Sequence[Check], keep: Sequence[str] = ()) -> DataFrame:
    """Long check rows, all checks in one pass over `df`."""
    rows = df.select(*keep, F.explode(F.array(*[_row(c) for c in checks])).alias("_c"))
    return rows.filter(F.col("_c").isNotNull()).select(*keep, "_c.*")


def summarise_checks(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check_name").agg(
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.max("rel_error").alias("worst_rel_error"),
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side, without a join."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])


def run_gate(
    checks: DataFrame, verification: DataFrame | None = None, ok: str = "ok", parsed: DataFrame | None = None, rejects: DataFrame | None = None
) -> DataFrame:
    """One status row: the run fails if any check or verification failed, and if it got nothing from its sources.

    Checks are reduced to one row per name first; `verification` is any frame
    with a boolean column named by `ok`. Where `parsed` and `rejects` are given,
    both are counted; a run without a parsed source fails, one with rejects is
    'partial'.
    """
    gate = summarise_checks(checks).agg(
        F.coalesce(F.sum("checks_total"), F.lit(0)).alias("checks_total"),
        F.coalesce(F.sum("checks_failed"), F.lit(0)).alias("checks_failed"),
        F.max("worst_rel_error").alias("worst_rel_error"),
        F.max_by("check_name", F.struct("worst_rel_error", "check_name")).alias("worst_check"),
    )
    if verification is None:
        gate = gate.withColumn("verifications_failed", F.lit(0).cast("bigint"))
    else:
        gate = one_row(gate, verification.agg(F.count_if(~F.col(ok)).alias("verifications_failed")))
    failed = (F.col("checks_failed") > 0) | (F.col("verifications_failed") > 0)
    status = F.when(failed, "fail")
    if parsed is not None:
        counts = [parsed.agg(F.count(F.lit(1)).alias("parsed"))]
        if rejects is not None:
            counts.append(rejects.agg(F.count(F.lit(1)).alias("rejected")))
        gate = one_row(gate, *counts)
        status = status.when(F.col("parsed") == 0, "fail")
        if rejects is not None:
            status = status.when(F.col("rejected") > 0, "partial")
    return gate.withColumn("status", status.otherwise("ok"))
