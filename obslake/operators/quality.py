"""Data-quality expectations with the null rule of SQL CHECK: unknown passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    holds: Column


def not_null(column: str) -> Expectation:
    return Expectation(f"{column}_not_null", F.col(column).isNotNull())


def in_domain(column: str, *values: str) -> Expectation:
    return Expectation(f"{column}_domain", F.col(column).isin(*values))


def in_range(column: str, low: float, high: float) -> Expectation:
    return Expectation(f"{column}_range", F.col(column).between(low, high))


def cross_column(name: str, predicate: Column) -> Expectation:
    return Expectation(name, predicate)


def violations(df: DataFrame, expectations: Sequence[Expectation], keep: Sequence[str]) -> DataFrame:
    """The violating rows, one per broken expectation."""
    broken = F.array_compact(F.array(*[F.when(~e.holds, F.lit(e.name)) for e in expectations]))
    return df.select(*keep, F.explode(broken).alias("expectation"))


def expectation_report(df: DataFrame, expectations: Sequence[Expectation], table: str) -> DataFrame:
    """Violation counts of all expectations in one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(~e.holds).alias(e.name) for e in expectations]
    )
    long = counts.unpivot(["_n"], [e.name for e in expectations], "expectation", "n_violations")
    return long.select(
        F.lit(table).alias("table_name"),
        "expectation",
        F.col("_n").alias("n_rows"),
        "n_violations",
        (F.col("n_violations") == 0).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Natural keys stored more than once; nulls in a key are one value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
