"""Provenance as one value that is merged by one rule.

A leg's provenance is a struct of its newest vintage, newest retrieval, weakest basis and set of sources. Whatever a
figure is derived from, by a formula over columns, a join or an aggregate, its provenance is the merge of its legs':
merging is associative and ignores what a leg does not have, so the order of derivations does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .indicators import basis_rank, rank_basis

FIELDS = ("vintage", "retrieved_at", "basis", "sources")
NOTHING = "array<string>"


def leg(
    vintage: Column | None = None, retrieved_at: Column | None = None, basis: Column | None = None, sources: Column | None = None,
) -> Column:
    """The provenance of one input; `sources` are names joined by "; "."""
    none = lambda c, kind: F.lit(None).cast(kind) if c is None else c
    names = F.filter(F.split(none(sources, "string"), "; "), lambda s: s != "")
    return F.struct(
        none(vintage, "date").alias("vintage"), none(retrieved_at, "date").alias("retrieved_at"), basis_rank(none(basis, "string")).alias("rank"),
        F.array_sort(F.array_distinct(F.coalesce(names, F.array().cast(NOTHING)))).alias("sources"),
    )


def of_columns() -> Column:
    """The provenance that a frame carries in its columns vintage, retrieved_at, basis and sources."""
    return leg(*[F.col(f) for f in FIELDS])


def merge(*legs: Column) -> Column:
    """The provenance of what is derived from several legs of a row; a null leg adds nothing."""
    if len(legs) == 1:
        return legs[0]
    most = lambda f: F.greatest(*[p[f] for p in legs])
    names = F.concat(*[F.coalesce(p["sources"], F.array().cast(NOTHING)) for p in legs])
    return F.struct(
        most("vintage").alias("vintage"), most("retrieved_at").alias("retrieved_at"), F.least(*[p["rank"] for p in legs]).alias("rank"),
        F.array_sort(F.array_distinct(names)).alias("sources"),
    )


def merge_rows(c: str) -> Column:
    """Aggregate: the provenance of what is derived from all rows; sources are a short list of names."""
    p = F.col(c)
    return F.struct(
        F.max(p["vintage"]).alias("vintage"), F.max(p["retrieved_at"]).alias("retrieved_at"), F.min(p["rank"]).alias("rank"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(p["sources"])))).alias("sources"),
    )


def told(c: str | Column) -> list[Column]:
    """Back to the four columns."""
    p = F.col(c) if isinstance(c, str) else c
    return [p["vintage"].alias("vintage"), p["retrieved_at"].alias("retrieved_at"), rank_basis(p["rank"]).alias("basis"), F.array_join(p["sources"], "; ").alias("sources")]
