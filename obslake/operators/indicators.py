"""Indicator formulas as Column expressions: decimals in, double ratios out.

A ratio with a missing input or a zero denominator is null, never zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def economic_hedge_ratio(hedges: Column, policy: Column, assets: Column) -> Column:
    return ratio(hedges + policy, assets)


def gross_hedge_ratio(hedges: Column, assets: Column) -> Column:
    return ratio(hedges, assets)


def regulatory_hedge_ratio(principal: Column, investments: Column, policy: Column, unhedged_equity: Column) -> Column:
    return ratio(principal, investments - policy - unhedged_equity)


def net_open_position(assets: Column, policy: Column, hedges: Column) -> Column:
    return assets - policy - hedges


def net_exposure(investments: Column, policy: Column, unhedged_equity: Column, principal: Column) -> Column:
    return investments - policy - unhedged_equity - principal


def policy_backed_assets(investments: Column, denominator: Column) -> Column:
    return investments - denominator


def effective_ratio(hedge_ratio: Column, buffer: Column, exposure: Column) -> Column:
    """Memo line only: hedge ratio plus the buffer's share of the net exposure."""
    return hedge_ratio.cast("double") + ratio(buffer, exposure)


def hedging_result(instrument: Column, swap_cost: Column) -> Column:
    """Hedging P&L, only where both legs are given."""
    return instrument + swap_cost


def residual(hedges: Column, bank_supply: Column, swap_book: Column) -> Column:
    return hedges - bank_supply - swap_book


def stressed(policy: Column, haircut: Column) -> Column:
    return policy * (F.lit(1).cast("decimal(5,4)") - haircut)


def weighted_average(value: Column, weight: Column) -> Column:
    """Aggregate: rows with a missing value or weight take no part in either sum."""
    both = value.isNotNull() & weight.isNotNull()
    return F.try_divide(
        F.sum(F.when(both, value * weight)).cast("double"), F.sum(F.when(both, weight)).cast("double")
    )


def unit_rows(df: DataFrame, keep: Sequence[str], series_key: str, units: Mapping[str, Column]) -> DataFrame:
    """One long row per presentation; the unit is part of the series key."""
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{series_key}.{u}").alias("series_key"), F.lit(u).alias("unit"), c.cast("double").alias("value")
            )
            for u, c in units.items()
        ]
    )
    return df.select(*keep, F.explode(rows).alias("_r")).select(*keep, "_r.*").filter("value IS NOT NULL")


REGIME_START = "2026-01-01"


def buffer_tiers(
    df: DataFrame,
    keep: Sequence[str],
    period: str,
    exposure: Column,
    reserve: Column,
    equity: Column,
    special_fixed: Column,
    strengthening: Column,
    memo: Column,
    regime_start: Column | None = None,
) -> DataFrame:
    """Buffer tiers in NT$ mn, as a share of exposure and as absorbable appreciation.

    Before the regime: (a) reserve, (b) + equity. After it: (a) reserve,
    (b) + special reserve; (c) the strengthening reserve stands alone as
    restricted capital and (d) deferred differences are a memo. Neither (c)
    nor (d) adds to a cumulative tier.
    """
    start = regime_start if regime_start is not None else F.to_date(F.lit(REGIME_START))
    v1 = F.col(period) < start

    def tier(name: str, version: str, amount: Column, counts: bool) -> Column:
        return F.struct(
            F.lit(name).alias("tier"),
            F.lit(version).alias("definition_version"),
            amount.cast("double").alias("amount"),
            F.lit(counts).alias("loss_absorbing"),
        )

    old = F.array(tier("a", "v1", reserve, True), tier("b", "v1", reserve + equity, True))
    new = F.array(
        tier("a", "v2", reserve, True),
        tier("b", "v2", reserve + special_fixed, True),
        tier("c_restricted", "v2", strengthening, False),
        tier("d_memo", "v2", memo, False),
    )
    rows = df.withColumn("_x", exposure.cast("double")).select(
        *keep, "_x", F.explode(F.when(v1, old).otherwise(new)).alias("_t")
    )
    share = F.try_divide(F.col("_t.amount"), F.col("_x"))
    return rows.select(
        *keep,
        "_t.*",
        share.alias("share_of_exposure"),
        F.when(F.col("_t.loss_absorbing"), share * 100).alias("absorbable_pct"),
    ).filter("amount IS NOT NULL")


def composition_shares(df: DataFrame, keys: Sequence[str], part: str, value: str) -> DataFrame:
    """Share of each part in its (entity, period) total; `df` has one row per part."""
    total = F.sum(value).over(W.partitionBy(*keys))
    return df.withColumn("share", ratio(F.col(value), total))


# From the weakest to the strongest kind of basis.
BASIS_STRENGTH = ("spliced", "estimated", "press_reported", "disclosed")


def weakest_basis(*bases: Column) -> Column:
    """Weakest basis among the legs of a derivation; an absent leg does not count."""
    out = F.lit(None).cast("string")
    for name in reversed(BASIS_STRENGTH):
        hit = F.lit(False)
        for b in bases:
            hit = hit | F.coalesce(b == name, F.lit(False))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def basis_rank(c: Column) -> Column:
    """Rank for aggregating with min: lower is weaker."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(BASIS_STRENGTH):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out


def rank_basis(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, name in enumerate(BASIS_STRENGTH):
        out = F.when(c == i, F.lit(name)).otherwise(out)
    return out


def carried_provenance(
    vintage: str = "vintage", retrieved_at: str = "retrieved_at", basis: str = "basis", sources: str = "sources"
) -> list[Column]:
    """Aggregates that keep provenance through a derivation.

    `sources` names source systems or channels, a short fixed list, joined by
    "; "; the result is their distinct union. For the documents behind a
    figure, which are many, use `provenance_links`.
    """
    names = F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.split(sources, "; ")))))
    return [
        F.max(vintage).alias("vintage"),
        F.max(retrieved_at).alias("retrieved_at"),
        rank_basis(F.min(basis_rank(F.col(basis)))).alias("basis"),
        F.array_join(names, "; ").alias("sources"),
    ]


def provenance_links(df: DataFrame, keys: Sequence[str], document: str) -> DataFrame:
    """Which documents stand behind which derived figure, one row per link."""
    return df.select(*keys, document).filter(F.col(document).isNotNull()).distinct()
