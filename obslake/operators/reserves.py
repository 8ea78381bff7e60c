"""Month-by-month reserve balances with floors, overflow and a cap, and the yearly steps they feed.

Months are scanned as combined steps (`scans`), never as one array per entity. Absent inputs are not read as zero: a
month without a change leaves the volatility reserve alone, a month without an exposure neither adds to the fixed
reserve nor caps it, and both are flagged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scans import clamped_scan, step

# Fixed values of the reserve rules.
COST_SHARE = 0.25
FIXED_CAP = 0.10
PROFIT_SHARE = 0.10
CAP_MULTIPLE = 2.0
DESIGNATED_COST = 0.025
FIXED_RATES = {"100": 0.0010, "100+": 0.00125, "50": 0.0005, "50+": 0.00075}

#: Months are bucketed by calendar year.
BUCKET_MONTHS = 12


def volatility_delta(gain_loss: Column, rate_class: Column, principal: Column, cost_diff: Column) -> Column:
    """Monthly provision (+) or offset (-) of the volatility reserve; null where an input it needs is missing.

    Half-rate entities also set aside, or release, a quarter of the hedging
    cost saved against its historical mean.
    """
    half = rate_class.startswith("50")
    rate = F.when(half, F.lit(0.5)).otherwise(F.lit(1.0))
    extra = F.when(half, -principal.cast("double") * cost_diff.cast("double") / 12.0 * COST_SHARE).otherwise(F.lit(0.0))
    return gain_loss.cast("double") * rate + extra


def reserve_scan(
    df: DataFrame, entity: str, month: str, delta: str, exposure: str, fixed_rate: str, opening_volatility: str, opening_fixed: str
) -> DataFrame:
    """Both reserves of every entity and month, and what moved them.

    A loss is first offset by the volatility reserve; the shortfall draws on the fixed reserve, which grows before that
    by a rate on net exposure and is capped after it at its share of the exposure. Both stop at zero, and what neither
    covers is `uncovered`. `df` has one row per (entity, month); openings count in the first.

    Columns: provision and offset (volatility), volatility, shortfall, fixed_provision, draw, fixed, cap_hit, uncovered,
    no_delta, no_exposure (an input is missing) and months_skipped (missing rows before this one).
    """
    year = F.year(month)
    vol = clamped_scan(
        df, [entity], [month], step(F.col(delta), F.when(F.col(delta).isNotNull(), 0.0)), F.coalesce(F.col(opening_volatility), F.lit(0.0)),
        year, BUCKET_MONTHS, "_v0", "volatility",
    )
    loss = F.greatest(-F.coalesce(F.col(delta).cast("double"), F.lit(0.0)), F.lit(0.0))
    known = F.col(exposure).isNotNull() & F.col(fixed_rate).isNotNull()
    base = F.greatest(F.col(exposure).cast("double"), F.lit(0.0))
    vol = vol.withColumns({
        "offset": F.least(loss, F.col("_v0")), "shortfall": F.greatest(loss - F.col("_v0"), F.lit(0.0)),
        "provision": F.greatest(F.coalesce(F.col(delta).cast("double"), F.lit(0.0)), F.lit(0.0)),
        "fixed_provision": F.when(known, base * F.col(fixed_rate).cast("double")).otherwise(F.lit(0.0)),
        "_cap": F.when(known, base * FIXED_CAP),
    })
    both = clamped_scan(
        vol, [entity], [month], step(F.col("fixed_provision") - F.col("shortfall"), F.lit(0.0), F.col("_cap")),
        F.coalesce(F.col(opening_fixed), F.lit(0.0)), year, BUCKET_MONTHS, "_f0", "fixed",
    )
    available = F.col("_f0") + F.col("fixed_provision")
    before = F.lag(month).over(W.partitionBy(entity).orderBy(month))
    return both.select(
        entity, month, "provision", "offset", "volatility", "shortfall", "fixed_provision", F.least(F.col("shortfall"), available).alias("draw"), "fixed",
        F.coalesce(available - F.col("shortfall") > F.col("_cap"), F.lit(False)).alias("cap_hit"),
        F.greatest(F.col("shortfall") - available, F.lit(0.0)).alias("uncovered"),
        F.col(delta).isNull().alias("no_delta"), (~known).alias("no_exposure"),
        F.coalesce(F.months_between(month, before).cast("int") - 1, F.lit(0)).alias("months_skipped"),
    )


def reserve_rollforward(
    df: DataFrame, entity: str, month: str, delta: str, exposure: str, fixed_rate: str, opening_volatility: str, opening_fixed: str
) -> DataFrame:
    """Closing volatility and fixed reserve per entity and month, and what neither covered; see `reserve_scan`."""
    out = reserve_scan(df, entity, month, delta, exposure, fixed_rate, opening_volatility, opening_fixed)
    return out.select(entity, F.col(month).alias("obs_month"), "volatility", "fixed", "uncovered")


def special_reserve_fixed(
    df: DataFrame,
    entity: str,
    year: str,
    profit: str,
    fixed_provision: str,
    cap_after_tax: str,
    opening: str,
) -> DataFrame:
    """Yearly special reserve: a tenth of a positive after-tax profit, less the fixed-reserve
    provision of the year; none in a year that opens at twice the cap. `df` has one row
    per (entity, year). What is left of the deduction goes to the strengthening reserve.

    A year without a profit or a deduction is not closed: nothing is set aside, `provision` and `left` are null. Without
    a cap nothing stops the provision. An entity has as many elements to fold as years.
    """
    out = _special_years(df, entity, year, profit, fixed_provision, cap_after_tax, opening)
    return out.select(entity, year, "provision", "balance")


def _special_years(
    df: DataFrame, entity: str, year: str, profit: str, deduction: str, cap: str, opening: str
) -> DataFrame:
    num = lambda c: F.col(c).cast("double")
    due = F.greatest(num(profit), F.lit(0.0)) * PROFIT_SHARE
    due = F.when(num(profit).isNotNull(), due)
    parts = F.struct(
        F.col(year).cast("int").alias("y"), due.alias("due"), num(deduction).alias("deduct"), num(cap).alias("cap")
    )
    series = df.groupBy(entity).agg(
        F.sort_array(F.collect_list(parts)).alias("steps"), F.min_by(F.coalesce(num(opening), F.lit(0.0)), year).alias("b0")
    )
    hist = "array<struct<y:int,provision:double,left:double,balance:double>>"
    state = f"struct<b:double,hist:{hist}>"
    start = F.struct(F.col("b0").alias("b"), F.array().cast(hist).alias("hist")).cast(state)

    def close(acc: Column, s: Column) -> Column:
        full = F.coalesce(acc["b"] >= s["cap"] * CAP_MULTIPLE, F.lit(False))
        known = s["due"].isNotNull() & s["deduct"].isNotNull()
        provision = F.when(known, F.when(full, F.lit(0.0)).otherwise(F.greatest(s["due"] - s["deduct"], F.lit(0.0))))
        used = F.when(full, F.lit(0.0)).otherwise(F.least(s["due"], s["deduct"]))
        balance = acc["b"] + F.coalesce(provision, F.lit(0.0))
        now = F.struct(
            s["y"].alias("y"), provision.alias("provision"), F.when(known, s["deduct"] - used).alias("left"), balance.alias("balance")
        )
        return F.struct(balance.alias("b"), F.concat(acc["hist"], F.array(now)).alias("hist")).cast(state)

    folded = series.select(entity, F.aggregate("steps", start, close)["hist"].alias("hist"))
    return folded.select(entity, F.inline("hist")).withColumnRenamed("y", year)


def strengthening_reserve(
    mean_denominator: Column, benchmark: Column, current: Column, fixed_left: Column, capital_raised: Column
) -> Column:
    """Year-mean denominator times the shortfall of the hedge ratio times the designated cost,
    less the deductions. The shortfall is benchmark minus current, floored at zero.

    Null without a denominator, a benchmark, a current ratio or the remainder of the deduction; capital that is not
    reported was not raised."""
    num = lambda c: c.cast("double")
    gap = num(benchmark) - num(current)
    gap = F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))
    due = num(mean_denominator) * gap * DESIGNATED_COST - num(fixed_left) - F.coalesce(num(capital_raised), F.lit(0.0))
    return F.when(due.isNotNull(), F.greatest(due, F.lit(0.0)))


def reserve_chain(months: DataFrame, years: DataFrame, entity: str, month: str, year: str) -> DataFrame:
    """The year close: months of `reserve_scan`, then the special reserve, then the strengthening reserve.

    `years` has one row per (entity, year): profit, cap_after_tax, opening, after_tax (the share left after tax),
    mean_denominator, benchmark, current_ratio, capital_raised. The after-tax fixed provision of a year first reduces
    the special reserve; what it leaves reduces the strengthening reserve. A year with a month whose exposure is
    missing is closed with what is known, and counted in `months_missing`; a year without months has no deduction.
    """
    added = months.groupBy(entity, F.year(month).alias(year)).agg(
        F.sum("fixed_provision").alias("added"), F.sum(F.col("no_exposure").cast("long")).alias("months_missing")
    )
    fed = years.join(added, [entity, year], "left").withColumn("deduction", F.col("added") * F.col("after_tax"))
    closed = _special_years(fed, entity, year, "profit", "deduction", "cap_after_tax", "opening")
    out = fed.join(closed, [entity, year])
    due = strengthening_reserve(*[F.col(c) for c in ("mean_denominator", "benchmark", "current_ratio", "left", "capital_raised")])
    return out.select(entity, year, "deduction", "provision", "left", "balance", due.alias("due"), "months_missing")
