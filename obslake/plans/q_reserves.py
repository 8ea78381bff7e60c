"""Queries on the scan of reserve balances and the year close."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import reserves as rs
from .proxies import monthly_by, panel
from .q_indicators import RATIO_SQL, RESERVE_SQL, _ratio_years, reserve_inputs
from .registry import query

# Gaps as they occur: a month is not published, a change or an exposure is missing. Amounts are whole numbers here, so
# that sums do not depend on how they are bracketed.
GAPS_SQL = f"""{RESERVE_SQL}, x AS (
  SELECT entity, obs_month, row_number() OVER (PARTITION BY entity ORDER BY obs_month) AS i, rate,
    CASE WHEN month(obs_month) <> 8 THEN round(delta) END AS delta,
    CASE WHEN month(obs_month) <> 5 THEN round(exposure / 2000) * 2000 END AS exposure
  FROM d WHERE month(obs_month) <> 11),
p AS (SELECT *, coalesce(delta, 0.0) AS dd, CASE WHEN exposure IS NULL THEN 0.0 ELSE greatest(exposure, 0.0) * rate END AS prov,
    CASE WHEN exposure IS NULL THEN CAST('infinity' AS DOUBLE) ELSE greatest(exposure, 0.0) * 0.1 END AS cap FROM x),
s AS (
  SELECT entity, CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS v0, CAST(0 AS DOUBLE) AS f0, CAST(0 AS DOUBLE) AS vol, CAST(0 AS DOUBLE) AS fix
  FROM (SELECT DISTINCT entity FROM p)
  UNION ALL
  SELECT p.entity, p.i, vol, fix, greatest(vol + dd, 0.0), least(greatest(fix + prov - greatest(-dd - vol, 0.0), 0.0), cap)
  FROM s JOIN p ON p.entity = s.entity AND p.i = s.i + 1),
bal AS (
  SELECT p.entity, p.obs_month, greatest(dd, 0.0) AS provision, least(greatest(-dd, 0.0), v0) AS off_set, vol AS volatility,
    greatest(greatest(-dd, 0.0) - v0, 0.0) AS shortfall, prov AS fixed_provision, f0, fix AS fixed, cap, delta IS NULL AS no_delta, exposure IS NULL AS no_exposure,
    coalesce(datediff('month', lag(p.obs_month) OVER (PARTITION BY p.entity ORDER BY p.obs_month), p.obs_month) - 1, 0) AS months_skipped
  FROM s JOIN p ON p.entity = s.entity AND p.i = s.i)"""


def _with_gaps(t):
    m = F.month("obs_month")
    d = reserve_inputs(t).where(m != 11)
    return d.withColumns({
        "delta": F.when(m != 8, F.round("delta")), "exposure": F.when(m != 5, F.round(F.col("exposure").cast("double") / 2000) * 2000)
    })


def _scanned(t):
    return rs.reserve_scan(_with_gaps(t), "entity", "obs_month", "delta", "exposure", "rate", "v0", "f0")


@query(
    "reserve_scan",
    f"""WITH RECURSIVE {GAPS_SQL}
SELECT entity, obs_month, round(provision, 2) AS provision, round(off_set, 2) AS "offset", round(volatility, 2) AS volatility,
  round(shortfall, 2) AS shortfall, round(fixed_provision, 2) AS fixed_provision, round(least(shortfall, f0 + fixed_provision), 2) AS draw,
  round(fixed, 2) AS fixed, f0 + fixed_provision - shortfall > cap AS cap_hit, round(greatest(shortfall - f0 - fixed_provision, 0.0), 2) AS uncovered,
  no_delta, no_exposure, CAST(months_skipped AS INTEGER) AS months_skipped
FROM bal""",
)
def reserve_scan(t):
    """Balances and what moved them, over months with missing inputs and missing rows."""
    amounts = ("provision", "offset", "volatility", "shortfall", "fixed_provision", "draw", "fixed", "uncovered")
    return _scanned(t).withColumns({c: F.round(c, 2) for c in amounts})


@query(
    "reserve_chain",
    f"""WITH RECURSIVE {GAPS_SQL}, {RATIO_SQL},
tax AS (SELECT entity, CAST(year(obs_month) AS INTEGER) AS year, 1 - CAST(sum(swap_cost) AS DOUBLE) / CAST(sum(assets) AS DOUBLE) AS after_tax FROM panel GROUP BY 1, 2),
yy AS (
  SELECT entity, CAST(year(obs_month) AS INTEGER) AS year, CAST(sum(value) AS DOUBLE) AS tot, CAST(max_by(value, obs_month) AS DOUBLE) AS last_value
  FROM monthly GROUP BY 1, 2),
a AS (
  SELECT entity, CAST(year(obs_month) AS INTEGER) AS year, sum(fixed_provision) AS added, CAST(sum(CAST(no_exposure AS INTEGER)) AS BIGINT) AS months_missing
  FROM bal GROUP BY 1, 2),
n AS (
  SELECT yy.entity, yy.year, tot - lag(tot) OVER w AS profit, last_value * 0.1 * after_tax AS cap_at, added * after_tax AS deduction, months_missing,
    row_number() OVER w AS i FROM yy LEFT JOIN tax USING (entity, year) LEFT JOIN a USING (entity, year) WINDOW w AS (PARTITION BY yy.entity ORDER BY yy.year)),
q AS (SELECT *, CASE WHEN profit IS NOT NULL THEN greatest(profit, 0.0) * 0.1 END AS owed FROM n),
c AS (
  SELECT entity, CAST(0 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS provision, CAST(NULL AS DOUBLE) AS remainder, CAST(0 AS DOUBLE) AS balance
  FROM (SELECT DISTINCT entity FROM q)
  UNION ALL
  SELECT q.entity, q.i,
    CASE WHEN owed IS NOT NULL AND deduction IS NOT NULL THEN CASE WHEN balance >= cap_at * 2 THEN 0.0 ELSE greatest(owed - deduction, 0.0) END END,
    CASE WHEN owed IS NOT NULL AND deduction IS NOT NULL THEN deduction - CASE WHEN balance >= cap_at * 2 THEN 0.0 ELSE least(owed, deduction) END END,
    balance + CASE WHEN owed IS NULL OR deduction IS NULL OR balance >= cap_at * 2 THEN 0.0 ELSE greatest(owed - deduction, 0.0) END
  FROM c JOIN q ON q.entity = c.entity AND q.i = c.i + 1)
SELECT q.entity, q.year, round(deduction, 2) AS deduction, round(provision, 2) AS provision, round(remainder, 2) AS "left", round(balance, 2) AS balance,
  CASE WHEN mean_denominator * (benchmark - current_ratio) - remainder IS NOT NULL
    THEN round(greatest(mean_denominator * greatest(benchmark - current_ratio, 0.0) * 0.025 - remainder, 0.0), 2) END AS due, months_missing
FROM q JOIN c ON q.entity = c.entity AND q.i = c.i LEFT JOIN y ON y.entity = q.entity AND y.year = q.year
LEFT JOIN (SELECT * FROM b WHERE entity NOT LIKE '%7') b ON b.entity = q.entity""",
)
def reserve_chain(t):
    """Months close into years: what the special reserve leaves of the deduction reduces the strengthening reserve."""
    w = W.partitionBy("entity").orderBy("year")
    years = monthly_by(t, "nation").groupBy("entity", F.year("obs_month").alias("year")).agg(
        F.sum("value").cast("double").alias("tot"), F.max_by("value", "obs_month").cast("double").alias("last_value")
    )
    tax = panel(t).groupBy("entity", F.year("obs_month").alias("year")).agg(
        (1 - F.sum("swap_cost").cast("double") / F.sum("assets").cast("double")).alias("after_tax")
    )
    # some entities have no benchmark
    ratios = _ratio_years(t).withColumn("benchmark", F.when(~F.col("entity").endswith("7"), F.col("benchmark")))
    years = years.withColumn("profit", F.col("tot") - F.lag("tot").over(w)).join(tax, ["entity", "year"], "left").join(ratios, ["entity", "year"], "left")
    years = years.withColumns({
        "cap_after_tax": F.col("last_value") * rs.FIXED_CAP * F.col("after_tax"), "opening": F.lit(0.0), "capital_raised": F.lit(None).cast("double"),
    })
    out = rs.reserve_chain(_scanned(t), years, "entity", "obs_month", "year")
    return out.withColumns({c: F.round(c, 2) for c in ("deduction", "provision", "left", "balance", "due")})
