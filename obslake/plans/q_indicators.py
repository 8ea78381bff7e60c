"""Queries on indicators, reserves and publication."""

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.numbers import MONEY
from ..operators import flows, indicators as ind, provenance as prov, reserves as rs
from ..operators.aggregates import percentile_benchmark, year_mean_of
from ..sources import sinks
from ..sources.append import read_bucketed
from .proxies import AMOUNT, PANEL_SQL, monthly_by, monthly_sql, panel
from .registry import query

PROV = ("vintage", "retrieved_at", "basis", "sources")


def dbl(c):
    return F.col(c).cast("double").alias(c)


def r6(c, name):
    return F.round(c, 6).alias(name)


@query(
    "ind_economic_ratio",
    f"""WITH {PANEL_SQL}
SELECT entity, obs_month, round(CAST(hedges + policy AS DOUBLE) / CAST(assets AS DOUBLE), 6) AS value, vintage, retrieved_at, basis, sources FROM panel""",
)
def ind_economic_ratio(t):
    v = ind.economic_hedge_ratio(F.col("hedges"), F.col("policy"), F.col("assets"))
    return panel(t).select("entity", "obs_month", r6(v, "value"), *PROV)


@query(
    "ind_sector_ratio",
    f"""WITH {PANEL_SQL}
SELECT obs_month, round(CAST(sum(hedges + policy) AS DOUBLE) / CAST(sum(assets) AS DOUBLE), 6) AS value,
  max(vintage) AS vintage, max(retrieved_at) AS retrieved_at,
  CASE WHEN bool_or(basis = 'estimated') THEN 'estimated' ELSE 'disclosed' END AS basis,
  (SELECT string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) FROM lineitem
   WHERE CAST(date_trunc('month', l_shipdate) AS DATE) = panel.obs_month) AS sources
FROM panel GROUP BY obs_month""",
)
def ind_sector_ratio(t):
    """Asset-weighted sector figure from the entity panel, with the provenance of all its legs."""
    s = panel(t).groupBy("obs_month").agg(
        *[F.sum(c).alias(c) for c in ("hedges", "policy", "assets")], *ind.carried_provenance()
    )
    v = ind.economic_hedge_ratio(F.col("hedges"), F.col("policy"), F.col("assets"))
    return s.select("obs_month", r6(v, "value"), *PROV)


@query(
    "ind_gross_ratio",
    f"""WITH {PANEL_SQL}
SELECT entity, obs_month, round(CAST(hedges AS DOUBLE) / CAST(assets AS DOUBLE), 6) AS value, vintage, retrieved_at, basis, sources FROM panel""",
)
def ind_gross_ratio(t):
    v = ind.gross_hedge_ratio(F.col("hedges"), F.col("assets"))
    return panel(t).select("entity", "obs_month", r6(v, "value"), *PROV)


@query(
    "ind_regulatory_ratio",
    f"""WITH {PANEL_SQL}
SELECT entity, obs_month, round(CAST(hedges AS DOUBLE) / nullif(CAST(assets - policy - unhedged_equity AS DOUBLE), 0), 6) AS value,
  CAST(assets - policy - unhedged_equity - hedges AS DOUBLE) AS net_exposure,
  CAST(assets - (assets - policy - unhedged_equity) AS DOUBLE) AS policy_backed_assets,
  round(CAST(hedges AS DOUBLE) / nullif(CAST(assets - policy - unhedged_equity AS DOUBLE), 0)
    + CAST(reserve AS DOUBLE) / nullif(CAST(assets - policy - unhedged_equity - hedges AS DOUBLE), 0), 6) AS effective_memo,
  vintage, retrieved_at, basis, sources FROM panel""",
)
def ind_regulatory_ratio(t):
    a, p, u, h = (F.col(c) for c in ("assets", "policy", "unhedged_equity", "hedges"))
    v = ind.regulatory_hedge_ratio(h, a, p, u)
    x = ind.net_exposure(a, p, u, h)
    return panel(t).select(
        "entity",
        "obs_month",
        r6(v, "value"),
        x.cast("double").alias("net_exposure"),
        ind.policy_backed_assets(a, a - p - u).cast("double").alias("policy_backed_assets"),
        r6(ind.effective_ratio(v, F.col("reserve"), x), "effective_memo"),
        *PROV,
    )


@query(
    "ind_net_open_units",
    f"""WITH {PANEL_SQL}, {monthly_sql('nation')},
q AS (
  SELECT entity, CAST(date_trunc('quarter', obs_month) AS DATE) AS obs_quarter, sum(value) AS v FROM monthly GROUP BY 1, 2),
g AS (
  SELECT entity, obs_quarter, CASE WHEN count(*) OVER w = 4 THEN CAST(sum(v) OVER w AS DOUBLE) END AS gdp
  FROM q WINDOW w AS (PARTITION BY entity ORDER BY year(obs_quarter) * 4 + quarter(obs_quarter) RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)),
f AS (
  SELECT p.*, last_value(g.gdp IGNORE NULLS) OVER (PARTITION BY p.entity ORDER BY obs_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gdp,
    CAST(30 + month(obs_month) / 10.0 AS DOUBLE) AS rate, CAST(assets - policy - hedges AS DOUBLE) AS open
  FROM panel p LEFT JOIN g ON g.entity = p.entity AND g.obs_quarter = CAST(date_trunc('quarter', p.obs_month) AS DATE)),
u AS (
  SELECT entity, obs_month, 'ntd_mn' AS unit, open AS value, vintage, retrieved_at, basis, sources FROM f
  UNION ALL SELECT entity, obs_month, 'usd_mn', open / rate, vintage, retrieved_at, basis, sources FROM f
  UNION ALL SELECT entity, obs_month, 'pct_gdp', open / gdp * 100, vintage, retrieved_at, basis, sources FROM f
  UNION ALL SELECT entity, obs_month, 'pct_assets', open / nullif(CAST(assets AS DOUBLE), 0) * 100, vintage, retrieved_at, basis, sources FROM f
  UNION ALL SELECT entity, obs_month, 'x_capital', open / nullif(CAST(equity AS DOUBLE), 0), vintage, retrieved_at, basis, sources FROM f)
SELECT entity, obs_month, 'net_open.' || unit AS series_key, unit, round(value, 6) AS value, vintage, retrieved_at, basis, sources FROM u WHERE value IS NOT NULL""",
)
def ind_net_open_units(t):
    gdp = flows.four_quarter_sum(monthly_by(t, "nation"), ["entity"], "obs_month", "value", MONEY).select(
        F.col("entity").alias("_e"), "obs_quarter", F.col("four_quarter_sum").alias("_g")
    )
    p = panel(t)
    # the quarterly denominator of a month is that of its quarter, or the latest one before it
    j = p.join(gdp, (p.entity == F.col("_e")) & (F.col("obs_quarter") == F.trunc("obs_month", "quarter")), "left")
    w = W.partitionBy("entity").orderBy("obs_month").rowsBetween(W.unboundedPreceding, W.currentRow)
    j = j.withColumn("gdp", F.last("_g", ignorenulls=True).over(w))
    op = ind.net_open_position(F.col("assets"), F.col("policy"), F.col("hedges"))
    rate = F.lit(30.0) + F.month("obs_month") / F.lit(10.0)
    units = {
        "ntd_mn": op,
        "usd_mn": op.cast("double") / rate,
        "pct_gdp": ind.ratio(op, F.col("gdp")) * 100,
        "pct_assets": ind.ratio(op, F.col("assets")) * 100,
        "x_capital": ind.ratio(op, F.col("equity")),
    }
    out = ind.unit_rows(j, ["entity", "obs_month", *PROV], "net_open", units)
    return out.withColumn("value", F.round("value", 6))


@query(
    "ind_buffer_tiers",
    f"""WITH {PANEL_SQL}, x AS (
  SELECT entity, obs_month, vintage, retrieved_at, basis, sources, CAST(assets - policy - hedges AS DOUBLE) AS open, CAST(reserve AS DOUBLE) AS r, CAST(equity AS DOUBLE) AS e,
    CAST(swap_cost AS DOUBLE) AS sf, CAST(unhedged_equity AS DOUBLE) AS st, CAST(policy AS DOUBLE) AS memo,
    CAST(reserve + equity AS DOUBLE) AS re, CAST(reserve + swap_cost AS DOUBLE) AS rsf FROM panel),
u AS (
  SELECT entity, obs_month, vintage, retrieved_at, basis, sources, open, 'a' AS tier, CASE WHEN obs_month < DATE '1999-01-01' THEN 'v1' ELSE 'v2' END AS definition_version, r AS amount, TRUE AS loss_absorbing FROM x
  UNION ALL SELECT entity, obs_month, vintage, retrieved_at, basis, sources, open, 'b', 'v1', re, TRUE FROM x WHERE obs_month < DATE '1999-01-01'
  UNION ALL SELECT entity, obs_month, vintage, retrieved_at, basis, sources, open, 'b', 'v2', rsf, TRUE FROM x WHERE obs_month >= DATE '1999-01-01'
  UNION ALL SELECT entity, obs_month, vintage, retrieved_at, basis, sources, open, 'c_restricted', 'v2', st, FALSE FROM x WHERE obs_month >= DATE '1999-01-01'
  UNION ALL SELECT entity, obs_month, vintage, retrieved_at, basis, sources, open, 'd_memo', 'v2', memo, FALSE FROM x WHERE obs_month >= DATE '1999-01-01')
SELECT entity, obs_month, vintage, retrieved_at, basis, sources, tier, definition_version, amount, loss_absorbing, round(amount / nullif(open, 0), 6) AS share_of_exposure,
  CASE WHEN loss_absorbing THEN round(amount / nullif(open, 0) * 100, 6) END AS absorbable_pct FROM u""",
)
def ind_buffer_tiers(t):
    p = panel(t)
    out = ind.buffer_tiers(
        p,
        ["entity", "obs_month", *PROV],
        "obs_month",
        ind.net_open_position(F.col("assets"), F.col("policy"), F.col("hedges")),
        F.col("reserve"),
        F.col("equity"),
        F.col("swap_cost"),
        F.col("unhedged_equity"),
        F.col("policy"),
        F.to_date(F.lit("1999-01-01")),
    )
    return out.withColumn("share_of_exposure", F.round("share_of_exposure", 6)).withColumn(
        "absorbable_pct", F.round("absorbable_pct", 6)
    )


PARTS = ("CS", "NDF", "proxy", "fx_policy", "open")
PART_COLUMNS = ("hedges", "swap_cost", "unhedged_equity", "policy", "reserve")


@query(
    "ind_composition",
    f"""WITH {PANEL_SQL}, u AS (
  {" UNION ALL ".join(f"SELECT entity, obs_month, vintage, retrieved_at, basis, sources, '{p}' AS instrument, CAST({c} AS DECIMAL(24,6)) AS amount FROM panel" for p, c in zip(PARTS, PART_COLUMNS))})
SELECT entity, obs_month, vintage, retrieved_at, basis, sources, instrument, CAST(amount AS DOUBLE) AS amount,
  round(CAST(amount AS DOUBLE) / nullif(CAST(sum(amount) OVER (PARTITION BY entity, obs_month) AS DOUBLE), 0), 6) AS share FROM u""",
)
def ind_composition(t):
    wide = panel(t).select("entity", "obs_month", *PROV, *[F.col(c).alias(p) for p, c in zip(PARTS, PART_COLUMNS)])
    long = wide.unpivot(["entity", "obs_month", *PROV], list(PARTS), "instrument", "amount")
    out = ind.composition_shares(long, ["entity", "obs_month"], "instrument", "amount")
    return out.select("entity", "obs_month", *PROV, "instrument", dbl("amount"), r6(F.col("share"), "share"))


@query(
    "ind_cost_spread",
    f"""WITH {PANEL_SQL}, m AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS obs_month, CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS implied
  FROM lineitem GROUP BY 1)
SELECT entity, p.obs_month, round(CAST(swap_cost AS DOUBLE) / nullif(CAST(assets AS DOUBLE), 0) * 10000, 4) AS reported_bp, round(implied * 10000, 4) AS implied_bp,
  round(CAST(swap_cost AS DOUBLE) / nullif(CAST(assets AS DOUBLE), 0) * 10000 - implied * 10000, 4) AS spread_bp, vintage, retrieved_at, basis, sources FROM panel p JOIN m ON m.obs_month = p.obs_month""",
)
def ind_cost_spread(t):
    market = t.lineitem.groupBy(cal.month_start(F.col("l_shipdate")).alias("obs_month")).agg(
        (F.sum(F.col("l_discount").cast("decimal(4,2)")).cast("double") / F.count(F.lit(1))).alias("implied")
    )
    reported = ind.ratio(F.col("swap_cost"), F.col("assets")) * 10000
    implied = F.col("implied") * 10000
    return panel(t).join(market, "obs_month").select(
        "entity", "obs_month", F.round(reported, 4).alias("reported_bp"), F.round(implied, 4).alias("implied_bp"),
        F.round(reported - implied, 4).alias("spread_bp"), *PROV,
    )


@query(
    "ind_residual",
    f"""WITH {PANEL_SQL}
SELECT entity, obs_month, CAST(hedges - policy - reserve AS DOUBLE) AS value, vintage, retrieved_at,
  CASE WHEN obs_month < DATE '1997-01-01' OR basis = 'estimated' THEN 'estimated' ELSE 'disclosed' END AS basis,
  array_to_string(list_sort(list_distinct(list_append(string_split(sources, '; '), 'swap book'))), '; ') AS sources FROM panel""",
)
def ind_residual(t):
    v = ind.residual(F.col("hedges"), F.col("policy"), F.col("reserve"))
    swap_book = F.when(F.col("obs_month") < F.to_date(F.lit("1997-01-01")), "estimated").otherwise("disclosed")
    legs = prov.merge(prov.of_columns(), prov.leg(basis=swap_book, sources=F.lit("swap book")))
    return panel(t).select("entity", "obs_month", v.cast("double").alias("value"), *prov.told(legs))


@query(
    "ind_flow_diag",
    f"""WITH {PANEL_SQL}, l AS (
  SELECT entity, obs_month, 'bonds' AS flow_code, assets AS v, vintage, retrieved_at, basis, sources FROM panel
  UNION ALL SELECT entity, obs_month, 'premiums', policy, vintage, retrieved_at, basis, sources FROM panel UNION ALL SELECT entity, obs_month, 'debt', hedges, vintage, retrieved_at, basis, sources FROM panel),
y AS (
  SELECT *, sum(v) OVER w AS ytd, month(obs_month) - coalesce(month(lag(obs_month) OVER w), 0) AS span
  FROM l WINDOW w AS (PARTITION BY entity, flow_code, year(obs_month) ORDER BY obs_month)),
f AS (SELECT *, CASE WHEN span = 1 THEN v END AS flow FROM y)
SELECT entity, obs_month, flow_code, vintage, retrieved_at, basis, sources, CAST(ytd AS DOUBLE) AS ytd, CAST(flow AS DOUBLE) AS flow,
  CAST(sum(flow) OVER (PARTITION BY entity, flow_code ORDER BY year(obs_month) * 12 + month(obs_month) RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS roll_12
FROM f""",
)
def ind_flow_diag(t):
    wide = panel(t).select(
        "entity", "obs_month", *PROV, F.col("assets").alias("bonds"), F.col("policy").alias("premiums"), F.col("hedges").alias("debt")
    )
    long = wide.unpivot(["entity", "obs_month", *PROV], ["bonds", "premiums", "debt"], "flow_code", "v")
    keys = ["entity", "flow_code"]
    published = flows.flow_to_ytd(long, keys, "obs_month", "v", AMOUNT).drop("v")
    out = flows.ytd_to_flow(published, keys, "obs_month", "ytd")
    out = flows.rolling_sum(out, keys, "obs_month", "flow", 12, AMOUNT)
    return out.select("entity", "obs_month", "flow_code", *PROV, dbl("ytd"), dbl("flow"), dbl("roll_12"))


@query(
    "ind_hedging_result",
    f"""WITH {PANEL_SQL}, i AS (SELECT *, CASE WHEN basis = 'disclosed' OR month(obs_month) > 3 THEN hedges END AS instrument FROM panel)
SELECT entity, obs_month, CAST(instrument - swap_cost AS DOUBLE) AS value, instrument IS NOT NULL AS split_available, vintage, retrieved_at, basis, sources FROM i""",
)
def ind_hedging_result(t):
    instrument = F.when((F.col("basis") == "disclosed") | (F.month("obs_month") > 3), F.col("hedges"))
    return panel(t).select(
        "entity",
        "obs_month",
        ind.hedging_result(instrument, -F.col("swap_cost")).cast("double").alias("value"),
        (instrument.isNotNull() & F.col("swap_cost").isNotNull()).alias("split_available"),
        *PROV,
    )


@query(
    "ind_stressed",
    f"""WITH {PANEL_SQL}
SELECT entity, obs_month, CAST(h AS DOUBLE) AS haircut,
  round(CAST(hedges + policy * (1 - CAST(h AS DECIMAL(5,4))) AS DOUBLE) / CAST(assets AS DOUBLE), 6) AS economic_ratio,
  CAST(assets - policy * (1 - CAST(h AS DECIMAL(5,4))) - hedges AS DOUBLE) AS net_open, vintage, retrieved_at, basis, sources
FROM panel, (SELECT unnest([0.0, 0.1, 0.25, 0.5]) AS h)""",
)
def ind_stressed(t):
    haircuts = F.array(*[F.lit(x).cast("decimal(5,4)") for x in ("0", "0.1", "0.25", "0.5")])
    s = panel(t).withColumn("haircut", F.explode(haircuts))
    pol = ind.stressed(F.col("policy"), F.col("haircut"))
    return s.select(
        "entity",
        "obs_month",
        dbl("haircut"),
        r6(ind.economic_hedge_ratio(F.col("hedges"), pol, F.col("assets")), "economic_ratio"),
        ind.net_open_position(F.col("assets"), pol, F.col("hedges")).cast("double").alias("net_open"),
        *PROV,
    )


RATIO_SQL = f"""{PANEL_SQL}, r AS (
  SELECT entity, obs_month, CAST(assets - policy - unhedged_equity AS DECIMAL(24,6)) AS den,
    CAST(hedges AS DOUBLE) / nullif(CAST(assets - policy - unhedged_equity AS DOUBLE), 0) AS ratio, vintage AS v, retrieved_at AS ra, basis AS ba,
    string_split(sources, '; ') AS so FROM panel),
b AS (SELECT entity, quantile_cont(ratio, 0.9) AS benchmark, max(v) AS bv, max(ra) AS bra, bool_or(ba = 'estimated') AS be, flatten(list(so)) AS bso FROM r WHERE obs_month BETWEEN DATE '1996-01-01' AND DATE '1998-12-01' GROUP BY 1),
y AS (
  SELECT entity, CAST(year(obs_month) AS INTEGER) AS year, CAST(sum(CAST(ratio AS DECIMAL(20,12))) AS DOUBLE) / count(ratio) AS current_ratio,
    CAST(sum(den) AS DOUBLE) / count(den) AS mean_denominator, max(v) AS yv, max(ra) AS yra, bool_or(ba = 'estimated') AS ye, flatten(list(so)) AS yso
  FROM r GROUP BY 1, 2)"""
RATIO_PROV_SQL = """greatest(yv, bv) AS vintage, greatest(yra, bra) AS retrieved_at,
  CASE WHEN ye OR coalesce(be, false) THEN 'estimated' ELSE 'disclosed' END AS basis,
  array_to_string(list_sort(list_distinct(list_concat(yso, coalesce(bso, [])))), '; ') AS sources"""


def _ratio_years(t):
    p = panel(t)
    den = (F.col("assets") - F.col("policy") - F.col("unhedged_equity")).cast(AMOUNT)
    r = p.select(
        "entity", "obs_month", den.alias("den"),
        ind.regulatory_hedge_ratio(F.col("hedges"), F.col("assets"), F.col("policy"), F.col("unhedged_equity")).alias("ratio"),
        prov.of_columns().alias("prov"),
    ).withColumn("ratio_d", F.col("ratio").cast("decimal(20,12)"))
    bench = percentile_benchmark(r, ["entity"], "obs_month", "ratio", "1996-01-01", "1998-12-01").drop("n_months")
    years = r.groupBy("entity", F.year("obs_month").alias("year")).agg(
        year_mean_of("ratio_d").alias("current_ratio"), year_mean_of("den").alias("mean_denominator"), prov.merge_rows("prov").alias("prov")
    )
    base = r.filter(F.col("obs_month").between("1996-01-01", "1998-12-01")).groupBy("entity").agg(prov.merge_rows("prov").alias("bench_prov"))
    both = years.join(bench, "entity", "left").join(base, "entity", "left")
    return both.withColumn("prov", prov.merge(F.col("prov"), F.col("bench_prov"))).drop("bench_prov")


@query(
    "ind_ratio_differential",
    f"""WITH {RATIO_SQL}
SELECT entity, year, round(benchmark, 6) AS benchmark, round(current_ratio, 6) AS current_ratio, CASE WHEN benchmark - current_ratio IS NOT NULL
  THEN round(greatest(benchmark - current_ratio, 0.0), 6) END AS differential, {RATIO_PROV_SQL}
FROM y LEFT JOIN b USING (entity)""",
)
def ind_ratio_differential(t):
    gap = F.col("benchmark") - F.col("current_ratio")
    return _ratio_years(t).select(
        "entity", "year", r6(F.col("benchmark"), "benchmark"), r6(F.col("current_ratio"), "current_ratio"),
        r6(F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0))), "differential"), *prov.told("prov"),
    )


@query(
    "ind_strengthening_reserve",
    f"""WITH {RATIO_SQL}
SELECT entity, year, round(greatest(mean_denominator * greatest(benchmark - current_ratio, 0.0) * 0.025 - 1000.0, 0.0), 4) AS due, {RATIO_PROV_SQL}
FROM y LEFT JOIN b USING (entity)""",
)
def ind_strengthening_reserve(t):
    due = rs.strengthening_reserve(
        F.col("mean_denominator"), F.col("benchmark"), F.col("current_ratio"), F.lit(1000.0), F.lit(0.0)
    )
    return _ratio_years(t).select("entity", "year", F.round(due, 4).alias("due"), *prov.told("prov"))


RESERVE_SQL = f"""{monthly_sql('nation')}, m AS (
  SELECT entity, obs_month, CAST(value - lag(value) OVER (PARTITION BY entity ORDER BY obs_month) AS DOUBLE) AS gain,
    CAST(value AS DOUBLE) AS exposure, CASE WHEN CAST(replace(entity, 'NATION_', '') AS INTEGER) % 2 = 0 THEN '50' ELSE '100' END AS cls,
    (month(obs_month) - 6.5) / 1000 AS cost_diff, row_number() OVER (PARTITION BY entity ORDER BY obs_month) AS i FROM monthly),
d AS (
  SELECT entity, obs_month, i, exposure, CASE WHEN cls = '50' THEN 0.0005 ELSE 0.001 END::DOUBLE AS rate,
    gain * CASE WHEN cls = '50' THEN 0.5 ELSE 1.0 END
      + CASE WHEN cls = '50' THEN -exposure * CAST(cost_diff AS DOUBLE) / 12.0 * 0.25 ELSE 0.0 END AS delta FROM m)"""


def reserve_inputs(t):
    m = monthly_by(t, "nation")
    w = W.partitionBy("entity").orderBy("obs_month")
    number = F.regexp_replace("entity", "NATION_", "").cast("int")
    cls = F.when(number % 2 == 0, "50").otherwise("100")
    cost_diff = (F.month("obs_month") - F.lit(6.5)) / 1000
    g = m.withColumn("gain", F.col("value") - F.lag("value").over(w)).withColumn("cls", cls)
    return g.select(
        "entity",
        "obs_month",
        rs.volatility_delta(F.col("gain"), F.col("cls"), F.col("value"), cost_diff).alias("delta"),
        F.col("value").alias("exposure"),
        F.when(F.col("cls") == "50", rs.FIXED_RATES["50"]).otherwise(rs.FIXED_RATES["100"]).alias("rate"),
        F.lit(0.0).alias("v0"),
        F.lit(0.0).alias("f0"),
    )


@query(
    "reserve_rollforward",
    f"""WITH RECURSIVE {RESERVE_SQL},
s AS (
  SELECT entity, CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS vol, CAST(0 AS DOUBLE) AS fix, CAST(0 AS DOUBLE) AS unc FROM (SELECT DISTINCT entity FROM d)
  UNION ALL
  SELECT d.entity, d.i, greatest(vol + coalesce(delta, 0.0), 0.0),
    least(greatest(fix + greatest(exposure, 0.0) * rate - greatest(-(vol + coalesce(delta, 0.0)), 0.0), 0.0), greatest(exposure, 0.0) * 0.1),
    greatest(greatest(-(vol + coalesce(delta, 0.0)), 0.0) - (fix + greatest(exposure, 0.0) * rate), 0.0)
  FROM s JOIN d ON d.entity = s.entity AND d.i = s.i + 1)
SELECT d.entity, d.obs_month, round(vol, 2) AS volatility, round(fix, 2) AS fixed, round(unc, 2) AS uncovered
FROM s JOIN d ON d.entity = s.entity AND d.i = s.i""",
)
def reserve_rollforward(t):
    out = rs.reserve_rollforward(reserve_inputs(t), "entity", "obs_month", "delta", "exposure", "rate", "v0", "f0")
    return out.select(
        "entity", "obs_month", *[F.round(c, 2).alias(c) for c in ("volatility", "fixed", "uncovered")]
    )


@query(
    "ind_special_reserve",
    f"""WITH RECURSIVE {monthly_sql('nation')}, yy AS (
  SELECT entity, CAST(year(obs_month) AS INTEGER) AS year, CAST(sum(value) AS DOUBLE) AS tot FROM monthly GROUP BY 1, 2),
y AS (
  SELECT entity, year, tot - coalesce(lag(tot) OVER w, 0.0) AS profit, tot * 0.0005 * 0.8 AS deduct, tot * 0.01 AS cap,
    row_number() OVER w AS i FROM yy WINDOW w AS (PARTITION BY entity ORDER BY year)),
s AS (
  SELECT entity, CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS prov, CAST(0 AS DOUBLE) AS bal FROM (SELECT DISTINCT entity FROM y)
  UNION ALL
  SELECT y.entity, y.i, CASE WHEN bal >= cap * 2 THEN 0.0 ELSE greatest(greatest(profit, 0.0) * 0.1 - deduct, 0.0) END,
    bal + CASE WHEN bal >= cap * 2 THEN 0.0 ELSE greatest(greatest(profit, 0.0) * 0.1 - deduct, 0.0) END
  FROM s JOIN y ON y.entity = s.entity AND y.i = s.i + 1)
SELECT y.entity, y.year, round(prov, 2) AS provision, round(bal, 2) AS balance FROM s JOIN y ON y.entity = s.entity AND y.i = s.i""",
)
def ind_special_reserve(t):
    y = monthly_by(t, "nation").groupBy("entity", F.year("obs_month").alias("year")).agg(F.sum("value").cast("double").alias("tot"))
    w = W.partitionBy("entity").orderBy("year")
    y = y.select(
        "entity",
        "year",
        (F.col("tot") - F.coalesce(F.lag("tot").over(w), F.lit(0.0))).alias("profit"),
        (F.col("tot") * 0.0005 * 0.8).alias("deduct"),
        (F.col("tot") * 0.01).alias("cap"),
        F.lit(0.0).alias("b0"),
    )
    out = rs.special_reserve_fixed(y, "entity", "year", "profit", "deduct", "cap", "b0")
    return out.select("entity", "year", F.round("provision", 2).alias("provision"), F.round("balance", 2).alias("balance"))


@query(
    "frame_export",
    f"""WITH {monthly_sql('nation')}
SELECT entity, count(*) AS n_points, '{{"index":[' || string_agg('"' || obs_month || '"', ',' ORDER BY obs_month) || '],"columns":{{"value":['
  || string_agg(CAST(value AS VARCHAR), ',' ORDER BY obs_month) || ']}}}}' AS frame FROM monthly GROUP BY 1""",
)
def frame_export(t):
    return sinks.frame_export(monthly_by(t, "nation"), "entity", F.col("obs_month"), F.col("value"))


@query(
    "derived_series",
    f"""WITH {PANEL_SQL}, e AS (
  SELECT 'ratio.economic' AS series_key, entity AS entity_id, obs_month AS obs_date, round(CAST(hedges + policy AS DOUBLE) / CAST(assets AS DOUBLE), 6) AS value,
    'ratio' AS unit, basis, sources AS source_doc, retrieved_at, vintage FROM panel
  UNION ALL
  SELECT 'residual', entity, obs_month, round(CAST(hedges - policy - reserve AS DOUBLE), 6), 'amount',
    CASE WHEN obs_month < DATE '1997-01-01' OR basis = 'estimated' THEN 'estimated' ELSE 'disclosed' END,
    array_to_string(list_sort(list_distinct(list_append(string_split(sources, '; '), 'swap book'))), '; '), retrieved_at, vintage FROM panel
  UNION ALL
  SELECT 'ratio.sector', NULL, obs_month, round(CAST(sum(hedges + policy) AS DOUBLE) / CAST(sum(assets) AS DOUBLE), 6), 'ratio',
    CASE WHEN bool_or(basis = 'estimated') THEN 'estimated' ELSE 'disclosed' END,
    array_to_string(list_sort(list_distinct(flatten(list(string_split(sources, '; '))))), '; '), max(retrieved_at), max(vintage) FROM panel GROUP BY obs_month)
SELECT series_key, entity_id, obs_date, value, unit, 'v1' AS definition_version, basis, source_doc, CAST(retrieved_at AS DATE) AS retrieved_at, vintage, 'run-1' AS run_id FROM e""",
)
def derived_series(t):
    """Three series with the provenance of all their legs, published by two runs; the second adds no row."""
    p = panel(t).withColumn("prov", prov.of_columns())
    early = F.when(F.col("obs_month") < F.to_date(F.lit("1997-01-01")), "estimated").otherwise("disclosed")
    entity = p.select(
        F.lit("ratio.economic").alias("series_key"), F.col("entity").alias("entity_id"), "obs_month", F.lit("ratio").alias("unit"), "prov",
        ind.economic_hedge_ratio(F.col("hedges"), F.col("policy"), F.col("assets")).alias("value"),
    )
    rest = p.select(
        F.lit("residual").alias("series_key"), F.col("entity").alias("entity_id"), "obs_month", F.lit("amount").alias("unit"),
        prov.merge(F.col("prov"), prov.leg(basis=early, sources=F.lit("swap book"))).alias("prov"),
        ind.residual(F.col("hedges"), F.col("policy"), F.col("reserve")).cast("double").alias("value"),
    )
    sums = p.groupBy("obs_month").agg(*[F.sum(c).alias(c) for c in ("hedges", "policy", "assets")], prov.merge_rows("prov").alias("prov"))
    sector = sums.select(
        F.lit("ratio.sector").alias("series_key"), F.lit(None).cast("string").alias("entity_id"), "obs_month", F.lit("ratio").alias("unit"), "prov",
        ind.economic_hedge_ratio(F.col("hedges"), F.col("policy"), F.col("assets")).alias("value"),
    )
    every = entity.unionByName(rest).unionByName(sector)
    rows = every.select("series_key", "entity_id", F.col("obs_month").alias("obs_date"), "unit", r6(F.col("value"), "value"), *prov.told("prov"))
    table = f"derived_{uuid.uuid4().hex}"
    for run in ("run-1", "run-2"):
        out = sinks.common_schema(rows.withColumnRenamed("sources", "source_doc"), freq="M", definition_version="v1", run_id=run)
        sinks.publish(out, table, 8)
    told = read_bucketed(t._spark, table).withColumn("retrieved_at", F.col("retrieved_at").cast("date"))
    return told.select("series_key", "entity_id", "obs_date", "value", "unit", "definition_version", "basis", "source_doc", "retrieved_at", "vintage", "run_id")
