"""Queries on period series."""

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.numbers import MONEY, money
from ..operators import flows, indicators
from ..operators.aggregates import (
    month_mean_vs_history as mean_vs_history,
    percentile_benchmark as p90_benchmark,
    regression_backfill as backfill,
    year_mean as mean_of_year,
)
from ..operators.ordered import carry_last, top_per_key
from ..operators.reconcile import Check, reconcile
from .proxies import monthly_by, monthly_sql
from .registry import query


def _dbl(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


@query(
    "flow_to_ytd",
    f"""WITH {monthly_sql('nation')}
SELECT entity, obs_month, CAST(value AS DOUBLE) AS value,
  CAST(sum(value) OVER (PARTITION BY entity, year(obs_month) ORDER BY obs_month) AS DOUBLE) AS ytd FROM monthly""",
)
def flow_to_ytd(t):
    m = monthly_by(t, "nation").drop("n_orders")
    return _dbl(flows.flow_to_ytd(m, ["entity"], "obs_month", "value", MONEY), "value", "ytd")


@query(
    "ytd_to_flow",
    f"""WITH {monthly_sql('customer')}, y AS (
  SELECT entity, obs_month, CAST(sum(value) OVER (PARTITION BY entity, year(obs_month) ORDER BY obs_month) AS DECIMAL(20,4)) AS ytd
  FROM monthly),
d AS (
  SELECT *, lag(ytd) OVER w AS prev, lag(obs_month) OVER w AS prev_month
  FROM y WINDOW w AS (PARTITION BY entity, year(obs_month) ORDER BY obs_month)),
s AS (
  SELECT *, CAST(CASE WHEN prev_month IS NULL THEN month(obs_month)
                 ELSE month(obs_month) - month(prev_month) END AS INTEGER) AS months_covered FROM d)
SELECT entity, obs_month, CAST(ytd AS DOUBLE) AS ytd, months_covered,
  CAST(CASE WHEN months_covered = 1 THEN ytd - coalesce(prev, 0) END AS DOUBLE) AS flow FROM s""",
)
def ytd_to_flow(t):
    m = flows.flow_to_ytd(monthly_by(t, "customer"), ["entity"], "obs_month", "value", MONEY)
    return _dbl(flows.ytd_to_flow(m.select("entity", "obs_month", "ytd"), ["entity"], "obs_month", "ytd"), "ytd", "flow")


@query(
    "rolling_12m",
    f"""WITH {monthly_sql('customer')}
SELECT entity, obs_month, CAST(value AS DOUBLE) AS value,
  CAST(sum(value) OVER (w RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS roll_3,
  count(value) OVER (w RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS n_3,
  CAST(sum(value) OVER (w RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS roll_12,
  count(value) OVER (w RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS n_12
FROM monthly WINDOW w AS (PARTITION BY entity ORDER BY year(obs_month) * 12 + month(obs_month))""",
)
def rolling_12m(t):
    m = monthly_by(t, "customer").drop("n_orders")
    for k in (3, 12):
        m = flows.rolling_sum(m, ["entity"], "obs_month", "value", k, MONEY)
    return _dbl(m, "value", "roll_3", "roll_12")


@query(
    "change_vs_year_end",
    f"""WITH {monthly_sql('customer')}
SELECT m.entity, m.obs_month, CAST(m.value AS DOUBLE) AS value,
  CAST(m.value - p.value AS DOUBLE) AS change_prior_month,
  CAST(m.value - y.value AS DOUBLE) AS change_prior_year_end
FROM monthly m
LEFT JOIN monthly p ON p.entity = m.entity AND p.obs_month = m.obs_month - INTERVAL 1 MONTH
LEFT JOIN monthly y ON y.entity = m.entity AND y.obs_month = make_date(year(m.obs_month) - 1, 12, 1)""",
)
def change_vs_year_end(t):
    m = monthly_by(t, "customer").drop("n_orders")
    return _dbl(
        flows.change_vs_year_end(m, ["entity"], "obs_month", "value"),
        "value", "change_prior_month", "change_prior_year_end",
    )


@query(
    "four_quarter_sum",
    f"""WITH {monthly_sql('customer')}, q AS (
  SELECT entity, CAST(date_trunc('quarter', obs_month) AS DATE) AS obs_quarter, sum(value) AS quarter_value
  FROM monthly GROUP BY 1, 2)
SELECT entity, obs_quarter, CAST(quarter_value AS DOUBLE) AS quarter_value,
  CAST(CASE WHEN count(*) OVER w = 4 THEN sum(quarter_value) OVER w END AS DOUBLE) AS four_quarter_sum
FROM q WINDOW w AS (PARTITION BY entity ORDER BY year(obs_quarter) * 4 + quarter(obs_quarter)
                    RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)""",
)
def four_quarter_sum(t):
    return _dbl(
        flows.four_quarter_sum(monthly_by(t, "customer"), ["entity"], "obs_month", "value", MONEY),
        "quarter_value", "four_quarter_sum",
    )


@query(
    "coverage_gaps",
    f"""WITH {monthly_sql('customer')}
SELECT entity, min(obs_month) AS first_period, max(obs_month) AS last_period, count(*) AS present,
  datediff('month', min(obs_month), max(obs_month)) + 1 AS expected,
  datediff('month', min(obs_month), max(obs_month)) + 1 - count(*) AS missing
FROM monthly GROUP BY 1""",
)
def coverage_gaps(t):
    return flows.coverage(monthly_by(t, "customer"), ["entity"], "obs_month")


@query(
    "missing_periods",
    f"""WITH {monthly_sql('customer')}, spine AS (
  SELECT entity, CAST(unnest(generate_series(min(obs_month), max(obs_month), INTERVAL 1 MONTH)) AS DATE) AS missing_period
  FROM monthly GROUP BY 1)
SELECT entity, missing_period FROM spine s WHERE NOT EXISTS (
  SELECT 1 FROM monthly m WHERE m.entity = s.entity AND m.obs_month = s.missing_period)""",
)
def missing_periods(t):
    return flows.missing_periods(monthly_by(t, "customer"), ["entity"], "obs_month")


@query(
    "splice_cutover",
    f"""WITH {monthly_sql('nation')}, parts AS (
  SELECT entity, CAST(date_trunc('quarter', obs_month) AS DATE) AS obs_date, 'Q' AS freq,
         sum(value) AS value, 'estimated' AS source_basis FROM monthly GROUP BY 1, 2
  HAVING CAST(date_trunc('quarter', any_value(obs_month)) AS DATE) < DATE '1998-01-01'
  UNION ALL
  SELECT entity, obs_month, 'M', value, 'disclosed' FROM monthly WHERE obs_month >= DATE '1998-01-01')
SELECT entity, obs_date, freq, CAST(value AS DOUBLE) AS value, source_basis,
  CASE WHEN min(source_basis) OVER (PARTITION BY entity) <> max(source_basis) OVER (PARTITION BY entity)
       THEN 'spliced' ELSE source_basis END AS basis FROM parts""",
)
def splice_cutover(t):
    m = monthly_by(t, "nation")
    sparse = (
        m.groupBy("entity", cal.quarter_start(F.col("obs_month")).alias("obs_date"))
        .agg(F.lit("Q").alias("freq"), F.sum("value").cast(MONEY).alias("value"), F.lit("estimated").alias("basis"))
    )
    dense = m.select(
        "entity", F.col("obs_month").alias("obs_date"), F.lit("M").alias("freq"), "value", F.lit("disclosed").alias("basis")
    )
    return _dbl(flows.splice(sparse, dense, ["entity"], "obs_date", F.to_date(F.lit("1998-01-01"))), "value")


@query(
    "period_end_pick",
    """SELECT user_id, CAST(ts AS DATE) AS obs_period, arg_max(value, ts) AS closing_value, arg_max(event_id, ts) AS event_id
FROM events GROUP BY 1, 2""",
)
def period_end_pick(t):
    e = t.events.withColumn("v", F.struct("value", "event_id"))
    day = F.col("ts").cast("date")
    out = flows.period_end_pick(e, ["user_id"], "ts", "v", day, ["event_id"])
    return out.select("user_id", "obs_period", F.col("closing_value.value").alias("closing_value"), F.col("closing_value.event_id"))


@query(
    "forward_fill",
    """WITH f AS (
  SELECT event_id, user_id, event_type,
    last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS last_event_id,
    last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER w AS last_value
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT * FROM f""",
)
def forward_fill(t):
    e = t.events.select("event_id", "user_id", "event_type", "ts", "value")
    filled = carry_last(
        e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", ["event_id", "value"],
        F.date_trunc("hour", F.col("ts")),
    )
    return filled.select("event_id", "user_id", "event_type", "last_event_id", "last_value")


@query(
    "newest_first",
    """SELECT c_custkey, max(CAST(o_orderdate AS DATE)) AS last_period FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY 1 ORDER BY last_period DESC NULLS LAST, c_custkey""",
)
def newest_first(t):
    last = t.orders.groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("last_period"))
    return (
        t.customer.select("c_custkey").join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", "last_period").orderBy(F.col("last_period").desc_nulls_last(), "c_custkey")
    )


@query(
    "newest_n",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS obs_date, o_orderstatus FROM orders
ORDER BY obs_date DESC NULLS LAST, o_orderkey LIMIT 25""",
)
def newest_n(t):
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("obs_date"), "o_orderstatus")
    return o.orderBy(F.col("obs_date").desc_nulls_last(), "o_orderkey").limit(25)


PERIOD_LABELS_SQL = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS obs_date FROM orders)
SELECT obs_date,
  CAST(round(year(obs_date) + (quarter(obs_date) - 1) / 4.0, 6) AS DOUBLE) AS x_quarter,
  CAST(round(year(obs_date) + (month(obs_date) - 1) / 12.0, 6) AS DOUBLE) AS x_month,
  CAST(year(obs_date) AS VARCHAR) AS label_year,
  CAST(quarter(obs_date) AS VARCHAR) || 'Q' || strftime(obs_date, '%y') AS label_quarter,
  strftime(obs_date, '%b-%y') AS label_month,
  strftime(obs_date, '%-d-%b-%y') AS label_day FROM d"""


@query("period_labels", PERIOD_LABELS_SQL)
def period_labels(t):
    d = t.orders.select(F.col("o_orderdate").cast("date").alias("obs_date")).distinct()
    c = F.col("obs_date")
    return d.select(
        "obs_date",
        F.round(cal.axis_position(c, "Q"), 6).alias("x_quarter"),
        F.round(cal.axis_position(c, "M"), 6).alias("x_month"),
        cal.period_label(c, "A").alias("label_year"),
        cal.period_label(c, "Q").alias("label_quarter"),
        cal.period_label(c, "M").alias("label_month"),
        cal.period_label(c, "D").alias("label_day"),
    )


@query(
    "roc_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) - 1911 AS INTEGER) AS roc_year,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month FROM orders""",
)
def roc_month(t):
    y = F.year("o_orderdate") - 1911
    return t.orders.select(
        "o_orderkey", y.alias("roc_year"), cal.roc_month(y, F.month("o_orderdate")).alias("obs_month")
    )


@query(
    "id_prefix_date",
    """SELECT o_orderkey, o_orderstatus = 'P' AS from_id, CAST(o_orderdate AS DATE) AS published FROM orders""",
)
def id_prefix_date(t):
    doc_id = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    printed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return t.orders.select(
        "o_orderkey", printed.isNull().alias("from_id"), F.coalesce(printed, cal.id_date(doc_id)).alias("published")
    )


@query(
    "year_mean",
    f"""WITH {monthly_sql('segment')}
SELECT entity, CAST(year(obs_month) AS INTEGER) AS year, round(CAST(sum(value) AS DOUBLE) / count(*), 4) AS year_mean,
  count(*) AS n_months FROM monthly GROUP BY 1, 2""",
)
def year_mean(t):
    return mean_of_year(monthly_by(t, "segment"), ["entity"], "obs_month", "value").withColumn(
        "year_mean", F.round("year_mean", 4)
    )


@query(
    "percentile_benchmark",
    f"""WITH {monthly_sql('segment')}
SELECT entity, round(quantile_cont(CAST(value AS DOUBLE), 0.9), 4) AS benchmark, count(*) AS n_months
FROM monthly WHERE obs_month BETWEEN DATE '1996-01-01' AND DATE '2000-12-01' GROUP BY 1""",
)
def percentile_benchmark(t):
    b = p90_benchmark(monthly_by(t, "segment"), ["entity"], "obs_month", "value", "1996-01-01", "2000-12-01")
    return b.withColumn("benchmark", F.round("benchmark", 4))


@query(
    "month_mean_vs_history",
    """WITH daily AS (
  SELECT o_orderpriority AS entity, CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS v
  FROM orders GROUP BY 1, 2),
m AS (
  SELECT entity, CAST(date_trunc('month', d) AS DATE) AS obs_month, sum(v) AS s, count(*) AS n FROM daily GROUP BY 1, 2),
h AS (
  SELECT a.entity, a.obs_month, sum(b.s) AS hs, sum(b.n) AS hn FROM m a
  LEFT JOIN m b ON b.entity = a.entity AND b.obs_month <= make_date(year(a.obs_month) - 1, 11, 1) GROUP BY 1, 2)
SELECT m.entity, m.obs_month, round(CAST(s AS DOUBLE) / n, 4) AS month_mean,
  round(CAST(hs AS DOUBLE) / CAST(hn AS DOUBLE), 4) AS history_mean,
  round(CAST(s AS DOUBLE) / n - CAST(hs AS DOUBLE) / CAST(hn AS DOUBLE), 4) AS difference
FROM m JOIN h USING (entity, obs_month)""",
)
def month_mean_vs_history(t):
    daily = t.orders.groupBy(
        F.col("o_orderpriority").alias("entity"), F.col("o_orderdate").cast("date").alias("d")
    ).agg(F.sum(money(F.col("o_totalprice"))).cast(MONEY).alias("v"))
    out = mean_vs_history(daily, ["entity"], "d", "v")
    for c in ("month_mean", "history_mean", "difference"):
        out = out.withColumn(c, F.round(c, 4))
    return out


@query(
    "regression_backfill",
    f"""WITH {monthly_sql('nation')}, x AS (
  SELECT entity, obs_month, CAST(n_orders AS DOUBLE) AS x, CAST(value AS DOUBLE) AS v,
    CASE WHEN obs_month >= DATE '1997-01-01' THEN CAST(value AS DOUBLE) END AS y FROM monthly),
f AS (
  SELECT entity, regr_count(y, x) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
    regr_avgx(y, x) AS mx, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
  FROM x GROUP BY 1),
e AS (
  SELECT x.entity, obs_month, y, a + b * x AS est,
    1.96 * sqrt((syy - b * sxy) / (n - 2) * (1 + 1.0 / n + (x - mx) * (x - mx) / sxx)) AS half
  FROM x JOIN f USING (entity))
SELECT entity, obs_month, round(coalesce(y, est), 0) AS value,
  CASE WHEN y IS NULL THEN 'estimated' ELSE 'disclosed' END AS basis,
  CASE WHEN y IS NULL THEN round(est - half, 0) END AS ci_low,
  CASE WHEN y IS NULL THEN round(est + half, 0) END AS ci_high FROM e""",
)
def regression_backfill(t):
    m = monthly_by(t, "nation").select(
        "entity",
        "obs_month",
        F.col("n_orders").cast("double").alias("x"),
        F.when(F.col("obs_month") >= F.to_date(F.lit("1997-01-01")), F.col("value").cast("double")).alias("y"),
    )
    out = backfill(m, ["entity"], "y", "x")
    return out.select(
        "entity", "obs_month", F.round("value", 0).alias("value"), "basis",
        F.round("ci_low", 0).alias("ci_low"), F.round("ci_high", 0).alias("ci_high"),
    )


@query(
    "composition_shares",
    f"""WITH {monthly_sql('priority')}
SELECT entity AS part, obs_month, round(CAST(value AS DOUBLE) / CAST(sum(value) OVER (PARTITION BY obs_month) AS DOUBLE), 8) AS share
FROM monthly""",
)
def composition_shares(t):
    m = monthly_by(t, "priority")
    out = indicators.composition_shares(m, ["obs_month"], "entity", "value")
    return out.select(F.col("entity").alias("part"), "obs_month", F.round("share", 8).alias("share"))


@query(
    "weighted_avg",
    """SELECT l_returnflag, l_linestatus,
  round(CAST(sum(CAST(l_discount AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE)
      / CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE), 8) AS weighted_discount, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2""",
)
def weighted_avg(t):
    d, w = F.col("l_discount").cast("decimal(4,2)"), money(F.col("l_extendedprice"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(indicators.weighted_average(d, w), 8).alias("weighted_discount"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "topk_weighted",
    """WITH c AS (
  SELECT c_nationkey, c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS bal, sum(CAST(o_totalprice AS DECIMAL(20,4))) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
r AS (
  SELECT r_name, c.* FROM c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  QUALIFY row_number() OVER (PARTITION BY r_name ORDER BY total DESC, c_custkey) <= 6)
SELECT r_name AS region, round(CAST(sum(bal * CAST(total AS DECIMAL(20,4))) AS DOUBLE) / CAST(sum(total) AS DOUBLE), 6) AS weighted_balance,
  CAST(sum(total) AS DOUBLE) AS top_total, count(*) AS n_entities FROM r GROUP BY 1""",
)
def topk_weighted(t):
    per = t.orders.groupBy("o_custkey").agg(F.sum(money(F.col("o_totalprice"))).cast(MONEY).alias("total"))
    placed = (
        per.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("region"), "c_custkey", F.col("c_acctbal").cast("decimal(12,2)").alias("bal"), "total")
    )
    top = top_per_key(placed, ["region"], [F.col("total").desc(), F.col("c_custkey")], 6)
    return top.groupBy("region").agg(
        F.round(indicators.weighted_average(F.col("bal"), F.col("total")), 6).alias("weighted_balance"),
        F.sum("total").cast("double").alias("top_total"),
        F.count(F.lit(1)).alias("n_entities"),
    )


@query(
    "parts_vs_total",
    """WITH leaf AS (
  SELECT c_mktsegment AS segment, o_orderstatus AS status, sum(CAST(o_totalprice AS DECIMAL(20,4))) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT segment, status, CAST(grouping_id(segment, status) AS BIGINT) AS level, CAST(sum(v) AS DOUBLE) AS value, count(*) AS n_parts
FROM leaf GROUP BY ROLLUP (segment, status)""",
)
def parts_vs_total(t):
    per = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.sum(money(F.col("o_totalprice"))).alias("v"))
    leaf = (
        per.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), F.col("o_orderstatus").alias("status"))
        .agg(F.sum("v").cast(MONEY).alias("v"))
    )
    return leaf.rollup("segment", "status").agg(
        F.grouping_id().alias("level"), F.sum("v").cast("double").alias("value"), F.count(F.lit(1)).alias("n_parts")
    )


@query(
    "parts_sum_check",
    """WITH leaf AS (
  SELECT c_mktsegment AS segment, o_orderstatus AS status, sum(CAST(o_totalprice AS DECIMAL(20,4))) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
w AS (
  SELECT segment, sum(v) FILTER (status = 'F') AS f, sum(v) FILTER (status = 'O') AS o, sum(v) FILTER (status = 'P') AS p,
    sum(v) AS total FROM leaf GROUP BY 1)
SELECT segment, 'F + O + P = total' AS check_name, CAST(f + o + p AS DOUBLE) AS lhs, CAST(total AS DOUBLE) AS rhs,
  CAST(0.03 AS DOUBLE) AS tolerance, CAST(0 AS DOUBLE) AS rel_error, TRUE AS passed, 'amount' AS unit
FROM w WHERE f + o + p IS NOT NULL""",
)
def parts_sum_check(t):
    per = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.sum(money(F.col("o_totalprice"))).alias("v"))
    wide = (
        per.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(
            *[F.sum(F.when(F.col("o_orderstatus") == s, F.col("v"))).cast(MONEY).alias(s) for s in "FOP"],
            F.sum("v").cast(MONEY).alias("total"),
        )
    )
    check = Check("F + O + P = total", F.col("F") + F.col("O") + F.col("P"), F.col("total"), unit="amount")
    return reconcile(wide, [check], ["segment"])
