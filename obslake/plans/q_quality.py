"""Queries on reconciliation, gates and expectations."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..functions.facts import warnings_array
from ..functions.numbers import MONEY, money
from ..operators import quality as q
from ..operators.reconcile import Check, reconcile as run_checks, run_gate as gate_of
from ..operators.vintages import latest_vintage
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from ..sources.append import log_run, read_bucketed, run_log_frames, source_status
from .proxies import CHANNELS_SQL, channel_a, channel_b
from .q_joins import PANEL_TOTAL_SQL, panel_and_total
from .registry import query


def order_checks(t):
    """Order totals against line sums, and against a line count times a price level."""
    a = channel_a(t).select("order_key", F.col("value").alias("total"))
    b = channel_b(t).select("order_key", F.col("value").alias("lines"), "n_lines")
    j = a.join(b, "order_key", "left")
    checks = [
        Check("lines = total", F.col("lines"), F.col("total"), unit="amount"),
        Check("lines = total (rounding)", F.col("lines"), F.col("total"), abs_tolerance=15000.0, unit="amount"),
        Check("total = 38000 x lines", F.col("total"), F.col("n_lines") * 38000, tolerance=0.05, unit="amount"),
    ]
    return run_checks(j, checks, ["order_key"])


ORDER_CHECKS_SQL = f"""{CHANNELS_SQL},
j AS (
  SELECT order_key, CAST(a.value AS DOUBLE) AS total, CAST(b.value AS DOUBLE) AS lines, CAST(n_lines * 38000 AS DOUBLE) AS level
  FROM channel_a a LEFT JOIN channel_b b USING (order_key)),
c AS (
  SELECT order_key, 'lines = total' AS check_name, lines AS lhs, total AS rhs, CAST(0.03 AS DOUBLE) AS tolerance, CAST(0 AS DOUBLE) AS abs_tol FROM j
  UNION ALL SELECT order_key, 'lines = total (rounding)', lines, total, 0.03, 15000 FROM j
  UNION ALL SELECT order_key, 'total = 38000 x lines', total, level, 0.05, 0 FROM j),
checks AS (
  SELECT order_key, check_name, lhs, rhs, tolerance,
    round(abs(lhs - rhs) / CASE WHEN rhs <> 0 THEN abs(rhs) ELSE 1 END, 6) AS rel_error,
    abs(lhs - rhs) / CASE WHEN rhs <> 0 THEN abs(rhs) ELSE 1 END <= tolerance OR abs(lhs - rhs) <= abs_tol AS passed,
    'amount' AS unit
  FROM c WHERE lhs IS NOT NULL AND rhs IS NOT NULL)"""


@query("reconcile", f"WITH {ORDER_CHECKS_SQL} SELECT * FROM checks")
def reconcile(t):
    return order_checks(t)


@query(
    "reconcile_abs",
    f"""WITH {PANEL_TOTAL_SQL}
SELECT obs_month, panel AS lhs, total AS rhs, abs(panel - total) AS abs_error,
  abs(panel - total) / total <= 0.001 OR abs(panel - total) <= 2000000 AS passed FROM t""",
)
def reconcile_abs(t):
    check = Check("panel = total (rounding)", F.col("panel"), F.col("total"), tolerance=0.001, abs_tolerance=2_000_000.0)
    out = run_checks(panel_and_total(t), [check], ["obs_month"])
    return out.select("obs_month", "lhs", "rhs", F.abs(F.col("lhs") - F.col("rhs")).alias("abs_error"), "passed")


@query(
    "reconcile_pp",
    """WITH s AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS obs_month,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) FILTER (l_returnflag = 'R') AS DOUBLE) / CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE) AS a,
    CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) / count(*) AS b FROM lineitem GROUP BY 1)
SELECT obs_month, round(a, 6) AS lhs, round(b, 6) AS rhs, abs(a - b) <= 0.01 AS passed FROM s
WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def reconcile_pp(t):
    r = F.col("l_returnflag") == "R"
    p = money(F.col("l_extendedprice"))
    s = t.lineitem.groupBy(month_start(F.col("l_shipdate")).alias("obs_month")).agg(
        (F.sum(F.when(r, p)).cast("double") / F.sum(p).cast("double")).alias("a"),
        (F.count_if(r).cast("double") / F.count(F.lit(1))).alias("b"),
    )
    check = Check("value share = count share", F.col("a"), F.col("b"), abs_tolerance=0.01, relative=False)
    out = run_checks(s, [check], ["obs_month"])
    return out.select("obs_month", F.round("lhs", 6).alias("lhs"), F.round("rhs", 6).alias("rhs"), "passed")


@query(
    "parts_identity",
    """WITH p AS (
  SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(20,4)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS x
  FROM lineitem),
o AS (
  SELECT l_orderkey, CAST(sum(CAST(p - p * d + p * x AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS parts, CAST(sum(p) AS DECIMAL(24,6)) AS whole FROM p GROUP BY 1)
SELECT l_orderkey, CAST(parts AS DOUBLE) AS lhs, CAST(whole AS DOUBLE) AS rhs,
  round(abs(CAST(parts AS DOUBLE) - CAST(whole AS DOUBLE)) / CAST(whole AS DOUBLE), 6) AS rel_error,
  abs(CAST(parts AS DOUBLE) - CAST(whole AS DOUBLE)) / CAST(whole AS DOUBLE) <= 0.03 AS passed FROM o""",
)
def parts_identity(t):
    p, d, x = money(F.col("l_extendedprice")), F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    o = t.lineitem.groupBy("l_orderkey").agg(
        F.sum((p - p * d + p * x).cast("decimal(24,6)")).cast("decimal(24,6)").alias("parts"),
        F.sum(p).cast("decimal(24,6)").alias("whole"),
    )
    out = run_checks(o, [Check("price - discount + tax = price", F.col("parts"), F.col("whole"))], ["l_orderkey"])
    return out.select("l_orderkey", "lhs", "rhs", "rel_error", "passed")


def admitted(t):
    """Source status of every document: admitted or not."""
    return t.documents.select(F.col("doc_id"), (F.octet_length("text") > 200).alias("ok"))


GATE_SQL = """SELECT count(*) AS checks_total, count(*) FILTER (NOT passed) AS checks_failed,
  max(rel_error) AS worst_rel_error, arg_max(check_name, (rel_error, check_name)) AS worst_check,
  (SELECT count(*) FILTER (NOT octet_length(encode(text)) > 200) FROM documents) AS verifications_failed"""


@query(
    "run_gate",
    f"""WITH {ORDER_CHECKS_SQL}, g AS ({GATE_SQL} FROM checks)
SELECT *, CASE WHEN checks_failed > 0 OR verifications_failed > 0 THEN 'fail' ELSE 'ok' END AS status FROM g""",
)
def run_gate(t):
    return gate_of(order_checks(t), admitted(t))


@query(
    "run_report",
    f"""WITH {ORDER_CHECKS_SQL}, g AS ({GATE_SQL} FROM checks),
per AS (SELECT check_name, count(*) FILTER (NOT passed) AS failed FROM checks GROUP BY 1),
cov AS (SELECT count(*) AS n_rows, min(CAST(o_orderdate AS DATE)) AS first_period, max(CAST(o_orderdate AS DATE)) AS last_period FROM orders)
SELECT 'run-1' AS run_id, g.*, CASE WHEN checks_failed > 0 OR verifications_failed > 0 THEN 'fail' ELSE 'ok' END AS status,
  n_rows, first_period, last_period,
  (SELECT string_agg(check_name || '=' || failed, '; ' ORDER BY check_name) FROM per) AS failed_by_check
FROM g, cov""",
)
def run_report(t):
    checks = order_checks(t)
    rows = t.orders.select(F.col("o_orderdate").cast("date").alias("obs_date"))
    rep = sinks.run_report("run-1", gate_of(checks, admitted(t)), checks, rows, "obs_date")
    listed = F.array_join(
        F.transform("checks", lambda c: F.concat(c["check_name"], F.lit("="), c["checks_failed"].cast("string"))), "; "
    )
    return rep.withColumn("failed_by_check", listed).drop("checks")


@query(
    "run_summary",
    """SELECT count(*) FILTER (event_type <> 'error') AS sources_ok, count(*) AS sources_total,
  count(*) FILTER (value > 300) AS checks_failed, count(value) AS checks_total,
  CASE WHEN count(*) FILTER (value > 300) > 0 THEN 'fail' ELSE 'ok' END AS status FROM events""",
)
def run_summary(t):
    e = t.events
    out = e.agg(
        F.count_if(F.col("event_type") != "error").alias("sources_ok"),
        F.count(F.lit(1)).alias("sources_total"),
        F.count_if(F.col("value") > 300).alias("checks_failed"),
        F.count("value").alias("checks_total"),
    )
    return out.withColumn("status", F.when(F.col("checks_failed") > 0, "fail").otherwise("ok"))


@query(
    "by_tier",
    """SELECT event_type AS tier, CAST(ts AS DATE) AS day, count(*) FILTER (value >= 10) AS reachable, count(*) AS probed
FROM events GROUP BY 1, 2""",
)
def by_tier(t):
    return t.events.groupBy(F.col("event_type").alias("tier"), F.col("ts").cast("date").alias("day")).agg(
        F.count_if(F.col("value") >= 10).alias("reachable"), F.count(F.lit(1)).alias("probed")
    )


@query(
    "row_warnings",
    """SELECT o_orderkey, concat_ws('; ',
  CASE WHEN o_totalprice > 400000 THEN 'large total' END,
  CASE WHEN o_orderstatus = 'P' THEN 'partial' END,
  CASE WHEN o_orderpriority LIKE '1-%' THEN 'urgent' END) AS warnings,
  CAST((o_totalprice > 400000)::INT + (o_orderstatus = 'P')::INT + (o_orderpriority LIKE '1-%')::INT AS INTEGER) AS n_warnings
FROM orders""",
)
def row_warnings(t):
    w = warnings_array(
        [
            (F.col("o_totalprice") > 400000, "large total"),
            (F.col("o_orderstatus") == "P", "partial"),
            (F.col("o_orderpriority").startswith("1-"), "urgent"),
        ]
    )
    return t.orders.select("o_orderkey", F.array_join(w, "; ").alias("warnings"), F.size(w).alias("n_warnings"))


@query(
    "warnings_by_period",
    """WITH w AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month, unnest([
    CASE WHEN o_totalprice > 400000 THEN 'large total' END, CASE WHEN o_orderstatus = 'P' THEN 'partial' END]) AS warning FROM orders)
SELECT obs_month, warning, count(*) AS n FROM w WHERE warning IS NOT NULL GROUP BY 1, 2""",
)
def warnings_by_period(t):
    w = warnings_array([(F.col("o_totalprice") > 400000, "large total"), (F.col("o_orderstatus") == "P", "partial")])
    long = t.orders.select(month_start(F.col("o_orderdate")).alias("obs_month"), F.explode(w).alias("warning"))
    return long.groupBy("obs_month", "warning").agg(F.count(F.lit(1)).alias("n"))


EXPECTATIONS = {
    "orders": [
        ("o_custkey_not_null", "o_custkey IS NOT NULL"),
        ("o_orderstatus_domain", "o_orderstatus IN ('F', 'O')"),
        ("o_totalprice_range", "o_totalprice BETWEEN 0 AND 450000"),
    ],
    "lineitem": [
        ("l_returnflag_domain", "l_returnflag IN ('A', 'N', 'R')"),
        ("l_discount_range", "l_discount BETWEEN 0 AND 0.08"),
        ("tax_only_with_discount", "l_discount > 0 OR l_tax = 0"),
    ],
    "events": [("value_range", "value BETWEEN 0 AND 300"), ("props_not_null", "props IS NOT NULL")],
}


@query(
    "expectations",
    "\nUNION ALL ".join(
        f"SELECT '{tab}' AS table_name, '{n}' AS expectation, count(*) AS n_rows, "
        f"count(*) FILTER (NOT ({p})) AS n_violations, count(*) FILTER (NOT ({p})) = 0 AS passed FROM {tab}"
        for tab, es in EXPECTATIONS.items() for n, p in es
    ),
)
def expectations(t):
    specs = {
        "orders": [q.not_null("o_custkey"), q.in_domain("o_orderstatus", "F", "O"), q.in_range("o_totalprice", 0, 450000)],
        "lineitem": [
            q.in_domain("l_returnflag", "A", "N", "R"),
            q.in_range("l_discount", 0, 0.08),
            q.cross_column("tax_only_with_discount", (F.col("l_discount") > 0) | (F.col("l_tax") == 0)),
        ],
        "events": [q.in_range("value", 0, 300), q.not_null("props")],
    }
    reports = [q.expectation_report(getattr(t, name), es, name) for name, es in specs.items()]
    return reduce(lambda a, b: a.unionByName(b), reports)


@query(
    "expectation_violations",
    """SELECT l_orderkey, l_linenumber, expectation, count(*) AS n FROM (
  SELECT l_orderkey, l_linenumber, unnest([
    CASE WHEN NOT (l_discount BETWEEN 0 AND 0.08) THEN 'l_discount_range' END,
    CASE WHEN NOT (l_discount > 0 OR l_tax = 0) THEN 'tax_only_with_discount' END]) AS expectation FROM lineitem)
WHERE expectation IS NOT NULL GROUP BY 1, 2, 3""",
)
def expectation_violations(t):
    es = [
        q.in_range("l_discount", 0, 0.08),
        q.cross_column("tax_only_with_discount", (F.col("l_discount") > 0) | (F.col("l_tax") == 0)),
    ]
    v = q.violations(t.lineitem, es, ["l_orderkey", "l_linenumber"])
    return v.groupBy("l_orderkey", "l_linenumber", "expectation").agg(F.count(F.lit(1)).alias("n"))


PANEL_TIE_SQL = f"""WITH {CHANNELS_SQL}, lv AS (
  SELECT l_orderkey, l_extendedprice AS value FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) = 1),
lines AS (SELECT l_orderkey, CAST(sum(CAST(value AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS lines FROM lv GROUP BY 1),
m AS (
  SELECT n_name AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month,
    CAST(sum(lines) AS DOUBLE) AS panel, CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DOUBLE) AS total
  FROM orders JOIN lines ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)
SELECT entity, obs_month, panel AS lhs, total AS rhs, round(abs(panel - total) / total, 6) AS rel_error,
  abs(panel - total) / total <= 0.03 AS passed FROM m"""


@query("panel_tie", PANEL_TIE_SQL)
def panel_checks(t):
    """Latest vintage of every line, summed per nation and month, against the reported totals."""
    line = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    latest = latest_vintage(line, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_extendedprice", "l_partkey"])
    per_order = latest.groupBy("l_orderkey").agg(F.sum(money(F.col("l_extendedprice"))).cast(MONEY).alias("lines"))
    o = t.orders.select(
        "o_orderkey", "o_custkey", month_start(F.col("o_orderdate")).alias("obs_month"), money(F.col("o_totalprice")).alias("v")
    )
    per_cust = (
        o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", "obs_month")
        .agg(F.sum("lines").alias("lines"), F.sum("v").alias("v"))
    )
    m = (
        per_cust.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("entity"), "obs_month")
        .agg(F.sum("lines").cast(MONEY).alias("panel"), F.sum("v").cast(MONEY).alias("total"))
    )
    out = run_checks(m, [Check("panel = total", F.col("panel"), F.col("total"), unit="amount")], ["entity", "obs_month"])
    return out.select("entity", "obs_month", "lhs", "rhs", "rel_error", "passed")


@query(
    "run_log_append",
    f"""WITH {PANEL_TOTAL_SQL}
SELECT CASE WHEN year(obs_month) < 1998 THEN 'run-1' ELSE 'run-2' END AS run_id, 'panel = total' AS check_name, obs_month, panel AS lhs, total AS rhs,
  abs(panel - total) / total <= 0.05 AS passed
FROM t WHERE panel IS NOT NULL AND total IS NOT NULL""",
)
def run_log_append(t):
    """Two runs log one check for many months, each run twice; the log holds every month once."""
    spark, prefix = t._spark, f"log_{uuid.uuid4().hex}"
    check = Check("panel = total", F.col("panel"), F.col("total"), tolerance=0.05, unit="amount")
    ensure_checkpoint_dir(spark)
    checks = run_checks(panel_and_total(t), [check], ["obs_month"]).checkpoint()
    early = F.year("obs_month") < 1998
    seen = checks.select(F.concat(F.lit("month:"), "obs_month").alias("url"), F.lit("panel").alias("doc"), F.lit(1).alias("attempt"), "passed")
    sources = source_status(seen, "url", "doc", F.col("passed"), F.lit("check failed"), "attempt")
    for run_id, part in (("run-1", early), ("run-2", ~early), ("run-1", early), ("run-2", ~early)):
        mine = checks.filter(part)
        log_run(spark, run_log_frames(run_id, "panel", gate_of(mine), sources, mine), prefix, 8)
    return read_bucketed(spark, f"{prefix}_run_reconciliation").select("run_id", "check_name", "obs_month", "lhs", "rhs", "passed")
