"""Queries on joins between series, channels, dimensions and texts."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..functions.numbers import MONEY, money
from ..operators import flows, joins
from ..operators.aggregates import ordered_text as roll_up_text
from ..operators.containment import containment_pairs, verify_citations as verify
from ..operators.ordered import asof_join as as_of
from ..operators.reconcile import Check, reconcile
from ..sources import landed, sinks
from .proxies import CHANNELS_SQL, channel_a, channel_b, monthly_by, monthly_sql
from .registry import query


@query(
    "prior_period_tie",
    f"""WITH {monthly_sql('segment')}, b AS (
  SELECT entity, obs_month,
    CAST(sum(value) OVER (PARTITION BY entity ORDER BY obs_month) AS DECIMAL(20,4)) AS balance,
    CAST(sum(value) OVER (PARTITION BY entity, year(obs_month) ORDER BY obs_month) AS DECIMAL(20,4)) AS ytd,
    value FROM monthly),
s AS (
  SELECT entity, obs_month, balance,
    CASE WHEN month(obs_month) % 3 = 0 THEN 'prev_year_end' ELSE 'prev_month' END AS change_basis,
    floor(CAST(CASE WHEN month(obs_month) % 3 = 0 THEN ytd ELSE value END AS DOUBLE) / 1000000) * 1000000 AS change
  FROM b)
SELECT s.entity, s.obs_month, s.change_basis,
  CAST(r.balance AS DOUBLE) + s.change AS lhs, CAST(s.balance AS DOUBLE) AS rhs,
  round(abs(CAST(r.balance AS DOUBLE) + s.change - CAST(s.balance AS DOUBLE)) / CAST(s.balance AS DOUBLE), 6) AS rel_error,
  abs(CAST(r.balance AS DOUBLE) + s.change - CAST(s.balance AS DOUBLE)) / CAST(s.balance AS DOUBLE) <= 0.03 AS passed
FROM s JOIN b r ON r.entity = s.entity AND r.obs_month = CASE s.change_basis
  WHEN 'prev_month' THEN s.obs_month - INTERVAL 1 MONTH ELSE make_date(year(s.obs_month) - 1, 12, 1) END""",
)
def prior_period_tie(t):
    m = monthly_by(t, "segment").drop("n_orders")
    w = W.partitionBy("entity").orderBy("obs_month").rowsBetween(W.unboundedPreceding, W.currentRow)
    b = flows.flow_to_ytd(m, ["entity"], "obs_month", "value", MONEY).withColumn(
        "balance", F.sum("value").over(w).cast(MONEY)
    )
    quarterly = F.month("obs_month") % 3 == 0
    # the change as printed: rounded down to whole millions
    stated = F.floor(F.when(quarterly, F.col("ytd")).otherwise(F.col("value")).cast("double") / 1_000_000) * 1_000_000
    s = b.withColumn("change_basis", F.when(quarterly, "prev_year_end").otherwise("prev_month")).withColumn("change", stated)
    pairs = joins.prior_period_rows(s, ["entity"], "obs_month", "balance", "change_basis")
    check = Check("balance ties to prior period", F.col("ref_value").cast("double") + F.col("change"), F.col("balance"), unit="amount")
    out = reconcile(pairs, [check], ["entity", "obs_month", "change_basis"])
    return out.select("entity", "obs_month", "change_basis", "lhs", "rhs", "rel_error", "passed")


@query(
    "channel_compare",
    f"""WITH {CHANNELS_SQL}
SELECT order_key, CAST(a.value AS DOUBLE) AS value_a, CAST(b.value AS DOUBLE) AS value_b,
  CAST(a.value - b.value AS DOUBLE) AS difference,
  CASE WHEN a.value IS NOT NULL AND b.value IS NOT NULL THEN
    abs(CAST(a.value AS DOUBLE) - CAST(b.value AS DOUBLE)) / CAST(b.value AS DOUBLE) <= 0.03 END AS agrees
FROM channel_a a FULL JOIN channel_b b USING (order_key)""",
)
def channel_compare(t):
    out = joins.compare_channels(channel_a(t), channel_b(t), ["order_key"], "value", 0.03)
    for c in ("value_a", "value_b", "difference"):
        out = out.withColumn(c, F.col(c).cast("double"))
    return out


@query(
    "asof_join",
    """SELECT p.event_id, p.user_id, c.event_id AS asof_event_id, c.value AS asof_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""",
)
def asof_join(t):
    left = t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = t.events.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts", "value")
    out = as_of(
        left, right, ["user_id"], "ts", "ts", ["event_id", "value"], lambda ts: F.date_trunc("hour", ts)
    )
    return out.select("event_id", "user_id", "asof_event_id", "asof_value")


@query(
    "validity_join",
    """WITH scd AS (
  SELECT c_custkey, c_mktsegment AS segment, DATE '1990-01-01' AS valid_from, make_date(CAST(1996 + c_custkey % 4 AS BIGINT), 1, 1) AS valid_to FROM customer
  UNION ALL
  SELECT c_custkey, c_mktsegment || '/2', make_date(CAST(1996 + c_custkey % 4 AS BIGINT), 1, 1), NULL FROM customer)
SELECT segment, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DOUBLE) AS value, count(*) AS n_orders
FROM orders JOIN scd ON o_custkey = c_custkey AND valid_from <= CAST(o_orderdate AS DATE)
  AND (valid_to IS NULL OR CAST(o_orderdate AS DATE) < valid_to) GROUP BY 1, 2""",
)
def validity_join(t):
    turn = F.make_date((F.lit(1996) + F.col("c_custkey") % 4).cast("int"), F.lit(1), F.lit(1))
    c = t.customer
    first = c.select(
        F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("segment"),
        F.to_date(F.lit("1990-01-01")).alias("valid_from"), turn.alias("valid_to"),
    )
    second = c.select(
        F.col("c_custkey").alias("entity"), F.concat("c_mktsegment", F.lit("/2")).alias("segment"),
        turn.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    fact = t.orders.groupBy(F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("d")).agg(
        F.sum(money(F.col("o_totalprice"))).alias("v"), F.count(F.lit(1)).alias("n")
    )
    j = joins.validity_join(fact, first.unionByName(second), "entity", F.col("d"), "valid_from", "valid_to")
    return j.groupBy("segment", F.year("d").alias("year")).agg(
        F.sum("v").cast("double").alias("value"), F.sum("n").alias("n_orders")
    )


@query(
    "successor_chain",
    """WITH RECURSIVE d AS (
  SELECT s_suppkey, CASE WHEN s_suppkey % 5 < 4 THEN s_suppkey + 1 END AS successor FROM supplier),
walk AS (
  SELECT s_suppkey, s_suppkey AS pos, 0 AS hops FROM d
  UNION ALL
  SELECT w.s_suppkey, d.successor, hops + 1 FROM walk w JOIN d ON d.s_suppkey = w.pos WHERE d.successor IS NOT NULL),
final AS (
  SELECT s_suppkey, arg_max(pos, hops) AS survivor FROM walk GROUP BY 1),
per AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS v FROM lineitem GROUP BY 1)
SELECT CASE WHEN e.s_suppkey IS NOT NULL THEN survivor END AS survivor, count(*) AS n_entities,
  CAST(sum(v) AS DOUBLE) AS value
FROM final LEFT JOIN per ON l_suppkey = final.s_suppkey
LEFT JOIN (SELECT s_suppkey FROM d WHERE successor IS NULL) e ON e.s_suppkey = survivor GROUP BY 1""",
)
def successor_chain(t):
    dim = t.supplier.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 5 < 4, F.col("s_suppkey") + 1).alias("successor")
    )
    survivors = joins.resolve_successors(dim, "s_suppkey", "successor")
    per = t.lineitem.groupBy("l_suppkey").agg(F.sum(money(F.col("l_extendedprice"))).cast(MONEY).alias("v"))
    return (
        survivors.join(per, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .groupBy("survivor")
        .agg(F.count(F.lit(1)).alias("n_entities"), F.sum("v").cast("double").alias("value"))
    )


# Entities with dated ends: four of five are taken over by the next, on the day, later or earlier; some ends are missing.
DATED_SQL = """WITH RECURSIVE d AS (
  SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 5 < 4 THEN s_suppkey + 1 END AS successor,
    CASE WHEN s_suppkey % 5 > 0 THEN DATE '1995-06-01' + CAST(400 * (s_suppkey % 5 - 1) + (s_suppkey % 3 - 1) * 20 AS INTEGER) END AS valid_from,
    CASE WHEN s_suppkey % 11 <> 10 THEN DATE '1995-06-01' + CAST(400 * (s_suppkey % 5) AS INTEGER) END AS valid_to FROM supplier)"""


def dated_entities(t):
    k = F.col("s_suppkey")
    day = F.lit("1995-06-01").cast("date")
    after = lambda n: F.date_add(day, n.cast("int"))
    return t.supplier.select(
        k.alias("entity"), F.when(k % 5 < 4, k + 1).alias("successor"),
        F.when(k % 5 > 0, after(400 * (k % 5 - 1) + (k % 3 - 1) * 20)).alias("valid_from"), F.when(k % 11 != 10, after(400 * (k % 5))).alias("valid_to"),
    )


@query(
    "successor_breaks",
    DATED_SQL + """
SELECT d.entity, d.successor, d.valid_to AS break_date,
  CASE WHEN d.successor IS NULL THEN 'ended' WHEN n.entity IS NULL THEN 'unknown_successor' WHEN d.valid_to IS NULL THEN 'undated'
    WHEN n.valid_from > d.valid_to THEN 'gap' WHEN n.valid_from < d.valid_to THEN 'overlap' ELSE 'succession' END AS kind,
  CAST(coalesce(n.valid_from - d.valid_to, 0) AS INTEGER) AS days
FROM d LEFT JOIN d n ON n.entity = d.successor WHERE d.successor IS NOT NULL OR d.valid_to IS NOT NULL""",
)
def successor_breaks(t):
    return joins.successor_breaks(dated_entities(t), "entity", "successor", "valid_from", "valid_to")


@query(
    "successor_asof",
    DATED_SQL + """, f AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS v FROM lineitem GROUP BY 1, 2),
walk AS (
  SELECT entity, m, v, entity AS pos, 0 AS hops FROM f
  UNION ALL
  SELECT w.entity, w.m, w.v, d.successor, hops + 1 FROM walk w JOIN d ON d.entity = w.pos JOIN d k ON k.entity = d.successor WHERE d.valid_to <= w.m),
last AS (SELECT entity, m, any_value(v) AS v, arg_max(pos, hops) AS survivor, max(hops) AS hops FROM walk GROUP BY 1, 2)
SELECT survivor, CAST(year(m) AS INTEGER) AS year, CAST(sum(v) AS DOUBLE) AS value, CAST(max(hops) AS INTEGER) AS most_hops FROM last GROUP BY 1, 2""",
)
def successor_asof(t):
    """Figures of every entity under the one that carried its series at the time."""
    facts = t.lineitem.groupBy(F.col("l_suppkey").alias("entity"), month_start(F.col("l_shipdate")).alias("m")).agg(
        F.sum(money(F.col("l_extendedprice"))).cast(MONEY).alias("v")
    )
    found = joins.survivors_asof(dated_entities(t), facts, "entity", "m", "successor", "valid_to")
    return found.groupBy("survivor", F.year("m").alias("year")).agg(F.sum("v").cast("double").alias("value"), F.max("hops").alias("most_hops"))


@query(
    "validity_sweep",
    """WITH v AS (
  SELECT c_nationkey AS entity, i AS version, DATE '1995-01-01' + CAST(i * 200 + c_nationkey * 3 AS INTEGER) AS valid_from,
    CASE WHEN i < 11 THEN DATE '1995-01-01' + CAST(i * 200 + c_nationkey * 3 + 300 AS INTEGER) END AS valid_to
  FROM (SELECT DISTINCT c_nationkey FROM customer), range(12) AS r(i))
SELECT v.entity, CAST(v.version AS INTEGER) AS version, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DOUBLE) AS value
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN v ON v.entity = c_nationkey AND v.valid_from <= CAST(o_orderdate AS DATE) AND (v.valid_to IS NULL OR CAST(o_orderdate AS DATE) < v.valid_to)
GROUP BY 1, 2""",
)
def validity_sweep(t):
    """Few entities with many facts each, and versions that overlap."""
    fact = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("entity"), F.col("o_orderdate").cast("date").alias("d"), money(F.col("o_totalprice")).alias("v")
    )
    n = t.customer.select(F.col("c_nationkey").alias("entity")).distinct().withColumn("version", F.explode(F.array(*map(F.lit, range(12)))))
    starts = F.date_add(F.lit("1995-01-01").cast("date"), F.col("version") * 200 + F.col("entity") * 3)
    versions = n.select("entity", "version", starts.alias("valid_from"), F.when(F.col("version") < 11, F.date_add(starts, 300)).alias("valid_to"))
    j = joins.validity_sweep(fact, versions, "entity", "d", "valid_from", "valid_to")
    return j.groupBy("entity", "version").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("v").cast("double").alias("value"))


PANEL_TOTAL_SQL = f"""{CHANNELS_SQL},
t AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month,
    CAST(sum(b.value) AS DOUBLE) AS panel, CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DOUBLE) AS total
  FROM orders LEFT JOIN channel_b b ON b.order_key = o_orderkey GROUP BY 1)"""


def panel_and_total(t):
    """Monthly panel aggregate (lines) beside the published total (orders)."""
    lines = channel_b(t).select("order_key", F.col("value").alias("lines"))
    o = t.orders.select("o_orderkey", month_start(F.col("o_orderdate")).alias("obs_month"), money(F.col("o_totalprice")).alias("v"))
    return (
        o.join(lines, F.col("o_orderkey") == F.col("order_key"), "left")
        .groupBy("obs_month")
        .agg(F.sum("lines").cast(MONEY).alias("panel"), F.sum("v").cast(MONEY).alias("total"))
    )


@query(
    "panel_vs_total",
    f"""WITH {PANEL_TOTAL_SQL}
SELECT obs_month, panel AS lhs, total AS rhs, round(abs(panel - total) / total, 6) AS rel_error,
  abs(panel - total) / total <= 0.03 AS passed FROM t""",
)
def panel_vs_total(t):
    check = Check("panel = published total", F.col("panel"), F.col("total"), unit="amount")
    out = reconcile(panel_and_total(t), [check], ["obs_month"])
    return out.select("obs_month", "lhs", "rhs", "rel_error", "passed")


MARKETS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query(
    "cross_market",
    f"""WITH {monthly_sql('region')}
SELECT obs_month, {", ".join(f"CAST(sum(value) FILTER (entity = '{m}') AS DOUBLE) AS {m.lower().replace(' ', '_')}" for m in MARKETS)}
FROM monthly GROUP BY 1""",
)
def cross_market(t):
    m = monthly_by(t, "region").select(
        F.col("entity").alias("line_code"), "obs_month", "value"
    )
    wide = landed.to_wide(m, ["obs_month"], MARKETS)
    return wide.select("obs_month", *[F.col(x).cast("double").alias(x.lower().replace(" ", "_")) for x in MARKETS])


@query(
    "cross_market_rows",
    f"""WITH {monthly_sql('region')}
SELECT obs_month, entity AS market, CAST(sum(value) AS DOUBLE) AS value FROM monthly GROUP BY 1, 2""",
)
def cross_market_rows(t):
    """A row per month and region, whatever the regions are called."""
    by_market = monthly_by(t, "region").groupBy("obs_month", F.col("entity").alias("market")).agg(F.sum("value").alias("value"))
    return by_market.withColumn("value", F.col("value").cast("double"))


@query(
    "common_schema",
    f"""WITH {monthly_sql('region')}
SELECT '2' AS series_id, 'net_open.ntd_mn' AS series_key, entity AS entity_id, obs_month AS obs_date, 'M' AS freq,
  CAST(value AS DOUBLE) AS value, 'ntd_mn' AS unit, 'v1' AS definition_version, NULL::VARCHAR AS basis,
  NULL::VARCHAR AS basis_note, 'orders' AS source_url, NULL::VARCHAR AS source_doc, NULL::TIMESTAMP AS retrieved_at,
  NULL::DATE AS vintage, NULL::VARCHAR AS run_id, 'first' AS market FROM monthly""",
)
def common_schema(t):
    m = monthly_by(t, "region").select(
        F.col("entity").alias("entity_id"), F.col("obs_month").alias("obs_date"), F.col("value").cast("double").alias("value")
    )
    return sinks.common_schema(
        m, "first", series_id="2", series_key="net_open.ntd_mn", freq="M", unit="ntd_mn", definition_version="v1", source_url="orders"
    )


@query(
    "admitted_only",
    """SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def admitted_only(t):
    ok = t.labels.filter(F.col("quality") == 1)
    return joins.admitted_only(t.documents, ok, "doc_id").select("doc_id", "lang", "n_chars")


WS_SQL = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def norm_sql(c: str) -> str:
    inner = WS_SQL[1:-1]
    return f"replace(regexp_replace({c}, '[{inner},，]', '', 'g'), '％', '%')"


@query(
    "literal_containment",
    f"""WITH d AS (SELECT doc_id, {norm_sql('text')} AS t FROM documents),
b AS (SELECT item_id, {norm_sql('text')} AS v FROM benchmark)
SELECT doc_id, item_id FROM d JOIN b ON contains(t, v) WHERE v <> ''""",
)
def literal_containment(t):
    return containment_pairs(t.documents, "doc_id", "text", t.benchmark, "item_id", "text")


def citations(t):
    """Every label quotes a document's last line and cites a document: the same, its neighbour or an absent one."""
    d = t.documents.select("doc_id", F.element_at(F.split("text", "\n"), -1).alias("last_line"))
    return t.labels.select(
        F.col("doc_id").alias("label_id"),
        (F.col("doc_id") + F.when(F.col("toxic") == 1, 10_000_000_000).otherwise(0)).alias("cited"),
        (F.col("doc_id") + 1 - F.col("quality")).alias("said_by"),
    ).join(d, F.col("said_by") == F.col("doc_id"), "left").select(
        "label_id", F.col("cited").alias("doc_id"), F.coalesce("last_line", F.lit("?")).alias("printed"),
        (F.col("label_id") % 7 == 0).alias("is_note"),
    )


CORE_SQL = "replace(regexp_replace(regexp_replace(replace(printed, '–', '-'), '^[<>≈約—-]+', ''), '元$', ''), '-', '')"


@query(
    "verify_citations",
    f"""WITH c AS (
  SELECT l.doc_id AS label_id, l.doc_id + CASE WHEN toxic = 1 THEN 10000000000 ELSE 0 END AS cited,
    coalesce(string_split(d.text, chr(10))[-1], '?') AS printed, l.doc_id % 7 = 0 AS is_note
  FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id + 1 - l.quality),
j AS (
  SELECT c.*, d.text, {norm_sql("d.text")} AS t, {norm_sql(CORE_SQL)} AS v, {CORE_SQL} AS core
  FROM c LEFT JOIN documents d ON d.doc_id = c.cited),
r AS (
  SELECT label_id, printed, CASE WHEN text IS NULL THEN 'text_absent' WHEN is_note THEN NULL
    WHEN NOT (CASE WHEN core = '0' THEN contains(text, '0') ELSE contains(t, v) OR contains(t, replace(v, '億', '')) END) THEN 'value_absent' END AS reason FROM j)
SELECT label_id, printed, reason, reason IS NULL AS ok FROM r""",
)
def verify_citations(t):
    out = verify(citations(t), t.documents, "doc_id", "printed", "text", F.col("is_note"))
    return out.select("label_id", "printed", "reason", "ok")


@query(
    "ordered_text",
    """SELECT conv_id, CAST(floor(turn / 1000) AS BIGINT) AS chunk_no,
  string_agg(role || ': ' || text, ' ‖ ' ORDER BY turn) AS text, count(*) AS n_parts
FROM conversations WHERE text IS NOT NULL GROUP BY 1, 2""",
)
def ordered_text(t):
    return roll_up_text(t.conversations, ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"), " ‖ ")
