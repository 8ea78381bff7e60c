"""Queries on the vintaged store, channels and idempotent appends."""

from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..functions.numbers import money
from ..operators import joins, quality, vintages as vt
from ..sources import append
from ..sources.sinks import union_columns
from .proxies import CHANNELS_SQL, VINTAGES_SQL, channel_a, channel_b, monthly_by, monthly_sql, vintages
from .registry import query

TIE = ("value", "l_linenumber")


@query(
    "latest_vintage",
    f"""WITH {VINTAGES_SQL}
SELECT * FROM vintages QUALIFY row_number() OVER (
  PARTITION BY l_orderkey ORDER BY vintage DESC, value DESC, l_linenumber DESC) = 1""",
)
def latest_vintage(t):
    return vt.latest_vintage(vintages(t), ["l_orderkey"], "vintage", TIE)


@query(
    "asof_vintage",
    f"""WITH {VINTAGES_SQL}
SELECT * FROM vintages WHERE vintage <= DATE '1998-06-30' QUALIFY row_number() OVER (
  PARTITION BY l_orderkey ORDER BY vintage DESC, value DESC, l_linenumber DESC) = 1""",
)
def asof_vintage(t):
    return vt.asof_vintage(vintages(t), ["l_orderkey"], "vintage", F.to_date(F.lit("1998-06-30")), TIE)


@query(
    "revisions",
    f"""WITH {VINTAGES_SQL}, one AS (
  SELECT * FROM vintages QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, vintage ORDER BY value DESC, l_linenumber DESC) = 1)
SELECT l_orderkey, vintage, value,
  CAST(row_number() OVER w AS INTEGER) AS revision_no,
  lag(value) OVER w AS previous_value,
  round(value - lag(value) OVER w, 2) AS revision
FROM one WINDOW w AS (PARTITION BY l_orderkey ORDER BY vintage)""",
)
def revisions(t):
    r = vt.revisions(vintages(t), ["l_orderkey"], "vintage", "value", ["l_linenumber"])
    return r.withColumn("revision", F.round("revision", 2))


@query(
    "revisions_set_aside",
    f"""WITH {VINTAGES_SQL}
SELECT l_orderkey, vintage, count(*) - 1 AS n_set_aside FROM vintages GROUP BY 1, 2 HAVING count(*) > 1""",
)
def revisions_set_aside(t):
    return vt.set_aside(vintages(t), ["l_orderkey", "vintage"])


@query(
    "channel_pick",
    f"""WITH {CHANNELS_SQL}
SELECT order_key, coalesce(b.channel, a.channel) AS channel,
  CAST(coalesce(b.value, a.value) AS DOUBLE) AS value
FROM channel_a a FULL JOIN channel_b b USING (order_key)""",
)
def channel_pick(t):
    both = union_columns([channel_a(t), channel_b(t)])
    picked = vt.pick_by_priority(both, ["order_key"], "channel", ["lines", "total"])
    return picked.select("order_key", "channel", F.col("value").cast("double").alias("value"))


@query(
    "basis_pick",
    """WITH b AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS obs_quarter, l_linestatus AS basis,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE) AS value, max(CAST(l_shipdate AS DATE)) AS vintage
  FROM lineitem GROUP BY 1, 2, 3)
SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY entity, obs_quarter ORDER BY CASE basis WHEN 'F' THEN 0 ELSE 1 END) = 1""",
)
def basis_pick(t):
    """Both bases of an entity's quarter are kept; this reader prefers F and says which it got."""
    both = t.lineitem.groupBy(
        F.col("l_suppkey").alias("entity"),
        F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("obs_quarter"),
        F.col("l_linestatus").alias("basis"),
    ).agg(
        F.sum(money(F.col("l_extendedprice"))).cast("double").alias("value"),
        F.max(F.col("l_shipdate").cast("date")).alias("vintage"),
    )
    return vt.pick_by_priority(both, ["entity", "obs_quarter"], "basis", ["F", "O"])


@query(
    "channel_union",
    f"""WITH {CHANNELS_SQL}
SELECT channel, n_lines, order_key, order_status, CAST(value AS DOUBLE) AS value
FROM (SELECT * FROM channel_a UNION ALL BY NAME SELECT * FROM channel_b)""",
)
def channel_union(t):
    return union_columns([channel_a(t), channel_b(t)]).withColumn("value", F.col("value").cast("double"))


@query(
    "field_last_wins",
    """SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id
FROM events GROUP BY 1, 2""",
)
def field_last_wins(t):
    return vt.last_write_wins(t.events, ["user_id"], "event_type", "event_id", "value")


def order_batches(t):
    """A stored table and a later batch that overlaps it and repeats keys within itself."""
    o = t.orders.select(
        "o_orderkey", month_start(F.col("o_orderdate")).alias("obs_month"), money(F.col("o_totalprice")).alias("v")
    )
    cut = lambda d: F.to_date(F.lit(d))
    stored = o.filter(F.col("obs_month") < cut("1999-01-01")).withColumn("batch", F.lit("stored"))
    late = o.filter(F.col("obs_month") >= cut("1998-01-01"))
    first = late.withColumn("arrival", F.lit(1)).withColumn("batch", F.lit("first"))
    again = (
        late.filter(F.col("obs_month") >= cut("2000-01-01"))
        .withColumn("v", (F.col("v") + 1).cast("decimal(20,4)"))
        .withColumn("arrival", F.lit(2)).withColumn("batch", F.lit("again"))
    )
    return stored, first.unionByName(again)


@query(
    "insert_ignore",
    """WITH o AS (
  SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month,
         CAST(o_totalprice AS DECIMAL(20,4)) AS v FROM orders),
stored AS (SELECT *, 'stored' AS batch FROM o WHERE obs_month < DATE '1999-01-01'),
batch AS (
  SELECT *, 1 AS arrival, 'first' AS batch FROM o WHERE obs_month >= DATE '1998-01-01'
  UNION ALL
  SELECT o_orderkey, obs_month, v + 1, 2, 'again' FROM o WHERE obs_month >= DATE '2000-01-01'),
fresh AS (
  SELECT * FROM batch b WHERE NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.o_orderkey = b.o_orderkey AND s.obs_month = b.obs_month)
  QUALIFY row_number() OVER (PARTITION BY obs_month, o_orderkey ORDER BY arrival) = 1)
SELECT o_orderkey, obs_month, CAST(v AS DOUBLE) AS v, batch FROM stored
UNION ALL SELECT o_orderkey, obs_month, CAST(v AS DOUBLE), batch FROM fresh""",
)
def insert_ignore(t):
    stored, batch = order_batches(t)
    out = append.insert_ignore(batch, stored, ["obs_month", "o_orderkey"], ["arrival"], "obs_month")
    return out.withColumn("v", F.col("v").cast("double"))


@query(
    "merge_sources",
    """WITH recent AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
whole AS (SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders)
SELECT o_orderkey, o_orderpriority, o_orderstatus, source_no FROM (
  SELECT o_orderkey, o_orderpriority, NULL AS o_orderstatus, 0 AS source_no FROM recent
  UNION ALL SELECT o_orderkey, o_orderpriority, o_orderstatus, 1 FROM whole)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY source_no) = 1""",
)
def merge_sources(t):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return joins.merge_sources(
        [recent.select("o_orderkey", "o_orderpriority"), t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")],
        "o_orderkey",
    )


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "orphan_keys",
    """SELECT o_orderkey, count(*) AS n_rows FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 1""",
)
def orphan_keys(t):
    return joins.orphan_keys(t.orders, "o_orderkey", t.lineitem.select("l_orderkey").distinct(), "l_orderkey")


@query(
    "basis_segments",
    """WITH one AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS obs_date, o_orderkey, o_orderstatus AS basis FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1),
f AS (
  SELECT *, CASE WHEN row_number() OVER w > 1 AND basis IS DISTINCT FROM lag(basis) OVER w THEN 1 ELSE 0 END AS is_break
  FROM one WINDOW w AS (PARTITION BY o_custkey ORDER BY obs_date))
SELECT o_custkey, obs_date, o_orderkey, basis, is_break,
  CAST(1 + sum(is_break) OVER (PARTITION BY o_custkey ORDER BY obs_date) AS INTEGER) AS segment FROM f""",
)
def basis_segments(t):
    series = t.orders.select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("obs_date"), "o_orderkey", F.col("o_orderstatus").alias("basis")
    )
    return vt.basis_segments(series, ["o_custkey"], "obs_date", "basis", ["o_orderkey"])


@query(
    "basis_segments_set_aside",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS obs_date, count(*) - 1 AS n_set_aside FROM orders
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def basis_segments_set_aside(t):
    series = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("obs_date"))
    return vt.set_aside(series, ["o_custkey", "obs_date"])


@query(
    "rank_entities",
    f"""WITH {monthly_sql('nation')}
SELECT r_name AS region, entity, CAST(total AS DOUBLE) AS total, CAST(rank AS INTEGER) AS rank FROM (
  SELECT r_name, entity, sum(value) AS total, row_number() OVER (PARTITION BY r_name ORDER BY sum(value) DESC, entity) AS rank
  FROM monthly JOIN nation ON n_name = entity JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)""",
)
def rank_entities(t):
    totals = monthly_by(t, "nation").groupBy("entity").agg(F.sum("value").alias("total"))
    placed = totals.join(t.nation, F.col("entity") == F.col("n_name")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    ranked = vt.rank_entities(
        placed.select(F.col("r_name").alias("region"), "entity", "total"), ["region"], [F.col("total").desc(), F.col("entity")]
    )
    return ranked.withColumn("total", F.col("total").cast("double"))
