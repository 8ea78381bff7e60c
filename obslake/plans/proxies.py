"""Period series, channels and panels derived from the sales tables.

Each view comes with the SQL of the same view for the reference queries.
Facts are aggregated on their own keys before they meet a dimension where a key
has many facts, so that it reaches the join as a few rows; line items of the
panel, few to a supplier and month, meet their nation first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..functions.numbers import MONEY, money
from ..operators.indicators import basis_rank, rank_basis
from ..sources.landed import Tables

AMOUNT = "decimal(24,6)"


def monthly_by(t: Tables, entity: str) -> DataFrame:
    """(entity, obs_month, value, n_orders): order totals per month.

    `entity` is nation, region, segment, priority or customer.
    """
    o = t.orders.select(
        "o_custkey",
        month_start(F.col("o_orderdate")).alias("obs_month"),
        money(F.col("o_totalprice")).alias("v"),
        F.col("o_orderpriority").alias("priority"),
    )
    total = [F.sum("v").cast(MONEY).alias("value"), F.sum("n").alias("n_orders")]
    if entity in ("priority", "customer"):
        key = "priority" if entity == "priority" else "o_custkey"
        return o.groupBy(F.col(key).alias("entity"), "obs_month").agg(
            F.sum("v").cast(MONEY).alias("value"), F.count(F.lit(1)).alias("n_orders")
        )
    per = o.groupBy("o_custkey", "obs_month").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))
    c = per.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), per.o_custkey == F.col("c_custkey"))
    if entity == "segment":
        return c.groupBy(F.col("c_mktsegment").alias("entity"), "obs_month").agg(*total)
    by_nation = c.groupBy("c_nationkey", "obs_month").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    n = by_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if entity == "nation":
        return n.groupBy(F.col("n_name").alias("entity"), "obs_month").agg(*total)
    r = n.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return r.groupBy(F.col("r_name").alias("entity"), "obs_month").agg(*total)


_SQL_ENTITY = {
    "nation": ("n_name", "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"),
    "region": (
        "r_name",
        "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey",
    ),
    "segment": ("c_mktsegment", "JOIN customer ON o_custkey = c_custkey"),
    "priority": ("o_orderpriority", ""),
    "customer": ("o_custkey", ""),
}


def monthly_sql(entity: str, name: str = "monthly") -> str:
    col, joins = _SQL_ENTITY[entity]
    return f"""{name} AS (
  SELECT {col} AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS value, count(*) AS n_orders
  FROM orders {joins} GROUP BY 1, 2)"""


def vintages(t: Tables) -> DataFrame:
    """Vintaged store: key l_orderkey, vintage = ship date, value = price."""
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_shipdate").cast("date").alias("vintage"),
        F.col("l_extendedprice").alias("value"),
        "l_linenumber",
    )


VINTAGES_SQL = """vintages AS (
  SELECT l_orderkey, CAST(l_shipdate AS DATE) AS vintage, l_extendedprice AS value, l_linenumber FROM lineitem)"""


def channel_a(t: Tables) -> DataFrame:
    """Order totals as one reporting channel, one row per order."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_key"),
        F.lit("total").alias("channel"),
        money(F.col("o_totalprice")).alias("value"),
        F.col("o_orderstatus").alias("order_status"),
    )


def channel_b(t: Tables) -> DataFrame:
    """Sum of line prices per order as the other channel."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.lit("lines").alias("channel"),
        F.sum(money(F.col("l_extendedprice"))).cast(MONEY).alias("value"),
        F.count(F.lit(1)).alias("n_lines"),
    )


CHANNELS_SQL = """channel_a AS (
  SELECT o_orderkey AS order_key, 'total' AS channel, CAST(o_totalprice AS DECIMAL(20,4)) AS value,
         o_orderstatus AS order_status FROM orders),
channel_b AS (
  SELECT l_orderkey AS order_key, 'lines' AS channel,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS value, count(*) AS n_lines
  FROM lineitem GROUP BY 1)"""


def panel(t: Tables) -> DataFrame:
    """(entity, obs_month) panel of exposure measures with provenance.

    Stand-ins: assets = line prices, hedges = returned lines, policy = accepted
    and filled lines, unhedged equity = discounts, swap cost = taxes,
    buffer = lines neither returned nor accepted.
    """
    # the conversion to decimal is the costly part: once per row, before the sums
    lines = t.lineitem.select(
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("shipped"),
        money(F.col("l_extendedprice")).alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
    )
    flag, filled, shipped = F.col("l_returnflag"), F.col("l_linestatus") == "F", F.col("shipped")

    def part(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("price"))), F.lit(0))

    measures = {
        "assets": F.sum("price"),
        "hedges": part(flag == "R"),
        "policy": part((flag == "A") & filled),
        "unhedged_equity": F.sum(F.col("price") * F.col("disc")),
        "swap_cost": F.sum(F.col("price") * F.col("tax")),
        "reserve": part((flag == "N") & filled),
        "equity": part((flag == "N") & ~filled),
    }
    basis = F.when(filled, F.lit("disclosed")).otherwise(F.lit("estimated"))
    flags = ("A", "N", "R")
    # a month has few lines of a supplier, so sums by supplier would be nearly as many as lines: a nation's are few
    placed = lines.join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
    ).join(t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    per_nation = placed.groupBy(F.col("n_name").alias("entity"), month_start(shipped).alias("obs_month")).agg(
        *[c.cast(AMOUNT).alias(n) for n, c in measures.items()],
        F.max(shipped).alias("vintage"),
        F.max(F.date_add(shipped, F.col("l_linenumber"))).alias("retrieved_at"),
        F.min(basis_rank(basis)).alias("rank"),
        *[F.max(flag == f).alias(f"from_{f}") for f in flags],
    )
    return per_nation.select(
        "entity",
        "obs_month",
        *measures,
        "vintage",
        "retrieved_at",
        rank_basis(F.col("rank")).alias("basis"),
        F.concat_ws("; ", *[F.when(F.col(f"from_{f}"), F.lit(f)) for f in flags]).alias("sources"),
    )


PANEL_SQL = """panel AS (
  SELECT n_name AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS obs_month,
    CAST(sum(p) AS DECIMAL(24,6)) AS assets,
    CAST(coalesce(sum(p) FILTER (l_returnflag = 'R'), 0) AS DECIMAL(24,6)) AS hedges,
    CAST(coalesce(sum(p) FILTER (l_returnflag = 'A' AND l_linestatus = 'F'), 0) AS DECIMAL(24,6)) AS policy,
    CAST(sum(CAST(p * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS unhedged_equity,
    CAST(sum(CAST(p * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS swap_cost,
    CAST(coalesce(sum(p) FILTER (l_returnflag = 'N' AND l_linestatus = 'F'), 0) AS DECIMAL(24,6)) AS reserve,
    CAST(coalesce(sum(p) FILTER (l_returnflag = 'N' AND l_linestatus = 'O'), 0) AS DECIMAL(24,6)) AS equity,
    CAST(max(l_shipdate) AS DATE) AS vintage,
    max(CAST(l_shipdate AS DATE) + l_linenumber) AS retrieved_at,
    CASE WHEN bool_or(l_linestatus <> 'F') THEN 'estimated' ELSE 'disclosed' END AS basis,
    string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS sources
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(20,4)) AS p FROM lineitem)
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2)"""
