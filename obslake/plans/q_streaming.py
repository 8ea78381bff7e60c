"""Queries that run a table through Structured Streaming and read back what was written."""

import uuid

from pyspark.sql import functions as F

from ..operators.reconcile import Check, reconcile
from ..session import scratch_dir
from ..sources.append import read_bucketed
from ..streaming import incremental as inc
from .registry import query

BATCHES = 4
BUCKETS = 8


def _paths(t, name, *parts):
    base = scratch_dir(t._spark, name)
    return [f"{base}/{p}" for p in (*parts, "checkpoint")]


def _events(t):
    """The events landed in several files, one to a batch, late ones in every file."""
    (landed, _) = _paths(t, "landed", "files")
    t.events.withColumn("day", F.col("ts").cast("date")).repartition(BATCHES, "event_id").write.parquet(f"{landed}/events.parquet")
    return inc.read_table_stream(t._spark, landed, "events", max_files=1)


def _table(name):
    """A name of its own for each run's store."""
    return f"{name}_{uuid.uuid4().hex}"


@query(
    "stream_insert_ignore",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(1 AS BIGINT) AS n_stored FROM events GROUP BY 1, 2, 3""",
)
def stream_insert_ignore(t):
    """Each key is stored once, whichever batch brings it first."""
    (ck,), store = _paths(t, "insert-ignore"), _table("insert_ignore")
    s = _events(t).select("user_id", "event_type", "day", "event_id")
    inc.stream_append(s, store, ck, ["user_id", "event_type", "day"], ["event_id"], BUCKETS).awaitTermination()
    return read_bucketed(t._spark, store).groupBy("user_id", "event_type", "day").agg(F.count(F.lit(1)).alias("n_stored"))


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(t):
    """Every event arrives twice; the repeat is dropped by its key, however late it comes."""
    (ck,), store = _paths(t, "dedup"), _table("dedup")
    s = _events(t).select("event_id", "user_id", "event_type", "day")
    inc.stream_append(s.unionByName(s), store, ck, ["event_id", "day"], ["event_id"], BUCKETS).awaitTermination()
    return read_bucketed(t._spark, store).select("event_id", "user_id", "event_type")


@query(
    "stream_tumbling",
    """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""",
)
def stream_tumbling(t):
    """Sums per day from deltas; a day that is not known is a group too."""
    out, ck = _paths(t, "tumbling", "out")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("total")]
    inc.stream_deltas(_events(t), _table("tumbling"), out, ck, ["event_id"], ["ts"], [F.col("day"), F.col("event_type")], sums, BUCKETS).awaitTermination()
    return inc.merged(t._spark, out, ["day", "event_type"]).withColumn("total", F.col("total").cast("double"))


@query(
    "stream_reconcile",
    """WITH d AS (
  SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase') AS DOUBLE) AS lhs,
    CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'click') AS DOUBLE) AS rhs FROM events GROUP BY 1)
SELECT day, lhs, rhs, round(abs(lhs - rhs) / rhs, 6) AS rel_error, abs(lhs - rhs) / rhs <= 0.1 AS passed FROM d WHERE lhs IS NOT NULL AND rhs IS NOT NULL""",
)
def stream_reconcile(t):
    """Checks on whole periods, from the deltas of all batches so far."""
    out, ck = _paths(t, "reconcile", "out")
    v = F.col("value").cast("decimal(12,2)")
    sums = [F.sum(F.when(F.col("event_type") == kind, v)).alias(side) for kind, side in (("purchase", "a"), ("click", "b"))]
    inc.stream_deltas(_events(t), _table("reconcile"), out, ck, ["event_id"], ["ts"], [F.col("day")], sums, BUCKETS).awaitTermination()
    check = Check("purchases = clicks", F.col("a"), F.col("b"), tolerance=0.1, unit="amount")
    return reconcile(inc.merged(t._spark, out, ["day"]), [check], ["day"]).select("day", "lhs", "rhs", "rel_error", "passed")
