"""Idempotent append under a natural key, and the run log built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import first_per_key, key_struct


def _touched(target: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The part of the target in the partitions a batch touches, and its null partition.

    A join on the partition column: the scan of a partitioned target is pruned by the values at run time.
    """
    values = batch.select(partition).distinct()
    return target.join(values, partition, "left_semi").unionByName(target.filter(F.col(partition).isNull()))


def new_rows(
    batch: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    arrival: Sequence[str],
    partition: str | None = None,
) -> DataFrame:
    """Rows of the batch whose key the target does not hold; the first arrival of a key wins.

    Keys compare null-safe. Give the target's partition column when it is part
    of the key: only the partitions the batch touches are then read.
    """
    if partition and partition not in keys:
        raise ValueError(f"partition {partition} is not in the key: the key may be held in another partition")
    first = first_per_key(
        batch.withColumn("_key", key_struct(keys)), ["_key"], [F.col(c).asc_nulls_first() for c in arrival]
    )
    if target is None:
        return first.drop("_key")
    if partition:
        target = _touched(target, batch, partition)
    held = target.select(key_struct(keys)).distinct()
    return first.join(held, "_key", "left_anti").drop("_key")


def insert_ignore(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], arrival: Sequence[str], partition: str | None = None
) -> DataFrame:
    """The target after the append: existing keys stay untouched."""
    fresh = new_rows(batch, target, keys, arrival, partition)
    return target.unionByName(fresh.select(*target.columns), allowMissingColumns=True)


def append_new(
    batch: DataFrame, path: str, target: DataFrame | None, keys: Sequence[str], arrival: Sequence[str],
    partition: str | None = None,
) -> None:
    """Write only the new rows behind the target at `path`."""
    w = new_rows(batch, target, keys, arrival, partition).write.mode("append")
    (w.partitionBy(partition) if partition else w).parquet(path)


#: The bucketing column of a bucketed store: a hash of the key, never null.
KEY_HASH = "_key_hash"


def _hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(KEY_HASH, F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys]))


def _buckets(spark: SparkSession, table: str) -> int | None:
    """Number of buckets of a stored table; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(told["Num Buckets"])


def bucketed_new_rows(
    batch: DataFrame, table: str, keys: Sequence[str], arrival: Sequence[str], buckets: int, held: Column | None = None
) -> DataFrame:
    """Rows of the batch whose key the bucketed store does not hold, dealt out as its buckets are.

    The batch alone is shuffled, once: buckets of the store meet the partition of the same number where they lie. Keys
    compare null-safe; the first arrival of a key wins. `held`, on the store's columns, says which stored rows count.
    """
    spark = batch.sparkSession
    have = _buckets(spark, table)
    dealt = _hashed(batch, keys).repartition(have or buckets, KEY_HASH).withColumn("_key", key_struct(keys))
    first = first_per_key(dealt, [KEY_HASH, "_key"], [F.col(c).asc_nulls_first() for c in arrival])
    if have is None:
        return first.drop("_key")
    store = spark.table(table)
    store = store.filter(held) if held is not None else store
    old = store.select(F.col(KEY_HASH).alias("_h"), key_struct(keys).alias("_old"))
    # the keys themselves are compared in a form that is no join key, as buckets know the hash alone
    same = (F.col(KEY_HASH) == F.col("_h")) & F.array_contains(F.array("_old"), F.col("_key"))
    return first.join(old.hint("merge"), same, "left_anti").drop("_key")


def append_bucketed(batch: DataFrame, table: str, keys: Sequence[str], arrival: Sequence[str], buckets: int = 16) -> None:
    """Add the batch's new keys to a store bucketed by its natural key, which is made if it is not there.

    Every bucket gets one file more; nothing that is stored is moved or written again. An existing store keeps its
    number of buckets. The same batch again, with the same or other boundaries, adds nothing.
    """
    fresh = bucketed_new_rows(batch, table, keys, arrival, buckets)
    have = _buckets(batch.sparkSession, table) or buckets
    if batch.sparkSession.catalog.tableExists(table):
        fresh = fresh.select(*batch.sparkSession.table(table).columns)
    fresh.write.mode("append").bucketBy(have, KEY_HASH).sortBy(KEY_HASH).saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(KEY_HASH)


def log_run(spark: SparkSession, frames: dict[str, DataFrame], prefix: str, buckets: int = 16) -> None:
    """Append the frames of `run_log_frames` to the bucketed stores `<prefix>_<name>`; a run logged twice is there once."""
    for name, frame in frames.items():
        append_bucketed(frame, f"{prefix}_{name}", RUN_KEYS[name], [c for c in frame.columns if c not in RUN_KEYS[name]][:1], buckets)


def save_store(df: DataFrame, table: str, keys: Sequence[str], vintage: str, buckets: int) -> None:
    """Save a vintaged store bucketed by its natural key and sorted by vintage.

    Point-in-time reads of the table then need no shuffle.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, vintage).saveAsTable(table)
    )


def source_status(df: DataFrame, url: str, doc: str, ok: Column, note: Column, attempt: str) -> DataFrame:
    """Source-status rows; the attempt number keeps a fail-then-ok pair of one URL apart."""
    return df.select(
        F.col(url).alias("source_url"),
        F.col(doc).alias("source_doc"),
        F.col(attempt).alias("attempt"),
        ok.alias("ok"),
        F.when(~ok, note).alias("note"),
    )


RUN_KEYS = {
    "run_log": ("run_id",),
    "run_source_status": ("run_id", "source_url", "attempt"),
    # one check stands for every period it is made for
    "run_reconciliation": ("run_id", "check_name", "obs_month"),
}


def run_log_frames(run_id: str, stage: str, gate: DataFrame, sources: DataFrame, checks: DataFrame) -> dict[str, DataFrame]:
    """The three append-only frames of one run, keyed for `insert_ignore` by RUN_KEYS."""
    rid = F.lit(run_id).alias("run_id")
    notes = F.to_json(F.struct(*[F.col(c) for c in gate.columns]))
    return {
        "run_log": gate.select(rid, F.lit(stage).alias("stage"), "status", notes.alias("notes")),
        "run_source_status": sources.select(rid, *sources.columns),
        "run_reconciliation": checks.select(rid, *checks.columns),
    }
