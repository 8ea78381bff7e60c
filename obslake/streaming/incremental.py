"""Incremental forms: a correction is a new vintage, and a repeated batch is harmless."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.reconcile import Check, reconcile
from ..sources.append import append_bucketed, bucketed_new_rows, new_rows


def read_table_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """File stream over one landed parquet table; event times become TIMESTAMP for watermarks."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # the glob takes a table that is one file as well as one that is a folder
    df = r.parquet(f"{folder}/{name}.parquet*")
    ntz = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz})


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """What has been written so far, or None before the first batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _start(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _add_new(batch: DataFrame, path: str, keys: Sequence[str], arrival: Sequence[str], partition: str | None) -> None:
    """Append the rows whose key is not stored yet.

    A replay, with the same or with other batch boundaries, finds its own rows in the store and adds nothing.
    """
    store = _stored(batch.sparkSession, path)
    w = new_rows(batch, store, keys, arrival, partition).write.mode("append")
    (w.partitionBy(partition) if partition else w).parquet(path)


def stream_insert_ignore(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], arrival: Sequence[str], partition: str | None = None
) -> StreamingQuery:
    """Append only rows whose natural key is new, batch after batch; rows may come as late as they like.

    Name a partition column that is part of the key to read only the target
    partitions a batch touches.
    """
    return _start(stream, checkpoint, lambda batch, epoch: _add_new(batch, path, keys, arrival, partition))


def stream_restate(
    stream: DataFrame, store: str, path: str, checkpoint: str, keys: Sequence[str], arrival: Sequence[str], period: str,
    compute: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Keep per-period results current: each batch is stored, and the periods it touches are computed anew.

    `compute` takes all stored rows of some periods and keeps the column `period`. What it gives is appended with the
    batch's epoch: a correction, however late, is a new vintage of its period. `latest_of` reads the current state.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        _add_new(batch, store, keys, arrival, period)
        touched = batch.select(period).distinct()
        rows = compute(spark.read.parquet(store).join(touched, period, "left_semi"))
        rows.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("append").parquet(path)

    return _start(stream, checkpoint, each)


def stream_append(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], arrival: Sequence[str], buckets: int = 16) -> StreamingQuery:
    """`stream_insert_ignore` into a bucketed store: a batch is shuffled once and the store not at all."""
    return _start(stream, checkpoint, lambda batch, epoch: append_bucketed(batch, table, keys, arrival, buckets))


def stream_deltas(
    stream: DataFrame, table: str, path: str, checkpoint: str, keys: Sequence[str], arrival: Sequence[str], group: Sequence[Column],
    sums: Sequence[Column], buckets: int = 16,
) -> StreamingQuery:
    """Per-group sums as one delta a batch; late rows and repeats may come at any time.

    A batch adds the sums of the keys it is the first to bring to `path`, under its epoch. Of what is stored only keys
    are read (`table`, bucketed), never a row or a sum, so a batch costs the same however old the store is. Groups may be
    null. A batch that is run again counts the keys of earlier epochs as known and its own as new, and so overwrites its
    delta with the same one.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        marked = batch.withColumn("_epoch", F.lit(epoch).cast("long"))
        fresh = bucketed_new_rows(marked, table, keys, arrival, buckets, F.col("_epoch") < epoch)
        delta = fresh.groupBy(*group).agg(*sums)
        delta.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        append_bucketed(marked.select(*keys, "_epoch"), table, keys, ["_epoch"], buckets)

    return _start(stream, checkpoint, each)


def merged(spark: SparkSession, path: str, group: Sequence[str]) -> DataFrame:
    """The current sums of every group, from all deltas."""
    log = spark.read.parquet(path).drop("epoch")
    return log.groupBy(*group).agg(*[F.sum(c).alias(c) for c in log.columns if c not in group])


def latest_of(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last vintage of every row; rows written twice by a replay count once."""
    log = spark.read.parquet(path)
    rest = [c for c in log.columns if c not in (*keys, "epoch")]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def tumbling(width: str, event_time: str, keys: Sequence[str], aggs: Sequence[Column]) -> Callable[[DataFrame], DataFrame]:
    """Aggregates per fixed period, for `stream_restate`."""

    def compute(rows: DataFrame) -> DataFrame:
        out = rows.groupBy(F.window(event_time, width), *keys).agg(*aggs)
        return out.withColumns({"period_start": F.col("window.start"), "period_end": F.col("window.end")}).drop("window")

    return compute


def checked(prepare: Callable[[DataFrame], DataFrame], checks: Sequence[Check], keep: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Checks of whole periods, for `stream_restate`."""
    return lambda rows: reconcile(prepare(rows), checks, keep)
