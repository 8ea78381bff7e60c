import pytest
from pyspark.sql import functions as F

from obslake.operators.reconcile import Check
from obslake.streaming import incremental as inc


def landed_events(spark, folder, parts):
    e = spark.range(0, 200).select(
        "id",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 40).alias("k"),
        (F.col("id") * 1.5).alias("v"),
    )
    e.filter("id < 1").coalesce(1).write.parquet(f"{folder}/schema/ev.parquet")
    for i in range(parts):
        e.filter(F.col("id").between(i * 200 // parts, (i + 1) * 200 // parts - 1)).coalesce(1).write.parquet(f"{folder}/raw{i}")
    return e


def stream_of(spark, folder, parts):
    schema = spark.read.parquet(f"{folder}/raw0").schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/raw*")
    return s.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("day", F.col("ts").cast("date"))


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_insert_ignore_over_many_batches_equals_batch(spark, tmp_path, parts):
    folder = str(tmp_path)
    e = landed_events(spark, folder, parts)
    s = stream_of(spark, folder, parts).select("k", "id")
    inc.stream_insert_ignore(s, f"{folder}/out", f"{folder}/ck", ["k"], ["id"]).awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == 40
    assert got.select("k").distinct().count() == e.select("k").distinct().count()


def test_replay_with_other_boundaries_adds_nothing(spark, tmp_path):
    folder = str(tmp_path)
    landed_events(spark, folder, 4)
    out = f"{folder}/out"
    inc.stream_insert_ignore(stream_of(spark, folder, 4).select("k", "id"), out, f"{folder}/ck1", ["k"], ["id"]).awaitTermination()
    before = sorted(map(tuple, spark.read.parquet(out).select("k", "id").collect()))
    # a lost checkpoint replays everything, now in one batch
    schema = spark.read.parquet(f"{folder}/raw0").schema
    whole = spark.readStream.schema(schema).parquet(f"{folder}/raw*").select("k", "id")
    inc.stream_insert_ignore(whole, out, f"{folder}/ck2", ["k"], ["id"]).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).select("k", "id").collect())) == before


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_tumbling_gives_every_period(spark, tmp_path, parts):
    folder = str(tmp_path)
    e = landed_events(spark, folder, parts)
    compute = inc.tumbling("1 day", "ts", [], [F.count(F.lit(1)).alias("n")])
    inc.stream_restate(stream_of(spark, folder, parts), f"{folder}/store", f"{folder}/out", f"{folder}/ck", ["id", "day"], ["id"], "day", compute).awaitTermination()
    got = {r["period_start"].date(): r["n"] for r in inc.latest_of(spark, f"{folder}/out", ["period_start"]).collect()}
    assert got == {r["day"]: r["n"] for r in e.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()}


def test_checks_see_whole_periods(spark, tmp_path):
    folder = str(tmp_path)
    e = landed_events(spark, folder, 3)
    prepare = lambda b: b.groupBy("k").agg(F.sum("v").alias("a"), F.count("v").alias("n"))
    compute = inc.checked(prepare, [Check("a = n", F.col("a"), F.col("n"))], ["k"])
    inc.stream_restate(stream_of(spark, folder, 3), f"{folder}/store", f"{folder}/out", f"{folder}/ck", ["id", "k"], ["id"], "k", compute).awaitTermination()
    log = spark.read.parquet(f"{folder}/out")
    assert log.select("epoch").distinct().count() == 3
    got = {r["k"]: r["lhs"] for r in inc.latest_of(spark, f"{folder}/out", ["k", "check_name"]).collect()}
    assert got == {r["k"]: r["a"] for r in e.groupBy("k").agg(F.sum("v").alias("a")).collect()}


def test_bucketed_append_moves_only_the_batch(spark):
    import uuid

    from obslake.sources import append

    table = f"store_{uuid.uuid4().hex}"
    keys = ["k", "p"]
    batch = lambda *r: spark.createDataFrame(list(r), "k string, p int, at int, v double")
    append.append_bucketed(batch(("a", 1, 2, 1.0), ("a", 1, 1, 2.0), (None, 1, 1, 3.0)), table, keys, ["at"], 4)
    again = batch(("a", 1, 0, 9.0), (None, 1, 5, 9.0), ("a", None, 5, 4.0), (None, None, 1, 5.0), (None, None, 2, 6.0))
    for _ in range(2):
        append.append_bucketed(again, table, keys, ["at"], 64)
    got = sorted(((r["k"], r["p"], r["v"]) for r in append.read_bucketed(spark, table).collect()), key=str)
    assert got == sorted([("a", 1, 2.0), (None, 1, 3.0), ("a", None, 4.0), (None, None, 5.0)], key=str)
    # the store is scanned in its buckets: the batch's is the only exchange
    plan = append.bucketed_new_rows(again, table, keys, ["at"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
    files = len(spark.table(table).inputFiles())
    append.append_bucketed(batch(("z", 1, 1, 1.0)), table, keys, ["at"], 4)
    assert len(spark.table(table).inputFiles()) == files + 1


def test_deltas_equal_the_batch_answer_whatever_the_batches(spark):
    import uuid

    from obslake.session import scratch_dir

    rows = [(i % 50, None if i % 7 == 0 else i % 3, float(i % 50)) for i in range(140)]  # repeats, null periods
    df = spark.createDataFrame(rows, "id int, period int, v double")
    first = df.dropDuplicates(["id"])
    # a repeat brings the same row again, whatever its period says
    df = df.drop("period", "v").join(first, "id")
    want = sorted(map(str, first.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()))
    for files in (1, 3):
        base = scratch_dir(spark, "deltas")
        df.repartition(files).write.parquet(f"{base}/rows.parquet")
        table = f"keys_{uuid.uuid4().hex}"
        for attempt in range(2):  # the second run has a checkpoint of its own: everything comes again
            stream = inc.read_table_stream(spark, base, "rows", max_files=1)
            inc.stream_deltas(stream, table, f"{base}/out{attempt}", f"{base}/ck{attempt}", ["id"], ["v"], [F.col("period")], [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")], 4).awaitTermination()
            if attempt == 0:
                assert sorted(map(str, inc.merged(spark, f"{base}/out0", ["period"]).collect())) == want
