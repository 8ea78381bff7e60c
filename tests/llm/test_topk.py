"""The search against all products."""

import math
import random

from obslake.llm.topk import top_k
from pyspark.sql import functions as F


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(hits)]
    return sorted(out)


def check(df, k=5, every=50, **how):
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % every == 0, k=k, **how).collect()))
    assert got == brute([(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()], k, every)


def test_embeddings(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(e)
    check(e, k=3, every=7, query_block=16, block=37)


def test_odd_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(9)]) for i in range(60)]
    rows += [(100 + i, [1.0] * 9) for i in range(30)]  # ties
    rows += [(200, None), (201, []), (202, [1.0, None] + [0.0] * 7), (203, [float("nan")] * 9), (204, [float("inf")] * 9), (None, [1.0] * 9)]
    rows += [(210, [2.0, 3.0]), (220, [1.0, -1.0]), (230, [1e6] * 9), (240, [0.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("at", F.lit(2))
    check(df, every=10)
    assert top_k(df.where("false"), F.col("vec_id") % 10 == 0).count() == 0
    check(df.where("vec_id in (210, 220)"), every=10)
