"""Removal against all windows of all texts."""

import hashlib
import random

import numpy as np
from obslake.llm import suffix_dedup
from obslake.llm.registered import op10_suffix_sort_dedup
from pyspark.sql import functions as F


def brute(rows, length):
    """(id, bytes, removed runs, kept) of every row; equal rows one after the other."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for doc_id, text in order:
        b = (text or "").encode()
        mask = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                mask[s : s + length] = True
            seen.add(w)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
        out.append((doc_id, len(b), int(mask.sum()), len(edge) // 2, hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def check(df, length=100):
    got = suffix_dedup.removed(df, length=length).collect()
    got = [(r["doc_id"], r["n_bytes"], sum(e - s for s, e in r["cut"]), len(r["cut"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got]
    assert sorted(got, key=repr) == brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], length)


def test_overlapping_repeats(spark):
    rng, pool = random.Random(5), []
    for _ in range(12):
        pool.append("".join(rng.choices("abcd é", k=rng.randrange(60, 400))))
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts.append(rng.choice([p, p[a:], p[:a], "".join(rng.choices("xyz ", k=rng.randrange(1, 90)))]))
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 300), (101, "z" * 500), (102, "ab" * 120), (103, "z" * 99), (104, "z" * 100)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(df)
    check(df, 30)


def test_query(spark, sf_dir, docs):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 100)
    assert sorted((tuple(r) for r in op10_suffix_sort_dedup(spark, sf_dir).collect()), key=repr) == want


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs.withColumn("did", odd_docs.lang).withColumn("start", odd_docs.lang))
    copies = odd_docs.where("doc_id = 5")
    check(copies.unionByName(copies))
    assert suffix_dedup.removed(no_docs).count() == 0


def test_null_ids_whose_hashes_agree(spark):
    """Texts of one id that agree in 32 bits of hash are different rows all the same."""
    many = spark.range(300_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "repeat(sha2(CAST(id AS STRING), 256), 1 + CAST(id % 4 AS INT)) AS text")
    agree = many.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where(F.size("t") > 1)
    rows = [(None, t) for r in agree.collect() for t in r["t"]]
    assert len(rows) > 4
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def crowd(n, seed=3):
    """Rows around one passage, each with bytes of its own on both sides; some share a part of them."""
    rng = random.Random(seed)
    passage = "".join(rng.choices("abcdefgh ", k=300))
    near = ["".join(rng.choices("pqrst ", k=40)) for _ in range(9)]
    own = lambda: "".join(rng.choices("uvwxyz ", k=80))
    rows = [(rng.choice([None, 7, i]), own() + rng.choice(["", rng.choice(near)]) + passage + rng.choice(["", rng.choice(near)]) + own()) for i in range(n)]
    return rows + rows[:3]


def test_crowded_anchors_are_split(spark, monkeypatch):
    """No task is handed all snippets of an anchor, and the result is that of the whole."""
    closer, met = suffix_dedup._closer, []

    def watched(bodies, length):
        met.append(bodies.groupBy("anchor").count().agg(F.max("count")).first()[0] or 0)
        return closer(bodies, length)

    monkeypatch.setattr(suffix_dedup, "_closer", watched)
    df = spark.createDataFrame(crowd(150), "doc_id long, text string").repartition(4)
    df = df.dropDuplicates().unionByName(df.limit(5))
    same = lambda hot: sorted((repr(r) for r in suffix_dedup.removed(df, hot=hot).collect()))
    whole = same(10**6)
    assert met.pop() > 50
    assert same(5) == same(0) == whole
    assert max(met) <= 5
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(crowd(120, 4))], "doc_id long, text string").repartition(4)
    check(df)
    assert same(5) == same(10**6)


def test_mergesort_orders_suffixes():
    rng = random.Random(1)
    data = np.frombuffer("".join(rng.choices("ab", k=4000)).encode(), np.uint8)
    at = np.array([rng.randrange(3800) for _ in range(500)])
    n = np.array([rng.randrange(1, 200) for _ in at])
    group = np.sort(np.array([rng.randrange(7) for _ in at]))
    order = suffix_dedup.SuffixOrder(data).sort(at, n, group)
    want = sorted(range(500), key=lambda i: (group[i], data[at[i] : at[i] + n[i]].tobytes(), i))
    assert order.tolist() == want
