"""Fingerprints against plain Python: the same draws one by one, and the similarity they estimate."""

import hashlib
import re
from collections import Counter
from math import floor, log

import pytest
import xxhash
from obslake.llm import weighted_sampling as ws
from obslake.llm.registered import op11_weighted_sampling
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_long(x, seed):
    return xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed)


def hash_pair(x, k):
    return xxhash.xxh64_intdigest((k & (1 << 32) - 1).to_bytes(4, "little"), hash_long(x, 42))


def unit(bits, place):
    return ((bits >> 21 * place & (1 << 21) - 1) + 0.5) / (1 << 21)


def brute(text, n):
    counts, out = Counter(WORD.findall(text)), []
    for k in range(n):
        keys = []
        for w, c in counts.items():
            h = xxhash.xxh64_intdigest(w.encode(), 42)
            one, two = hash_pair(h, 2 * k), hash_pair(h, 2 * k + 1)
            r, ln_c, b = -log(unit(one, 0) * unit(one, 1)), log(-log(unit(two, 0) * unit(two, 1))), unit(one, 2)
            value = ln_c - r * (floor(log(c) / r + b) - b + 1)
            keys.append(int((value + 128.0) * 2**24) << 31 | h & (1 << 31) - 1)
        out.append(hash_long(min(keys), 42) >> 33 if keys else 0)
    return out


def edit(text, other):
    q = len(text) // 4
    return text[: len(text) - q] + other[:q]


def ordered(rows):
    """Rows by id, null last, ties by the hash of the text."""
    key = lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    return sorted(rows, key=key)


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_against_brute_force(request, which):
    df = request.getfixturevalue(which)
    n = 8
    rows = ordered([(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()])
    got = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], list(r["sample"]), list(r["edited_sample"]), r["near_edited"], r["near_next"])
        for r in ws.fingerprints(df.withColumn("sample", F.lit(1)).withColumn("range", F.lit(2)), n=n, n_ranges=7).collect()
    )
    want = []
    for i, (key, text) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        new = edit(text, other)
        own, ed, nxt = brute(text, n), brute(new, n), brute(other, n)
        same = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / n
        want.append((key is None, key or 0, len(text), hashlib.sha256(new.encode()).hexdigest(), own, ed, same(own, ed), same(own, nxt)))
    assert [g[:4] for g in got] == [w[:4] for w in sorted(want)]
    total = sum(len(g[4]) + len(g[5]) for g in got)
    # the last bit of a logarithm may differ between libraries
    wrong = sum(x != y for g, w in zip(got, sorted(want), strict=True) for k in (4, 5) for x, y in zip(g[k], w[k], strict=True))
    assert wrong <= total * 0.002
    if not wrong:
        assert [g[6:] for g in got] == [w[6:] for w in sorted(want)]


def test_collisions_estimate_generalised_jaccard(spark):
    a = "a a a a b b c d d d d d d d e f g h " * 3
    b = "a a b b b b c c d d d e e e e k l m " * 3
    counts = spark.createDataFrame(
        [(1, w, a.split().count(w), b.split().count(w)) for w in sorted(set((a + b).split()))], "u int, w string, own int, edit int"
    ).withColumn("word", F.xxhash64("w"))
    got = ws.samples(counts, ["u"], {"x": "own", "y": "edit"}, 4096).select(ws.likeness(F.col("x"), F.col("y")).alias("s")).head()["s"]
    x, y = Counter(a.split()), Counter(b.split())
    want = sum(min(x[w], y[w]) for w in x | y) / sum(max(x[w], y[w]) for w in x | y)
    assert got == pytest.approx(want, abs=4 * (want * (1 - want) / 4096) ** 0.5)


def test_hot_ids_are_dealt_out(spark):
    rows = [(None if i % 3 == 0 else (5 if i % 3 == 1 else i), f"text number {i} with words of its own {i * 7}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    put = ws.in_order(df, doc_id="doc_id", text="text", n_ranges=16).cache()
    assert put.where("extra = 0").groupBy("range").count().agg(F.max("count")).head()[0] < 300
    got = {(r["id"], r["text"]): r["next_text"] for r in put.where("extra = 0").collect()}
    line = ordered(rows)
    assert got == {(k, t): line[(i + 1) % len(line)][1] for i, (k, t) in enumerate(line)}


def test_equal_texts_empty_texts_and_tables(spark, odd_docs, no_docs, sf_dir):
    got = ws.fingerprints(odd_docs, n=8).collect()
    assert len(got) == odd_docs.count()
    empty = [r for r in got if r["doc_id"] in (2, 3, 4)]
    assert all(set(r["sample"]) == {0} for r in empty) and len(empty) == 3
    twice = [r["sample"] for r in got if r["doc_id"] == 1]
    assert twice[0] == twice[1]
    assert ws.fingerprints(no_docs, n=8).count() == 0
    q = op11_weighted_sampling(spark, sf_dir)
    assert q.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("n_ranges", [7, 800])
def test_texts_are_shuffled_once(docs, n_ranges):
    out = ws.fingerprints(docs, n=4, n_ranges=n_ranges)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
