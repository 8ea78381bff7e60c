"""Formats against Python's regular expressions; contexts on planted rows."""

import hashlib
import re

from obslake.llm import pii
from obslake.llm.registered import op6_bootstrapped_pii
from pyspark.sql import functions as F

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


TRICKY = [
    "a@b.c@d.e a@b.c%x@d.ee ..@..@x.y.z a@b a@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.1.1.1111 0000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111-1 411111111111 5500005555555559", "+1 (212) 555-0100 +12 +1-2-3-4-5-6-7-8-9) (+49 30 1234567890123",
    "été 😀 x@y.zz 10.0.0.1 é +44 20 7946 0958.", "1" * 3000 + "@" + "a." * 2000 + "b " + "a" * 5000, "+" * 50 + "1" * 400, None, "", " ",
]


def test_formats(spark, docs, odd_docs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    for rows in (df, docs.select("doc_id", "text"), odd_docs.select("doc_id", "text")):
        for r in pii.find(rows).withColumn("told", pii.told("base")).collect():
            assert r["told"] == brute(r["text"]), r["text"]


def test_query(spark, sf_dir, docs):
    want = {r["doc_id"]: brute(r["text"]) for r in docs.collect()}
    for r in op6_bootstrapped_pii(spark, sf_dir).collect():
        told = want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [told.count(k + ":") for k in PATTERNS]
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))


def test_contexts_discover(spark):
    rows = [(i, f"some words then reach me at user{i}@host{i}.example.org for more of {i * i}") for i in range(20)]
    rows += [(100, "some words then reach me at ann_9(at)host,example for more"), (101, "nothing at 77ab here"), (102, "count to 12 for more")]
    out = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), least_confidence=0.8).withColumn("told", pii.told("spans")).collect()}
    assert out[100]["told"] == "email:28:49", out[100]
    assert out[102]["told"] == ""
    assert out[3]["told"].startswith("email:28:")


def test_redaction(spark):
    df = pii.find(spark.createDataFrame([(1, "x a@b.cc y 10.0.0.1"), (2, None), (3, "plain")], "doc_id long, text string"))
    got = {r[0]: r[1] for r in df.select("doc_id", pii.redacted("text", "spans")).collect()}
    assert got == {1: "x [EMAIL] y [IP]", 2: None, 3: "plain"}


def test_odd(odd_docs, no_docs):
    clash = odd_docs.withColumn("base", F.lit(1)).withColumn("u", F.lit(2)).drop("base")
    assert pii.find(clash).count() == odd_docs.count()
    assert pii.find(no_docs).count() == 0


def test_only_what_is_asked_for_is_computed(spark, monkeypatch):
    """Two tables to start from, what each round but the last teaches, and the patterns in the end."""
    made, real = [], pii.kept
    monkeypatch.setattr(pii, "kept", lambda df: made.append(df.columns) or real(df))
    rows = [(["L mail"], f"a{i}@b.c", "email") for i in range(6)] + [(["L mail"], "x1", None), (["L mail"], "x2", None)]
    found = spark.createDataFrame(rows, "contexts array<string>, value string, seed string")
    got = pii.confident_patterns(found, rounds=3, least_seeds=5, least_confidence=0.6).collect()
    assert [(r["pattern"], r["kind"]) for r in got] == [("L mail", "email")] and len(made) == 5
    # first 6 of 9; then the two unknown values count as far as the pattern was trusted
    share = 6 / 9
    for _ in range(2):
        share = (6 + 2 * share) / 9
    assert abs(got[0]["confidence"] - share) < 1e-12


def test_texts_without_discoveries_are_not_shuffled(spark, monkeypatch):
    """Rows pass by without a shuffle unless the map holds their hash; with a map of one place all are joined, with the same result."""
    rows = [(i, f"some words then reach me at user{i}@host{i}.example.org for more of {i * i}") for i in range(20)]
    rows += [(100, "some words then reach me at ann_9(at)host,example for more"), (101, "nothing at 77ab here"), (102, None), (103, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = docs.select("*", F.xxhash64("text").alias("h"))
    marked = pii.maybe_among(hashed, F.col("h"), hashed.where("doc_id IN (3, 100)").select("h")).where("maybe")
    assert sorted(r["doc_id"] for r in marked.collect()) == [3, 100]
    told = lambda: sorted(map(tuple, pii.find(docs, least_confidence=0.8).select("doc_id", pii.told("spans")).collect()))
    apart = told()
    monkeypatch.setattr(pii, "MAP_PLACES", 1)
    assert told() == apart and dict(apart)[100] == "email:28:49"
