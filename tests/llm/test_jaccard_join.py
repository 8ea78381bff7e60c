"""The join against all pairs of sets."""

import random
from collections import Counter

import numpy as np
import pytest
from obslake.llm import jaccard_join
from obslake.llm.jaccard_join import join_classes, rare_first


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n, percent):
    sets = [(d, shingles(t, n)) for d, t in rows]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, (d, s) in enumerate(sets)), key=repr)


def check(df, n, percent, **how):
    got = join_classes(df, n=n, percent=percent, **how).select("doc_id", "n_grams", "class_id").collect()
    want = brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], n, percent)
    assert sorted(map(tuple, got), key=repr) == want


def near_copies(seed=3):
    """Chains of texts that drift apart word by word, a group around one text, and a shared opening."""
    rng, out = random.Random(seed), []
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    for _ in range(3):
        w = [word() for _ in range(70)]
        for _ in range(25):
            out.append(list(w))
            w[rng.randrange(len(w))] = word()
    w = [word() for _ in range(60)]
    out += [w[:i] + [word()] + w[i + 1 :] for i in range(0, 60, 2)]
    out += [w[:40] + [word() for _ in range(20)] for _ in range(20)]
    out += [w + [word()] * k for k in range(6)]
    rng.shuffle(out)
    return [(i, " ".join(x)) for i, x in enumerate(out)]


def test_near_copies(spark):
    df = spark.createDataFrame(near_copies(), "doc_id long, text string")
    check(df, 4, 85)
    check(df, 5, 80, stars=0)


def test_documents(docs):
    check(docs, 4, 85)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs.withColumn("u", odd_docs.doc_id).withColumn("k1", odd_docs.lang), 4, 85)
    assert join_classes(no_docs).count() == 0


def test_rare_first(spark):
    """Exact counts, each set once; grams of one set alone push the others back and are not listed."""
    rng = random.Random(5)
    sets = {u: sorted(rng.sample(range(-40, 60), rng.randrange(1, 30))) for u in range(30)}
    df = spark.createDataFrame([(u, len(s), np.array(s, np.int64).tobytes()) for u, s in sets.items()], "u long, n int, grams binary")
    got = {(r["u"], r["at"], r["g"]) for r in rare_first(df, 80).collect()}
    many = Counter(g for s in sets.values() for g in s)
    want = set()
    for u, s in sets.items():
        lead = len(s) - -(-80 * len(s) // 100) + 1
        want |= {(u, at, g) for at, g in enumerate(sorted(s, key=lambda g: (many[g] > 1, many[g], g))[:lead]) if many[g] > 1}
    assert got == want


@pytest.mark.parametrize("size", [40, 160])
def test_group_below_the_similarity(spark, size):
    """Texts of one source that differ by too much list none of each other's grams, whatever the group's size."""
    rng = random.Random(size)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(300)]
    texts = [[word() if rng.random() < 0.07 else w for w in base] for _ in range(size)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    check(df, 4, 85)
    grams = [sorted(hash(g) for g in shingles(" ".join(t), 4)) for t in texts]
    sets = spark.createDataFrame([(i, len(g), np.array(g, np.int64).tobytes()) for i, g in enumerate(grams)], "u long, n int, grams binary")
    assert rare_first(sets, 85).groupBy("g").count().selectExpr("coalesce(sum(count * (count - 1)), 0)").first()[0] <= 4 * size


def test_overloaded_counters(spark, docs, monkeypatch):
    """With so few counters that each holds thousands of grams, and with long lists alone, the classes are the same."""
    monkeypatch.setattr(jaccard_join, "SHORT", 2)
    monkeypatch.setattr(jaccard_join, "COUNTERS", 64)
    monkeypatch.setattr(jaccard_join, "COUNTER_BLOCK", 8)
    extra = spark.createDataFrame([(100_000 + i, t) for i, t in near_copies()], "doc_id long, text string")
    check(docs.select("doc_id", "text").unionByName(extra), 4, 85)


def test_lists_with_the_same_members_count_once(spark):
    rows = [(1, 0, 10), (2, 1, 10), (1, 2, 11), (2, 2, 11), (1, 3, 12), (2, 3, 12), (3, 0, 12), (3, 1, 13)]
    got = jaccard_join.once_each(spark.createDataFrame(rows, "u long, at int, g long")).collect()
    assert {tuple(r) for r in got} == {(10, 2), (12, 3)}


def test_sketches_bound_the_difference():
    """They never count more than sets differ by, whatever their sizes, and rule out long sets, which 256 ranges cannot."""
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 1 << 63, 8000).astype(np.uint64) * np.uint64(2)
    sets = [rng.choice(pool, k, replace=False) for k in (1, 3, 130, 1500, 1500, 1740, 4000)]
    sizes = np.array([len(s) for s in sets] + [0])
    told = jaccard_join.sketches(np.repeat(np.arange(len(sizes)), sizes), np.concatenate(sets), sizes)
    told = [np.frombuffer(s.as_buffer(), np.uint8) for s in told]
    assert len(told[3]) == 2048 // 8 and len(told[0]) == 256 // 8 and not len(told[-1])
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert jaccard_join.apart(told[i], told[j]) <= len(np.setxor1d(x, y))
    assert 185 * jaccard_join.apart(told[3], told[4]) > 15 * 3000 > 185 * 128


def test_pairs_beyond_the_similarity_ask_for_no_sets(spark):
    """Long texts with one gram in common: no set is read again, so none is shuffled."""
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(1200)) for _ in range(6)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    profiled = jaccard_join.profiles(rows, "doc_id", "text", 4, 85, jaccard_join.gram_counts(rows, "text", 4)).withColumn("u", jaccard_join.F.col("doc_id"))
    pairs = spark.createDataFrame([(i, j) for i in range(6) for j in range(i + 1, 6)], "a long, b long")
    assert jaccard_join.still_open(pairs, profiled, 85).count() == 0
    copy = spark.createDataFrame([(0, 0)], "a long, b long")
    assert jaccard_join.still_open(copy, profiled, 85).count() == 1


def test_no_shuffle_files_are_left(spark):
    """Checkpoints and collected rows give their shuffle files back, and the session's setting stays as it was."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    n = tracker.shuffleStatuses().size()
    out = jaccard_join.kept(df)
    assert len(jaccard_join.collected(df)) == out.count() == 7
    assert tracker.shuffleStatuses().size() <= n + 1 and spark.conf.get(key) == before
