"""Toxicity and language model: held-out quality, probabilities that sum to one, gradients, odd rows."""

import sys
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from obslake.llm import lm_scoring, toxicity
from obslake.llm.registered import op1_gated_recurrent_lm, op9_subword_toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5


def test_toxicity_held_out(spark):
    got = {r["doc_id"]: r for r in op9_subword_toxicity(spark, SF).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r["held_out"] == (fold(d) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for d, r in got.items())
    held = [(got[d]["predicted"], t) for d, t in labels.items() if fold(d) == 0]
    assert np.mean([p == t for p, t in held]) > 0.9


def test_misspelt_words_share_subwords():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("bcdfgaeiou"), 6))
    texts, y = [], []
    for i in range(400):
        w = [word() for _ in range(20)]
        if i % 4 == 0:
            w[int(rng.integers(20))] = ["worthless", "pathetic", "disgusting"][i // 4 % 3]
        texts.append(" ".join(w))
        y.append(int(i % 4 == 0))
    bags = toxicity.SubwordBags().fit(pa.array(texts), np.array(y))
    clean, bad = " ".join(word() for _ in range(20)), " ".join([word() for _ in range(10)] + ["worthles"] + [word() for _ in range(9)])
    a, b, empty, none = bags.scores(pa.array([clean, bad, "", None], pa.string()))
    assert a < 0.5 < b and empty == none == pytest.approx(0.25)


def test_word_in_front_takes_no_stretch_away(labels, docs):
    """All neighbours are looked at, at even and at odd places alike."""
    rows = docs.select("doc_id", "text").join(labels, "doc_id").where("toxic IS NOT NULL").orderBy("doc_id", "text").limit(300).collect()
    texts = [r["text"] or "" for r in rows]
    bags = toxicity.SubwordBags().fit(pa.array(texts, pa.string()), np.array([r["toxic"] for r in rows]))
    some = [" ".join(t.split()[:30]) for t in texts if len(t.split()) > 4]
    alone, behind = bags.scores(pa.array(some)), bags.scores(pa.array(["the " + t for t in some]))
    assert (behind >= alone - 1e-9).all()
    starts, many = toxicity.stretch_starts(np.array([3, 0, 1, 2]), 2)
    assert starts.tolist() == [0, 1, 3, 4] and many.tolist() == [2, 0, 1, 1]


def test_toxicity_odd_rows(odd_docs, no_docs, labels):
    clash = odd_docs.withColumn("told", F.lit(1)).withColumn("score", F.lit(1)).withColumn("toxic", F.lit(1))
    assert toxicity.score(clash, labels).count() == odd_docs.count()
    assert toxicity.score(no_docs, labels).count() == 0
    assert {r["score"] for r in toxicity.score(odd_docs, labels.where("false")).collect()} == {0.0}


def brute_base(rows):
    c, n = Counter(), 0
    texts = [(d, (t or "").encode().lower().split() + [0]) for d, t in rows]
    for d, ws in texts:
        if fold(d) != 1:
            c.update(ws)
            n += len(ws)
    return n, sorted(
        ((d, len(ws), sum(c[w] > 0 for w in ws), sum(log10((c[w] + 0.5) / (n + 0.5 * (len(c) + 1))) for w in ws)) for d, ws in texts), key=repr
    )


def test_language_model_base_and_gain(spark):
    got = op1_gated_recurrent_lm(spark, SF).collect()
    n, want = brute_base([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=repr)
    for a, b in zip(have, want):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)
    assert {r["train_tokens"] for r in got} == {n}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"]) == 1) for r in got)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def model(seed=1):
    v = lm_scoring.Vocabulary(np.arange(1, 60, dtype=np.uint64), np.arange(118, 0, -2), 10, 5000, 90, 40, 6, 8)
    m = lm_scoring.GatedModel(v, 5, 7, seed)
    rng = np.random.default_rng(seed)
    for k in ("wc", "wo"):
        m.p[k] = rng.normal(size=m.p[k].shape).astype(np.float32)
    return v, m


def test_probabilities_sum_to_one():
    v, m = model()
    states = np.random.default_rng(3).normal(size=(1, 7)).astype(np.float32)
    out, _, _ = m.output(np.repeat(states, v.size + 1, 0), np.arange(v.size + 1), False)
    assert np.exp(out).sum() == pytest.approx(1, abs=1e-4)
    known = np.concatenate([[v.n_docs], v.counts])[: v.size] + 0.5
    assert known.sum() + v.rest == pytest.approx(v.total + 0.5 * (v.distinct + 1))


def test_gradients():
    v, m = model()
    m.p = {k: x.astype(np.float64) for k, x in m.p.items()}
    rng = np.random.default_rng(5)
    inp, target = rng.integers(0, v.size, (6, 3)), rng.integers(0, v.size + 1, (6, 3))
    keep = np.ones((6, 3))
    keep[2, 1] = keep[0, 0] = 0
    h = rng.normal(size=(3, 7))

    def loss():
        return -m.output(m.forward(inp, keep, h)[4].reshape(-1, 7), target.ravel(), False)[0].sum()

    run = m.forward(inp, keep, h)
    _, back, grads = m.output(run[4].reshape(-1, 7), target.ravel(), True)
    grads |= m.backward(inp, keep, run, back.reshape(6, 3, 7))
    for k, x in m.p.items():
        for at in [tuple(rng.integers(0, s) for s in x.shape) for _ in range(6)] + ([(int(inp[0, 0]), 0)] if k == "embed" else []):
            was, eps = x[at], 1e-5
            x[at] = was + eps
            up = loss()
            x[at] = was - eps
            down = loss()
            x[at] = was
            assert grads[k][at] == pytest.approx((up - down) / (2 * eps), abs=2e-3), (k, at)


def test_classes_share_their_passes():
    """A class adds its products to a training window, not passes of its own over the scores (CPU seconds)."""

    def calls(classes):
        v = lm_scoring.Vocabulary(np.arange(1, 600, dtype=np.uint64), np.arange(1198, 0, -2), 10, 500_000, 900, 400, classes, 8)
        m, seen = lm_scoring.GatedModel(v, 5, 7), []
        states, target = np.random.default_rng(2).normal(size=(800, 7)).astype(np.float32), np.arange(800) % 401
        sys.setprofile(lambda frame, event, arg: seen.append(event) if event in ("call", "c_call") else None)
        try:
            m.output(states, target, True)
        finally:
            sys.setprofile(None)
        return len(seen) / (v.n_classes - 1)

    assert calls(40) < 7


@pytest.mark.parametrize("words", [[], [7], [0, 2**64 - 1], list(range(1, 60)), [(k * 0x9E3779B97F4A7C15) % 2**64 for k in range(3000)]])
def test_places_of_words(words):
    told = {w: k for k, w in enumerate(words, 1)}
    asked = [*words, 0, 1, 61, 2**63, 2**64 - 2, 2**64 - 1]
    assert lm_scoring.Places(np.array(words, np.uint64)).find(np.array(asked, np.uint64)).tolist() == [told.get(w, 0) for w in asked]


def test_windows_do_not_change_scores():
    """A document's score is the same whatever stands beside it and however windows cut it."""
    v, m = model()
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, v.size + 1, n) for n in (1, 5, 40, 3, 17, 90, 2)]

    def total(width, steps):
        s, out = lm_scoring.Streams(width, steps, 7), np.zeros(len(docs))
        for d, t in enumerate(docs):
            s.add(d, t)
        for last in (False, True):
            for live, (inp, target, doc, keep) in s.windows(last):
                run = m.forward(np.minimum(inp, v.size), keep.astype(np.float32), s.state[live])
                s.state[live] = run[5]
                ok = np.flatnonzero(doc.ravel() >= 0)
                out += np.bincount(doc.ravel()[ok], m.output(run[4].reshape(-1, 7)[ok], target.ravel()[ok], False)[0], len(docs))
        return out

    assert total(1, 200) == pytest.approx(total(3, 4), abs=1e-3)


def test_language_model_odd_rows(odd_docs, no_docs):
    clash = odd_docs.withColumn("u", F.lit(1)).withColumn("token", F.lit(1)).withColumn("learns", F.lit(1))
    got = lm_scoring.score(clash, F.lit(True)).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len((r["text"] or "").encode().split()) + 1 for r in odd_docs.collect())
    assert all(np.isfinite(r["score"]) for r in got)
    untaught = lm_scoring.score(odd_docs, F.lit(False)).collect()
    assert all(r["score"] == r["base_score"] == pytest.approx(0, abs=1e-6) for r in untaught)
    assert lm_scoring.score(no_docs, F.lit(True)).count() == 0
