"""Mixing and quality rules against plain Python; mixing also against its SQL in test_queries."""

import re
from collections import Counter
from math import log

import pytest
import xxhash
from obslake.llm import mixing, quality
from obslake.llm.registered import op3_fair_queue_mix, op4_ngram_likelihood_ratio
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, repeats=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > repeats * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(repeats * sizes[s])
            open_.remove(s)
            left -= target[s]


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_mix(request, which):
    df = request.getfixturevalue(which)
    rows = df.select("doc_id", "source", "text").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want = water_fill(dict(sizes))
    got = mixing.mix(df.withColumn("h", F.lit(1)).withColumn("taken", F.lit(1))).collect()
    assert len(got) == len(rows)
    taken, most = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * max(most.values())


def test_mix_reruns_agree_and_empty(spark, sf_dir, no_docs):
    once, twice = (sorted(map(tuple, op3_fair_queue_mix(spark, sf_dir).collect())) for _ in range(2))
    assert once == twice
    assert mixing.mix(no_docs).count() == 0


def brute_base(text):
    ws = WORD.findall(text or "")
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(ws)
    return n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text):
    hs = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in WORD.findall((text or "").lower())]
    pairs = [xxhash.xxh64(b.to_bytes(8, "little"), seed=xxhash.xxh64(a.to_bytes(8, "little"), seed=42).intdigest()).intdigest() for a, b in zip(hs, hs[1:])]
    return hs + pairs


def test_judge_against_plain_counts(spark, sf_dir, docs, labels):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    n_cells, t, r = 1 << 15, Counter(), Counter()
    for d, text in rows:
        c = Counter(g & (n_cells - 1) for g in grams(text))
        r.update(c)
        if d in good:
            t.update(c)
    nt, nr = sum(t.values()), sum(r.values())

    def weight(c):
        p = (r[c] + 1) / (nr + n_cells)
        return round(1000 * log((t[c] + p * n_cells) / (nt + n_cells) / p))

    got = {x["doc_id"]: x for x in op4_ngram_likelihood_ratio(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        x = got[d]
        base = brute_base(text)
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == base
        gs = grams(text)
        llr = sum(weight(g & (n_cells - 1)) for g in gs) / (1000 * len(gs)) if gs else 0.0
        assert x["llr"] == pytest.approx(llr, abs=2e-3)
        assert x["kept"] == (not base[5] and x["llr"] >= -0.09)


def test_judge_odd_rows(odd_docs, no_docs, labels):
    got = quality.judge(odd_docs.withColumn("hs", F.lit(1)).withColumn("key", F.lit(1)), labels).collect()
    assert sorted((x["n_words"], x["n_repeat_words"]) for x in got) == sorted(brute_base(r["text"])[0:5:4] for r in odd_docs.collect())
    assert not any(x["kept"] for x in got if x["n_words"] < 50)
    assert quality.judge(no_docs, labels).count() == 0
    assert {x["llr"] for x in quality.judge(odd_docs, labels.where("false")).collect()} == {0.0}
