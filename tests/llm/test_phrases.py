"""Collocations against plain Python; over whole tables also against their SQL in test_queries."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from obslake.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, share, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for n in range(1, 5):
                f[lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cand.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        best = []
        for p, a in cand.items():
            if 100 * inside[p] >= share * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("which", "least", "size"), [("docs", 4, 40_000), ("odd_docs", 2, 16 << 20), ("odd_docs", 2, 10)])
def test_against_brute_force(request, which, least, size):
    from pyspark.sql import functions as F

    df = request.getfixturevalue(which)
    want = brute([(r["lang"], r["text"]) for r in df.select("lang", "text").collect()], least, 80, 50)
    renamed = df.withColumnsRenamed({"text": "body", "lang": "tongue"}).withColumns({"word": F.lit("x"), "n": F.lit(1), "shard": F.lit(0)})
    got = phrases.collocations(renamed, text="body", lang="tongue", least=least, share=80, top=50, size=size)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == want and want


def test_no_documents(no_docs):
    assert phrases.collocations(no_docs).count() == 0


def test_counts_are_exact_beyond_64_bits(spark):
    big = 6_000_000_000_000
    rows = spark.createDataFrame([([1], big), ([2], big), ([1, 2], big - 1)], "ids array<long>, a long")
    got = phrases.cut_scores(rows).head()
    assert (got["score"], got["l"], got["r"]) == (2_000_000 * (big - 1) // (2 * big), big, big)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=12), max_size=6))
def test_index_enumerates_all_phrases(pieces):
    stream = np.array([0] + [x for p in pieces for x in (*p, 0)], np.int32)
    shard = phrases.Shard(phrases.unpacked(phrases.packed(stream), len(stream)), np.arange(1, 5, dtype=np.int32), np.arange(1, 5))
    want = {n: Counter(tuple(p[i : i + n]) for p in pieces for i in range(len(p) - n + 1)) for n in (2, 3, 4)}
    assert dict(zip(map(tuple, shard.pairs.T), shard.high - shard.low, strict=True)) == want[2]
    if want[2]:
        words, _, _, counts = shard.triples(np.arange(shard.pairs.shape[1]))
        assert dict(zip(map(tuple, words.T), counts, strict=True)) == want[3]
        words, counts = shard.quadruples(np.arange(shard.pairs.shape[1]), np.arange(words.shape[1]))
        assert dict(zip(map(tuple, words.T), counts, strict=True)) == want[4]


def test_copies_add_no_quadruples():
    """A shard gives each of its quadruples once, however many copies of a text it holds."""
    rng = np.random.default_rng(1)
    text, rest = rng.integers(1, 200, 300), rng.integers(1, 200, 20_000)

    def rows(copies):
        stream = np.concatenate([np.append(0, text)] * copies + [[0], rest, [0]]).astype(np.int32)
        shard = phrases.Shard(stream, np.arange(1, 200, dtype=np.int32), np.arange(1, 200))
        pairs = np.flatnonzero(shard.high - shard.low >= 30)
        counts = shard.triples(pairs)[3]
        return len(shard.quadruples(pairs, np.flatnonzero(counts >= 30))[1])

    assert rows(30) == rows(300) == 297
