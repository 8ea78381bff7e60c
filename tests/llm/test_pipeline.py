"""Stages of the pipeline: each on its own input against brute force."""

import re
from collections import Counter

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F
from test_jaccard_join import brute, near_copies
from test_pii import brute as pii_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_order():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "pii", "mix", "pack"]


def test_near_duplicates(spark, docs, sf_dir):
    extra = spark.createDataFrame([(100_000 + i, t) for i, t in near_copies()], "doc_id long, text string")
    both = docs.unionByName(extra, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in both.collect()]
    got = sorted(r["doc_id"] for r in cp.drop_near_duplicates(spark, both, sf_dir).collect())
    assert got == sorted({c for _, n, c in brute(rows, 5, 80)})


def test_pii(spark, docs, sf_dir):
    out = {r["doc_id"]: r for r in cp.mask_pii(spark, docs, sf_dir).collect()}
    for r in docs.collect():
        spans = [x.split(":") for x in pii_spans(r["text"]).split(",") if x]
        text = out[r["doc_id"]]["text"]
        assert out[r["doc_id"]]["n_chars"] == len(text)
        assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", text)) >= bool(spans)
        assert text == r["text"] or spans


def test_mix(spark, docs, sf_dir):
    size = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    sizes = {r[0]: (r[1], r[2]) for r in docs.select("doc_id", "source", size).collect()}
    taken = Counter(r["doc_id"] for r in cp.mix_sources(spark, docs, sf_dir).select("doc_id").collect())
    assert max(taken.values()) <= 3 and set(taken) <= set(sizes)
    total, most = sum(n for _, n in sizes.values()), max(n for _, n in sizes.values())
    assert total - most <= sum(sizes[d][1] * n for d, n in taken.items()) <= total


def test_pack(spark, docs, sf_dir):
    pieces = cp.pack_sequences(spark, docs, sf_dir)
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.where("n <> t").count() == 0 and whole.count() == docs.count()


@pytest.mark.parametrize("k", range(5))
def test_odd_rows(spark, odd_docs, no_docs, sf_dir, k):
    name, stage = cp.STAGES[k]
    clash = {c: F.lit(1) for c in ("u", "n", "h", "row", "k1", "did", "base", "spans", "score", "predicted", "taken", "turn", "a.b")}
    rows = odd_docs.withColumns(clash)
    out = stage(spark, rows, sf_dir)
    assert name == "pack" or out.columns == rows.columns
    n = out.count()
    assert n >= odd_docs.count() if name == "pack" else n == {"toxicity": 9, "near_duplicates": 7, "pii": 9}.get(name, n)
    assert stage(spark, no_docs, sf_dir).count() == 0


def test_run(spark, sf_dir, docs):
    out = cp.run(spark, sf_dir)
    seq = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("fill").alias("fill"), F.max("padded").alias("padded"))
    assert seq.where("n <> fill OR n > 1024 OR (padded <> 1024 AND padded <> n)").count() == 0
    assert out.where("length = 0").count() == 0
