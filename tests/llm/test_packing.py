"""Packing and packed rows: every id once, in order, equal to what the tokenizer gives."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from obslake.llm import packing, token_output
from pyspark.sql import functions as F
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def whole_ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check_pieces(pieces, rows, tokenizer, size):
    """Pieces of every document put together are its ids; pieces of every sequence leave no gap."""
    want = sorted((d is None, d or 0, whole_ids(tokenizer, t).tobytes()) for d, t in rows)
    parts = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        parts.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    got = {}
    for (d, n), ps in parts.items():
        assert sum(p["length"] for p in ps) % n == 0
        got[d, n] = sum(p["length"] for p in ps) // n
    assert sum(got.values()) == len(rows)
    by_doc = {}
    for d, t in rows:
        by_doc.setdefault((d, len(whole_ids(tokenizer, t))), whole_ids(tokenizer, t))
    for p in pieces:
        ids = by_doc[p["doc_id"], p["doc_tokens"]][p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(ids.tobytes()) and p["length"] > 0
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for ps in sequences.values():
        at = 0
        for offset, length in sorted(ps):
            assert offset == at
            at += length
        assert at <= size
    return want, sequences


@pytest.mark.parametrize("parts", [1, 7])
def test_online_packing(docs, tokenizer, parts):
    df = docs.repartition(parts, "doc_id")
    pieces = packing.pack(df, size=256, open_windows=4, fan_in=2).collect()
    _, sequences = check_pieces(pieces, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 256)
    padded = sum(256 - n for ps in sequences.values() if (n := sum(x for _, x in ps)) & (n - 1))
    assert padded < 0.06 * sum(p["length"] for p in pieces)


def test_online_packing_of_odd_rows(odd_docs, no_docs, tokenizer):
    clash = odd_docs.withColumn("sequence_id", F.lit("x")).withColumn("from", F.lit("y"))
    check_pieces(packing.pack(clash).collect(), [(r["doc_id"], r["text"]) for r in odd_docs.collect()], tokenizer, 1024)
    assert packing.pack(no_docs).count() == 0


def test_ids_are_the_tokenizers(tokenizer):
    from obslake.llm.tokens import encoder

    for text in ["", " a  b \n\n c ", "x<|endoftext|>y", "é ü 😀 it's 1234", "\n \n", "a" * 5000]:
        assert encoder("byte_bpe_50k").ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_best_fit_decreasing():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 101, 500).tolist()
    rows = token_output.best_fit_decreasing(lengths, 100)
    assert sorted(k for r in rows for k in r) == list(range(500))
    # against a plain search of the fullest row that still takes the piece
    free, plain = [], []
    for k in sorted(range(500), key=lambda i: (-lengths[i], i)):
        fits = [c for c in free if c >= lengths[k]]
        c = min(fits) if fits else 100
        if fits:
            free.remove(c)
        free.append(c - lengths[k])
        plain.append(c)
    assert sorted(100 - sum(lengths[k] for k in r) for r in rows) == sorted(free)


def test_packed_rows_round_trip(docs, odd_docs, no_docs, tokenizer):
    for df in (docs, odd_docs):
        packed = token_output.write_rows(token_output.pack_rows(df, size=512, block_ids=50_000))
        rows = packed.collect()
        m = token_output.matrices(rows, 512)
        assert m["ids"].shape == m["positions"].shape == (len(rows), 512)
        for r, ids, positions in zip(rows, m["ids"], m["positions"]):
            for s, a, b in zip(r["segments"], r["cu_seqlens"], r["cu_seqlens"][1:]):
                assert zlib.crc32(ids[a:b].astype("<u4").tobytes()) == s["ids_crc32"] and b - a == s["length"]
                assert (positions[a:b] == np.arange(b - a)).all()
            assert r["cu_seqlens"][-1] == r["n_ids"]
        check_pieces(token_output.segments(packed).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], tokenizer, 512)
    assert token_output.pack_rows(no_docs).count() == 0
