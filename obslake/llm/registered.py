"""The subpackage's queries, and their SQL where SQL can ask the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard_join, lm_scoring, mixing, packing, phrases, pii, quality, suffix_dedup, token_output, topk, toxicity, turn_repair, weighted_sampling
from .common import documents, fold_of


def op1_gated_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(documents(spark, sf_dir), fold_of("doc_id") != 1)
    return scored.select("doc_id", (fold_of("doc_id") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_best_fit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_output.write_rows(token_output.pack_rows(documents(spark, sf_dir)))
    return token_output.segments(rows)


def op3_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_ngram_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_prefix_filtered_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join_classes(documents(spark, sf_dir), n=4, percent=85)
    return found.select("doc_id", F.col("n_grams").alias("n_shingles"), F.col("class_id").alias("component_id"), "n_copies")


def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.told("base"), 256).alias("base_sha256"), pii.told("spans").alias("spans"))


def op7_segment_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op8_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), size=1024)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs.select("doc_id", "text"), labels, learn_from=fold_of("told") != 0)
    return scored.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", "predicted")


def op10_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.removed(documents(spark, sf_dir))
    return cut.select(
        "doc_id", "n_bytes", F.aggregate("cut", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
        F.size("cut").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weighted_sampling.fingerprints(documents(spark, sf_dir))
    printed = [weighted_sampling.printed(F.col(c)).alias(n) for c, n in (("sample", "fingerprint"), ("edited_sample", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", "edited_sha256", *printed, "near_edited", "near_next")


def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), least=30, share=80, top=2000)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)
}

SQL = {
    "op3_fair_queue_mix": r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('mix' || coalesce('+' || CAST(doc_id AS VARCHAR), '-') || coalesce('+' || text, '-')) AS h
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM d GROUP BY source
), w AS (SELECT *, rank % 3 + 1 AS weight, source_size * 3 AS cap FROM s
), l AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / CAST(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM w
), t AS (
    SELECT *, least(CAST(cap AS DOUBLE), max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight) AS target FROM l
), p AS (
    SELECT d.*, t.rank, t.source_size, t.target, row_number() OVER o AS turn,
        sum(d.size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    WINDOW o AS (PARTITION BY t.rank ORDER BY d.h, d.size)
), c AS (
    SELECT p.*, copy, CASE WHEN target > 0 THEN (copy * source_size + until) / target ELSE 0 END AS finish
    FROM p, range(3) AS r(copy)
), q AS (
    SELECT *, sum(size) OVER (ORDER BY finish, rank, copy, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        <= (SELECT sum(source_size) FROM s) AS is_taken
    FROM c
)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
    CAST(sum(CASE WHEN is_taken THEN size ELSE 0 END) AS BIGINT) AS taken
FROM q GROUP BY rank, turn
""",
    "op7_segment_top_k": r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
    WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
""",
    "op12_phrase_index": r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents
), p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d
), g AS (
    SELECT lang, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS ws
    FROM (SELECT lang, w, unnest(range(1, least(len(w), 4) + 1)) AS size FROM p)
), f AS (SELECT lang, ws, len(ws) AS size, count(*) AS a FROM g GROUP BY lang, ws
), t AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (SELECT * FROM f WHERE size > 1 AND a >= 30
), e AS (SELECT lang, ws, a, k, ws[1:k] AS head, ws[k + 1:] AS tail FROM (SELECT *, unnest(range(1, size)) AS k FROM c)
), h AS (SELECT lang, ws, a FROM f WHERE a >= 30
), k AS (
    SELECT e.lang, e.ws, e.a, k, x.a AS l, y.a AS r, CAST((2000000::HUGEINT * e.a) // (x.a::HUGEINT + y.a) AS BIGINT) AS score
    FROM e JOIN h x ON x.lang = e.lang AND x.ws = e.head JOIN h y ON y.lang = e.lang AND y.ws = e.tail
), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) AS turn FROM k) WHERE turn = 1
), z AS (SELECT lang, ws, a, size, z, unnest(range(1, size - z + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS z FROM c)
), s AS (SELECT lang, ws[i:i + z - 1] AS ws, max(a) AS most FROM z GROUP BY ALL
), o AS (
    SELECT b.*, array_to_string(b.ws, ' ') AS phrase FROM b LEFT JOIN s ON b.lang = s.lang AND b.ws = s.ws
    WHERE s.most IS NULL OR 100::HUGEINT * s.most < 80::HUGEINT * b.a
), m AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM o)
SELECT m.lang, rank, phrase, a, l, r, CAST(t.n AS BIGINT) AS n, score FROM m JOIN t ON m.lang = t.lang WHERE rank <= 2000
""",
}
