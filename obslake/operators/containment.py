"""Which printed values occur literally in which texts.

With a cited document the pair is known and only verified. Without one, candidates come from an equality join on
winnowed fingerprints, so the work is never (texts x values), and every candidate is verified by `contains`.

Fingerprints are minimisers: of every `window` neighbouring fragments of `width` code points the one with the smallest
hash. The choice depends on the characters alone, whatever the script, so every window that lies inside a value is
chosen alike in each text that holds the value: all fingerprints of the value are fingerprints of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import literal_in_text, text_norm
from ..session import written

#: (width, window) of fragments by length of value: from 15 code points, from 7, and shorter ones whole.
TIERS = ((8, 8), (4, 4))
SHORTEST = sum(TIERS[-1]) - 1

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _fragments(points: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` code points from every place on; those that reach over the end are wrong and not asked for."""
    h = np.zeros(len(points), np.uint64)
    for i in range(width):
        ahead = np.zeros(len(points), np.uint64)
        ahead[: len(points) - i] = points[i:]
        h = _spread(h * np.uint64(0x9E3779B97F4A7C15) + ahead + np.uint64(1))
    return h


def _chosen(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of every `window` neighbours, each once."""
    least, span = h.copy(), 1
    while span < window:
        step = min(span, window - span)
        least[: len(least) - step] = np.minimum(least[: len(least) - step], least[step:])
        span += step
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # a place is chosen if it holds the minimum of some window that covers it
    keep = np.zeros(len(h), bool)
    for back in range(window):
        at = slice(back, back + n)
        keep[at] |= h[at] == least[:n]
    return np.flatnonzero(keep)


def fingerprints(df: DataFrame, key: str, text: str, width: int, window: int) -> DataFrame:
    """(key, gram): the distinct minimisers of every text; texts below width + window - 1 code points have none."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            who, grams = [], []
            for i, t in enumerate(texts):
                points = np.frombuffer((t or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
                if len(points) < width + window - 1:
                    continue
                h = _fragments(points, width)[: len(points) - width + 1]
                found = np.unique(h[_chosen(h, window)])
                who.append(np.full(len(found), i))
                grams.append(found)
            if who:
                at = np.concatenate(who)
                yield pa.record_batch({"key": batch.column(0).take(pa.array(at)), "gram": pa.array(np.concatenate(grams).view(np.int64))})

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(pick, f"key {kind}, gram long").withColumnRenamed("key", key)


def _whole(df: DataFrame, key: str, text: str, lengths: list[int]) -> DataFrame:
    """(key, gram): all distinct fragments of the given lengths."""
    each = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]
    return df.select(key, F.explode(F.array_distinct(F.concat(*each))).alias("g")).select(key, F.xxhash64("g").alias("gram"))


def _proposed(grams: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc, item) pairs by way of the item's rarest fingerprint.

    Only fingerprints of items survive the first join, and each item keeps the one found in the fewest texts, so a
    passage copied into many texts proposes pairs only for items that have nothing rarer.
    """
    # every text is read, normalised and fingerprinted once: what it shares with items is written and read twice
    grams = written(grams.join(anchors.select("gram").distinct(), "gram"), "containment-grams")
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    many = anchors.groupBy("item").agg(F.count(F.lit(1)).alias("of"))
    rarest = (
        anchors.join(frequency, "gram")
        .groupBy("item")
        .agg(F.min(F.struct("n", "gram")).alias("m"), F.count(F.lit(1)).alias("found"))
        .join(many, "item").filter("found = of")
        .select("item", F.col("m.gram").alias("gram"))
    )
    return grams.join(rarest, "gram").select("doc", "item")


def candidate_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, t) x (item, v), both normalised -> the distinct pairs to be verified."""
    n = F.length("v")
    least = [sum(t) - 1 for t in TIERS]  # shortest value of each tier
    tier = F.when(n >= least[0], -1).when(n >= least[1], -2).otherwise(n)
    shapes = {r[0] for r in items.select(tier).distinct().collect()}  # a few numbers: both tiers and the short lengths
    found = None if shapes else docs.filter("false").select("doc", F.lit(None).cast(items.schema["item"].dataType).alias("item"))
    for code, (width, window) in zip((-1, -2), TIERS, strict=True):
        if code in shapes:
            pairs = _proposed(fingerprints(docs, "doc", "t", width, window), fingerprints(items.filter(tier == code), "item", "v", width, window))
            found = pairs if found is None else found.unionByName(pairs)
    if lengths := sorted(s for s in shapes if s > 0):
        short = items.filter(tier > 0).select("item", F.xxhash64("v").alias("gram"))
        pairs = _proposed(_whole(docs, "doc", "t", lengths), short)
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def containment_pairs(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, value: str) -> DataFrame:
    """All (doc_id, item_id) where the normalised value occurs in the normalised text."""
    raw = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    # never null, so that no null test on the costly normal form is pushed into the scan
    d = raw.select("doc", F.coalesce(text_norm(F.col("text")), F.lit("")).alias("t"))
    i = items.select(F.col(item_id).alias("item"), text_norm(F.col(value)).alias("v")).filter("v != ''")
    # of the texts only those of a pair travel, as they are: few pairs are sent to the texts, not the texts to them
    both = written(candidate_pairs(d, i), "containment-pairs").join(raw, "doc").join(i, "item")
    found = both.filter(F.contains(text_norm(F.col("text")), F.col("v")))
    return found.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).distinct()


def verify_citations(
    citations: DataFrame,
    articles: DataFrame,
    doc_id: str,
    printed: str,
    text: str,
    exempt: Column,
    boundary: bool = False,
) -> DataFrame:
    """Check every printed value against the text it cites, with a reason for each failure."""
    # only cited texts travel, and each is normalised once
    cited = articles.join(citations.select(doc_id).distinct(), doc_id, "left_semi")
    texts = cited.select(doc_id, F.col(text).alias("_text"), text_norm(F.col(text)).alias("_norm"))
    joined = citations.join(texts, doc_id, "left")
    found = literal_in_text(F.col(printed), F.col("_text"), boundary, F.col("_norm"))
    reason = (
        F.when(F.col("_text").isNull(), F.lit("text_absent"))
        .when(exempt, F.lit(None).cast("string"))
        .when(~found, F.lit("value_absent"))
    )
    return joined.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull()).drop("_text", "_norm")
