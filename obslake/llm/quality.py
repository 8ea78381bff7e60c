"""Quality rules by a hashed n-gram log-likelihood ratio, in DataFrame operations alone.

Lower-case words and pairs of neighbouring words are hashed into a fixed number of cells. Two multinomials over the
cells are counted in one pass over whole texts: of the trusted target, labelled good, and of the raw corpus, all rows.
A document's score is the mean of log(p target / p raw) over its n-grams, in fixed-point units so that sums do not
depend on their order; documents below the threshold are rejected, those at it are kept.

Which documents are trusted is fitted on a bounded, documented number of labelled rows; counts cover every document.

Null and empty texts have no words, score 0 and are rejected by the base rules. A document with several labels is
trusted if one of them is good; unlabelled ones are raw corpus only. Repeated rows are scored alike. Empty tables give
empty results; without any trusted document every score is 0.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, whole_text, words

UNITS = 1000


def base_columns(text: Column, ws: Column) -> dict[str, Column]:
    """Counts of the base rules; `ws` are the words of `text`."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(ws).cast("long"),
        "word_chars": F.length(F.array_join(ws, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def hashed(ws: str) -> Column:
    """Hash of each word."""
    return F.expr(f"transform({ws}, w -> xxhash64(w))")


def with_pairs(hs: str) -> Column:
    """The words' hashes, then those of all pairs of neighbours."""
    return F.expr(f"concat({hs}, zip_with(slice({hs}, 1, greatest(size({hs}) - 1, 0)), slice({hs}, 2, greatest(size({hs}) - 1, 0)), (a, b) -> xxhash64(a, b)))")


def windows_of_three(hs: str) -> Column:
    """Hashes of the 3-word windows, in order, from the words' hashes."""
    return F.expr(f"CASE WHEN size({hs}) >= 3 THEN transform(sequence(0, size({hs}) - 3), i -> xxhash64({hs}[i], {hs}[i + 1], {hs}[i + 2])) ELSE array() END")


def repeat_words(grams: str) -> Column:
    """Words in windows that are found twice or more; only texts with a repeated window are sorted."""
    return F.expr(f"""
        CASE WHEN size(array_distinct({grams})) = size({grams}) THEN 0L ELSE aggregate(
            sort_array(flatten(transform(array(sort_array(transform({grams}, (h, i) -> struct(h AS h, i AS i)))), s ->
                transform(filter(sequence(0, size(s) - 1), k ->
                    (k > 0 AND s[k].h = get(s, k - 1).h) OR (k < size(s) - 1 AND s[k].h = get(s, k + 1).h)), k -> s[k].i)))),
            struct(0L AS n, -3 AS last),
            (a, i) -> struct(a.n + least(3, i - a.last) AS n, i AS last),
            a -> a.n) END""")


def trusted_ids(labels: DataFrame, *, key: str, good: str, most: int) -> DataFrame:
    """At most `most` ids that are labelled good, those of the smallest hashes."""
    ids = labels.where(F.col(good) == 1).select(F.col(key).alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    return ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(most)


def cell_weights(docs: DataFrame, trusted: DataFrame, *, key: str, text: str, n_cells: int, prior: float) -> list[int]:
    """log(p target / p raw) of each cell in UNITS; `n_cells` numbers whatever the input."""
    narrow = docs.select(F.col(key).alias("key"), words(F.lower(whole_text(text))).alias("ws"))
    # `trusted` has a proven bound
    flagged = narrow.join(F.broadcast(trusted), F.col("key") == F.col("trusted_id"), "left")
    hs = flagged.select(F.col("trusted_id").isNotNull().cast("long").alias("good"), hashed("ws").alias("hs"))
    grams = hs.select("good", F.explode(with_pairs("hs")).alias("h"))
    counted = grams.groupBy(F.col("h").bitwiseAND(n_cells - 1).alias("cell")).agg(F.sum("good").alias("t"), F.count("*").alias("r"))
    found = {row["cell"]: (row["t"], row["r"]) for row in counted.collect()}  # n_cells rows at most
    nt, nr = (sum(v[k] for v in found.values()) for k in (0, 1))
    out = []
    for t, r in (found.get(c, (0, 0)) for c in range(n_cells)):
        # the raw share is the prior of the target's, so that a rare cell says little
        p = (r + 1) / (nr + n_cells)
        out.append(round(UNITS * log((t + prior * p * n_cells) / (nt + prior * n_cells) / p)) if nt else 0)
    return out


def judge(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", good: str = "quality", n_cells: int = 1 << 15,
    most_trusted: int = 20_000, prior: float = 1.0, threshold: float = -0.09,
) -> DataFrame:
    """One row a document: key, base counts, `llr`, `base_failed` and `kept`. `n_cells` is a power of two."""
    trusted = kept(trusted_ids(labels, key=key, good=good, most=most_trusted))
    weights = cell_weights(docs, trusted, key=key, text=text, n_cells=n_cells, prior=prior)
    table = f"CAST(split('{','.join(map(str, weights))}', ',') AS array<int>)"  # folded once into a constant
    body = docs.select(F.col(key).alias("key"), whole_text(text).alias("body"))
    split = body.select("key", "body", words(F.col("body")).alias("ws"), words(F.lower(F.col("body"))).alias("low"))
    base = split.select(
        "key", hashed("ws").alias("hs"), hashed("low").alias("low"), *[c.alias(n) for n, c in base_columns(F.col("body"), F.col("ws")).items()]
    )
    counts = ["key", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    units = base.select(*counts, windows_of_three("hs").alias("windows"), with_pairs("low").alias("grams"))
    units = units.select(*counts, repeat_words("windows").alias("n_repeat_words"), "grams")
    total = F.expr(f"aggregate(grams, 0L, (a, h) -> a + {table}[CAST(h & {n_cells - 1}L AS int)])")
    scored = units.select("*", F.when(F.size("grams") > 0, total / (UNITS * F.size("grams"))).otherwise(F.lit(0.0)).alias("llr"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(
        F.col("key").alias(key), *counts[1:], "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("llr") >= threshold)).alias("kept"), "llr",
    )
