"""Document fingerprints by consistent weighted sampling, in DataFrame operations alone.

A text is its words, each weighted by its count. For sample k every word draws, from hashes of itself and k
only, r and c from Gamma(2, 1) and b from the unit interval; a word of weight w then has the level t = floor(ln w / r + b)
and the key ln c - r (t - b + 1). The word with the smallest key is the sample, together with its level. Two texts agree
in a sample with the probability of their generalised Jaccard similarity, sum of min(w, w') over sum of max(w, w'), so
the share of equal samples estimates it; its standard error is sqrt(s (1 - s) / n) for n samples.

`fingerprints` also compares each document with the next in ascending order of ids and with an edited text: its last
quarter of code points replaced by the first as many of the next document's. Documents are put into ranges of the order
once, with the texts; the first document of each range is also sent to the range before. Counts of words, samples and
comparisons then need no further shuffle of texts. Ranges are as many as the session has shuffle partitions, times four.

Ids are numbers; null ids come last, and rows of one id are ordered by a hash of the text. An id that fills a range by
itself is dealt out by that hash; only rows equal in id and text always meet, in a window that spills. A null text is
empty. Texts without a word have equal fingerprints, unlike all others, and a likeness of 1 to each other. A single
document is its own next one. Further columns, of whatever name, stay as they are (`row`); an empty table gives an
empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, whole_text, words

#: Bits of a key that hold its value; the others hold the word, so that equal values cannot mix words up.
VALUE_SCALE = float(1 << 24)
UNIT_BITS = (1 << 21) - 1
#: Samples that one row computes: few, so that the compiled loop stays below the size that the JVM compiles further.
WIDE = 4


def _unit(bits: Column, place: int) -> Column:
    """A number strictly between 0 and 1 from 21 of 64 bits."""
    return (F.shiftrightunsigned(bits, 21 * place).bitwiseAND(F.lit(UNIT_BITS).cast("long")) + 0.5) * (1.0 / (UNIT_BITS + 1))


def draws(word: Column, k: Column) -> tuple[Column, Column, Column]:
    """What a word draws in sample k, whatever its weight: r, ln c and b."""
    one, two = F.xxhash64(word, 2 * k), F.xxhash64(word, 2 * k + 1)
    return -F.ln(_unit(one, 0) * _unit(one, 1)), F.ln(-F.ln(_unit(two, 0) * _unit(two, 1))), _unit(one, 2)


def sample_key(word: Column, weight_log: Column, r: Column, ln_c: Column, b: Column) -> Column:
    """The key of a word of some weight as one number: its value, and below it bits of the word."""
    level = F.when(weight_log == 0.0, F.lit(0.0)).otherwise(F.floor(weight_log / r + b).cast("double"))
    value = ln_c - r * (level - b + 1.0)
    # values lie far within 128 of zero: c is at least e-15, r at most 31 and r times the level about the log of the weight
    return F.shiftleft(((value + 128.0) * VALUE_SCALE).cast("long"), 31).bitwiseOR(word.bitwiseAND(F.lit((1 << 31) - 1).cast("long")))


def samples(counts: DataFrame, by: list[str], weights: dict[str, str], n: int) -> DataFrame:
    """(by, word, weights) -> for each named weight the array of n 31-bit samples; no word at all gives zeros.

    Every row's draws serve all its weights. A word that does not occur in a text has the weight 0 there. `n` is a
    multiple of WIDE: each word gives n / WIDE rows of WIDE samples, which keeps the compiled code small.
    """
    logs = {name: F.when(F.col(w) > 0, F.ln(F.col(w).cast("double"))) for name, w in weights.items()}
    rows = counts.select(*by, "word", *[log.alias(f"log_{name}") for name, log in logs.items()])
    rows = rows.withColumn("lane", F.explode(F.array(*map(F.lit, range(n // WIDE)))))
    drawn = {f"{x}_{j}": c for j in range(WIDE) for x, c in zip("rcb", draws(F.col("word"), F.col("lane") * WIDE + j), strict=True)}
    rows = rows.select(*by, "lane", "word", *[f"log_{name}" for name in logs], *[c.alias(x) for x, c in drawn.items()])
    first, *others = logs
    key = lambda name, j: sample_key(F.col("word"), F.col(f"log_{name}"), *[F.col(f"{x}_{j}") for x in "rcb"])
    rows = rows.select("*", *[key(first, j).alias(f"k_{j}") for j in range(WIDE)])
    # most words weigh the same in both texts
    again = lambda name, j: F.when(F.col(f"log_{name}") == F.col(f"log_{first}"), F.col(f"k_{j}")).otherwise(key(name, j))
    least = rows.groupBy(*by, "lane").agg(
        *[F.min(f"k_{j}").alias(f"{first}_{j}") for j in range(WIDE)], *[F.min(again(name, j)).alias(f"{name}_{j}") for name in others for j in range(WIDE)]
    )
    short = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(c), 33).cast("int"))
    wide = least.select(*by, "lane", *[F.array(*[short(f"{name}_{j}") for j in range(WIDE)]).alias(name) for name in logs])
    lanes = wide.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("lane", *logs))).alias("lanes"))
    return lanes.select(*by, *[F.flatten(F.col(f"lanes.{name}")).alias(name) for name in logs])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)


def printed(samples_: Column) -> Column:
    """Eight hexadecimal digits a sample."""
    return F.array_join(F.transform(samples_, lambda s: F.lpad(F.hex(s), 8, "0")), "")


def _below(cuts: list, c: Column) -> Column:
    """How many of some ascending constants are below a value: a search by halves, as there are as many as ranges."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    at = F.array(*map(F.lit, cuts))
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when((n + s <= len(cuts)) & (F.get(at, n + s - 1) < c), n + s).otherwise(n))


def _ranges(docs: DataFrame, key: Column, h: Column, n: int) -> Column:
    """A non-decreasing number, never null, for (id, hash): ranges of ids; ids that fill one are dealt out by the hash."""
    cuts = docs.agg(F.percentile_approx(key, [(i + 1) / n for i in range(n - 1)], 10 * n).alias("q")).head()["q"] or []
    at = sorted(set(cuts))
    full = sorted({a for a, b in zip(cuts, cuts[1:], strict=False) if a == b})
    alone = key.isin(full) if full else F.lit(False)
    # a full id is a range of its own, behind the smaller ids and before the larger ones
    number = F.when(key.isNull(), F.lit(2 * n + 2)).otherwise(2 * _below(at, key) + _below(full, key))
    part = F.when(alone | key.isNull(), F.shiftrightunsigned(h, 56).bitwiseXOR(F.lit(128).cast("long"))).otherwise(F.lit(0).cast("long"))
    return F.coalesce(number.cast("long") * 256 + part, F.lit(0).cast("long"))


def in_order(docs: DataFrame, *, doc_id: str, text: str, n_ranges: int) -> DataFrame:
    """(range, at, id, text, next_text, extra): every row with its successor's text; `extra` rows close a range.

    Rows are partitioned by `range` and ordered in it by `at`; the last row of a range is the next range's first again.
    """
    # one projection, without nulls in the range: the optimizer may merge several, or a test for null and one of them, in
    # one reader of the ordered rows and not in the other, and then both shuffle the texts
    whole = whole_text(text)
    h = F.xxhash64(whole)
    keyed = docs.select(_ranges(docs, F.col(doc_id), h, n_ranges).alias("range"), F.col(doc_id).alias("id"), whole.alias("text"), h.alias("h"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    heads = keyed.groupBy("range").agg(F.min(order).alias("head"))
    # one narrow row a range
    line = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(line), F.last("range").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select(before.alias("to"), F.col("head.id").alias("head_id"), F.col("head.h").alias("head_h"), F.col("range").alias("from"))
    closing = keyed.join(
        F.broadcast(heads), (F.col("range") == F.col("from")) & F.col("id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    )
    # one row a range; stored, so that what reads the ordered rows twice finds one and the same shuffle
    closing = kept(closing.groupBy("to").agg(*[F.first(c).alias(c) for c in ("id", "text", "h")]))
    both = keyed.select("range", "id", "text", "h", F.lit(0).alias("extra")).unionByName(
        closing.select(F.col("to").alias("range"), "id", "text", "h", F.lit(1).alias("extra"))
    )
    within = Window.partitionBy("range").orderBy("extra", F.col("id").isNull(), "id", "h")
    return both.select("range", F.row_number().over(within).alias("at"), "id", "text", F.lead("text").over(within).alias("next_text"), "extra")


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by the first as many of the next text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(next_text, F.lit(1), quarter))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 64, n_ranges: int | None = None) -> DataFrame:
    """One row a document: id, n_chars, edited_sha256, sample, edited_sample, near_edited, near_next."""
    n_ranges = n_ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_order(docs, doc_id=doc_id, text=text, n_ranges=n_ranges)
    by = ["range", "at"]
    other = F.when(F.col("extra") == 0, edited(F.col("text"), F.col("next_text")))

    told = rows.where("extra = 0").select(
        *by, "id", F.length("text").cast("long").alias("n_chars"), F.sha2(other.cast("binary"), 256).alias("edited_sha256")
    )

    # a word that stands for no word keeps texts without one in the result
    split = lambda c: F.array_append(words(c), "")
    both = F.explode(F.array(F.struct(F.lit(1).alias("own"), split(F.col("text")).alias("ws")), F.struct(F.lit(0).alias("own"), split(F.coalesce(other, F.lit(""))).alias("ws")))).alias("b")
    each = rows.select(*by, both).select(*by, "b.own", F.explode("b.ws").alias("w"))
    is_word = F.col("w") != ""
    each = each.select(*by, F.when(is_word, F.xxhash64("w")).alias("word"), (is_word & (F.col("own") == 1)).cast("int").alias("own"), (is_word & (F.col("own") == 0)).cast("int").alias("edit"))
    counts = each.groupBy(*by, "word").agg(F.sum("own").alias("own"), F.sum("edit").alias("edit"))
    drawn = samples(counts, by, {"sample": "own", "edited_sample": "edit"}, n)

    line = Window.partitionBy("range").orderBy("at")
    drawn = drawn.select(*by, "sample", "edited_sample", F.lead("sample").over(line).alias("next_sample"))
    out = told.join(drawn, by)
    return out.select(
        F.col("id").alias(doc_id), "n_chars", "edited_sha256", "sample", "edited_sample",
        likeness(F.col("sample"), F.col("edited_sample")).alias("near_edited"), likeness(F.col("sample"), F.col("next_sample")).alias("near_next"),
    )
