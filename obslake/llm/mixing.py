"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Every source's documents are put in a random but fixed order and repeated in it as often as allowed. A copy's virtual
finish time is the running number of its source's words, itself included, divided by the source's target. All copies
are then ordered by finish time over ranges of it, and the mix takes them until the budget, the sum of all targets, is
used up.

Running sums are taken in two steps, within and over ranges of the order, so a source may hold any share of the rows.

Targets: sources in order of code points, null last, have the given weights in turn and share the budget by weight;
none gets more than `repeats` times its size, and what is over goes to the others by weight until none is above.

Null and empty texts have size 0 and are worth no words; a source of size 0 has target 0. Rows that are equal in the
key columns and the text are taken each on its own, which of them first does not matter. A null id is a value like
others. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, n_words, whole_text

#: Ranges of the finish time over which the global order is dealt.
RANGES = 4096


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """(source, source_size) -> rank, weight and target of each source; one small row a source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("rank", F.row_number().over(order) - 1)
    w = w.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)).cast("long"))
    w = w.withColumn("cap", F.col("source_size") * repeats)
    # sources that reach their cap first come first; the level is what a weight of 1 gets of the rest
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    # too many capped leave less for the rest: the highest level that respects all caps is the one sought
    w = w.withColumn("level", level)
    fits = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(Window.partitionBy())
    return w.select("source", "source_size", "rank", F.least(F.col("cap").cast("double"), fits * F.col("weight")).alias("target"))


def shuffled(docs: DataFrame, *, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    """The narrow rows: id, source, size and a hash that orders them."""
    body = whole_text(text)
    # a null and an empty text, or a null id and an empty one, hash apart
    parts = [F.coalesce(F.concat(F.lit("+"), c), F.lit("-")) for c in (F.col(doc_id).cast("string"), F.col(text))]
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(body).alias("size"),
        F.md5(F.concat(F.lit(seed), *parts).cast("binary")).alias("h"),
    )


def mix(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (1, 2, 3),
    repeats: int = 3, seed: str = "mix",
) -> DataFrame:
    """One row a document: doc_id, source, h, size, source_size, target, copies that the mix takes, taken words."""
    rows = kept(shuffled(docs, doc_id=doc_id, text=text, source=source, seed=seed))
    bin_ = F.substring("h", 1, 3)
    bins = rows.groupBy("source", bin_.alias("bin")).agg(F.sum("size").alias("bin_size"))
    of = targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, repeats)
    t = of.withColumnRenamed("source", "source_of")
    bins = bins.join(t, F.col("source").eqNullSafe(F.col("source_of")), "left").drop("source_of")
    bins = bins.withColumn("before", F.sum("bin_size").over(Window.partitionBy("rank").orderBy("bin")) - F.col("bin_size"))
    bins = bins.select(F.col("source").alias("source_of"), F.col("bin").alias("bin_of"), "rank", "source_size", "target", "before")

    placed = rows.withColumn("bin", bin_).join(bins, F.col("source").eqNullSafe(F.col("source_of")) & (F.col("bin") == F.col("bin_of")))
    order = Window.partitionBy("rank", "bin").orderBy("h", "size")
    placed = placed.withColumn("turn", F.row_number().over(order))
    placed = placed.withColumn("until", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.drop("source_of", "bin_of", "before")

    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = (F.col("copy") * F.col("source_size") + F.col("until")) / F.col("target")
    copies = kept(copies.withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0))).withColumn("range", _range("finish")))
    ranges = copies.groupBy("range").agg(F.sum("size").alias("range_size"))
    all_ranges = Window.partitionBy()
    ranges = ranges.select(  # RANGES rows at most; every source's words stand in them `repeats` times
        F.col("range").alias("range_of"), (F.sum("range_size").over(Window.orderBy("range")) - F.col("range_size")).alias("before"),
        (F.sum("range_size").over(all_ranges) / repeats).cast("long").alias("budget"),
    )
    line = Window.partitionBy("range").orderBy("finish", "rank", "copy", "bin", "turn").rowsBetween(Window.unboundedPreceding, 0)
    copies = copies.join(F.broadcast(ranges), F.col("range") == F.col("range_of"))
    copies = copies.withColumn("taken", F.col("before") + F.sum("size").over(line) <= F.col("budget"))
    same = ["rank", "bin", "turn"]
    return copies.groupBy(*same).agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "h", "size", "source_size", "target")],
        F.sum(F.col("taken").cast("long")).alias("copies"),
        F.sum(F.when(F.col("taken"), F.col("size")).otherwise(F.lit(0))).cast("long").alias("taken"),
    ).drop(*same)


def _range(finish: str) -> Column:
    x = F.col(finish)
    return F.floor(RANGES * x / (1 + x))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns they came with."""
    taken = mix(docs, **how).groupBy("h").agg(F.sum("copies").alias("n_copies"), F.count("*").alias("n_rows"))
    named = {"doc_id": "doc_id", "text": "text", "source": "source", "seed": "mix"} | {k: v for k, v in how.items() if k in ("doc_id", "text", "source", "seed")}
    parts = [F.coalesce(F.concat(F.lit("+"), c), F.lit("-")) for c in (F.col(named["doc_id"]).cast("string"), F.col(named["text"]))]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(row, F.md5(F.concat(F.lit(named["seed"]), *parts).cast("binary")).alias("h"))
    out = whole.join(taken.where("n_copies > 0"), "h")
    # equal rows share the copies of their kind evenly
    turn = F.row_number().over(Window.partitionBy("h").orderBy(F.lit(0)))
    n = F.floor(F.col("n_copies") / F.col("n_rows")) + (turn <= F.col("n_copies") % F.col("n_rows")).cast("long")
    out = out.withColumn("n", n).where("n > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
