"""Bulk extraction: header carry-forward, first yielding block, routing to rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.facts import first_label
from ..functions.numbers import is_numeric_cell


def carry_header(
    blocks: DataFrame,
    doc: Sequence[str],
    pos: str,
    text: str,
    is_header: Column,
    keywords: Sequence[tuple[str, str]],
    reach: int | None = None,
) -> DataFrame:
    """A block belongs to the nearest header before it that holds a keyword.

    Headers without a keyword do not interrupt. With `reach`, a header counts
    only when fewer than that many characters lie between it and the block.
    The window holds the blocks of one document.
    """
    w = W.partitionBy(*doc).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    b = blocks.withColumn("is_header", is_header)
    word = F.when(F.col("is_header"), first_label(F.col(text), keywords))
    if reach is None:
        return b.withColumn("kind", F.last(word, ignorenulls=True).over(w))
    b = b.withColumn("_end", F.sum(F.length(text)).over(w))
    last = F.last(F.when(word.isNotNull(), F.struct(word.alias("kind"), F.col("_end").alias("end"))), ignorenulls=True)
    b = b.withColumn("_h", last.over(w))
    between = F.col("_end") - F.length(text) - F.col("_h.end")
    return b.withColumn("kind", F.when(between < reach, F.col("_h.kind"))).drop("_h", "_end")


def tag_levels(pages: DataFrame, key: str, html: str, name: str) -> DataFrame:
    """Pages cut at the tags of one element: (key, no, piece, level, element_no, is_open).

    A running sum of opening less closing tags is the depth, so equal names close rightly however deep they are nested;
    a closing tag without an opening one counts for nothing, an element that never closes runs to the end. `level` is
    the depth a piece lies at, 0 outside; `element_no` counts the outermost elements from 1 and is null outside. The
    window holds the pieces of one page.
    """
    cuts = rf"(?i)(?=<{name}\b)|(?<=</{name}\s{{0,8}}>)"
    p = pages.select(key, F.posexplode(F.split(html, cuts)).alias("no", "piece"))
    opens, closes = F.col("piece").rlike(rf"(?i)^<{name}\b"), F.col("piece").rlike(rf"(?i)</{name}\s*>$")
    w = W.partitionBy(key).orderBy("no")
    here = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    p = p.withColumn("is_open", opens).withColumn("_net", F.sum(opens.cast("int") - closes.cast("int")).over(here))
    # never below nothing: what was closed too often is given back
    p = p.withColumn("_after", F.col("_net") - F.least(F.lit(0), F.min("_net").over(here)))
    p = p.withColumn("_before", F.lag("_after", 1, 0).over(w))
    p = p.withColumn("level", F.col("_before") + F.col("is_open").cast("int"))
    number = F.sum((F.col("is_open") & (F.col("_before") == 0)).cast("int")).over(here)
    return p.select(key, "no", "piece", "level", F.when(F.col("level") > 0, number).alias("element_no"), "is_open")


def outer_elements(pages: DataFrame, key: str, html: str, name: str) -> DataFrame:
    """Outermost elements of a name: (key, element_no, at, html, layers), `at` being the piece each begins with.

    `layers` has the element's own content without the elements inside it, then that of those inside it, and so on.
    """
    pieces = tag_levels(pages, key, html, name).filter("level > 0")
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["piece"]), "")
    layers = pieces.groupBy(key, "element_no", "level").agg(F.collect_list(F.struct("no", "piece")).alias("pieces"))
    whole = layers.groupBy(key, "element_no").agg(F.flatten(F.collect_list("pieces")).alias("all"), F.array_sort(F.collect_list(F.struct("level", joined("pieces").alias("piece")))).alias("layers"))
    return whole.select(key, "element_no", F.array_min("all")["no"].alias("at"), joined("all").alias("html"), F.col("layers.piece").alias("layers"))


def first_yielding(
    df: DataFrame, keep: Sequence[str], lines: Column, kinds: Sequence[tuple[str, str]], default: str
) -> DataFrame:
    """First line per document and kind that holds figures; empty lines do not count.

    A document's lines are sifted inside its own row, so nothing is shuffled.
    """
    blocks = F.transform(
        lines,
        lambda line, i: F.struct(
            i.alias("pos"),
            F.coalesce(first_label(line, kinds), F.lit(default)).alias("kind"),
            F.filter(F.split(line, " "), is_numeric_cell).alias("figures"),
        ),
    )
    yielding = F.filter(blocks, lambda b: F.size(b["figures"]) > 0)
    names = list(dict.fromkeys([k for _, k in kinds] + [default]))
    d = df.select(*keep, yielding.alias("_b"))

    def first_of(name: str) -> Column:
        return F.get(F.filter("_b", lambda b: b["kind"] == name), 0)

    firsts = F.array_compact(F.array(*[first_of(n) for n in names]))
    return d.select(*keep, F.explode(firsts).alias("_f")).select(
        *keep, "_f.kind", "_f.pos", F.size("_f.figures").alias("n_figures"), "_f.figures"
    )


def quarantine(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Mark rows that lack a mandatory part with the first reason that applies."""
    reason = F.lit(None).cast("string")
    for cond, name in reversed(list(rules)):
        reason = F.when(cond, F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with reason) of one marked frame."""
    return df.filter("reject_reason IS NULL").drop("reject_reason"), df.filter("reject_reason IS NOT NULL")
