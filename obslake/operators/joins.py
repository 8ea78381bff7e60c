"""Joins of the observation model. No cross joins, no bare range joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..session import ensure_checkpoint_dir
from .ordered import first_per_key, join_null_safe
from .reconcile import rel_error


def prior_period_rows(
    df: DataFrame, keys: Sequence[str], period: str, value: str, change_basis: str
) -> DataFrame:
    """Pair each row with its own series at the period its change refers to.

    `change_basis` holds 'prev_month' or 'prev_year_end' per row. Rows without
    a basis or without the referenced period are left out. Run it on one
    vintage per key and period.
    """
    ref = F.when(F.col(change_basis) == "prev_month", cal.prior_month(F.col(period))).when(
        F.col(change_basis) == "prev_year_end", cal.prior_year_end(F.col(period))
    )
    left = df.withColumn("ref_period", ref).filter(F.col("ref_period").isNotNull())
    right = df.select(*keys, F.col(period).alias("ref_period"), F.col(value).alias("ref_value"))
    pairs = join_null_safe(left, right, [*keys, "ref_period"], "inner")
    return pairs.filter(F.col("ref_value").isNotNull())


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; counted before the join.

    A null reference is no reference and is not reported.
    """
    counted = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(parent, counted[child_key] == parent[parent_key], "left_anti")


def compare_channels(
    a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float, arrival: str | None = None
) -> DataFrame:
    """Full outer comparison of one measure in two channels, one row per key in each.

    With an `arrival` column a key may hold several rows in a channel: the first
    value to arrive is compared, and `n_set_aside` counts the key's other values.

    Stacked and grouped instead of joined: keys match null-safe and each side
    is shuffled once.
    """
    none = F.lit(None)
    at = [] if arrival is None else [F.col(arrival).alias("_at")]
    both_sides = a.select(*keys, F.col(value).alias("a"), none.alias("b"), *at).unionByName(
        b.select(*keys, none.alias("a"), F.col(value).alias("b"), *at)
    )
    if arrival is None:
        picked = [F.max("a").alias("value_a"), F.max("b").alias("value_b")]
    else:
        # null arrivals come last, of equal ones the smaller value first
        first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("_at").isNull(), "_at", F.col(c).alias("v"))))["v"]
        extra = F.greatest(F.count("a") - 1, F.lit(0)) + F.greatest(F.count("b") - 1, F.lit(0))
        picked = [first("a").alias("value_a"), first("b").alias("value_b"), extra.alias("n_set_aside")]
    g = both_sides.groupBy(*keys).agg(*picked)
    rel = rel_error(F.col("value_a").cast("double"), F.col("value_b").cast("double"))
    return g.withColumn("difference", F.col("value_a") - F.col("value_b")).withColumn("agrees", rel <= tolerance)


def validity_join(
    fact: DataFrame, dim: DataFrame, key: str, at: Column, valid_from: str, valid_to: str
) -> DataFrame:
    """Row of a slowly changing dimension that was valid at the fact's date.

    The entity key is an equality, so the range test is a residual on a keyed
    join; an open end is valid for ever.
    """
    d = dim.withColumnRenamed(key, f"_{key}")
    cond = (
        (F.col(key) == F.col(f"_{key}"))
        & (F.col(valid_from) <= at)
        & (F.col(valid_to).isNull() | (at < F.col(valid_to)))
    )
    return fact.join(d, cond, "inner").drop(f"_{key}")


def validity_sweep(
    fact: DataFrame, dim: DataFrame, key: str, at: str, valid_from: str, valid_to: str, bucket_days: int = 90
) -> DataFrame:
    """`validity_join` for keys with very many facts and versions.

    Time is cut into buckets: a version stands in every bucket it is valid in, within the time that facts cover, a fact
    in its own. They meet on (key, bucket), so an entity is spread over its buckets, and dates are compared inside one.
    Versions may overlap, a fact then meets each; a missing start or end is open. Facts without a date meet none.
    """
    number = lambda c: F.floor(F.unix_date(c.cast("date")) / bucket_days)
    ends = fact.agg(number(F.min(at)).alias("low"), number(F.max(at)).alias("high")).head()
    low, high = (0 if ends[i] is None else ends[i] for i in (0, 1))
    first = F.greatest(F.coalesce(number(F.col(valid_from)), F.lit(low)), F.lit(low))
    last = F.least(F.coalesce(number(F.col(valid_to)), F.lit(high)), F.lit(high))
    spread = dim.withColumn("_bucket", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    d = spread.withColumnRenamed(key, f"_{key}").withColumnRenamed("_bucket", "_b")
    f = fact.withColumn("_bucket", number(F.col(at)))
    cond = (
        (F.col(key) == F.col(f"_{key}")) & (F.col("_bucket") == F.col("_b"))
        & (F.col(valid_from).isNull() | (F.col(valid_from) <= F.col(at))) & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    )
    return f.join(d, cond, "inner").drop(f"_{key}", "_bucket", "_b")


def successor_breaks(dim: DataFrame, key: str, successor: str, valid_from: str, valid_to: str) -> DataFrame:
    """One row for every entity whose series breaks: (key, successor, break_date, kind, days).

    kind: `succession` (the successor begins as the entity ends), `gap` and `overlap` (by `days`), `ended` (no
    successor), `undated` (a successor but no end), `unknown_successor`.
    """
    nxt = dim.select(F.col(key).alias("_s"), F.col(valid_from).alias("_begins"), F.lit(True).alias("_known"))
    j = dim.join(nxt, F.col(successor) == F.col("_s"), "left")
    days = F.date_diff("_begins", valid_to)
    kind = (
        F.when(F.col(successor).isNull(), F.when(F.col(valid_to).isNotNull(), "ended")).when(F.col("_known").isNull(), "unknown_successor")
        .when(F.col(valid_to).isNull(), "undated").when(days > 0, "gap").when(days < 0, "overlap").otherwise("succession")
    )
    return j.select(key, successor, F.col(valid_to).alias("break_date"), kind.alias("kind"), F.coalesce(days, F.lit(0)).alias("days")).filter("kind IS NOT NULL")


def survivors_asof(dim: DataFrame, facts: DataFrame, key: str, at: str, successor: str, valid_to: str) -> DataFrame:
    """Facts (key, at) with `survivor`, the entity that carries the key's series on that date, and the `hops` to it.

    A series passes on from the day its entity ends. Links are composed by doubling, each with the day from which the
    whole of it holds; a fact then takes the longest link that holds on its day, and shorter ones after it, so a chain
    of n mergers costs log2(n) joins and no list of intervals. Chains stop at an entity without an end, without or
    with an unknown successor. In a cycle that goes round on the fact's day there is no survivor.
    """
    ensure_checkpoint_dir(dim.sparkSession)
    known = dim.select(F.col(key).alias("_k"))
    link = dim.filter(F.col(successor).isNotNull() & F.col(valid_to).isNotNull()).join(known, F.col(successor) == F.col("_k"), "left_semi")
    link = link.select(F.col(key).alias("_e"), F.col(successor).alias("_s"), F.col(valid_to).alias("_holds")).checkpoint()
    links, reach, most = [link], 1, link.count()
    while reach <= most:
        a = links[-1]
        b = a.select(F.col("_e").alias("_s"), F.col("_s").alias("_s2"), F.col("_holds").alias("_h2"))
        longer = a.join(b, "_s").select("_e", F.col("_s2").alias("_s"), F.greatest("_holds", "_h2").alias("_holds")).checkpoint()
        if longer.isEmpty():
            break
        links.append(longer)
        reach *= 2
    out = facts.withColumns({"survivor": F.col(key), "hops": F.lit(0)})
    for i, step in reversed(list(enumerate(links))):
        taken = F.col("_e").isNotNull()
        out = out.join(step, (F.col("survivor") == F.col("_e")) & (F.col("_holds") <= F.col(at)), "left")
        out = out.withColumns({
            "survivor": F.coalesce("_s", "survivor"), "hops": F.col("hops") + F.when(taken, 1 << i).otherwise(0)
        }).drop("_e", "_s", "_holds")
    # more hops than there are links: the chain goes round
    return out.withColumns({"survivor": F.when(F.col("hops") <= most, F.col("survivor")), "hops": F.when(F.col("hops") <= most, F.col("hops"))})


def resolve_successors(dim: DataFrame, key: str, successor: str) -> DataFrame:
    """Surviving entity of every entity, following successor links to the end.

    Every round doubles the length of the links, so a chain of n mergers takes
    log2(n) rounds; each round is checkpointed so the plan does not grow. A
    cycle or a link to an unknown entity has no survivor and gives null.
    """
    ensure_checkpoint_dir(dim.sparkSession)
    links = dim.select(
        key,
        F.coalesce(successor, F.col(key)).alias("survivor"),
        F.col(successor).isNotNull().cast("int").alias("hops"),
    ).checkpoint()
    entities = links.count()
    reach = 1
    while True:
        step = links.select(
            F.col(key).alias("survivor"), F.col("survivor").alias("_s2"), F.col("hops").alias("_h2")
        )
        joined = links.join(step, "survivor", "left").select(
            key,
            F.coalesce("_s2", "survivor").alias("survivor"),
            (F.col("hops") + F.coalesce("_h2", F.lit(0))).alias("hops"),
            (F.coalesce("_h2", F.lit(0)) > 0).alias("_moved"),
        ).checkpoint()
        links = joined.drop("_moved")
        reach *= 2
        if reach > entities or joined.filter("_moved").isEmpty():
            break
    ends = dim.filter(F.col(successor).isNull()).select(F.col(key).alias("_end"))
    return links.join(ends, F.col("survivor") == F.col("_end"), "left").select(
        key, F.col("_end").alias("survivor"), "hops"
    )


def merge_sources(sources: Sequence[DataFrame], key: str, order: Sequence[str] = ()) -> DataFrame:
    """Union of several searches, deduplicated on id; the earliest source wins."""
    tagged = [d.withColumn("source_no", F.lit(i)) for i, d in enumerate(sources)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return first_per_key(both, [key], [F.col("source_no"), *[F.col(c).asc_nulls_last() for c in order]])


def admitted_only(df: DataFrame, admitted: DataFrame, key: str) -> DataFrame:
    """Rows whose document was admitted."""
    return df.join(admitted.select(key), key, "left_semi")
