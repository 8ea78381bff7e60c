"""Personal data: formats, and identifiers that their contexts give away, in DataFrame operations alone.

Emails, addresses, card and phone numbers are found by their formats. These seeds then teach contexts: a pattern is the
word in front of an identifier-shaped run of words, or the words on both sides of it. Patterns and the values they
stand with form a graph, counted over all texts; scores go back and forth for a fixed number of rounds. A pattern is
trusted as far as the values it stands with are, a value as far as its patterns; values of a pattern that are no
identifiers count against it. In the end the patterns of high confidence, seen with enough different seeds, name the
values that no format matches, and every occurrence of such a value in such a context becomes a span.

Places are code points, ends exclusive. Spans of formats stay as they are; discovered ones never overlap them.
Null and empty texts have no spans. Repeated rows are searched alike; a null id is a value like others; an empty table
gives an empty result. Matching takes time in proportion to the text: patterns never go back over what they have read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, whole_text, written

KINDS = ("email", "ip", "card", "phone")
#: Places of the map that spares texts without discovered spans the shuffle: 1 MB.
MAP_PLACES = 1 << 23

# The formats asked for. `\G` is the end of the match before; with the look-behind it keeps a search from
# beginning again inside a run it has already failed on, and what cannot match otherwise is not given back.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A run of words with a digit or an at sign in each, as identifiers have.
SHAPED = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)*+"


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        # a part may have leading zeros; more than three digits after them are over 255
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(r"^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        n = F.length(digits)
        places = F.transform(F.split(F.when(n.between(12, 19), digits), ""), lambda d, i: _luhn(d.cast("int"), (n - 1 - i) % 2))
        return n.between(12, 19) & (F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10 == 0)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _luhn(digit: Column, odd: Column) -> Column:
    twice = digit * 2
    return F.when(odd == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)


def spans_of(text: str, pattern: str, kind: str | None) -> Column:
    """Array of (start, end, rank, kind, value) of a pattern's matches in a text, only the valid ones if a kind is given."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    gaps = F.split(F.col(text), pattern, -1)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda v, g: F.struct(v.alias("value"), F.length(g).alias("gap"), F.length(v).alias("length")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,rank:int,kind:string,value:string>>").alias("found"))
    rank, name = (KINDS.index(kind), kind) if kind else (len(KINDS), "")
    span = lambda a, p: F.struct(
        (a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + p["length"]).alias("end"), F.lit(rank).alias("rank"), F.lit(name).alias("kind"), p["value"].alias("value")
    )
    every = F.aggregate(pairs, none, lambda a, p: F.struct((a["at"] + p["gap"] + p["length"]).alias("at"), F.concat(a["found"], F.array(span(a, p))).alias("found")), lambda a: a["found"])
    empty = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string,value:string>>")
    every = F.when(F.col(text).rlike(pattern), every).otherwise(empty)
    return F.filter(every, lambda s: valid(kind, s["value"])) if kind else every


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """All rows with `base`, the valid spans of the formats by start and kind."""
    hint = {"email": F.col(text).contains("@"), "ip": F.col(text).rlike(r"[0-9]\.[0-9]"), "card": F.col(text).rlike("[0-9]"), "phone": F.col(text).contains("+")}
    empty = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string,value:string>>")
    each = [F.when(hint[k], spans_of(text, FORMATS[k], k)).otherwise(empty) for k in KINDS]
    base = F.concat(*each)
    return docs.withColumn("base", F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))))


def instances(rows: DataFrame, text: str) -> DataFrame:
    """One row for each identifier-shaped run: its place, value, contexts and the kind of a base span in it, if any."""
    shaped = spans_of(text, SHAPED, None)
    runs = rows.where(F.col(text).rlike("[0-9@]")).select("u", "base", text, F.explode(shaped).alias("s"))
    before = F.substring(F.col(text), F.greatest(F.col("s.start") - 80, F.lit(0)) + 1, F.least(F.col("s.start"), F.lit(80)))
    after = F.substring(F.col(text), F.col("s.end") + 1, 80)
    left = F.lower(F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1))
    right = F.lower(F.regexp_extract(after, r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1))
    inside = F.filter("base", lambda b: (b["start"] < F.col("s.end")) & (b["end"] > F.col("s.start")))
    out = runs.select("u", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.value").alias("value"), F.get(inside, F.lit(0))["kind"].alias("seed"), left.alias("left"), right.alias("right"))
    contexts = F.array(F.concat(F.lit("L "), "left"), F.concat(F.lit("B "), "left", F.lit(" "), "right"))
    return out.withColumn("contexts", F.when(F.length("left") > 0, contexts).otherwise(F.array()))


def confident_patterns(found: DataFrame, *, rounds: int, least_seeds: int, least_confidence: float) -> DataFrame:
    """(pattern, kind, confidence) after scores have gone back and forth over the pattern-value graph."""
    edges = found.select(F.explode("contexts").alias("pattern"), "value", "seed").groupBy("pattern", "value").agg(
        F.count("*").alias("n"), F.max("seed").alias("seed")
    )
    # a pattern that stands with too few seeds can never be trusted, whatever the scores
    enough = edges.where("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count("*").alias("seeds")).where(F.col("seeds") >= least_seeds)
    edges = kept(edges.join(enough.select("pattern").distinct(), "pattern", "left_semi"))
    enough = kept(enough)
    learnt = None
    for turn in range(rounds):
        scored = edges if learnt is None else edges.join(learnt, "value", "left")
        score = F.when(F.col("seed").isNotNull(), (F.col("seed") == F.col("kind")).cast("double"))
        score = score if learnt is None else F.coalesce(score, F.when(F.col("learnt") == F.col("kind"), F.col("score")))
        shares = scored.join(enough, "pattern").groupBy("pattern", "kind").agg(
            (F.sum(F.col("n") * F.coalesce(score, F.lit(0.0))) / (F.sum("n") + 1)).alias("confidence")
        )
        if turn == rounds - 1:
            break  # what the last round would teach the values is not asked for
        trusted = shares.where(F.col("confidence") >= 0.5)
        voted = edges.where("seed IS NULL").join(trusted, "pattern").groupBy("value", F.col("kind").alias("learnt")).agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score")
        )
        best = voted.groupBy("value").agg(F.max(F.struct("score", "learnt")).alias("b"))
        learnt = kept(best.select("value", "b.learnt", "b.score"))
    top = shares.where(F.col("confidence") >= least_confidence).groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("b"))
    return kept(top.select("pattern", "b.kind", "b.confidence"))


def maybe_among(rows: DataFrame, hashed: Column, wanted: DataFrame) -> DataFrame:
    """All rows with `maybe`: false only where the hash is none of those `wanted` (h). A map of fixed size is broadcast."""
    at = lambda h: F.pmod(h, F.lit(MAP_PLACES))
    maps = wanted.groupBy(F.bitmap_bucket_number(at(F.col("h"))).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at(F.col("h")))).alias("bitmap"))
    found = rows.withColumn("bucket", F.bitmap_bucket_number(at(hashed))).withColumn("bit", F.bitmap_bit_position(at(hashed)))
    found = found.join(F.broadcast(kept(maps)), "bucket", "left")
    byte = F.expr("CAST(conv(hex(substring(bitmap, CAST(bit div 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    hit = F.expr("CAST(1 AS INT) << CAST(bit % 8 AS INT)").bitwiseAND(byte) != 0
    return found.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("bucket", "bit", "bitmap")


def find(
    docs: DataFrame, *, text: str = "text", rounds: int = 3, least_seeds: int = 5, least_confidence: float = 0.7,
) -> DataFrame:
    """All rows of `docs`, unchanged, with `base` and `spans`: arrays of (start, rank, end, kind, value), sorted."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), whole_text(text).alias("body"))
    narrow = base_spans(rows.where(F.col("body").rlike("[0-9@]")).select("body", F.xxhash64("body").alias("u"), F.length("body").alias("n")), "body")
    # copies of a text have the same spans, so a text is its hashes
    found = written(instances(narrow.withColumn("u", F.struct("u", F.md5("body"), "n")), "body"), "pii-instances")
    patterns = confident_patterns(found, rounds=rounds, least_seeds=least_seeds, least_confidence=least_confidence)
    fresh = found.where("seed IS NULL").select("u", "start", "end", "value", F.explode("contexts").alias("pattern")).join(patterns, "pattern")
    fresh = fresh.groupBy("u", "start", "end", "value").agg(F.max(F.struct("confidence", "kind")).alias("b"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("b.kind")).cast("int") - 1
    fresh = fresh.groupBy("u").agg(F.collect_set(F.struct("start", rank.alias("rank"), "end", F.col("b.kind").alias("kind"), "value")).alias("more"))
    fresh = kept(fresh)
    plain = lambda some: base_spans(some, "body").select("row", "base", F.col("base").alias("spans"))
    if fresh.isEmpty():
        spans = plain(rows)
    else:
        marked = maybe_among(rows, F.xxhash64("body"), fresh.select(F.col("u.u").alias("h")))
        keyed = base_spans(marked.where("maybe"), "body").withColumn("u", F.struct(F.xxhash64("body").alias("u"), F.md5("body"), F.length("body").alias("n")))
        joined = keyed.join(fresh, "u", "left")
        spans = joined.select("row", "base", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(fresh.schema["more"].dataType)))).alias("spans"))
        spans = spans.unionByName(plain(marked.where("NOT maybe")))
    return spans.select("row.*", "base", "spans")


def told(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: str, spans: str) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first speaks for all."""
    merged = F.aggregate(
        F.col(spans), F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda a, s: F.when((F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["end"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"), F.element_at(a, -1)["kind"].alias("kind")))))
        .otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))),
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(
        merged, start,
        lambda a, s: F.struct(F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"), s["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(F.col(text))
