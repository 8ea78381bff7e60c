"""N-gram Jaccard self-join of texts, and its classes.

A text's set are the hashes of its word n-grams. Grams are ordered rare first, by a fixed number of counters that all
rows are counted in; texts that reach the similarity share a gram among the first few of each, so candidates meet on
those alone. A candidate must then pass the length filter, the positional filter (what is left behind the shared gram
suffices) and the suffix filter: grams fall into ranges of the hash, and the ranges whose counts differ in parity are a
lower bound of the sets' difference. What passes meets the same bound once more, over as many ranges as the sets are
large, and what remains is verified once per pair on the whole sets.

Texts with equal sets are one from the start. Of lists with the same members only the first is kept, as it holds the
first gram that a pair of them shares: near copies share many grams, but stand in few lists. Links are found in rounds,
so that a large group of near copies is never expanded into all its pairs: first every text of a gram's list meets one
pivot of the list, then all in a small cell of it, which is the whole of a short list; each list deals its cells anew, so
that texts with many lists meet many others. In the last round texts of long lists that are still in different classes
meet if they still share a prefix once the grams of these texts are counted exactly. Pairs inside a class need no test:
they cannot change it. So the classes are exact.

Null, empty and blank texts have an empty set and are linked with nothing; with fewer words than a gram, the whole
sequence is one gram. Repeated rows are copies. A null id is no candidate for a class's smallest id; a class with null
ids only has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import collected, kept, scramble, slices, text_buffers, word_hashes, written

ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
COUNTERS, COUNTER_BLOCK = 1 << 20, 1 << 12
#: Bytes of text that a task looks at at once: hashing takes about sixty times as much.
SLICE = 1 << 19
#: Members of a cell: lists of up to so many give all their pairs at once.
SHORT = 16
#: Ranges of the suffix filter, 64 to a number.
RANGES, PARITY = 256, ["s0", "s1", "s2", "s3"]
#: Bits of the map that spares most rows a shuffle.
MAP_BITS = 23


def gram_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram) of every text's set, sorted; grams are 64-bit hashes."""
    if n > len(ODD):
        raise ValueError(f"n-grams of at most {len(ODD)} words")
    words, counts = word_hashes(raw, offsets)
    ends = np.cumsum(counts)
    whose = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words))
    begins = at + n <= ends[whose] if len(words) else np.zeros(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < n))
    starts = np.concatenate([at[begins], ends[short] - counts[short]])
    left = np.concatenate([np.full(int(begins.sum()), n), counts[short]])
    grams = np.zeros(len(starts), np.uint64)
    for j in range(n):
        ok = left > j
        grams[ok] += words[starts[ok] + j] * ODD[j]
    grams = scramble(grams + left.astype(np.uint64))
    docs = np.concatenate([whose[begins], short]).astype(np.int64)
    order = np.lexsort((grams, docs))
    docs, grams = docs[order], grams[order]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (grams[1:] != grams[:-1])
    return docs[first], grams[first]


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, text, gram, size of each text's set) for slices of a batch."""
    raw, off = text_buffers(column)
    for a, b in slices(off, SLICE):
        docs, grams = gram_sets(raw[off[a] : off[b]], off[a : b + 1] - off[a], n)
        yield a, docs, grams, np.bincount(docs, minlength=b - a)
    pa.default_memory_pool().release_unused()


def gram_counts(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """How many texts hold a gram of each counter: a fixed number of counters, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, waiting = np.zeros(COUNTERS, np.int64), [], 0
        for b in batches:
            for _, _, grams, _ in _sets(b.column(0), n):
                held.append((grams & np.uint64(COUNTERS - 1)).astype(np.int32))
                waiting += len(grams)
                if waiting >= COUNTERS:
                    total += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=COUNTERS)
        yield from _blocks(dict(enumerate(total.reshape(-1, COUNTER_BLOCK))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(data, np.int64)
        yield from _blocks(sums)

    def _blocks(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["block", "counts"])

    parts = docs.select(text).mapInArrow(count, "block int, counts binary")
    rows = collected(parts.repartition("block").mapInArrow(add, "block int, counts binary"))  # COUNTERS numbers
    total = np.zeros((COUNTERS // COUNTER_BLOCK, COUNTER_BLOCK), np.int64)
    for r in rows:
        total[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(total.ravel(), (1 << 32) - 1).astype(np.uint32)


PROFILE = "doc_id long, n int, k1 long, k2 long, s0 long, s1 long, s2 long, s3 long, sketch binary, grams array<long>"


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _identity(docs: np.ndarray, grams: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        s = np.concatenate([[np.uint64(0)], np.cumsum(scramble(grams ^ np.uint64(salt)))])
        ends = np.searchsorted(docs, np.arange(n_docs), "right")
        starts = np.searchsorted(docs, np.arange(n_docs), "left")
        out.append((s[ends] - s[starts]).view(np.int64))
    return out[0], out[1]


def sketches(docs: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Parities of as many ranges as a set is large, at most twice and at least once: a power of two, RANGES or more.

    The ranges are the last bits of a part of the hash, so that a longer sketch folds to a shorter one.
    """
    ranges = np.where(sizes > 0, np.maximum(RANGES, 1 << np.int64(np.log2(np.maximum(2 * sizes, 1)))), 0)
    begin = np.cumsum(ranges) - ranges
    odd = np.bincount(begin[docs] + ((grams >> np.uint64(28)).astype(np.int64) & (ranges[docs] - 1)), minlength=int(ranges.sum())) & 1
    data, ends = np.packbits(odd.astype(bool)), np.concatenate([[0], np.cumsum(ranges // 8)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """How many ranges of two sketches (bytes) differ: no more than the sets do."""
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def profiles(docs: DataFrame, doc_id: str, text: str, n: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Per row: size and identity of its set, parities of its ranges, and its first grams, rare first."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # COUNTERS numbers

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, whose, grams, sizes in _sets(b.column(1), n):
                k1, k2 = _identity(whose, grams, len(sizes))
                odd = np.bincount(whose * RANGES + (grams >> np.uint64(56)).astype(np.int64), minlength=len(sizes) * RANGES) & 1
                parity = np.packbits(odd.astype(bool).reshape(-1, RANGES), axis=1).view(np.int64)
                common = shared.value[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)]
                order = np.lexsort((grams, common, whose))
                place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                lead = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
                first = order[place < np.repeat(lead, sizes)]
                yield pa.record_batch(
                    [
                        b.column(0).slice(a, len(sizes)), pa.array(sizes, pa.int32()), pa.array(k1), pa.array(k2),
                        *(pa.array(np.ascontiguousarray(x)) for x in parity.T), sketches(whose, grams, sizes), _lists(grams[first].view(np.int64), lead, pa.int64()),
                    ], ["doc_id", "n", "k1", "k2", *PARITY, "sketch", "grams"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text)).mapInArrow(profile, PROFILE)


def flags(rows: DataFrame, key: str, bits: int = MAP_BITS) -> np.ndarray:
    """Bits of a map of fixed size, packed: those at the last bits of the keys are set."""
    at = F.col(key).bitwiseAND((1 << bits) - 1)
    maps = collected(rows.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")))
    out = np.zeros(1 << bits, bool)
    for r in maps:
        found = np.unpackbits(np.frombuffer(bytes(r["bitmap"]), np.uint8), bitorder="little")
        # bucket b stands for the positions (b - 1) * 32768 + 1 .. b * 32768, 0 with bucket 0
        places = np.flatnonzero(found) + (r["bucket"] - 1) * 32768 + 1 if r["bucket"] else np.zeros(1, int)
        out[places[places < len(out)]] = True
    return np.packbits(out)


def whole_sets(docs: DataFrame, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """(k1, k2, set) of the texts in `wanted`, read again; a map of fixed size spares the others the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(flags(wanted, "k1"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = np.unpackbits(shared.value)
        for b in batches:
            for _, whose, grams, sizes in _sets(b.column(0), n):
                k1, k2 = _identity(whose, grams, len(sizes))
                ends = np.cumsum(sizes)
                hit = np.flatnonzero((want[k1 & (len(want) - 1)] > 0) & (sizes > 0))
                _, once = np.unique(np.stack([k1[hit], k2[hit]]), axis=1, return_index=True) if len(hit) else (0, hit)
                hit = hit[once]
                data = [grams[ends[i] - sizes[i] : ends[i]].tobytes() for i in hit.tolist()]
                yield pa.record_batch([pa.array(k1[hit]), pa.array(k2[hit]), pa.array(data, pa.binary())], ["k1", "k2", "grams"])

    found = docs.select(text).mapInArrow(read, "k1 long, k2 long, grams binary")
    return found.join(wanted, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("grams").alias("grams"))


def _reaches(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _positions(percent: int) -> str:
    """What is left behind the shared gram suffices, if it is the first one shared."""
    return f"{100 + percent} * least(a_n - a_at, b_n - b_at) >= {percent} * (a_n + b_n)"


def _parities(percent: int) -> str:
    """The ranges differ too little to rule the pair out."""
    apart = " + ".join(f"bit_count(a_{x} ^ b_{x})" for x in PARITY)
    return f"{100 + percent} * ({apart}) <= {100 - percent} * (a_n + b_n)"


def still_open(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, a_k1, a_k2, b_k1, b_k2) of the pairs whose sketches do not rule the similarity out."""
    side = lambda s: reps.select(F.col("u").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("k1", "k2", "n", "sketch")])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column(6).to_numpy() + b.column(7).to_numpy()
            far = [apart(*(np.frombuffer(s.as_buffer(), np.uint8) for s in two)) for two in zip(b.column(8), b.column(9))]
            ok = (100 + percent) * np.array(far, np.int64) <= (100 - percent) * sizes.astype(np.int64)
            yield pa.RecordBatch.from_arrays(b.columns[:6], b.schema.names[:6]).filter(pa.array(ok))

    names = ["a", "b", "a_k1", "a_k2", "b_k1", "b_k2"]
    known = pairs.join(side("a"), "a").join(side("b"), "b").select(*names, "a_n", "b_n", "a_sketch", "b_sketch")
    return known.mapInArrow(near, ", ".join(f"{c} long" for c in names))


def verified(pairs: DataFrame, reps: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Those of the pairs (a, b) that reach the similarity; `sets` gives the whole sets (k1, k2, grams) of those wanted."""
    known = kept(still_open(pairs, reps, percent))
    key = lambda s: known.select(F.col(f"{s}_k1").alias("k1"), F.col(f"{s}_k2").alias("k2"))
    wanted = kept(key("a").unionByName(key("b")).distinct())
    if wanted.isEmpty():
        return known.select("a", "b")
    # each set goes to where its text is asked for, and from there one of a pair to the other
    told = sets(wanted)
    end = lambda s: told.select(*[F.col(c).alias(f"{s}_{c}") for c in ("k1", "k2", "grams")])
    both = known.join(end("a"), ["a_k1", "a_k2"]).select("a", "b", "b_k1", "b_k2", "a_grams").join(end("b"), ["b_k1", "b_k2"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "a_grams", "b_grams").mapInArrow(check, "a long, b long")


def classes(edges: DataFrame) -> DataFrame:
    """(u, root) of every vertex of the edges (a, b): alternating stars until nothing moves; root is the smallest."""
    e, before = kept(edges.select("a", "b").where("a <> b").distinct()), None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        e = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        hung = down.join(low, "a")
        e = kept(hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        (state,) = collected(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))))
        if state == before:
            return e.select(F.col("a").alias("u"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("u"), F.col("b").alias("root")).distinct())
        before = state


def rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """(u, n, at, g): the first grams of the sets (u, n, grams), rare first by their exact counts over these sets.

    A gram of one set alone stands first and meets nothing; a set whose prefix holds no other gram is gone.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for u, n, data in zip(b.column(0), b.column(1), b.column(2)):
                g = pa.array(np.frombuffer(data.as_buffer(), np.int64))
                yield pa.record_batch([pa.repeat(u, len(g)), pa.repeat(n, len(g)), g], ["u", "n", "g"])

    grams = sets.select("u", "n", "grams").mapInArrow(each, "u long, n int, g long")
    common = grams.withColumn("many", F.count("*").over(Window.partitionBy("g"))).where("many > 1")
    whole = Window.partitionBy("u")
    placed = common.withColumn("alone", F.col("n") - F.count("*").over(whole))
    at = F.col("alone") + F.row_number().over(whole.orderBy("many", "g")) - 1
    lead = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    return placed.withColumn("at", at.cast("int")).where(F.col("at") < lead).select("u", "n", "at", "g")


def once_each(listed: DataFrame) -> DataFrame:
    """(g, many): of the lists (u, at, g) with the same members, two at least, the first one, and the number of members.

    Grams have one order in all sets, so that of two such lists every member has the one before the other.
    """
    lists = listed.groupBy("g").agg(
        F.count("*").alias("many"), F.min("u").alias("low"), F.max("u").alias("high"), F.bit_xor(F.xxhash64("u")).alias("mark"), F.sum("at").alias("depth")
    )
    first = lists.where("many > 1").groupBy("many", "low", "high", "mark").agg(F.min(F.struct("depth", "g")).alias("f"))
    return first.select(F.col("f.g").alias("g"), "many")


def _open(members: DataFrame, by: list[str]) -> DataFrame:
    """The members (by, c, ..) of lists or cells that hold more than one class."""
    lists = members.groupBy(*by).agg(F.min("c").alias("low"), F.max("c").alias("high"))
    return members.join(lists.where("low < high").select(*by), by)


def _pairs(members: DataFrame, filters: str, by: list[str]) -> DataFrame:
    """Pairs (a, b) of members of one list or cell, of different classes, that pass the filters."""
    x, y = (members.select(*by, *[F.col(c).alias(f"{s}_{c}") for c in ("u", "n", "at", "c", *PARITY)]) for s in ("a", "b"))
    return x.join(y, by).where(f"a_u < b_u AND a_c <> b_c AND {filters}").select(F.col("a_u").alias("a"), F.col("b_u").alias("b")).distinct()


def _with_near_size(members: DataFrame, percent: int) -> DataFrame:
    """Members of a list that has another class among sizes that can reach the similarity.

    Sizes fall into classes as wide as the length filter, so that partners are of one or of neighbouring classes.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) * 1.000001))
    cells = members.select("g", "u", "c", F.explode(F.array(step, step + 1)).alias("cell"))
    mixed = cells.groupBy("g", "cell").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    return cells.join(mixed.select("g", "cell"), ["g", "cell"]).select("u").distinct()


def _with_class(listed: DataFrame, label: DataFrame | None) -> DataFrame:
    if label is None:
        return listed.withColumn("c", F.col("u"))
    return listed.join(label, "u", "left").withColumn("c", F.coalesce("root", "u")).drop("root")


def _classed(docs: DataFrame, doc_id: str, text: str, n: int, percent: int, stars: int) -> tuple[DataFrame, DataFrame]:
    """The rows' profiles, and per set (k1, k2): `root` of its class, smallest id and number of copies."""
    rows = written(profiles(docs, doc_id, text, n, percent, gram_counts(docs, text, n)).withColumn("u", F.monotonically_increasing_id()), "profiles")
    same = kept(rows.where("n > 0").groupBy("k1", "k2").agg(F.min("u").alias("u"), F.min("doc_id").alias("least"), F.count("*").alias("n_copies")))
    reps = rows.join(same.select("u"), "u", "left_semi")
    # narrow rows for all grams; the rest is joined to those that are left
    # dealt by gram once, for the lists and for what joins them; a gram has a row a text at most
    listed = reps.select("u", F.posexplode("grams").alias("at", "g")).where("g IS NOT NULL").repartition("g")
    listed = kept(listed.join(once_each(listed), "g").join(reps.select("u", "n", *PARITY), "u"))
    filters = f"{_reaches('a_n', 'b_n', percent)} AND {_positions(percent)} AND {_parities(percent)}"
    from_texts = lambda wanted: whole_sets(docs, text, n, wanted)
    label = None

    def linked(pairs: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
        """(u, root) by the links so far, as stars, and by those of the pairs that hold."""
        found = kept(verified(pairs.select("a", "b").distinct(), reps, sets, percent))
        if found.isEmpty():
            return label
        return kept(classes(found if label is None else found.unionByName(label.select(F.col("u").alias("a"), F.col("root").alias("b")))))

    for turn in range(stars):
        members = _with_class(listed, label)
        if turn:
            cell = F.pmod(F.xxhash64("u", "g", F.lit(turn)), F.ceil(F.col("many") / SHORT))
            label = linked(_pairs(kept(_open(members.withColumn("cell", cell), ["g", "cell"])), filters, ["g", "cell"]), from_texts)
            continue
        # the pivot is the smallest set
        first = F.struct("n", "u", "at", "c", *PARITY)
        pivot = members.groupBy("g").agg(F.min(first).alias("p"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
        met = members.join(pivot.select("g", "p"), "g").where("c <> p.c").select(
            F.least("u", "p.u").alias("a"), F.greatest("u", "p.u").alias("b"), F.col("n").alias("a_n"), F.col("at").alias("a_at"),
            F.col("p.n").alias("b_n"), F.col("p.at").alias("b_at"), *[F.col(f"{f}{x}").alias(f"{t}_{x}") for f, t in (("", "a"), ("p.", "b")) for x in PARITY],
        )
        label = linked(met.where(filters), from_texts)

    # Short lists have met as a whole. Members of longer lists are counted anew, exactly and each set once: sets that
    # differ by more than the similarity allows hold enough grams of their own to list no other, in groups of any size.
    left = kept(_open(_with_class(listed.where(F.col("many") > SHORT) if stars > 1 else listed, label), ["g"]))
    wanted = kept(reps.select("u", "n", "k1", "k2", *PARITY).join(_with_near_size(left, percent), "u"))
    if not wanted.isEmpty():
        sets = written(from_texts(wanted.select("k1", "k2")).join(wanted.drop(*PARITY), ["k1", "k2"]), "sets")
        again = kept(rare_first(sets, percent))
        again = again.join(once_each(again), "g").join(wanted.select("u", *PARITY), "u")
        met = _pairs(kept(_open(_with_class(again, label), ["g"])), filters, ["g"])
        label = linked(met, lambda wanted: sets.select("k1", "k2", "grams").join(wanted, ["k1", "k2"], "left_semi"))
    if label is None:
        return rows, kept(same.withColumn("root", F.col("u")))
    return rows, kept(same.join(label, "u", "left").withColumn("root", F.coalesce("root", "u")))


def join_classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, stars: int = 2,
) -> DataFrame:
    """One row a document: doc_id, n_grams (size of its set), class_id (smallest id in its class), copies in its text's set."""
    rows, named = _classed(docs, doc_id, text, n, percent, stars)
    lowest = named.groupBy("root").agg(F.min("least").alias("class_id"))
    named = named.join(lowest, "root").select("k1", "k2", "class_id", "n_copies")
    out = rows.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select(
        F.col("doc_id"), F.col("n").cast("long").alias("n_grams"), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("n") > 0, F.col("n_copies")).otherwise(F.lit(1)).cast("long").alias("n_copies"),
    )


def one_of_each(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, stars: int = 2,
) -> DataFrame:
    """Of each class the row with the smallest id, null last, with the columns it came with; empty sets all stay.

    `docs` has no columns named as those of this operator; of rows equal in id and set one stays.
    """
    _, named = _classed(docs, doc_id, text, n, percent, stars)
    no_id = F.lit((1 << 63) - 1)
    best = named.groupBy("root").agg(F.min(F.struct(F.coalesce("least", no_id).alias("did"), "k1", "k2")).alias("b")).select("b.*")
    place = docs.columns.index(text)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, whose, grams, sizes in _sets(b.column(place), n):
                k1, k2 = _identity(whose, grams, len(sizes))
                yield pa.RecordBatch.from_arrays([*b.slice(a, len(sizes)).columns, pa.array(k1), pa.array(k2), pa.array(sizes, pa.int32())], [*b.schema.names, "k1", "k2", "n"])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in ("k1", "k2")), T.StructField("n", T.IntegerType())])
    known = docs.mapInArrow(identify, schema).withColumn("did", F.coalesce(F.col(doc_id).cast("long"), no_id))
    turn = F.row_number().over(Window.partitionBy("did", "k1", "k2").orderBy("did"))
    first = known.where("n > 0").join(best, ["did", "k1", "k2"], "left_semi").withColumn("turn", turn).where("turn = 1")
    return first.select(*docs.columns).unionByName(known.where("n = 0").select(*docs.columns))
