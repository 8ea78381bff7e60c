"""Collocations from FM-indexes over word ids, one index a shard, summed across shards.

Texts are cut into pieces and words. Each scan task cuts its documents into shards of bounded size and writes, for every
shard, a dictionary of its (language, word) pairs with counts and the stream of their numbers, 0 between pieces. Then:

1. Counts of words are summed over shards; words below the threshold cannot stand in a phrase and become 0 in a stream.
2. Every shard builds an FM-index of its stream and one of the reversed stream. All words are extended to the left by
   every word that their intervals of the Burrows-Wheeler transform hold: these are the pairs, with counts. Sums over the
   shards tell each shard which of its pairs reach the threshold.
3. Only those are extended further, to the right in the reversed index, the interval of each index being kept in step
   with the other's: triples both of whose pairs reach the threshold. Their sums go back to the shards as well.
4. Those that reach it are extended to the left in the other index: quadruples both of whose triples do.

So all phrases of two to four words with at least `least` occurrences are found, with exact counts, and with every phrase
all its parts. No task holds more than a shard; shards are as long as tasks give, so their number follows the input.

Nulls: a null language is `und`, a null text is empty. Texts without a word give nothing; repeated rows count each. A
document longer than a shard is a shard of its own. Only the two columns named are read, whatever else a table holds. An
empty table gives an empty result. Which of several shards a document falls into does not change any count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, lower_bytes, slices, text_buffers, written

#: Words that no language is given for.
NO_LANGUAGE = "und"
MOST = 4
#: Shard numbers that a task may give.
TASK_SHARDS = 1 << 12
SHARD = "shard long, local int, lang string, word string, n long, codes binary"

# What parts words within a piece, and what parts pieces.
_GAP = np.zeros(256, bool)
_GAP[[9, 32]] = True
_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_APART = _GAP | _CUT


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lowered words of some texts, the text each stands in, and whether it begins a piece."""
    low, solid = lower_bytes(raw), ~_APART[raw]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    opens[edge] = solid[edge]
    start = np.flatnonzero(opens)
    place = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(solid, out=place[1:])
    ends = np.append(place[start], place[-1])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[solid])])
    doc = np.searchsorted(offsets, start, "right") - 1
    cuts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_CUT[raw], out=cuts[1:])
    first = np.ones(len(start), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (cuts[start[1:]] != cuts[start[:-1]])
    return words, doc, first


def shards(docs: DataFrame, *, text: str, lang: str, size: int = 32 << 20) -> DataFrame:
    """(shard, local, lang, word, n) for every word of a shard, and (shard, codes) once a shard; `size` in bytes."""

    def shard(number: int, held: list) -> Iterator[pa.RecordBatch]:
        words = pa.concat_arrays([h[0] for h in held]).dictionary_encode()
        langs = pa.concat_arrays([h[1] for h in held]).dictionary_encode()
        first = np.concatenate([h[2] for h in held])
        many = max(len(langs.dictionary), 1)
        pair, code, n = np.unique(
            words.indices.to_numpy().astype(np.int64) * many + langs.indices.to_numpy(), return_inverse=True, return_counts=True
        )
        # frequent words first
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        pair, n = pair[order], n[order]
        # a 0 in front of every piece and one at the end
        stream = np.zeros(len(code) + int(first.sum()) + 1, np.int32)
        stream[np.arange(len(code)) + np.cumsum(first)] = rank[code] + 1
        one = pa.record_batch(
            {
                "shard": pa.array([number], pa.int64()), "local": pa.nulls(1, pa.int32()), "lang": pa.nulls(1, pa.string()),
                "word": pa.nulls(1, pa.string()), "n": pa.array([len(stream)], pa.int64()), "codes": pa.array([packed(stream)], pa.binary()),
            }
        )
        yield one
        for at in range(0, len(pair), 1 << 16):
            p = pair[at : at + (1 << 16)]
            yield pa.record_batch(
                {
                    "shard": pa.array(np.full(len(p), number)), "local": pa.array(np.arange(at + 1, at + 1 + len(p), dtype=np.int32)),
                    "lang": langs.dictionary.take(pa.array(p % many)).cast(pa.string()),
                    "word": words.dictionary.take(pa.array(p // many)).cast(pa.large_string()).cast(pa.string()),
                    "n": pa.array(n[at : at + (1 << 16)]), "codes": pa.nulls(len(p), pa.binary()),
                }
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = TaskContext.get().partitionId() * TASK_SHARDS
        number, held, full = begin, [], 0
        for batch in batches:
            raw, offsets = text_buffers(batch.column(0))
            names = batch.column(1).fill_null(NO_LANGUAGE)
            for a, b in slices(offsets, min(size, 2 << 20)):
                words, doc, first = tokens(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if len(words):
                    held.append((words, names.take(pa.array(doc + a)), first))
                full += int(offsets[b] - offsets[a])
                if full >= size and held:
                    yield from shard(number, held)
                    number, held, full = number + 1, [], 0
                    pa.default_memory_pool().release_unused()
                    if number == begin + TASK_SHARDS:
                        raise ValueError("a task has more shards than numbers: take larger shards")
        if held:
            yield from shard(number, held)

    return docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(cut, SHARD)


def packed(stream: np.ndarray) -> bytes:
    """Numbers of four bytes as four planes of bytes, compressed: frequent words have small numbers, so most are zero."""
    return pa.compress(np.ascontiguousarray(stream.astype(np.int32).view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


class Index:
    """FM-index of a stream of numbers, 0 between pieces, for patterns of up to four numbers without 0.

    Suffixes are in the order of their first four numbers, which is all that patterns of that length need.
    """

    def __init__(self, stream: np.ndarray, top: int):
        n = len(stream)
        pad = np.concatenate([stream, np.zeros(MOST, stream.dtype)]).astype(np.int64)
        # ranks of pairs, then the order of pairs of pairs
        pairs = pad[: n + 2] * (top + 1) + pad[1 : n + 3]
        del pad
        order = np.argsort(pairs)
        new = np.ones(n + 2, np.int64)
        new[1:] = pairs[order[1:]] != pairs[order[:-1]]
        pairs[order] = np.cumsum(new)
        del new, order
        order = np.argsort(pairs[:n] * int(n + 3) + pairs[2:])
        del pairs
        self.bwt = stream[order - 1]  # before the first stands the last, and both are 0
        del order
        self.first = np.concatenate([[0], np.cumsum(np.bincount(stream, minlength=top + 1))])
        self.lf = np.empty(n, np.int32)
        self.lf[np.argsort(self.bwt, kind="stable")] = np.arange(n, dtype=np.int32)

    def extend(self, low: np.ndarray, high: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """All one-number extensions of some intervals: (which, number, low, high, other).

        `other` is where the same patterns' intervals begin in the index of the reversed stream; there, an extended
        pattern's interval lies inside, behind those of smaller numbers.
        """
        size = high - low
        which = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        key, seen, n = np.unique((which << 32) + self.bwt[at], return_index=True, return_counts=True)
        which, number = key >> 32, key & 0xFFFFFFFF
        before = np.cumsum(n) - n
        inside = before - (np.cumsum(size) - size)[which]
        begin = self.lf[at[seen]].astype(np.int64)
        real = number > 0
        return tuple(x[real] for x in (which, number, begin, begin + n, other[which] + inside))


class Shard:
    """The two indexes of a shard and its pairs."""

    def __init__(self, stream: np.ndarray, local: np.ndarray, ids: np.ndarray):
        order = np.argsort(local)
        self.ids = np.concatenate([[-1], ids[order]])
        number = np.zeros(max(int(stream.max(initial=0)), int(local.max(initial=0))) + 1, np.int32)
        number[local[order]] = np.arange(1, len(local) + 1)
        stream = number[stream]
        top = len(local)
        self.stream, self.left = stream, Index(stream, top)
        words = np.arange(1, top + 1)
        low, high = self.left.first[words], self.left.first[words + 1]
        # word by word the intervals are alike in both indexes
        which, number, self.low, self.high, self.other = self.left.extend(low, high, low)
        self.pairs = np.stack([number, words[which]]) if top else np.zeros((2, 0), np.int64)

    def triples(self, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Triples both of whose pairs are among `nodes`: the words, and where they begin in either index, and how many."""
        x, y = self.pairs[:, nodes]
        good = np.sort((x << 32) + y)
        low, high, other = self.low[nodes], self.high[nodes], self.other[nodes]
        # to the right: intervals of the reversed index, in step with those of the other
        right = Index(self.stream[::-1].copy(), len(self.ids) - 1)
        which, z, rlow, rhigh, begin = right.extend(other, other + high - low, low)
        key = (y[which] << 32) + z
        keep = good[np.minimum(np.searchsorted(good, key), len(good) - 1)] == key
        which, z = which[keep], z[keep]
        return np.stack([x[which], y[which], z]), begin[keep], rlow[keep], (rhigh - rlow)[keep]

    def quadruples(self, nodes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quadruples both of whose triples are among the `chosen` ones of `triples(nodes)`, and their counts."""
        words, begin, rlow, n = (v[..., chosen] for v in self.triples(nodes))
        which, w, low, high, _ = self.left.extend(begin, begin + n, rlow)
        # triples as pairs of numbers: the place of their first pair, and the third word
        pair = np.unique((self.pairs[0] << 32) + self.pairs[1])
        key = lambda a, b, c: np.searchsorted(pair, (a << 32) + b) * np.int64(len(self.ids)) + c
        keep = np.isin(key(w, words[0, which], words[1, which]), key(*words))
        return np.concatenate([w[None, keep], words[:, which[keep]]]), (high - low)[keep]


def _over_shards(table: DataFrame, marks: DataFrame, solve, schema: str) -> DataFrame:
    """`solve(shard, Shard, nodes, triples)` for every shard, from the written streams and what is known about each.

    `marks` has (shard, local, id) for frequent words, (shard, node) for frequent pairs and (shard, triple) for triples. One shard is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if shard[a] != now and parts:
                    yield from one(now, parts)
                    parts = []
                now = shard[a]
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from one(now, parts)

    def one(number: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts)
        codes = t.column("codes").drop_null()
        words = t.filter(pc.is_valid(t.column("local")))
        if not len(codes) or not len(words):
            return
        stream = unpacked(codes[0].as_buffer(), t.column("length").drop_null()[0].as_py())
        shard = Shard(stream, words.column("local").to_numpy(), words.column("id").to_numpy())
        nodes, triples = (np.sort(t.column(c).drop_null().to_numpy()).astype(np.int64) for c in ("node", "triple"))
        del t, codes, words, stream, parts[:]
        yield from solve(int(number), shard, nodes, triples)
        del shard
        pa.default_memory_pool().release_unused()

    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    streams = table.where("codes IS NOT NULL").select("shard", none("int", "local"), none("long", "id"), none("int", "node"), none("int", "triple"), F.col("n").alias("length"), "codes")
    rows = streams.unionByName(marks, allowMissingColumns=True)
    return rows.select("shard", "local", "id", "node", "triple", "length", "codes").repartition("shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def _batches(columns: dict[str, np.ndarray], step: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for a in range(0, n, step):
        yield pa.record_batch({k: pa.array(v[a : a + step]) for k, v in columns.items()})


def _pairs(number: int, shard: Shard, nodes: np.ndarray, triples: np.ndarray) -> Iterator[pa.RecordBatch]:
    x, y = shard.ids[shard.pairs]
    n = shard.high - shard.low
    # the number of the shard and of the pair in it as one
    yield from _batches({"at": (number << 32) + np.arange(len(n)), "w1": x, "w2": y, "n": n})


def _triples(number: int, shard: Shard, nodes: np.ndarray, triples: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(nodes):
        words, _, _, n = shard.triples(nodes)
        w1, w2, w3 = shard.ids[words]
        yield from _batches({"at": (number << 32) + np.arange(len(n)), "w1": w1, "w2": w2, "w3": w3, "n": n})


def _quadruples(number: int, shard: Shard, nodes: np.ndarray, triples: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(triples):
        words, n = shard.quadruples(nodes, triples)
        yield from _batches(dict(zip(("w1", "w2", "w3", "w4", "n"), (*shard.ids[words], n), strict=True)))


def _reaching(rows: DataFrame, words: list[str], least: int, name: str) -> DataFrame:
    """(shard, <name>, words, a) of the phrases whose sums over the shards reach the threshold."""
    # shards have added up already, so a window only brings their sums together and needs no second shuffle to go back
    rows = rows.withColumn("a", F.sum("n").over(Window.partitionBy(*words))).where(F.col("a") >= least)
    place = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")
    return kept(rows.select(F.shiftright("at", 32).alias("shard"), place.alias(name), *words, "a"))


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, size: int = 32 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, lang, word, n) of frequent words, (ids, a) of all frequent phrases of 1 to 4 words, (lang, n) of all words."""
    table = written(shards(docs, text=text, lang=lang, size=size), "phrase-shards")
    dictionary = table.where("local IS NOT NULL").select("shard", "local", "lang", "word", "n")
    totals = dictionary.groupBy("lang").agg(F.sum("n").alias("n"))
    # a word is known by its first shard and its number there
    same = Window.partitionBy("lang", "word")
    first = F.min(F.shiftleft("shard", 32) + F.col("local")).over(same)
    known = dictionary.select("*", F.sum("n").over(same).alias("a"), first.alias("id")).where(F.col("a") >= least)
    known = written(known.select("shard", "local", "lang", "word", "a", "id"), "phrase-words")
    words = known.where(F.col("id") == F.shiftleft("shard", 32) + F.col("local")).select("id", "lang", "word", F.col("a").alias("n"))
    known = known.select("shard", "local", "id")

    two, three, four = (["w1", "w2", "w3", "w4"][:n] for n in (2, 3, 4))
    pairs = _reaching(_over_shards(table, known, _pairs, "at long, w1 long, w2 long, n long"), two, least, "node")
    marks = known.unionByName(pairs.select("shard", "node"), allowMissingColumns=True)
    triples = _reaching(_over_shards(table, marks, _triples, "at long, w1 long, w2 long, w3 long, n long"), three, least, "triple")
    marks = marks.unionByName(triples.select("shard", "triple"), allowMissingColumns=True)
    quads = _over_shards(table, marks, _quadruples, "w1 long, w2 long, w3 long, w4 long, n long")
    quads = quads.groupBy(*four).agg(F.sum("n").alias("a")).where(F.col("a") >= least)

    phrases = words.select(F.array("id").alias("ids"), F.col("n").alias("a"))
    for found, names in ((pairs, two), (triples, three)):
        phrases = phrases.unionByName(found.groupBy(*names).agg(F.first("a").alias("a")).select(F.array(*names).alias("ids"), "a"))
    return words, kept(phrases.unionByName(quads.select(F.array(*four).alias("ids"), "a"))), totals


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def cut_scores(phrases: DataFrame) -> DataFrame:
    """(ids, a, l, r, score) of each phrase at its lowest-scoring cut; equal scores go to the shortest first part."""
    cuts = phrases.where("size(ids) > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cuts = cuts.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"))
    cuts = cuts.join(phrases.select(F.col("ids").alias("head"), F.col("a").alias("l")), "head")
    cuts = cuts.join(phrases.select(F.col("ids").alias("tail"), F.col("a").alias("r")), "tail")
    # decimals: two million times a count may pass 64 bits
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS LONG)")
    best = cuts.withColumn("score", score).groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a"))
    return best.select("ids", "a", "b.l", "b.r", "b.score")


def swallowed(phrases: DataFrame) -> DataFrame:
    """(ids, most): the highest count of a longer phrase that a phrase lies in, for phrases of two words and more."""
    longer = phrases.where("size(ids) > 2")
    parts = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("ids") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.size("ids") - n + 1), lambda i: F.slice("ids", i, n)),
    ))
    return longer.select(F.explode(parts).alias("ids"), "a").groupBy("ids").agg(F.max("a").alias("most"))


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, share: int = 80, top: int = 2000, size: int = 32 << 20,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two to four words."""
    words, phrases, totals = phrase_counts(docs, text=text, lang=lang, least=least, size=size)
    inside = swallowed(phrases)
    scored = cut_scores(phrases).join(inside, "ids", "left")
    scored = scored.where(F.col("most").isNull() | (_wide("most") * 100 < _wide("a") * share))
    spelt = scored.select("*", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    named = spelt.groupBy("ids", "a", "l", "r", "score").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
