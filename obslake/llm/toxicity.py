"""Toxicity from subword bags: n-gram embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, hashed into a fixed table of embeddings, and of itself; a stretch of words
is the mean of its words' embeddings; a linear softmax tells the two classes apart. A text has a stretch of a few words
from each of its words on, and both in training and in scoring its most toxic stretch speaks for it, so that a long text is not judged
by its mean. Embeddings and the softmax are trained together by stochastic gradient descent. A misspelt or unseen word
shares n-grams with those that were seen.

Training takes a bounded, documented number of labelled rows, those of the smallest hashes; every text is scored whole.
At scoring the model is linear in the subwords, so each table place has one logit and no vector is built.

Null and empty texts have no words and get the share of toxic rows in training, as does every text if no row of one of
the classes is labelled. Rows with several labels are toxic if one of them says so; null labels are left out. Repeated
rows and null ids are scored like others. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_bytes, prefix_hash, range_hash, scramble, slices, text_buffers, whole_text, word_bounds

N_GRAMS = (3, 4, 5)
SLICE = 1 << 20


def subwords(raw: np.ndarray, offsets: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table places of every word's subwords, the word of each place, and the number of words of each text.

    A word's subwords are itself and its n-grams of bytes, A-Z lowered; n-grams at its start or end are told apart.
    """
    start, end = word_bounds(raw, offsets)
    prefix = prefix_hash(lower_bytes(raw))
    places, whose = [range_hash(prefix, start, end)], [np.arange(len(start))]
    length = end - start
    for n in N_GRAMS:
        has = np.flatnonzero(length >= n)
        many = length[has] - n + 1
        word = np.repeat(has, many)
        at = start[word] + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
        mark = np.uint64(n) + np.uint64(16) * (at == start[word]).astype(np.uint64) + np.uint64(32) * (at + n == end[word]).astype(np.uint64)
        places.append(range_hash(prefix, at, at + n) + mark)
        whose.append(word)
    cells = (scramble(np.concatenate(places)) & np.uint64(table - 1)).astype(np.int64)
    return cells, np.concatenate(whose), np.diff(np.searchsorted(start, offsets))


def stretch_starts(n_words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every stretch, none across texts, and the number of stretches of each text.

    All `length` neighbours are a stretch; a shorter text is one.
    """
    many = np.minimum(n_words, np.maximum(n_words - length + 1, 1))
    return np.repeat(np.cumsum(n_words) - n_words, many) + _within(many), many


def stretch_means(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of the words' values in every stretch."""
    out = words[starts].astype(float)
    for j in range(1, int(sizes.max(initial=1))):
        has = np.flatnonzero(sizes > j)
        out[has] += words[starts[has] + j]
    return out / sizes


class SubwordBags:
    """The model: embeddings of subwords and a linear softmax over the mean of a stretch."""

    def __init__(self, table: int = 1 << 17, width: int = 8, length: int = 2, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table, self.length = table, length
        self.embed = rng.uniform(-1 / width, 1 / width, (table, width)).astype(np.float32)
        self.out, self.bias, self.base = np.zeros((2, width), np.float32), np.zeros(2, np.float32), 0.0
        self.out[1, 0], self.out[0, 0] = 0.1, -0.1
        self.slope, self.shift = 1.0, 0.0

    def fit(self, texts: pa.Array, toxic: np.ndarray, epochs: int = 8, rate: float = 0.3, batch: int = 64) -> "SubwordBags":
        """Joint descent (Adagrad, small batches) on the cross entropy of each text's most toxic stretch."""
        self.base = float(toxic.mean()) if len(toxic) else 0.0
        if not 0 < self.base < 1:
            return self
        blocks = [_Block(texts.slice(k, batch), toxic[k : k + batch].astype(int), self) for k in range(0, len(toxic), batch)]
        blocks = [b for b in blocks if b.n_words]
        weigh = np.array([1.0, min(8.0, (1 - self.base) / self.base)])
        seen = [np.full_like(x, 1e-6) for x in (self.embed, self.out, self.bias)]
        rng = np.random.default_rng(11)
        for epoch in range(epochs):
            for i in rng.permutation(len(blocks)).tolist():
                b = blocks[i]
                logit = b.logits(self)
                chosen = b.first_by(-logit, rng)
                # clean texts also learn from a stretch at random; in the first round so do toxic ones
                other = b.first_by(np.zeros(len(logit)), rng)
                chosen = np.concatenate([chosen, other[(b.toxic[b.doc_of[other]] == 0) | (epoch == 0)]])
                k, cell, share = b.members(chosen)
                means = np.stack([np.bincount(k, self.embed[cell, j] * share, len(chosen)) for j in range(self.embed.shape[1])], 1)
                p = means @ self.out.T + self.bias
                p = np.exp(p - p.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                t = b.toxic[b.doc_of[chosen]]
                p[np.arange(len(t)), t] -= 1
                g = p * weigh[t][:, None] / batch
                back = g @ self.out
                used, at = np.unique(cell, return_inverse=True)
                for_cells = np.stack([np.bincount(at, back[k, j] * share, len(used)) for j in range(back.shape[1])], 1)
                for x, d, s, rows in ((self.embed, for_cells, seen[0], used), (self.out, g.T @ means, seen[1], slice(None)), (self.bias, g.sum(0), seen[2], slice(None))):
                    s[rows] += d * d
                    x[rows] -= (rate * d / np.sqrt(s[rows])).astype(np.float32)
        tops, told = zip(*((b.tops(self), b.toxic[b.with_words]) for b in blocks))
        self._calibrate(np.concatenate(tops), np.concatenate(told))
        return self

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Slope and shift of the logit, by Newton's method, so that one half parts the classes of the training rows."""
        scale = float(np.std(x)) or 1.0
        a, b = 1.0 / scale, -float(np.mean(x)) / scale
        xs = np.stack([x, np.ones_like(x)], 1)
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            h = np.maximum(p * (1 - p), 1e-6)
            ridge = 1e-3 * np.array([scale * scale, 1.0])
            move = np.linalg.solve((xs * h[:, None]).T @ xs + np.diag(ridge), xs.T @ (p - y) + ridge * np.array([a, b]))
            a, b = a - 0.5 * move[0], b - 0.5 * move[1]
            if np.abs(move).max() < 1e-6:
                break
        self.slope, self.shift = float(a), float(b)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of the toxic class for each text."""
        raw, off = text_buffers(texts)
        out = np.full(len(off) - 1, self.base)
        if not 0 < self.base < 1:
            return out
        value = self.embed @ (self.out[1] - self.out[0])
        for a, b in slices(off, SLICE):
            cells, whose, n_words = subwords(raw[off[a] : off[b]], off[a : b + 1] - off[a], self.table)
            n_all = int(n_words.sum())
            if not n_all:
                continue
            words = np.bincount(whose, value[cells], n_all) / np.bincount(whose, minlength=n_all)
            starts, many = stretch_starts(n_words, self.length)
            logit = stretch_means(words, starts, np.repeat(np.minimum(n_words, self.length), many))
            has = np.flatnonzero(many)
            top = np.maximum.reduceat(logit, (np.cumsum(many) - many)[has])
            out[a + has] = 1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -30, 30)))
        return out


class _Block:
    """Subwords and stretches of a few training texts."""

    def __init__(self, texts: pa.Array, toxic: np.ndarray, model: SubwordBags):
        raw, off = text_buffers(texts)
        cells, whose, counts = subwords(raw, off, model.table)
        self.toxic, self.n_words = toxic, int(counts.sum())
        # all blocks stay in memory while they are learnt from: no more than a number a subword
        self.cells = cells[np.argsort(whose, kind="stable")].astype(np.int32)
        self.per_word = np.bincount(whose, minlength=self.n_words)
        self.begin = np.cumsum(self.per_word) - self.per_word
        self.starts, self.many = stretch_starts(counts, model.length)
        self.sizes = np.repeat(np.minimum(counts, model.length), self.many)
        self.doc_of = np.repeat(np.arange(len(self.many)), self.many)
        self.with_words = np.flatnonzero(self.many)

    def logits(self, model: SubwordBags) -> np.ndarray:
        """Of each stretch, up to the bias."""
        value = (model.embed @ (model.out[1] - model.out[0]))[self.cells]
        return stretch_means(np.add.reduceat(value, self.begin) / self.per_word, self.starts, self.sizes)

    def first_by(self, rank: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The first stretch of each text by rank, ties at random."""
        order = np.lexsort((rng.random(len(rank)), rank, self.doc_of))
        return order[np.concatenate([[True], np.diff(self.doc_of[order]) > 0])]

    def members(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place among the chosen, table place and share in the mean of every subword of the chosen stretches."""
        size = self.sizes[chosen]
        word = np.repeat(self.starts[chosen], size) + _within(size)
        n = self.per_word[word]
        k = np.repeat(np.repeat(np.arange(len(chosen)), size), n)
        return k, self.cells[np.repeat(self.begin[word], n) + _within(n)], 1 / (np.repeat(n, n) * size[k])

    def tops(self, model: SubwordBags) -> np.ndarray:
        return np.maximum.reduceat(self.logits(model), (np.cumsum(self.many) - self.many)[self.with_words])


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n[0] - 1, 0, 1, .. n[1] - 1, and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def training_rows(docs: DataFrame, labels: DataFrame, learn_from: Column, *, key: str, text: str, label: str, most: int) -> DataFrame:
    """At most `most` labelled texts (text, toxic) of the rows to learn from, in a fixed order."""
    told = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("told")).agg(F.max(label).cast("int").alias("toxic"))
    chosen = told.where(learn_from).orderBy(F.xxhash64("told"), "told").limit(most)
    rows = docs.select(F.col(key).alias("told"), whole_text(text).alias("text")).join(F.broadcast(chosen), "told")  # `most` rows
    return rows.orderBy(F.xxhash64("told"), "told", "text").limit(most).select("text", "toxic")


def trained(rows: DataFrame, **model) -> SubwordBags:
    """The model of the rows (text, toxic), in their order, fitted in one task; no text comes to the driver.

    The bound is on rows alone: the task's memory grows with their characters.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if parts:
            all_ = pa.Table.from_batches(parts)
            texts, toxic = all_.column(0).cast(pa.large_string()).combine_chunks(), all_.column(1).to_numpy()
            bags = SubwordBags(**model).fit(texts, toxic)
            yield pa.record_batch([pa.array([pickle.dumps(bags)], pa.binary())], ["model"])

    found = rows.coalesce(1).mapInArrow(fit, "model binary").collect()  # one row of a fixed size, or none without labelled rows
    return pickle.loads(bytes(found[0]["model"])) if found else SubwordBags(**model)


def score(
    docs: DataFrame, labels: DataFrame, *, learn_from: Column | None = None, key: str = "doc_id", text: str = "text", label: str = "toxic",
    most: int = 3000, **model,
) -> DataFrame:
    """The documents with `score` and `predicted`. `learn_from` is a condition on `told`, the labelled id."""
    rows = training_rows(docs, labels, learn_from if learn_from is not None else F.lit(True), key=key, text=text, label=label, most=most)
    shared = docs.sparkSession.sparkContext.broadcast(trained(rows, **model))  # a fixed size
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    place = names.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value.scores(b.column(place))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(apply, schema)
