"""Log-likelihood of whole documents by a gated recurrent language model written in numpy.

The model reads words, A-Z lowered, with an end after the last; its vocabulary are the most frequent training tokens.
The output softmax is factored: a class given the state, then a word given class and state; one more class stands for
all other tokens, which share it by their smoothed counts, so probabilities sum to one. Its biases start at the
logarithms of the counts, so an untrained model is the smoothed unigram model.

Training is one pass over all training documents in rounds: every task takes the parameters so far, trains on its share
by truncated back-propagation, and the tasks' parameters are averaged by their numbers of tokens. Each task runs many
documents side by side; the state is carried from window to window and cleared where a document begins, both in
training and in scoring, so that a score covers the complete document.

Counts of all tokens are exact. The most frequent ones, a fixed number, go to every task; the others of a document are
looked up by a join. Null and empty texts are one end. Repeated rows and null ids are scored like others; without
training documents the score is that of the base. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, text_buffers, word_hashes, written

#: Tokens whose counts go to every task.
FREQUENT = 1 << 18
BLOCK = 1 << 12
END = 0  # place of the end in the model's vocabulary; also what stands in front of a document


def token_counts(texts: DataFrame, limit: int = 4_000_000) -> DataFrame:
    """(token, n) of the words of all texts; tokens are 64-bit hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def told() -> pa.RecordBatch:
            token, many = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(token.view(np.int64)), pa.array(many)], ["token", "n"])

        for b in batches:
            raw, off = text_buffers(b.column(0))
            for x, y in slices(off):
                h, _ = word_hashes(raw[off[x] : off[y]], off[x : y + 1] - off[x])
                held.append(h)
                n += len(h)
                if n >= limit:
                    yield told()
                    held, n = [], 0
        if held:
            yield told()

    return texts.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Places:
    """Places of words by count, from 1, found by the leading bits of their hashes."""

    def __init__(self, words: np.ndarray):
        self.order = np.argsort(words)
        self.words = words[self.order]
        self.order = np.append(self.order + 1, 0)
        # two to four cells a word, so that few words share one
        self.shift = np.uint64(64 - max(len(words) * 2, 1).bit_length())
        cell = (self.words >> self.shift).astype(np.int64)
        edge = np.searchsorted(cell, np.arange((1 << 64 - int(self.shift)) + 1)).astype(np.int32)
        self.first, self.most = edge[:-1], int(np.diff(edge).max())
        # behind the last word stands one that ends every search, with place 0
        self.words = np.append(self.words, np.uint64(0xFFFFFFFFFFFFFFFF))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word, 0 if unknown."""
        at = self.first[(hashes >> self.shift).view(np.int64)]
        there = self.words[at]
        later = np.flatnonzero(there < hashes)
        for _ in range(1, self.most):
            if not len(later):
                break
            at[later] += 1
            there[later] = self.words[at[later]]
            later = later[there[later] < hashes[later]]
        return np.where(there == hashes, self.order[at], 0)


class Vocabulary:
    """The most frequent tokens with their counts; the first of them are the model's."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, n_docs: int, total: int, distinct: int, size: int, n_classes: int, buckets: int):
        # by count: place 0 is the end, then words
        self.places, self.own_places = Places(tokens), Places(tokens[: size - 1])
        self.counts = counts
        self.total, self.distinct, self.n_docs = total + n_docs, distinct + (n_docs > 0), n_docs
        own = counts[: size - 1]
        self.size, self.buckets = len(own) + 1, buckets
        freq = np.concatenate([[n_docs], own]).astype(float) + 0.5
        share = np.cumsum(np.sqrt(freq))
        cls = np.minimum((n_classes * (share - share[0] / 2) / share[-1]).astype(int), n_classes - 1)
        self.word_class = np.unique(cls, return_inverse=True)[1]
        self.n_classes = int(self.word_class.max()) + 2  # the last is that of all other tokens
        self.first = np.searchsorted(self.word_class, np.arange(self.n_classes))
        # a token of the vocabulary, or one beyond it; few bytes, which sort faster
        self.token_class = np.append(self.word_class, self.n_classes - 1).astype(np.min_scalar_type(self.n_classes))
        self.class_size = np.diff(np.append(self.first, self.size))
        self.rest = self.total - (freq.sum() - 0.5 * self.size) + 0.5 * (self.distinct - self.size) + 0.5
        mass = np.append(np.bincount(self.word_class, freq), self.rest)
        self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        self.word_bias = np.log(freq / mass[self.word_class]).astype(np.float32)

    def tokens(self, hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The model's tokens of words by their places, rare ones by a bucket of the hash."""
        own = (place > 0) & (place < self.size)
        return np.where(own, place, self.size + (hashes % np.uint64(self.buckets)).astype(np.int64))


class GatedModel:
    """A gated recurrent unit between word embeddings and a class-factored softmax."""

    def __init__(self, v: Vocabulary, embed: int = 16, hidden: int = 24, seed: int = 13):
        rng = np.random.default_rng(seed)
        u = lambda *s: rng.uniform(-1, 1, s).astype(np.float32) / np.float32(np.sqrt(s[0]))
        self.v, self.hidden = v, hidden
        self.p = {
            "embed": u(v.size + v.buckets, embed) * np.float32(np.sqrt(v.size)) * np.float32(0.3), "wx": u(embed, 3 * hidden), "wh": u(hidden, 3 * hidden),
            "b": np.zeros(3 * hidden, np.float32), "wc": np.zeros((hidden, v.n_classes), np.float32), "bc": v.class_bias.copy(),
            "wo": np.zeros((v.size, hidden), np.float32), "bo": v.word_bias.copy(),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    def load(self, flat: np.ndarray) -> "GatedModel":
        at = 0
        for k, x in self.p.items():
            self.p[k] = flat[at : at + x.size].astype(np.float32).reshape(x.shape)
            at += x.size
        return self

    def forward(self, inp: np.ndarray, keep: np.ndarray, h: np.ndarray) -> tuple:
        """States of a window (steps, streams); `keep` is 0 where a document begins.

        Inside, a stream is a column, so the parts of a gate are whole rows.
        """
        p, n = self.p, self.hidden
        x = p["embed"][inp]
        # the gates are 1 / (1 + exp(-...)): their weights are negated once, not their sums at every step
        sign = np.where(np.arange(3 * n) < 2 * n, -1, 1).astype(x.dtype)
        gates = np.matmul((p["wx"] * sign).T, x.transpose(0, 2, 1))
        # a state has a one below it, which the bias is multiplied by
        wh = np.ascontiguousarray((np.concatenate([p["wh"], p["b"][None]]) * sign).T)
        w2, w1 = wh[: 2 * n], wh[2 * n :]
        ones = np.ones_like(gates, shape=(len(inp) + 1, n + 1, inp.shape[1]))
        olds, kept, hs = ones[:-1, :n], ones[-1], np.empty_like(gates, shape=(len(inp), n, inp.shape[1]))
        h = h.T
        for zr, c, old, below, new, k in zip(gates[:, : 2 * n], gates[:, 2 * n :], olds, ones, hs, keep):
            np.multiply(h, k, out=old)
            zr += w2 @ below
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[n:], old, out=kept[:n])
            c += w1 @ kept
            np.tanh(c, out=c)
            np.subtract(c, old, out=new)
            new *= zr[:n]
            new += old
            h = new
        return x, olds, gates, None, np.ascontiguousarray(hs.transpose(0, 2, 1)), h.T

    def output(self, states: np.ndarray, target: np.ndarray, learn: bool) -> tuple:
        """Natural logarithms of the targets' probabilities; gradients of the states and the output layer, if wanted.

        A target beyond the vocabulary is the last class, whose tokens are told apart elsewhere.
        """
        p, v = self.p, self.v
        cls = v.token_class[np.minimum(target, v.size)]
        # a class a row: sums over classes run along the rows
        e = p["wc"].T @ states.T
        e += p["bc"][:, None]
        e -= e.max(0)
        rows = np.arange(len(target))
        out = e[cls, rows]
        np.exp(e, out=e)
        s = e.sum(0)
        out -= np.log(s)
        grads, back = None, None
        if learn:
            e /= s
            e[cls, rows] -= 1
            back = e.T @ p["wc"].T
            grads = {"wc": (e @ states).T, "bc": e.sum(1)}
        # words by class; one product a class, all else over all classes at once
        order = np.argsort(cls, kind="stable")
        edge = np.searchsorted(cls[order], np.arange(v.n_classes))
        order = order[: edge[-1]]
        mine, size = target[order] - v.first[cls[order]], v.class_size[cls[order]]
        begin = np.cumsum(size) - size
        st = np.concatenate([states[order], np.ones((len(order), 1), states.dtype)], 1)
        weights = np.concatenate([p["wo"], p["bo"][:, None]], 1)
        z = np.empty(int(size.sum()), states.dtype)
        parts, done = [], 0
        for i, j, a, b in zip(edge.tolist(), edge[1:].tolist(), v.first.tolist(), v.first[1:].tolist()):
            if i < j:
                part = z[done : done + (j - i) * (b - a)].reshape(j - i, b - a)
                np.matmul(st[i:j], weights[a:b].T, out=part)
                parts.append((part, i, j, a, b))
                done += part.size
        if parts:
            z -= np.repeat(np.maximum.reduceat(z, begin), size)
            own = z[begin + mine]
            np.exp(z, out=z)
            s = np.add.reduceat(z, begin)
            out[order] += own - np.log(s)
        if learn:
            d_weights, d_states = np.zeros_like(weights), np.empty_like(states, shape=(len(order), states.shape[1]))
            if parts:
                z /= np.repeat(s, size)
                z[begin + mine] -= 1
            for part, i, j, a, b in parts:
                np.matmul(part.T, st[i:j], out=d_weights[a:b])
                np.matmul(part, p["wo"][a:b], out=d_states[i:j])
            back[order] += d_states
            grads |= {"wo": d_weights[:, :-1], "bo": d_weights[:, -1]}
        return out, back, grads

    def backward(self, inp: np.ndarray, keep: np.ndarray, run: tuple, back: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients through one window; nothing flows to the window before."""
        x, olds, gates, _, _, _ = run
        p, n = self.p, self.hidden
        w2, w1 = p["wh"][:, : 2 * n], p["wh"][:, 2 * n :]
        zs, rs, cs = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        # all that does not depend on later steps, for all steps at once
        stay, reset, slope = 1 - zs, rs * olds, 1 - cs * cs
        slope *= zs
        by_r = reset - reset * rs
        by_z = cs - olds
        by_z *= zs
        by_z *= stay
        d_gates = np.empty_like(gates)
        back = np.ascontiguousarray(back.transpose(0, 2, 1))
        begins = (~keep.all(1)).tolist()
        dh = np.zeros_like(back[0])
        for t in range(len(inp) - 1, -1, -1):
            g = d_gates[t]
            dh += back[t]
            dc = np.multiply(dh, slope[t], out=g[2 * n :])
            np.multiply(dh, by_z[t], out=g[:n])
            drh = w1 @ dc
            np.multiply(drh, by_r[t], out=g[n : 2 * n])
            dh *= stay[t]
            drh *= rs[t]
            dh += drh
            dh += w2 @ g[: 2 * n]
            if begins[t]:
                dh *= keep[t]
        row = lambda a: a.transpose(1, 0, 2).reshape(a.shape[1], -1)  # noqa: E731  (units, steps * streams)
        dx = np.matmul(d_gates.transpose(0, 2, 1), p["wx"].T).reshape(-1, x.shape[2])
        g = row(d_gates)
        d_wh = np.concatenate([row(olds) @ g[: 2 * n].T, row(reset) @ g[2 * n :].T], 1)
        flat = inp.ravel()
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        d_embed = np.zeros_like(p["embed"])
        d_embed[flat[first]] = np.add.reduceat(dx[order], first)
        return {"embed": d_embed, "wx": (g @ x.reshape(-1, x.shape[2])).T, "wh": d_wh, "b": g.sum(1)}


class Descent:
    """Adam over all parameters, which become parts of one vector, with clipped gradients."""

    def __init__(self, model: GatedModel, rate: float):
        self.model, self.rate, self.n = model, rate, 0
        self.all = model.flat()
        # rows of rare words have tiny gradients most of the time: they move little
        self.least = np.concatenate([np.full(x.size, 1e-5 if k in ("wx", "wh", "b") else 1e-3, self.all.dtype) for k, x in model.p.items()])
        self.m, self.s = np.zeros_like(self.all), np.zeros_like(self.all)
        at = 0
        for k, x in model.p.items():
            model.p[k] = self.all[at : at + x.size].reshape(x.shape)
            at += x.size

    def step(self, grads: dict[str, np.ndarray], share: float, scale: float = 1.0) -> None:
        """`share`: how full the window is; the last windows hold few documents and must not outweigh the others."""
        self.n += 1
        g = np.concatenate([grads[k].ravel() for k in self.model.p])
        norm = float(np.sqrt(g @ g)) * scale
        g *= np.float32(min(1.0, 5.0 / (norm + 1e-9)) * scale)
        rate = np.float32(share * min(1.0, self.n / 30) * self.rate * np.sqrt(1 - 0.99**self.n) / (1 - 0.9**self.n))
        move = g - self.m
        move *= np.float32(0.1)
        self.m += move
        g *= g
        g -= self.s
        g *= np.float32(0.01)
        self.s += g
        np.sqrt(self.s, out=move)
        move += self.least
        np.divide(self.m, move, out=move)
        move *= rate
        self.all -= move


class Streams:
    """Documents side by side: windows of (previous token, token, document) over a fixed number of streams."""

    def __init__(self, width: int, steps: int, hidden: int):
        self.width, self.steps = width, steps
        self.queue: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(width)]
        self.left, self.heap = np.zeros(width, np.int64), [(0, i) for i in range(width)]
        self.state = np.zeros((width, hidden), np.float32)

    def add(self, doc: int, tokens: np.ndarray) -> None:
        while True:  # entries of the heap may be out of date
            n, i = heapq.heappop(self.heap)
            if n == self.left[i]:
                break
            heapq.heappush(self.heap, (int(self.left[i]), i))
        part = np.ones((4, len(tokens)), np.int64)
        part[0, 0], part[0, 1:], part[1], part[2], part[3, 0] = END, tokens[:-1], tokens, doc, 0
        self.queue[i].append(part)
        self.left[i] += len(tokens)
        heapq.heappush(self.heap, (int(self.left[i]), i))

    def windows(self, last: bool = False) -> Iterator[tuple]:
        """Windows that all streams fill; at the end also those that some fill."""
        while (self.left.max() > 0) if last else (self.left.min() >= self.steps):
            live = np.flatnonzero(self.left > 0) if last else np.arange(self.width)
            # as many windows at once as these streams fill
            many = max(int(self.left[live].min()) // self.steps, 1)
            out = np.zeros((4, many * self.steps, len(live)), np.int64)
            out[2] = -1
            for k, i in enumerate(live.tolist()):
                at, used = 0, 0
                for part in self.queue[i]:
                    take = min(out.shape[1] - at, part.shape[1])
                    out[:, at : at + take, k] = part[:, :take]
                    at += take
                    if take < part.shape[1]:
                        self.queue[i][used] = part[:, take:]
                        break
                    used += 1
                del self.queue[i][:used]
                self.left[i] -= at
            for begin in range(0, out.shape[1], self.steps):
                yield live, out[:, begin : begin + self.steps]
        self.heap = [(int(n), i) for i, n in enumerate(self.left)]
        heapq.heapify(self.heap)


def _train(docs: DataFrame, v: Vocabulary, model: GatedModel, rate: float, width: int, steps: int) -> GatedModel:
    """One round: parameters trained apart on each partition, averaged by tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((v, model.flat()))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, flat = shared.value
        m = GatedModel(v).load(flat)
        descent, streams, n = Descent(m, rate), Streams(width, steps, m.hidden), 0

        def learn(last: bool) -> int:
            seen = 0
            for live, (inp, target, doc, keep) in streams.windows(last):
                keep = keep.astype(np.float32)
                run = m.forward(inp, keep, streams.state[live])
                streams.state[live] = run[5]
                flat_target = target.ravel()
                valid = (doc.ravel() >= 0).astype(np.float32)
                _, back, grads = m.output(run[4].reshape(-1, m.hidden), flat_target, True) if valid.all() else _masked(m, run[4].reshape(-1, m.hidden), flat_target, valid)
                full = float(valid.sum())
                grads |= m.backward(inp, keep, run, back.reshape(*inp.shape, -1))
                descent.step(grads, full / (width * steps), 1 / max(1.0, full))
                seen += int(full)
            return seen

        for b in batches:
            raw, off = text_buffers(b.column(0))
            for x, y in slices(off):
                hashes, counts = word_hashes(raw[off[x] : off[y]], off[x : y + 1] - off[x])
                tokens = v.tokens(hashes, v.own_places.find(hashes))
                ends = np.cumsum(counts)
                for d in range(len(counts)):
                    streams.add(0, np.append(tokens[ends[d] - counts[d] : ends[d]], END))
                n += learn(False)
        n += learn(True)
        if n:
            out = m.flat().astype(float) * n
            blocks = [out[i : i + BLOCK].tobytes() for i in range(0, len(out), BLOCK)]
            yield pa.record_batch([pa.array(range(len(blocks)), pa.int32()), pa.array([float(n)] * len(blocks)), pa.array(blocks, pa.binary())], ["block", "weight", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for k, w, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                have = sums.setdefault(k, [0.0, 0])
                have[0], have[1] = have[0] + w, have[1] + np.frombuffer(data)
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([s[0] for s in sums.values()], pa.float64()), pa.array([s[1].tobytes() for s in sums.values()], pa.binary())], ["block", "weight", "sums"])

    kinds = "block int, weight double, sums binary"
    rows = docs.mapInArrow(train, kinds).repartition("block").mapInArrow(add, kinds).orderBy("block").collect()  # one model
    return model.load(np.concatenate([np.frombuffer(r["sums"]) / r["weight"] for r in rows])) if rows else model


def _masked(m: GatedModel, states: np.ndarray, target: np.ndarray, valid: np.ndarray) -> tuple:
    """The output of the places that hold a token; the others get no gradient."""
    i = np.flatnonzero(valid)
    out, back, grads = m.output(states[i], target[i], True)
    whole = np.zeros_like(states)
    whole[i] = back
    return out, whole, grads


TOLD = (
    "u long, doc_id long, n_tokens long, n_known long, n_rest long, log_all double, log_rest double, model double, "
    "rare array<long>, times array<int>"
)


def _read(docs: DataFrame, v: Vocabulary, model: GatedModel, width: int, steps: int) -> DataFrame:
    """Per document what its frequent tokens tell and its rare ones; the model's part follows in a row of its own."""
    shared = docs.sparkSession.sparkContext.broadcast((v, model.flat()))
    names = [f.split()[0] for f in TOLD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, flat = shared.value
        m = GatedModel(v).load(flat)
        streams, base = Streams(width, steps, m.hidden), TaskContext.get().partitionId() << 32
        log_count = np.log10(np.concatenate([[v.n_docs], v.counts]) + 0.5)
        total, n_rows = np.zeros(0), 0

        def score(last: bool) -> None:
            for live, (inp, target, doc, keep) in streams.windows(last):
                run = m.forward(inp, keep.astype(np.float32), streams.state[live])
                streams.state[live] = run[5]
                valid = doc.ravel() >= 0
                valid = slice(None) if valid.all() else np.flatnonzero(valid)
                out, _, _ = m.output(run[4].reshape(-1, m.hidden)[valid], target.ravel()[valid], False)
                total[:] += np.bincount(doc.ravel()[valid], out, len(total))

        for b in batches:
            raw, off = text_buffers(b.column(1))
            for x, y in slices(off):
                hashes, counts = word_hashes(raw[off[x] : off[y]], off[x : y + 1] - off[x])
                place = v.places.find(hashes)
                known, tokens = place > 0, v.tokens(hashes, place)
                n, ends = len(counts), np.cumsum(counts)
                whose = np.repeat(np.arange(n), counts)
                value = np.where(known, log_count[place], 0.0)
                outside = tokens >= v.size
                far = np.flatnonzero(~known)
                order = far[np.lexsort((hashes[far], whose[far]))]
                first = np.ones(len(order), bool)
                first[1:] = (whose[order][1:] != whose[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
                times = np.diff(np.append(np.flatnonzero(first), len(order))).astype(np.int32)
                order = order[first]
                each = pa.array(np.concatenate([[0], np.cumsum(np.bincount(whose[order], minlength=n))]), pa.int32())
                yield pa.record_batch(
                    [
                        pa.array(base + n_rows + np.arange(n)), b.column(0).slice(x, n), pa.array(counts + 1), pa.array(np.bincount(whose, known, n).astype(np.int64) + (v.n_docs > 0)),
                        pa.array(np.bincount(whose, outside, n).astype(np.int64)), pa.array(np.bincount(whose, value, n) + log_count[0]),
                        pa.array(np.bincount(whose, value * outside, n).astype(float)), pa.nulls(n, pa.float64()),
                        pa.ListArray.from_arrays(each, pa.array(hashes[order].view(np.int64))), pa.ListArray.from_arrays(each, pa.array(times)),
                    ], names,
                )
                total = np.append(total, np.zeros(n))
                for d in range(n):
                    streams.add(n_rows + d, np.append(tokens[ends[d] - counts[d] : ends[d]], END))
                n_rows += n
                score(False)
        score(True)
        for i in range(0, n_rows, 100_000):
            part = total[i : i + 100_000] / np.log(10)
            k = len(part)
            empty = [pa.nulls(k, pa.int64())] * 4 + [pa.nulls(k, pa.float64())] * 2
            yield pa.record_batch([pa.array(base + i + np.arange(k)), *empty, pa.array(part), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int32()))], names)

    return docs.mapInArrow(read, TOLD)


def score(
    docs: DataFrame, learn_from: Column, *, doc_id: str = "doc_id", text: str = "text", vocabulary: int = 2048, classes_: int = 40, buckets: int = 128,
    rounds: int = 2, rate: float = 0.01, train_streams: tuple[int, int] = (64, 20), score_streams: tuple[int, int] = (256, 32),
) -> DataFrame:
    """One row a document: doc_id, n_tokens, n_known, train_tokens, base_score, score (both log10). `learn_from`: condition on training rows."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(learn_from, F.lit(False)).alias("learns"))
    training = rows.where("learns")
    counts = written(token_counts(training.select("text")), "token-counts")
    total, distinct = (x or 0 for x in counts.agg(F.sum("n"), F.count("*")).first())
    n_docs = training.count()
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    v = Vocabulary(top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), n_docs, total, distinct, vocabulary, classes_, buckets)
    model = GatedModel(v)
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for k in range(rounds):
        model = _train(training.where(turn == k).select("text"), v, model, rate, *train_streams)
    told = written(_read(rows.select("doc_id", "text"), v, model, *score_streams), "told")
    rare = told.where(F.size("rare") > 0).select("u", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("u", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    found = rare.join(counts, "token", "left").groupBy("u").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log_rare"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_rare"),
    )
    frequent = told.where("model IS NULL").drop("model", "rare", "times").join(told.where("model IS NOT NULL").select("u", "model"), "u").join(found, "u", "left")
    far = F.coalesce("log_rare", F.lit(0.0))
    base = F.col("log_all") + far - F.col("n_tokens") * float(np.log10(v.total + 0.5 * (v.distinct + 1)))
    modelled = F.col("model") + F.col("log_rest") + far - F.col("n_rest") * float(np.log10(v.rest))
    return frequent.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known_rare", F.lit(0))).cast("long").alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        base.alias("base_score"), (modelled if n_docs else base).alias("score"),
    )
