"""Removal of repeated byte strings by a sparse, hash-compared suffix sort.

Every byte covered by a string of `length` bytes that also starts earlier is removed: earlier in a document of a smaller
id, or further left in the same one. Strings are judged on the input and never cross documents.

1. Each window of `length` bytes elects an anchor, the smallest hash among its k-grams, so that equal windows elect the
   same one; windows with the same anchor side by side form a snippet. Repeats of a snippet within a task are known
   there and do not travel.
2. Snippets meet by anchor. All windows of a snippet seen before are repeats. Where an anchor has several snippets,
   they may still share windows: only these are looked at more closely.
3. For those, the suffixes at the anchor are sorted by mergesort. Two suffixes are compared by their common extension,
   found by binary search over prefix polynomial hashes: a logarithmic number of steps. Runs of the order that agree to
   a depth, together with the hash of what stands left of the anchor, are the equal windows; their bytes are compared,
   and where hashes have collided they are parted by the bytes.
4. An anchor with very many snippets, as at the edges of a passage that many documents share, is split: each of its
   windows travels by a 128-bit digest of its bytes (BLAKE2), of equal windows the first and no others from each part
   of a task, and the first of all parts stays.

Ids order documents, null last; rows with equal ids are ordered by their text's hashes. Rows equal in id and in two
hashes of the text, 96 bits together, count as copies of one that comes first. Null and empty texts, and texts shorter than the length, keep all bytes. An empty table gives an
empty result. A task holds the anchors of its own input, or a bounded number of snippets at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import INVERSE, kept, powers, prefix_hash, range_hash, scramble, slices, text_buffers, whole_text, written

GRAM = 40
_AT = np.uint64((1 << 28) - 1)
#: An anchor with more differing snippets is split by its windows.
HOT = 30_000
NO_ID = (1 << 63) - 1
#: What tells rows apart: the id and two hashes of the text.
ROW = ("did", "hh", "h2")
RUN = "anchor long, snippet long, did long, hh int, h2 long, start int, many int, lead int, known boolean"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    n = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def snippets(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, snippet hash, text, start, windows, anchor's place in the snippet) of a slice of texts."""
    k = min(GRAM, length)
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(raw) < length:
        return empty
    prefix, at = prefix_hash(raw), np.arange(len(raw) - k + 1)
    gram = scramble(range_hash(prefix, at, at + k))
    elected = sliding_min((gram & ~_AT) | at.astype(np.uint64), length - k + 1) & _AT
    s = np.arange(len(elected))
    doc = np.searchsorted(offsets, s, "right") - 1
    s = s[s + length <= offsets[doc + 1]]
    if not len(s):
        return empty
    a = elected[s].astype(np.int64)
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)])
    start = s[first]
    many = np.diff(np.append(np.flatnonzero(first), len(s)))
    a = a[first]
    # the place of the anchor is part of the snippet's identity, so that equal snippets line up
    whole = scramble(range_hash(prefix, start, start + many + length - 1) + (many * 1024 + a - start).astype(np.uint64))
    doc = np.searchsorted(offsets, start, "right") - 1
    return gram[a], whole, doc, start - offsets[doc], many, a - start


def _runs(docs: DataFrame, length: int) -> DataFrame:
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for b in batches:
            did, hh, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            raw, off = text_buffers(b.column(3))
            for x, y in slices(off):
                anchor, whole, doc, start, many, lead = snippets(raw[off[x] : off[y]], off[x : y + 1] - off[x], length)
                held.append((anchor, whole, did[x + doc], hh[x + doc], h2[x + doc], start.astype(np.int32), many.astype(np.int32), lead.astype(np.int32)))
                n += len(anchor)
            if n > 2_000_000:
                yield from _told(held)
                held, n = [], 0
        if held:
            yield from _told(held)

    def _told(held: list) -> Iterator[pa.RecordBatch]:
        anchor, whole, did, hh, h2, start, many, lead = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((start, h2, hh, did, whole, anchor))
        same = np.zeros(len(order), bool)
        o, p = order[1:], order[:-1]
        same[1:] = (anchor[o] == anchor[p]) & (whole[o] == whole[p])
        # a repeat is known; it travels under a key of its own
        key = np.where(same, scramble(did[order].astype(np.uint64) + start[order].astype(np.uint64)), anchor[order])
        # equal rows stand for one
        twin = same.copy()
        twin[1:] &= (did[o] == did[p]) & (hh[o] == hh[p]) & (h2[o] == h2[p]) & (start[o] == start[p])
        cols = [key.view(np.int64), whole[order].view(np.int64), did[order], hh[order], h2[order], start[order], many[order], lead[order], same]
        for i in range(0, len(order), 100_000):
            part = slice(i, i + 100_000)
            yield pa.record_batch([pa.array(c[part][~twin[part]]) for c in cols], [f.split()[0] for f in RUN.split(", ")])

    return docs.mapInArrow(runs, RUN)


MET = "did long, hh int, h2 long, start int, many int, lead int, anchor long, whole boolean"


def _met(runs: DataFrame) -> DataFrame:
    """Repeated snippets (`whole`), and first ones whose anchor has others too; what is unique is left out."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting, bare = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            c = {n: b.column(n).to_numpy(zero_copy_only=False) for n in b.schema.names}
            n = b.num_rows
            new_a, new_s = np.ones(n, bool), np.ones(n, bool)
            new_a[1:] = c["anchor"][1:] != c["anchor"][:-1]
            new_s[1:] = new_a[1:] | (c["snippet"][1:] != c["snippet"][:-1])
            if last is not None:
                new_a[0] = c["anchor"][0] != last[0]
                new_s[0] = new_a[0] or c["snippet"][0] != last[1]
            twin = np.zeros(n, bool)  # the same row once more
            twin[1:] = ~new_s[1:] & np.all([c[x][1:] == c[x][:-1] for x in (*ROW, "start")], axis=0)
            if last is not None and not new_s[0]:
                twin[0] = tuple(c[x][0] for x in (*ROW, "start")) == last[2:]
            known = c["known"]
            first = np.flatnonzero(new_s & ~known)
            more = np.zeros(n, bool)  # the anchor has another snippet
            more[first] = ~new_a[first]
            following = np.append(first[1:], n)[: len(first)]
            open_ = following < n
            more[first[open_]] |= ~new_a[following[open_]]
            keep = (known | ~new_s) & ~twin
            if waiting is not None and len(first) and not new_a[: first[0] + 1].any():
                yield waiting  # what was the last of the batch before has company
                waiting = None
            elif new_a.any():
                waiting = None
            out = pa.record_batch(
                [pa.array(c[x][keep | more]) for x in (*ROW, "start", "many", "lead", "anchor")] + [pa.array(keep[keep | more])],
                [f.split()[0] for f in MET.split(", ")],
            )
            yield out
            if len(first) and not more[first[-1]] and not new_a[first[-1] + 1 :].any():
                i = slice(first[-1], first[-1] + 1)
                waiting = pa.record_batch([pa.array(c[x][i]) for x in (*ROW, "start", "many", "lead", "anchor")] + [pa.array([False])], out.schema.names)
            last = tuple(c[x][-1] for x in ("anchor", "snippet", *ROW, "start"))

    return runs.repartition("anchor").sortWithinPartitions("anchor", "snippet", *ROW, "start").mapInArrow(meet, MET)


class SuffixOrder:
    """Suffixes of one buffer, sorted inside groups, compared by common extensions over prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data, self.prefix = data, prefix_hash(data)
        self.inverse = powers(INVERSE, len(data))

    def extension(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at x and y, at most `most`: binary search over lengths."""
        low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
        p, inv = self.prefix, self.inverse
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo] + 1) >> 1
            a, b = x[todo], y[todo]
            same = (p[a + mid] - p[a]) * inv[a] == (p[b + mid] - p[b]) * inv[b]
            low[todo] = np.where(same, mid, low[todo])
            high[todo] = np.where(same, high[todo], mid - 1)
        return low

    def less(self, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
        """Whether suffix x comes before y; nx, ny are their lengths."""
        most = np.minimum(nx, ny)
        e = self.extension(x, y, most)
        inside = e < most
        out = nx < ny
        i = np.flatnonzero(inside)
        out[i] = self.data[x[i] + e[i]] < self.data[y[i] + e[i]]
        return out

    def sort(self, at: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Mergesort from the bottom up: order of the suffixes inside each group; groups are contiguous."""
        begin = np.searchsorted(group, group, "left")
        end = np.searchsorted(group, group, "right")
        order, place = np.arange(len(at)), np.arange(len(at))
        width = 1
        while (end - begin > width).any():
            run = (place - begin) // width
            other = begin + (run ^ 1) * width
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            first, left = low.copy(), run % 2 == 0
            while (todo := np.flatnonzero(low < high)).size:
                mid = (low[todo] + high[todo]) >> 1
                mine, theirs = order[todo], order[mid]
                # of equal suffixes the left run's come first
                before = np.where(
                    left[todo], self.less(at[theirs], n[theirs], at[mine], n[mine]), ~self.less(at[mine], n[mine], at[theirs], n[theirs])
                )
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
            to = begin + (run // 2) * 2 * width + (place - begin - run * width) + (low - first)
            merged = np.empty_like(order)
            merged[to] = order
            order, width = merged, 2 * width
        return order


def repeated_windows(data: np.ndarray, at: np.ndarray, size: np.ndarray, many: np.ndarray, lead: np.ndarray, group: np.ndarray, rank: np.ndarray, start: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(snippet, window) of windows that equal an earlier one of their group; `rank` orders the documents."""
    order_of = SuffixOrder(data)
    anchor, right = at + lead, size - lead
    order = order_of.sort(anchor, right, group)
    o, p = order[1:], order[:-1]
    common = np.zeros(len(order), np.int64)
    common[1:] = np.where(group[o] == group[p], order_of.extension(anchor[o], anchor[p], np.minimum(right[o], right[p])), -1)
    for j in range(int(lead.max(initial=0)) + 1):
        depth = length - j
        if depth < 1:
            break
        run = np.cumsum(common < depth)
        t = lead[order] - j
        has = np.flatnonzero((t >= 0) & (t < many[order]))
        if len(has) < 2:
            continue
        i, t, run = order[has], t[has], run[has]
        before = range_hash(order_of.prefix, at[i] + t, anchor[i])
        sort = np.lexsort((start[i] + t, rank[i], before, run))
        same = (run[sort][1:] == run[sort][:-1]) & (before[sort][1:] == before[sort][:-1])
        if not same.any():
            continue
        opens = np.concatenate([[True], ~same])
        head = sort[np.maximum.accumulate(np.where(opens, np.arange(len(sort)), 0))]
        late = np.flatnonzero(~opens)
        mine, theirs = at[i[sort[late]]] + t[sort[late]], at[i[head[late]]] + t[head[late]]
        ok = np.ones(len(late), bool)
        for q in range(0, len(late), 1 << 16):
            w = slice(q, q + (1 << 16))
            ok[w] = (data[mine[w, None] + np.arange(length)] == data[theirs[w, None] + np.arange(length)]).all(1)
        if not ok.all():  # hashes have collided: part the windows by their bytes
            seen, late = {}, np.arange(len(sort))
            ok = np.zeros(len(sort), bool)
            by = np.lexsort((start[i[sort]] + t[sort], rank[i[sort]]))
            for z in by.tolist():
                b = at[i[sort[z]]] + t[sort[z]]
                ok[z] = (int(group[i[sort[z]]]), data[b : b + length].tobytes()) in seen
                seen[int(group[i[sort[z]]]), data[b : b + length].tobytes()] = True
        yield i[sort[late[ok]]], t[sort[late[ok]]]


SNIPPET = "anchor long, did long, hh int, h2 long, start int, many int, lead int, body binary"
HIT = "did long, hh int, h2 long, start int, many int"


def _bodies(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the snippets to look at more closely."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = text_buffers(b.column("text"))
            lists = b.column("firsts")
            flat, n = lists.flatten(), np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), n)
            c = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("anchor", "start", "many", "lead")}
            a = off[row] + c["start"]
            for k in range(0, len(row), 50_000):
                w = slice(k, k + 50_000)
                data = [raw[x : x + m + length - 1].tobytes() for x, m in zip(a[w].tolist(), c["many"][w].tolist())]
                whose = (b.column(x).take(pa.array(row[w])) for x in ROW)
                yield pa.record_batch([pa.array(c["anchor"][w]), *whose, *(pa.array(c[x][w]) for x in ("start", "many", "lead")), pa.array(data, pa.binary())], [f.split()[0] for f in SNIPPET.split(", ")])

    return texts.mapInArrow(read, SNIPPET)


def _closer(bodies: DataFrame, length: int, chunk: int = 30_000) -> DataFrame:
    """Repeated windows among the snippets of each anchor."""

    def solve(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(tables)
        c = {n: t.column(n).to_numpy() for n in ("anchor", *ROW, "start", "many", "lead")}
        # equal rows sent the same snippet: one is enough
        order = np.lexsort((c["start"], c["h2"], c["hh"], c["did"], c["anchor"]))
        once = np.ones(len(order), bool)
        once[1:] = np.any([c[n][order][1:] != c[n][order][:-1] for n in ("anchor", *ROW, "start")], axis=0)
        pick = order[once]
        c = {n: x[pick].astype(np.int64) for n, x in c.items()}
        data = np.frombuffer(b"".join(t.column("body").combine_chunks().take(pa.array(pick)).to_pylist()), np.uint8)
        size = c["many"] + length - 1
        at = np.cumsum(size) - size
        _, group = np.unique(c["anchor"], return_inverse=True)
        _, rank = np.unique(np.stack([c[n] for n in ROW], 1), axis=0, return_inverse=True)
        found = list(repeated_windows(data, at, size, c["many"], c["lead"], group, rank.ravel(), c["start"], length))
        if not found:
            return
        i, w = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((w, i))
        i, w = i[order], w[order]
        opens = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (w[1:] != w[:-1] + 1)]))
        many = np.diff(np.append(opens, len(i)))  # windows side by side are one run
        i, w = i[opens], w[opens]
        cols = [pa.array(c["did"][i]), pa.array(c["hh"][i].astype(np.int32)), pa.array(c["h2"][i]), *(pa.array(x.astype(np.int32)) for x in (c["start"][i] + w, many))]
        yield pa.record_batch(cols, [f.split()[0] for f in HIT.split(", ")])

    def closer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n >= chunk:
                # all but the last anchor are complete
                t = pa.Table.from_batches(held).combine_chunks()
                anchors = t.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1], "left"))
                if cut:
                    yield from solve(t.slice(0, cut).to_batches())
                held = t.slice(cut).to_batches()
                n = len(t) - cut
        if held:
            yield from solve(held)

    return bodies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(closer, HIT)


def _compared(texts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the other anchors."""
    return _closer(_bodies(texts, length), length)


SPLIT = "high long, low long, did long, hh int, h2 long, start int, known boolean"


def _split(texts: DataFrame, length: int, most: int = 1_000_000) -> DataFrame:
    """Repeated windows of the anchors that have very many snippets; windows meet by their digests, not by anchor."""
    names = [f.split()[0] for f in SPLIT.split(", ")]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for b in batches:
            raw, off = text_buffers(b.column("text"))
            lists = b.column("firsts")
            flat, many = lists.flatten(), np.diff(lists.offsets.to_numpy())
            size = flat.field("many").to_numpy(zero_copy_only=False).astype(np.int64)
            whose, row = (b.column(x).to_numpy(zero_copy_only=False) for x in ROW), np.repeat(np.arange(len(many)), many)
            whose, begin = tuple(whose), flat.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
            x = 0
            while x < len(size):  # a part of the batch's snippets, however many they are
                y = max(x + 1, x + int(np.searchsorted(np.cumsum(size[x : x + most]), most - n, "right")))
                part = np.repeat(np.arange(x, y), size[x:y])
                start = begin[part] + np.arange(len(part)) - np.repeat(np.cumsum(size[x:y]) - size[x:y], size[x:y])
                at = off[row[part]] + start
                digest = np.frombuffer(b"".join([blake2b(raw[a : a + length], digest_size=16).digest() for a in at.tolist()]), np.int64).reshape(-1, 2)
                held.append((digest[:, 0], digest[:, 1], *(c[row[part]] for c in whose), start.astype(np.int32)))
                n, x = n + len(part), y
                if n >= most:
                    yield from _first(held)
                    held, n = [], 0
        if held:
            yield from _first(held)

    def _first(held: list) -> Iterator[pa.RecordBatch]:
        cols = [np.concatenate(x) for x in zip(*held)]
        order = np.lexsort(cols[::-1])
        cols = [c[order] for c in cols]
        equal = [np.concatenate([[False], c[1:] == c[:-1]]) for c in cols]
        known = equal[0] & equal[1]
        once = ~np.all(equal, axis=0)  # equal rows stand for one
        # a repeat is known; it travels under a key of its own
        own = scramble(scramble(cols[2].view(np.uint64) ^ cols[4].view(np.uint64)) + cols[5].astype(np.uint64)).view(np.int64)
        cols[0], cols[1] = np.where(known, own, cols[0]), np.where(known, ~own, cols[1])
        for i in range(0, len(order), 100_000):
            part = slice(i, i + 100_000)
            yield pa.record_batch([pa.array(c[part][once[part]]) for c in (*cols, known)], names)

    met = texts.mapInArrow(windows, SPLIT)
    place = F.rank().over(Window.partitionBy("high", "low").orderBy(*ROW, "start"))
    return met.withColumn("place", place).where("known OR place > 1").select(*ROW, "start", F.lit(1).alias("many"))


def removed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = 100, hot: int = HOT) -> DataFrame:
    """One row a document: doc_id, n_bytes, `cut` (array of start, end of the removed runs, in bytes), kept bytes."""
    if length > 1000:
        raise ValueError("strings of at most 1000 bytes")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"),
        F.hash(whole_text(text)).alias("hh"), F.xxhash64(whole_text(text)).alias("h2"), whole_text(text).alias("text"),
    )
    met = written(_met(_runs(rows.select(*ROW, "text").where(F.octet_length("text") >= length), length)), "snippets")
    single = met.where("NOT whole")
    crowded = kept(single.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"))  # at most a row per `hot` snippets
    both = met.where("whole").select(*ROW, "start", "many")
    parts = [("left_anti", _compared)] if crowded.isEmpty() else [("left_anti", _compared), ("left_semi", _split)]
    for how, solve in parts:
        mine = single.join(F.broadcast(crowded), "anchor", how)
        firsts = mine.groupBy(*ROW).agg(F.collect_list(F.struct("anchor", "start", "many", "lead")).alias("firsts"))
        both = both.unionByName(solve(rows.select(*ROW, "text").join(firsts, [*ROW]), length))
    cuts = both.groupBy(*ROW).agg(F.collect_list(F.struct("start", "many")).alias("hits"))
    # of equal rows the first is judged, the others are copies of it
    turn = F.row_number().over(Window.partitionBy(*ROW).orderBy("did"))
    out = rows.join(cuts, [*ROW], "left").withColumn("turn", turn)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = text_buffers(b.column("text"))
            sizes, spans, bodies = [], [], []
            for i, (hits, turn) in enumerate(zip(b.column("hits"), b.column("turn").to_pylist())):
                body = raw[off[i] : off[i + 1]]
                gone = np.zeros(len(body) + 1, np.int64)
                if turn > 1 and len(body) >= length:
                    gone[0] = 1
                elif hits.is_valid:
                    s, m = (hits.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "many"))
                    np.add.at(gone, s, 1)
                    np.add.at(gone, s + m - 1 + length, -1)
                mask = np.cumsum(gone[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                sizes.append(len(body))
                bodies.append(body[~mask].tobytes())
            yield pa.record_batch(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(bodies, pa.binary())],
                ["doc_id", "n_bytes", "cut", "kept"],
            )

    return out.select("doc_id", "text", "hits", "turn").mapInArrow(cut, "doc_id long, n_bytes long, cut array<struct<start:long,end:long>>, kept binary")
