"""Bounded-space online packing of token ids into sequences of a fixed length.

Every task keeps a fixed number of open windows and never looks back: a piece goes to the window it fits best; when it
fits none, the fullest window is closed and a new one opens. A closing window that still has room for a useful stretch
is topped up with the head of the piece at hand, so little is padded and a document is cut only there or where it is
longer than a window. What is left open at the end of the tasks is merged level by level, a bounded number of tasks'
leftovers in one group, until one group remains; its last windows are cut at powers of two.

Null and empty texts are one closing id. Repeated rows and rows with a null id are packed each on its own. An empty
table gives no pieces. Only the id and text columns are read. Ids of sequences depend on the split of the input into
partitions, which Spark keeps when a task is run again, so a retried task gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .tokens import encoder

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, fill long, "
    "padded long, ids binary"
)
COLUMNS = [x.split()[0] for x in PIECE.split(", ")]
#: Sequence ids: the level from this bit on, then the group, then a counter in the lower 32 bits.
LEVEL_BITS = 58


class Windows:
    """At most `limit` open windows of `size` ids; `add` yields the windows it closes."""

    def __init__(self, size: int, limit: int, least_cut: int):
        self.size, self.limit, self.least_cut = size, limit, least_cut
        self.open: list[tuple[int, list]] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> Iterator[tuple[int, list]]:
        while len(ids):
            room = [(self.size - fill, k) for k, (fill, _) in enumerate(self.open) if self.size - fill >= len(ids)]
            if room:
                k = min(room)[1]
                take = len(ids)
            elif len(self.open) < self.limit:
                self.open.append((0, []))
                k, take = len(self.open) - 1, min(len(ids), self.size)
            else:
                k = max(range(len(self.open)), key=lambda i: (self.open[i][0], -i))
                take = self.size - self.open[k][0]
                take = min(take, len(ids) - self.least_cut)
                if take < self.least_cut:
                    take = 0
            fill, pieces = self.open[k]
            if take:
                pieces.append((doc_id, start, ids[:take], doc_tokens))
                self.open[k] = (fill + take, pieces)
                start, ids = start + take, ids[take:]
            if not take or fill + take == self.size:
                yield self.open.pop(k)


def _rows(window: tuple[int, list], sequence_id: int, padded: int) -> Iterator[tuple]:
    fill, pieces = window
    offset = 0
    for doc_id, start, ids, doc_tokens in pieces:
        data = ids.astype("<u4").tobytes()
        yield doc_id, start, len(ids), zlib.crc32(data), doc_tokens, sequence_id, offset, fill, padded, data
        offset += len(ids)


def piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in COLUMNS]
    return pa.record_batch([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(cols, COLUMNS)], COLUMNS)


def _pack(items: Iterable[tuple], w: Windows, first_id: int, batch_ids: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Closed windows as pieces; the pieces of windows still open come last, without a sequence id."""
    rows, held, n = [], 0, first_id
    for item in items:
        for closed in w.add(*item):
            rows += _rows(closed, n, w.size)
            n, held = n + 1, held + w.size
        if held >= batch_ids:
            yield piece_batch(rows)
            rows, held = [], 0
    for left in w.open:
        rows += [(*r[:5], None, *r[6:]) for r in _rows(left, 0, w.size)]
    yield piece_batch(rows)


def documents_as_ids(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple]:
    """(doc_id, start, ids, tokens of the document), by row."""
    enc = encoder(tokenizer)
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            ids = np.append(enc.ids(text.as_py() or ""), np.uint16(end_id))
            yield doc_id, 0, ids, len(ids)


def pack(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 1024, open_windows: int = 64, least_cut: int = 16,
    tokenizer: str = "byte_bpe_50k", end_id: int = 0, fan_in: int = 64,
) -> DataFrame:
    """One row a piece: where it lies in its document and in its sequence, and its ids (little-endian 32 bits).

    `fill` is the sequence's number of ids, `padded` the length it is stored at: `size`, or `fill` where that is a
    power of two. At most `fan_in` leftovers of `open_windows` windows meet in one task.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group = TaskContext.get().partitionId()
        yield from _pack(documents_as_ids(batches, tokenizer, end_id), Windows(size, open_windows, least_cut), group << 32)

    narrow = docs.select(F.col(doc_id).cast("long"), F.col(text))
    groups = max(1, narrow.rdd.getNumPartitions())
    done, level = [], 0
    packed = written(narrow.mapInArrow(first, PIECE).withColumn("from", F.spark_partition_id().cast("long")), "packed")
    while True:
        done.append(packed.where("sequence_id IS NOT NULL").select(*COLUMNS))
        left, level, last = packed.where("sequence_id IS NULL"), level + 1, groups <= fan_in
        merge = _merger(size, open_windows, least_cut, level, last)
        groups = -(-groups // fan_in)
        packed = left.withColumn("group", F.floor(F.col("from") / fan_in)).groupBy("group").applyInArrow(merge, PIECE + ", from long")
        if last:
            done.append(packed.select(*COLUMNS))
            break
        packed = written(packed, "packed")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _merger(size: int, open_windows: int, least_cut: int, level: int, last: bool):
    def merge(key: tuple, left: pa.Table) -> pa.Table:
        # the order is fixed, so that a task that runs again gives the same sequences
        rows = left.sort_by([(c, "ascending") for c in ("from", "fill", "doc_id", "start", "ids_crc32")]).to_pylist()
        items = ((r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in rows)
        group = key[0].as_py()
        n = (level << LEVEL_BITS) + (group << 32)
        out, w = [], Windows(size, 1 if last else open_windows, 0 if last else least_cut)
        for batch in _pack(items, w, n):
            out += batch.to_pylist()
        rest = [r for r in out if r["sequence_id"] is None]
        if last:
            out = [r for r in out if r["sequence_id"] is not None]
            out += _at_powers(rest, n + len(out))
        kinds = [(c, pa.binary() if c == "ids" else pa.int64()) for c in COLUMNS] + [("from", pa.int64())]
        return pa.Table.from_pylist([r | {"from": group} for r in out], schema=pa.schema(kinds))

    return merge


def _at_powers(pieces: list[dict], n: int) -> list[dict]:
    """The last window cut into sequences whose lengths are powers of two, so that it needs no padding."""
    out, total = [], sum(p["length"] for p in pieces)
    todo = [(p["doc_id"], p["start"], np.frombuffer(p["ids"], "<u4"), p["doc_tokens"]) for p in pieces]
    while total:
        room = fill = 1 << (total.bit_length() - 1)
        taken = []
        while room:
            whose, start, ids, tokens = todo.pop(0)
            if len(ids) > room:
                todo.insert(0, (whose, start + room, ids[room:], tokens))
                ids = ids[:room]
            taken.append((whose, start, ids, tokens))
            room -= len(ids)
        out += [dict(zip(COLUMNS, r)) for r in _rows((fill, taken), n, fill)]
        n, total = n + 1, total - fill
    return out
