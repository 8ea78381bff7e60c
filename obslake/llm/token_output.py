"""Token ids packed offline by best-fit-decreasing and written as binary matrices.

Texts are cut into blocks of a bounded number of ids, inside the tasks that read them. In a block, documents longer than
a row are split without loss into whole rows and one remainder; remainders and short documents are placed longest
first, each in the fullest row that still takes it. The row is found by a segment tree over the free capacities, in
logarithmic time whatever the number of rows.

The table has one row per packed row: `ids` (little-endian unsigned 16 bits, padded with the end id to the row length),
`cu_seqlens` (cumulative lengths of the segments, 0 first, the padding not counted), `positions` (each id's place in
its document's stretch, starting over at each segment) and the documents of the segments. `matrices` stacks them.

Null and empty texts are one closing id; repeated rows and rows with a null id are packed each on its own; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .packing import documents_as_ids

PACKED = (
    "row_id long, n_ids int, ids binary, cu_seqlens array<int>, positions binary, "
    "segments array<struct<doc_id:long,start:long,length:long,doc_tokens:long,ids_crc32:long>>"
)
SEGMENT = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "ids_crc32")]))
SCHEMA = pa.schema(
    [("row_id", pa.int64()), ("n_ids", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("positions", pa.binary()), ("segments", SEGMENT)]
)


class Capacities:
    """Rows by free capacity: how many there are in each range of capacities, as a segment tree."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The row with the smallest capacity that is `least` or more, removed; None if there is none."""
        i = least + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        self._add(capacity, -1)
        return capacity, self.rows[capacity].pop()

    def _add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of at most `size` ids, as lists of the pieces' places; every length is at most `size`."""
    free, rows = Capacities(size), []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[k])
        if found is None:
            found = size, len(rows)
            rows.append([])
        rows[found[1]].append(k)
        free.put(found[0] - lengths[k], found[1])
    return rows


def _block(items: list[tuple], size: int, end_id: int, first_row: int) -> pa.RecordBatch:
    pieces = [(d, s, ids[s : s + size], n) for d, _, ids, n in items for s in range(0, n, size)]
    out = []
    for r, row in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], size)):
        ids, positions, ends, segments = np.full(size, end_id, "<u2"), np.zeros(size, "<u2"), [0], []
        for doc_id, start, part, n in (pieces[k] for k in row):
            a, b = ends[-1], ends[-1] + len(part)
            ids[a:b], positions[a:b] = part, np.arange(len(part))
            ends.append(b)
            segments.append({"doc_id": doc_id, "start": start, "length": len(part), "doc_tokens": n, "ids_crc32": zlib.crc32(part.astype("<u4").tobytes())})
        out.append((first_row + r, ends[-1], ids.tobytes(), ends, positions.tobytes(), segments))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), SCHEMA)], schema=SCHEMA)


def pack_rows(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 2048, block_ids: int = 4 << 20,
    tokenizer: str = "byte_bpe_50k", end_id: int = 0,
) -> DataFrame:
    """The packed rows. A block holds `block_ids` ids or one document more; a task holds one block at a time."""
    if not 1 < size <= 1 << 16:
        raise ValueError("rows hold from 2 to 65536 ids")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, items, held = TaskContext.get().partitionId() << 32, [], 0
        for item in documents_as_ids(batches, tokenizer, end_id):
            items.append(item)
            held += item[3]
            if held >= block_ids:
                yield (done := _block(items, size, end_id, row))
                row, items, held = row + done.num_rows, [], 0
        if items:
            yield _block(items, size, end_id, row)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(blocks, PACKED)


def write_rows(packed: DataFrame) -> DataFrame:
    """The packed rows as a table in the shared folder, reread."""
    return written(packed, "packed-rows")


def matrices(rows: list, size: int) -> dict[str, np.ndarray]:
    """Collected rows as an id matrix, a position matrix and the rows' cumulative lengths."""
    stack = lambda c: np.stack([np.frombuffer(r[c], "<u2") for r in rows]) if rows else np.zeros((0, size), "<u2")
    return {"ids": stack("ids"), "positions": stack("positions"), "cu_seqlens": np.array([np.array(r["cu_seqlens"], np.int32) for r in rows], object)}


def segments(packed: DataFrame) -> DataFrame:
    """One row a segment: its document, stretch and row."""
    at = packed.select("row_id", "n_ids", F.posexplode("segments").alias("k", "s"), "cu_seqlens")
    return at.select("s.*", F.col("row_id").alias("sequence_id"), F.get("cu_seqlens", "k").cast("long").alias("offset"), F.col("n_ids").cast("long").alias("fill"))
