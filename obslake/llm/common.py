"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffles_freed, written  # noqa: F401 (operators take it from here)

#: The white space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = "\t\n\x0b\x0c\r "
SPLIT_SPACES = "\t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: later jobs reread it, lost executors do not matter."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint()  # a frame of its own, whose shuffle files nobody else reads


def collected(df: DataFrame) -> list[Row]:
    """The rows of a small frame, which leaves no shuffle files."""
    with shuffles_freed(df.sparkSession):
        return df.select("*").collect()


def whole_text(text: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order."""
    for space in SPLIT_SPACES:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fold_of(key: str | Column, folds: int = 5) -> Column:
    """crc32 of a key as text, modulo the number of folds; a null key counts as the empty text."""
    return F.crc32(F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("")).cast("binary")) % folds


# ---------------------------------------------------------------- numpy over Arrow text, inside tasks

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 2 << 20


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; the longest table so far is kept."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1 << 16), np.uint64(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[: n + 1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * BASE**i: hash of data[a:b] is (P[b] - P[a]) * BASE**-a."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[:-1], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * powers(INVERSE, len(prefix) - 1)[start]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column  # which would copy all texts
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]] if len(off) else raw[:0], off - off[0] if len(off) else np.zeros(1, np.int64)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of about `limit` bytes; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words do not run from one text into the next."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_SPACE[raw]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    opens[edge] = solid[edge]
    closes[edge - 1] = solid[edge - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z lowered."""
    return _LOWER[raw]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, A-Z lowered, and the number of words of each text."""
    start, end = word_bounds(raw, offsets)
    hashes = scramble(range_hash(prefix_hash(_LOWER[raw]), start, end) + (end - start).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(start, offsets))
