"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    ``rows`` bounds the number of (narrow) rows, where it is known: the table
    then has a partition per 50,000 of them, not one per shuffle partition.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // 50_000)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, max_bytes: int = 8 << 20) -> None:
    """Cut Arrow batches of whole texts at about ``max_bytes`` (a batch is in
    memory several times, in the JVM and in Python).  Only the size of the
    batches changes, no row; a limit that the session already has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, str(max_bytes))


def id_remainder(col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(col.cast("string").cast("binary")) % mod


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


# ------------------------------------------------------------------ Arrow text

def text_chunks(col: pa.Array, max_bytes: int = 1 << 20
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``max_bytes``.

    Yields (first row, row after the last, bytes, offsets into them).  A null
    is an empty text; a text longer than the limit is a run of its own.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, offs: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word (a run of bytes other than
    0x20 and 0x09-0x0D) of the concatenated texts."""
    n = len(data)
    if not n:
        e = np.empty(0, np.int64)
        return e, e, e
    word = ~_WS[data]
    edge = np.zeros(n + 1, bool)          # a text begins here
    edge[offs] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offs, starts, "right") - 1


_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1


class _Powers:
    """Powers of the base and of its inverse modulo 2**64; grown as needed
    and never shipped with a task."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, (1 << 20) + 1, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_POWERS = _Powers()


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span, from one running polynomial sum.

    ``lower`` maps A-Z to a-z first.
    """
    p, inv = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * p[:len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def gather_spans(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions first[i] .. first[i]+length[i]-1, one span after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total) - np.repeat(before - first, length)
