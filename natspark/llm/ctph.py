"""Context-triggered piecewise hashing.

A rolling hash of the last 7 bytes cuts a text into chunks: at block size 2**k
a chunk ends where the hash has k trailing zero bits.  Each chunk's hash gives
one of 64 characters.  The fingerprint is "blocksize:signature:signature at
twice the block size"; two fingerprints are compared, at a block size that
both have, by the edit distance (insertions and deletions) of the signatures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import materialize, span_hashes

WINDOW = 7
LONG, SHORT = 64, 32          # characters of the two signatures at most
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_COMMON_RUN = 4


class Fingerprints:
    """Fingerprints of many texts: block size exponent, and both signatures as
    numbers 0..63 (64 behind the end) with their lengths."""

    def __init__(self, k, sig1, len1, sig2, len2):
        self.k, self.sig1, self.len1, self.sig2, self.len2 = k, sig1, len1, sig2, len2

    def __len__(self):
        return len(self.k)

    def take(self, rows) -> Fingerprints:
        return Fingerprints(self.k[rows], self.sig1[rows], self.len1[rows], self.sig2[rows], self.len2[rows])

    def texts(self) -> list[str]:
        def part(sig, n):
            return bytes(_ALPHABET[sig[:n]]).decode()

        return [f"{1 << int(k)}:{part(a, m)}:{part(b, n)}"
                for k, a, m, b, n in zip(self.k, self.sig1, self.len1, self.sig2, self.len2)]


def _triggers(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Trailing zero bits of the rolling hash at each byte; the window never
    reaches into the text before."""
    n, texts = len(data), len(offs) - 1
    gap = WINDOW - 1
    at = np.arange(n) + gap * (np.repeat(np.arange(texts), np.diff(offs)) + 1)
    padded = np.zeros(n + gap * (texts + 1), np.uint32)
    padded[at] = data.astype(np.uint32) + np.uint32(1)
    h = np.zeros(len(padded), np.uint32)
    for i in range(WINDOW):
        h[i:] += padded[:len(padded) - i] * np.uint32(pow(0x01000193, i, 2**32))
    h = h[at]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return np.bitwise_count((h & -h) - np.uint32(1)).astype(np.int8)      # 32 for a hash of 0


def _signature(data, offs, level, k, limit) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the texts at their block sizes 2**k; the last of ``limit``
    characters stands for all that is left."""
    texts = len(offs) - 1
    size = np.diff(offs)
    of = np.repeat(np.arange(texts), size)
    ends = np.flatnonzero(level >= k[of]) + 1
    owner = of[ends - 1]
    last = offs[1:][owner]
    ends, owner = ends[ends < last], owner[ends < last]          # a text's end comes below
    n = np.bincount(owner, minlength=texts)
    rank = np.arange(len(ends)) - (np.cumsum(n) - n)[owner]
    ok = rank < limit - 1
    ends, owner, rank = ends[ok], owner[ok], rank[ok]
    some = np.flatnonzero(size > 0)
    ends, owner = np.concatenate([ends, offs[1:][some]]), np.concatenate([owner, some])
    order = np.lexsort((ends, owner))
    ends, owner = ends[order], owner[order]
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, bool)
    starts = np.where(first, offs[owner], np.concatenate([[0], ends[:-1]])) if len(owner) else ends
    length = np.bincount(owner, minlength=texts)
    column = np.arange(len(owner)) - (np.cumsum(length) - length)[owner]
    sig = np.full((texts, limit), 64, np.uint8)
    sig[owner, column] = (span_hashes(data, starts, ends) >> np.uint64(58)).astype(np.uint8)
    return sig, length


def fingerprint(data: np.ndarray, offs: np.ndarray) -> Fingerprints:
    """Fingerprints of the concatenated texts.

    The block size is the smallest with 64 blocks covering the text, halved
    once if the signature has fewer than 32 characters: texts of like length
    so share a block size, whatever repeats in them.  An empty text has block
    size 1 and empty signatures.
    """
    size = np.diff(offs)
    level = _triggers(data, offs)
    of = np.repeat(np.arange(len(size)), size)
    k = np.maximum(np.ceil(np.log2(np.maximum(size, 1) / LONG)), 0).astype(np.int64)
    top = int(k.max(initial=0))
    hist = np.bincount(of * (top + 2) + np.minimum(level, top + 1), minlength=len(size) * (top + 2))
    ends = hist.reshape(len(size), top + 2)[:, ::-1].cumsum(1)[:, ::-1]      # chunks that end at level k
    k -= (k > 0) & (ends[np.arange(len(size)), k] + 1 < LONG // 2)
    sig1, len1 = _signature(data, offs, level, k, LONG)
    sig2, len2 = _signature(data, offs, level, k + 1, SHORT)
    return Fingerprints(k, sig1, len1, sig2, len2)


def _alike(a, na, b, nb) -> np.ndarray:
    """1 - edit distance / sum of lengths for each pair of signatures; 0 for
    pairs without a common run of 4 characters (or of the shorter one's length)."""
    out = np.zeros(len(a))
    wide = max(a.shape[1], b.shape[1])
    a = np.pad(a, ((0, 0), (0, wide - a.shape[1])), constant_values=64)
    b = np.pad(b, ((0, 0), (0, wide - b.shape[1])), constant_values=64)
    for i in range(0, len(a), 256):
        s = slice(i, i + 256)
        same = (b[s][:, :, None] == a[s][:, None, :]) & (b[s] < 64)[:, :, None]
        need = np.minimum(np.minimum(na[s], nb[s]), _COMMON_RUN)
        run, common = same, np.zeros(len(same), bool)
        for length in range(1, _COMMON_RUN + 1):
            common |= (need == length) & run.any((1, 2))
            if length < _COMMON_RUN:
                run = run[:, :-1, :-1] & same[:, length:, length:]
        # longest common subsequence, 64 cells of a column at a time
        match = np.packbits(same, axis=2, bitorder="little")
        match = np.pad(match, ((0, 0), (0, 0), (0, 8 - match.shape[2]))).view(np.uint64)[:, :, 0]
        v = np.full(len(same), 2**64 - 1, np.uint64)
        for j in range(match.shape[1]):
            u = v & match[:, j]
            v = (v + u) | (v - u)
        lcs = np.bitwise_count(~v)
        total = np.maximum(na[s] + nb[s], 1)
        out[s] = np.where(common, 2 * lcs / total, 0.0)
    return out


def likeness(x: Fingerprints, y: Fingerprints) -> np.ndarray:
    """0 to 1 for each pair; 1 for equal fingerprints, 0 where no block size
    is common."""
    out = np.zeros(len(x))
    level = x.k - y.k
    equal = level == 0
    for rows, pairs in (
            (equal, (("sig1", "len1", "sig1", "len1"), ("sig2", "len2", "sig2", "len2"))),
            (level == 1, (("sig1", "len1", "sig2", "len2"),)),
            (level == -1, (("sig2", "len2", "sig1", "len1"),))):
        rows = np.flatnonzero(rows)
        for a, na, b, nb in pairs:
            out[rows] = np.maximum(out[rows], _alike(getattr(x, a)[rows], getattr(x, na)[rows],
                                                     getattr(y, b)[rows], getattr(y, nb)[rows]))
    same = equal & (x.sig1 == y.sig1).all(1) & (x.sig2 == y.sig2).all(1)
    out[same] = 1.0
    return out


def of_strings(texts: list[str]) -> Fingerprints:
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return fingerprint(np.frombuffer(b"".join(raw), np.uint8), offs)


# ----------------------------------------------------------------- Spark steps

def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as much of the
    begin of ``following`` as there is."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    new = [edited(t, f) for t, f in zip(texts, following)]
    own, other, changed = of_strings(texts), of_strings(following), of_strings(new)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
         pa.array(own.texts()), pa.array(changed.texts()),
         pa.array(likeness(own, changed)), pa.array(likeness(own, other))],
        ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _begin(text_col: str) -> Column:
    """The first 64 characters: a short key in the order of the texts."""
    return F.substring(text_col, 1, 64)


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               chunk_chars: int = 1 << 20) -> DataFrame:
    """Fingerprint every text, its edit by the next text, and compare.

    The next row is that of the next larger id (of equal ids: by text; null
    ids first); after the last comes the first.  A null text is empty.  An
    empty table gives no rows; a single row is its own next.

    The texts cross one range shuffle, by id and the begin of the text, so an
    id (or no id) that a third of the rows share is many tasks.  They are then
    read in order and a task holds a chunk of them; only the seams between the
    sorted partitions, two rows for each, are joined afterwards.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(F.col("id"), _begin("text")).sortWithinPartitions("id", "text")
    seam = ("struct<first_id:bigint,first:string,last_id:bigint,last:string>")
    fields = [f.split() for f in RESULT.split(", ")]
    arrow = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    seam_type = pa.struct([("first_id", pa.int64()), ("first", pa.string()),
                           ("last_id", pa.int64()), ("last", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        ids: list = []
        texts: list[str] = []
        names = [f[0] for f in fields] + ["seam"]

        def out() -> pa.RecordBatch:
            done = _compare(ids[:-1], texts[:-1], texts[1:])
            return pa.RecordBatch.from_arrays([*done.columns, pa.nulls(done.num_rows, seam_type)], names)

        for b in batches:
            chars = sum(map(len, texts))
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                first = first or (i, t)
                ids.append(i)
                texts.append(t)
                chars += len(t)
                if chars >= chunk_chars and len(texts) > 1:
                    yield out()
                    ids, texts = ids[-1:], texts[-1:]
                    chars = len(t)
        if first:
            if len(texts) > 1:
                yield out()
            seams = pa.array([{"first_id": first[0], "first": first[1], "last_id": ids[-1], "last": texts[-1]}],
                             seam_type)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, arrow[f[1]]) for f in fields), seams], names)

    found = materialize(ordered.mapInArrow(run, RESULT + f", seam {seam}"), "ctph")
    seams = found.where("seam is not null").select("seam.*").withColumn("begin", _begin("first"))
    # One row per partition, ids and begins only: which partition follows which.
    in_order = Window.orderBy("first_id", "begin")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    here, head = F.struct("first_id", "begin"), F.first(F.struct("first_id", "begin")).over(whole)
    order = seams.select(here.alias("s"), F.coalesce(F.lead(here).over(in_order), head).alias("next"))
    heads = seams.select(here.alias("h"), "first")
    ends = (seams.select(here.alias("here"), "last_id", "last")
            .join(order, F.col("here").eqNullSafe(F.col("s")))
            .join(heads, F.col("next").eqNullSafe(F.col("h")))
            .select(F.col("last_id").alias("id"), "last", "first"))

    def run_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, following = b.column(1).to_pylist(), b.column(2).to_pylist()
            for i in range(0, b.num_rows, 256):
                s = slice(i, i + 256)
                yield _compare(b.column(0).to_pylist()[s], texts[s], following[s])

    return found.where("seam is null").drop("seam").unionByName(ends.mapInArrow(run_ends, RESULT))
