"""Nearest neighbours by multi-index hashing over learned binary codes.

Several rotations learned by iterative quantization (on a bounded sample of
the index) turn a vector into a binary code.  The code is split into
substrings, each with an index of its own.  By the pigeonhole principle a code
within Hamming distance r of a query's differs in at least one substring by at
most r // m bits, so probing every substring index at that radius retrieves
every code within r; the true distance filters, and the survivors are reranked
by the inner product of the original vectors.

Rows and queries are dealt into hash blocks; every query block meets every
row block once, in a task of its own, and only the best k per block leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import materialize


@dataclass(frozen=True)
class CodeModel:
    """``rotations`` is (dimension, bits); ``radius`` the Hamming radius that
    held the wanted share of true neighbours in the sample."""

    mean: np.ndarray
    rotations: np.ndarray
    radius: int
    substring: int = 8

    @property
    def bits(self) -> int:
        return self.rotations.shape[1]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of bytes, one byte a substring."""
        return np.packbits((x - self.mean) @ self.rotations > 0, axis=1)


def fit(sample: np.ndarray, k: int, tables: int = 4, iterations: int = 20, recall: float = 0.97,
        queries: int = 200, seed: int = 3) -> CodeModel:
    """Learn ``tables`` rotations from rows of a bounded sample, and the
    radius: the Hamming distance that ``recall`` of the true ``k`` nearest of
    ``queries`` sampled queries don't exceed.  In a larger index neighbours
    are nearer, so the radius holds there too."""
    rng = np.random.Generator(np.random.PCG64(seed))
    d = sample.shape[1]
    mean = sample.mean(0)
    x = sample - mean
    rotations = []
    for _ in range(tables):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(iterations):
            u, _, vt = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
            r = (u @ vt).T
        rotations.append(r)
    model = CodeModel(mean, np.concatenate(rotations, 1), 0)
    q = sample[:queries]
    near = q @ sample.T
    near[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return CodeModel(mean, model.rotations, model.bits)
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    codes = model.encode(sample)
    dist = np.bitwise_count(codes[:len(q), None, :] ^ codes[top]).sum(2, dtype=np.int64)
    return CodeModel(mean, model.rotations, int(np.quantile(dist, recall)) if len(q) else model.bits)


class SubstringIndexes:
    """For each substring the rows by its value, as a table of rows within a
    distance of each value."""

    def __init__(self, codes: np.ndarray, radius: int):
        m = codes.shape[1]
        values = np.arange(256, dtype=np.uint8)
        apart = np.bitwise_count(values[:, None] ^ values)
        # radius r over m substrings: r % m + 1 of them reach r // m, the
        # others one less; a code within r differs little enough in one
        reach = np.full(m, radius // m)
        reach[radius % m + 1:] -= 1
        self.near = [(apart <= t)[:, codes[:, j]] for j, t in enumerate(reach)]

    def probe(self, code: np.ndarray) -> np.ndarray:
        """Rows (as a mask for each query) that any substring retrieves."""
        hit = self.near[0][code[:, 0]]
        for j in range(1, len(self.near)):
            hit |= self.near[j][code[:, j]]
        return hit


def _whole_words(codes: np.ndarray) -> np.ndarray:
    """Codes as words of 8 bytes, zero bytes added at the end."""
    return np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 8)))).view(np.uint64)


def search_block(model: CodeModel, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, qids: np.ndarray,
                 q: np.ndarray, qcodes: np.ndarray, k: int, radius: int) -> tuple[np.ndarray, ...]:
    """(query id, row id, score) of the best k rows of a block per query
    within ``radius``; a query is not its own neighbour."""
    words, qwords = _whole_words(codes), _whole_words(qcodes)
    index = SubstringIndexes(codes, radius)
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, (1 << 20) // max(1, len(ids)))
    for i in range(0, len(qids), step):
        s = slice(i, i + step)
        of, row = np.nonzero(index.probe(qcodes[s]) & (qids[s, None] != ids))
        dist = np.zeros(len(of), np.int64)
        for w in range(words.shape[1]):
            dist += np.bitwise_count(qwords[s][of, w] ^ words[row, w])
        of, row = of[dist <= radius], row[dist <= radius]
        score = np.empty(len(of))
        for j in range(0, len(of), 1 << 16):
            c = slice(j, j + (1 << 16))
            score[c] = np.einsum("ij,ij->i", q[s][of[c]], x[row[c]])
        order = np.lexsort((ids[row], -score, of))
        of, row, score = of[order], row[order], score[order]
        first = np.searchsorted(of, np.arange(of[-1] + 1 if len(of) else 0))
        keep = np.arange(len(of)) - first[of] < k if len(of) else np.zeros(0, bool)
        out.append((qids[s][of[keep]], ids[row[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (qids[:0], ids[:0], np.empty(0))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part: an id, and a vector that is neither
    null nor empty nor zero and whose components are all finite."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))
                   & F.exists(v, lambda x: x != 0)))


def _vectors(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _grid(rows: DataFrame, queries: DataFrame, model: CodeModel, k: int, radius: int,
          block_rows: int, block_queries: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each block for each query."""
    n_rows = max(1, -(-rows.count() // block_rows))
    n_queries = max(1, -(-queries.count() // block_queries))

    def block(n):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    sides = (queries.select(block(n_queries).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("rb"),
                            F.lit(0).alias("side"), "id", "v")
             .unionByName(rows.select(F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("qb"),
                                      block(n_rows).alias("rb"), F.lit(1).alias("side"), "id", "v")))

    def search(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        v = _vectors(table.column("v"))
        codes = model.encode(v)
        a, b = side == 0, side == 1
        got = search_block(model, ids[b], v[b], codes[b], ids[a], v[a], codes[a], k, radius) \
            if a.any() and b.any() else (ids[:0], ids[:0], np.empty(0))
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()),
                         "score": pa.array(got[2], pa.float64())})

    return sides.groupBy("qb", "rb").applyInArrow(search, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            sample_rows: int = 20_000, block_rows: int = 16_384, block_queries: int = 4_096) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a
    condition on ``id``) holds, the k other rows of largest inner product
    among those within the Hamming radius.

    Ties go to the smaller id.  Rows without an id, and vectors that are null,
    empty, zero or hold null or non-finite components, take no part.  Vectors
    of each dimension are an index of their own, with codes of their own.  Of
    repeated ids each row is a candidate of its own, and they are not each
    other's.  A query that finds fewer than k rows (and fewer than there are)
    searches again at full radius, that is all rows.  The codes are learned
    from ``sample_rows`` rows at most, by hash of id and vector; every row is
    indexed.
    """
    index = materialize(usable(rows, id_col, vector_col), "ann-rows")
    sizes = sorted((r["d"], r["n"]) for r in index.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect())
    found = [_nearest_of(index.where(F.size("v") == d), n, is_query, k, sample_rows, block_rows, block_queries)
             for d, n in sizes]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _nearest_of(index: DataFrame, total: int, is_query, k: int, sample_rows: int, block_rows: int,
                block_queries: int) -> DataFrame:
    """``nearest`` among the ``total`` rows (id, v) of one dimension."""
    share = min(1.0, sample_rows / total)
    sample = index.where(F.pmod(F.xxhash64("id", "v", F.lit(29)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    taken = sample.orderBy(F.xxhash64("id", "v", F.lit(31)), "id").limit(sample_rows).toPandas()
    if not len(taken):       # a few repeated rows, none of them drawn
        taken = index.limit(sample_rows).toPandas()
    model = fit(np.stack(taken.v.to_numpy()).astype(float), k)
    queries = index.where(is_query)
    found = materialize(_best(_grid(index, queries, model, k, model.radius, block_rows, block_queries), k), "ann-first")
    others = total - 1
    done = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, others))
    short = materialize(queries.join(done, queries["id"] == done["query_id"], "left_anti"), "ann-short")
    if short.limit(1).count():
        again = _best(_grid(index, short, model, k, model.bits, block_rows, block_queries), k)
        found = (found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti")
                 .unionByName(again))
    return found
