"""Near-duplicate detection with b-bit MinHash.

1.  Every text becomes its set of word shingles (64-bit hashes) and k minima.
    Texts of equal sets are one node from here on, so exact copies cost one.
2.  Bands of full minima give the candidate buckets.
3.  Of the minima only the low b bits are kept, packed; the share of equal
    b-bit values, corrected for chance collisions, estimates the similarity.
    Candidates whose estimate is far below the threshold are dropped, the
    others are confirmed on the full sets.
4.  Buckets are never expanded into all pairs.  Each bucket first links its
    nodes to one pseudo-random member, then to the member of most links.  In
    the few buckets that still hold several components, the nodes outside the
    largest one are compared with all others in blocks, by packed signatures;
    what passes the estimate forms clusters, and these are confirmed in blocks
    on the full sets.  A task gives only links that join components, so no
    pair that shares a bucket goes unseen and none is written out twice.
5.  Components come from alternating star contraction of the links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import materialize, mix64, span_hashes, text_chunks, word_bounds


@dataclass(frozen=True)
class Params:
    """``shingle_words`` words a shingle; pairs link if 100 * intersection >=
    ``percent`` * union.  With 32 bands of 5 a pair at similarity 0.8 shares
    no bucket with probability 3e-6; the estimate's slack is ``sigmas`` of its
    standard error."""

    shingle_words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    bits: int = 4
    sigmas: float = 5.0
    block: int = 2048
    set_block: int = 128
    broadcast_nodes: int = 500_000

    @property
    def k(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Equal b-bit values that a candidate needs."""
        s, c = self.percent / 100, 2.0 ** -self.bits
        p = c + (1 - c) * s
        return math.ceil(self.k * p - self.sigmas * math.sqrt(self.k * p * (1 - p)))


# ------------------------------------------------------------------ signatures

def shingles(data: np.ndarray, offs: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts, and the text number of each (ascending).
    A text of fewer than ``w`` words has its whole sequence as one shingle."""
    starts, ends, doc = word_bounds(data, offs)
    if not len(starts):
        return np.empty(0, np.uint64), doc
    words = span_hashes(data, starts, ends, lower=True)
    n = np.bincount(doc, minlength=len(offs) - 1)
    first = np.cumsum(n) - n
    size = np.minimum(n, w)
    at = np.flatnonzero(np.arange(len(words)) + size[doc] <= (first + n)[doc])
    of = doc[at]
    h = np.zeros(len(at), np.uint64)
    for i in range(w):
        inside = i < size[of]
        word = words[np.minimum(at + i, len(words) - 1)]
        h = np.where(inside, mix64(h * np.uint64(0x9E3779B97F4A7C15) + word), h)
    return h, of


def text_sets(data: np.ndarray, offs: np.ndarray, w: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, of = shingles(data, offs, w)
    cut = np.searchsorted(of, np.arange(1, len(offs) - 1))
    return [np.unique(x) for x in np.split(h, cut)]


def node_id(unique: np.ndarray) -> int:
    """A set's identity: 64 bits of its MD5."""
    return int.from_bytes(hashlib.md5(unique.astype("<u8").tobytes()).digest()[:8], "little", signed=True)


class MinHasher:
    def __init__(self, p: Params, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.p = p
        self.mul = rng.integers(1, 2**63, p.k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**63, p.k, dtype=np.uint64)
        self.band_seed = rng.integers(1, 2**63, p.bands, dtype=np.uint64)

    def minima(self, unique: np.ndarray) -> np.ndarray:
        low = None
        for i in range(0, len(unique), 2048):
            part = ((unique[i:i + 2048, None] * self.mul + self.add) >> np.uint64(32)).min(0)
            low = part if low is None else np.minimum(low, part)
        return low

    def bands(self, low: np.ndarray) -> np.ndarray:
        rows = low.reshape(self.p.bands, self.p.rows)
        h = self.band_seed.copy()
        for i in range(self.p.rows):
            h = mix64(h ^ rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        return h

    def pack(self, low: np.ndarray) -> bytes:
        """The low bits of the minima, end to end."""
        b = self.p.bits
        bits = (low[:, None] >> np.arange(b, dtype=np.uint64)) & np.uint64(1)
        return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def equal_values(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Equal b-bit values between packed signatures (uint64 words on the last
    axis; values must not straddle words, so ``bits`` divides 64)."""
    x = a ^ b
    shift = 1
    while shift < bits:                      # OR the bits of a value into its lowest
        x = x | (x >> np.uint64(shift))
        shift *= 2
    lowest = np.uint64(sum(1 << i for i in range(0, 64, bits)))
    return x.shape[-1] * (64 // bits) - np.bitwise_count(x & lowest).sum(-1, dtype=np.int64)


def sig_words(sigs: list[bytes]) -> np.ndarray:
    width = -(-len(sigs[0]) // 8) * 8
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in sigs), np.uint64).reshape(len(sigs), -1)


def _pad(p: Params) -> int:
    """Values that padding to whole words adds, equal in every signature."""
    width = -(-p.k * p.bits // 64)
    return width * (64 // p.bits) - p.k


def sign(docs: DataFrame, p: Params, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, node, sig, bands) of every row; an empty set has no
    node, sig or bands."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(p)
        for b in batches:
            for i, j, data, offs in text_chunks(b.column(1)):
                n, node, sig, bands = [], [], [], []
                for u in text_sets(data, offs, p.shingle_words):
                    n.append(len(u))
                    if len(u):
                        low = hasher.minima(u)
                        node.append(node_id(u))
                        sig.append(hasher.pack(low))
                        bands.append(hasher.bands(low).view(np.int64))
                    else:
                        node.append(None)
                        sig.append(None)
                        bands.append(None)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "node", "sig", "bands"])

    return src.mapInArrow(run, "id long, n_shingles long, node long, sig binary, bands array<long>")


def node_sets(docs: DataFrame, nodes: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame:
    """(node, items): the full sets of ``nodes`` (node, id), from the texts."""
    # 16 bytes a node: sent to all tasks within the bound, else the texts are shuffled
    few = nodes.count() <= p.broadcast_nodes
    src = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
           .join(F.broadcast(nodes) if few else nodes, "id").select("node", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_chunks(b.column(1)):
                want = b.column(0).slice(i, j - i).to_pylist()
                # an id can stand for several texts: only the node's own counts
                own = [(x, u) for x, u in zip(want, text_sets(data, offs, p.shingle_words))
                       if len(u) and node_id(u) == x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in own], pa.int64()),
                     pa.array([u.view(np.int64) for _, u in own], pa.list_(pa.int64()))], ["node", "items"])

    return src.mapInArrow(run, "node long, items array<long>")


# ----------------------------------------------------------------------- links

def estimated(pairs: DataFrame, sigs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose estimate allows the threshold."""
    withs = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
             .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
             .select("a", "b", "sa", "sb"))
    least, pad = p.least_equal, _pad(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                eq = equal_values(sig_words(batch.column(2).to_pylist()),
                                  sig_words(batch.column(3).to_pylist()), p.bits) - pad
                ok = pa.array(eq >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)],
                                                 ["a", "b"])

    return withs.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, p: Params, rows: int) -> DataFrame:
    """The pairs whose full sets meet the threshold."""
    needed = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nd-needed", rows)
    sets = sets.join(needed, "node", "left_semi")
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("ia")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("items").alias("ib")), "b"))
    common = F.size(F.array_intersect("ia", "ib"))
    union = F.size("ia") + F.size("ib") - common
    return both.where(common * 100 >= union * p.percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of a link.

    Alternating star contraction: the larger neighbours of a node are linked
    to its smallest one (large star), then a node and its smaller neighbours
    (small star), until nothing changes.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u <> v").distinct(), "cc")
    n = 2 * edges.count()
    state = None
    while n:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                          .select("u", F.least("u", "m").alias("m")), "cc-min", n)
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(low.where("u <> m").select("u", F.col("m").alias("v"))), "cc-large", n)
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min", n)
        edges = materialize(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc", n)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _open_buckets(entries: DataFrame, comps: DataFrame | None, rows: int | None = None) -> DataFrame:
    """Entries (key, node, comp) of the buckets that hold several components;
    ``rows``, where known, is the number of entries."""
    if comps is None:
        placed = entries.withColumn("comp", F.col("node"))
    else:
        placed = (entries.join(comps, "node", "left")
                  .select("key", "node", F.coalesce("comp", "node").alias("comp")))
    several = materialize(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                          .where("lo <> hi").select("key"), "open-keys", rows)
    return placed.join(several, "key")


def _stars(entries: DataFrame, degree: DataFrame | None, rows: int) -> DataFrame:
    """Pairs of each bucket's centre with its nodes of other components.  The
    centre is the node of most links; among equals a pseudo-random one."""
    if degree is None:
        weighed = entries.withColumn("deg", F.lit(0).cast("long"))
    else:
        weighed = entries.join(degree, "node", "left").withColumn("deg", F.coalesce("deg", F.lit(0)))
    centre = F.struct("deg", F.xxhash64("node", "key").alias("h"), "node", "comp")
    centres = materialize(weighed.groupBy("key").agg(F.max(centre).alias("c"))
                          .select("key", F.col("c.node").alias("hub"), F.col("c.comp").alias("hub_comp")), "hubs", rows)
    return (entries.join(centres, "key").where("comp <> hub_comp")
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())


def _cells(rows: DataFrame, group: str, block_col: str, fields: list[str], block: int) -> DataFrame:
    """Rows of each group (with its size ``block_col``) dealt into cells
    (group, i, j) so that any two rows meet in one, sorted by cell; side 0 is
    block i and side 1 block j. A cell with i = j has its rows once."""
    n = F.ceil(F.col(block_col) / block).cast("int")
    own = rows.withColumn("_n", n).withColumn("_b", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    dealt = own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select(
        group, F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"),
        (F.col("_b") > F.col("_o")).cast("int").alias("side"), *fields)
    return dealt.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", "side")


def _by_cell(batches: Iterator[pa.RecordBatch], compare) -> Iterator[pa.RecordBatch]:
    """Feed the rows of each cell (equal first three columns) to ``compare``,
    which returns two lists of nodes; a cell can span batches."""
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        a, b = compare(held)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:3] != r[:3]:
                yield out()
                held = []
            held.append(r)
    if held:
        yield out()


def _suspects(entries: DataFrame, sigs: DataFrame, p: Params, n: int) -> DataFrame:
    """A forest over all pairs across components within a bucket that pass the
    estimate: the nodes outside a bucket's largest component are compared with
    all its nodes, and each cell keeps only pairs that join two of its trees."""
    sizes = entries.groupBy("key", "comp").agg(F.count("*").alias("n"))
    most = materialize(sizes.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("top"),
                                                F.sum("n").alias("all"), F.max("n").alias("n_top")), "rest-buckets", n)
    rows = (entries.join(most, "key").join(sigs, "node")
            .select("key", "node", "comp", "sig", (F.col("comp") == F.col("top")).alias("inner"),
                    F.ceil((F.col("all") - F.col("n_top")) / p.block).cast("int").alias("o"),
                    F.ceil(F.col("all") / p.block).cast("int").alias("t")))
    h = F.xxhash64("node")
    left = (rows.where("not inner")
            .select("key", F.pmod(h, F.col("o")).cast("int").alias("i"),
                    F.explode(F.sequence(F.lit(0), F.col("t") - 1)).alias("j"), F.lit(0).alias("side"),
                    "node", "comp", "sig"))
    right = rows.select("key", F.explode(F.sequence(F.lit(0), F.col("o") - 1)).alias("i"),
                        F.pmod(h, F.col("t")).cast("int").alias("j"), F.lit(1).alias("side"),
                        "node", "comp", "sig")
    cells = (left.unionByName(right).repartition("key", "i", "j")
             .sortWithinPartitions("key", "i", "j", "side"))
    least, pad = p.least_equal, _pad(p)

    def compare(cell: list[tuple]) -> tuple[list[int], list[int]]:
        side = np.array([r[3] for r in cell])
        node, tree = np.unique(np.array([r[4] for r in cell], np.int64), return_inverse=True)
        at = tree.copy()                       # the distinct node of each row
        tree = np.arange(len(node))
        comp = np.array([r[5] for r in cell], np.int64)
        sig = sig_words([r[6] for r in cell])
        hi = np.flatnonzero(side == 1)
        a, b = [], []
        for x in np.flatnonzero(side == 0):
            eq = equal_values(sig[x], sig[hi], p.bits) - pad
            met = at[hi[(eq >= least) & (comp[hi] != comp[x])]]
            if len(met):
                trees, first = np.unique(tree[met], return_index=True)
                new = trees != tree[at[x]]
                if new.any():
                    a += [int(node[at[x]])] * int(new.sum())
                    b += node[met[first[new]]].tolist()
                    tree[np.isin(tree, trees)] = tree[at[x]]
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_cell(batches, compare)

    return cells.mapInArrow(run, "a long, b long").distinct()


def _rest(entries: DataFrame, sigs: DataFrame, sets: DataFrame, p: Params, n: int) -> DataFrame:
    """Confirmed links between the components that share a bucket.

    Nodes that pass the estimate with each other, directly or through others,
    form a cluster; inside it every pair across components that passes is
    confirmed on the full sets, block against block, and a cell gives only the
    links that join two of its components."""
    clusters = materialize(components(materialize(_suspects(entries, sigs, p, n), "nd-suspects"))
                           .withColumnRenamed("comp", "cluster"), "nd-clusters", n)
    size = materialize(clusters.groupBy("cluster").agg(F.count("*").alias("n")), "nd-cluster-sizes", n)
    comp = entries.select("node", "comp").distinct()
    rows = (clusters.join(size, "cluster").join(comp, "node").join(sigs, "node").join(sets, "node"))
    cells = _cells(rows, "cluster", "n", ["node", "comp", "sig", "items"], p.set_block)
    least, pad, percent = p.least_equal, _pad(p), p.percent

    def compare(cell: list[tuple]) -> tuple[list[int], list[int]]:
        side = np.array([r[3] for r in cell])
        comp = np.array([r[5] for r in cell], np.int64)
        sig = sig_words([r[6] for r in cell])
        items = [np.array(r[7], np.int64) for r in cell]
        size = np.array([len(x) for x in items])
        within = cell[0][1] == cell[0][2]
        a, b = [], []
        for x in range(len(cell)) if within else np.flatnonzero(side == 0):
            other = np.arange(x + 1, len(cell)) if within else np.flatnonzero(side == 1)
            other = other[(comp[other] != comp[x]) & (size[other] * 100 >= size[x] * percent)
                          & (size[x] * 100 >= size[other] * percent)]
            other = other[equal_values(sig[x], sig[other], p.bits) - pad >= least]
            for y in other:
                if comp[x] != comp[y]:
                    common = len(np.intersect1d(items[x], items[y], assume_unique=True))
                    if common * 100 >= (size[x] + size[y] - common) * percent:
                        a.append(cell[x][4])
                        b.append(cell[y][4])
                        comp[comp == comp[y]] = comp[x]
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_cell(batches, compare)

    return cells.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component, kept) of every row of ``docs``.

    ``component`` is the smallest id reachable over links, the row's own
    included.  A null, empty or blank text has an empty set and links with
    nothing; a row without an id links with nothing either and its component
    is null.  ``kept`` is whether the id is the component's own (null with
    null: true).  Rows of equal id and text get equal results.  An empty
    table gives no rows.  Eager: intermediate tables go to the shared folder.
    """
    signed = materialize(sign(docs, p, id_col, text_col), "nd-signed")
    nodes = materialize(
        signed.where("node is not null and id is not null").groupBy("node")
        .agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "nd-nodes")
    sigs = nodes.select("node", "sig")
    entries = nodes.select("node", F.explode("bands").alias("key"))
    entries = materialize(_open_buckets(entries, None).select("key", "node"), "nd-entries")
    n = entries.count()
    wanted = entries.select("node").distinct().join(nodes.select("node", "id"), "node")
    sets = materialize(node_sets(docs, materialize(wanted, "nd-wanted"), p, id_col, text_col), "nd-sets")

    links = comps = None
    for step in ("star", "hub", "rest"):
        still = materialize(_open_buckets(entries, comps, n), "nd-open")
        if step == "rest":
            found = _rest(still, sigs, sets, p, n)
        else:
            degree = None
            if links is not None:
                degree = materialize(links.select(F.explode(F.array("a", "b")).alias("node"))
                                     .groupBy("node").agg(F.count("*").alias("deg")), "nd-degree", n)
            pairs = materialize(estimated(_stars(still, degree, n), sigs, p), "nd-pairs")
            found = confirmed(pairs, sets, p, n)
        found = materialize(found, "nd-links")
        links = found if links is None else links.unionByName(found)
        comps = materialize(components(links), "nd-comps", 2 * n)

    placed = nodes.select("node", "id").join(comps, "node", "left").select(
        "node", "id", F.coalesce("comp", "node").alias("comp"))
    least = materialize(placed.groupBy("comp").agg(F.min("id").alias("component")), "nd-least")
    named = materialize(placed.join(least, "comp").select("node", "component"), "nd-named")
    return (signed.select("id", "n_shingles", "node").join(named, "node", "left")
            .select("id", "n_shingles",
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component"))))


def one_of_each(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` without the near-duplicates: of each group the document with
    the smallest id stays.  Rows without an id stay; of rows repeated with
    equal id and text one stays."""
    ids = (near_duplicates(docs, p, id_col, text_col).where("id is not null")
           .groupBy(F.col("id").alias("_id")).agg(F.max("kept").alias("_kept"), F.count("*").alias("_rows")))
    # what goes or repeats is far less than what stays
    marked = materialize(ids.where("not _kept or _rows > 1"), "nd-marked")
    gone = marked.where("not _kept").select("_id")
    if gone.count() <= p.broadcast_nodes:      # 8 bytes each; beyond the bound a shuffle join
        gone = F.broadcast(gone)
    out = docs.join(gone, docs[id_col].cast("long") == gone["_id"], "left_anti")
    if marked.where("_kept").limit(1).count():
        named = out.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col])
        out = named.unionByName(out.where(F.col(id_col).isNull()))
    return out
