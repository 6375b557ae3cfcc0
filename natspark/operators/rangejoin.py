"""Point-in-range lookups as equi-joins.

Catalyst plans a bare ``ip BETWEEN startip AND endip`` join as a nested-loop
join.  Here the address space is cut into fixed buckets (``ip >> bits``, a
/16 by default) and each range is listed under every bucket it touches, so
the join is an equi-join on the bucket with the interval test as residual.
For ranges that do not overlap, the bucketed table has at most
``ranges + 2**(32 - bits)`` rows, which is what the broadcast bound checks.

When the ranges are too many to broadcast, ``sweep_lookup`` resolves the
*distinct* points instead: points and range starts of one bucket are sorted
together and each point takes the last range start before it (a window
``last(..., ignorenulls)``).  Per bucket there are at most 2**bits distinct
points plus the ranges starting in it, so no window partition grows with the
data, and a hot address is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_BITS = 16


def bucketed_ranges(ranges: DataFrame, lo: str, hi_inclusive, bits: int = DEFAULT_BUCKET_BITS,
                    bucket: str = "_bucket") -> DataFrame:
    """``ranges`` with one row per bucket each range touches."""
    hi = F.col(hi_inclusive) if isinstance(hi_inclusive, str) else hi_inclusive
    first = F.shiftright(F.col(lo), bits)
    last = F.shiftright(hi, bits)
    return ranges.where(F.col(lo) <= hi).withColumn(bucket, F.explode(F.sequence(first, last)))


def bucket_join(points: DataFrame, point: str, ranges: DataFrame, lo: str, hi_inclusive: str,
                bits: int = DEFAULT_BUCKET_BITS, how: str = "left",
                broadcast_ranges: bool = True) -> DataFrame:
    """Equi-join on the bucket with ``lo <= point <= hi`` as residual."""
    b = bucketed_ranges(ranges, lo, hi_inclusive, bits, "_rb")
    if broadcast_ranges:
        b = F.broadcast(b)
    pts = points.withColumn("_pb", F.shiftright(F.col(point), bits))
    cond = ((pts["_pb"] == b["_rb"]) & (pts[point] >= b[lo]) & (pts[point] <= b[hi_inclusive]))
    return pts.join(b, cond, how).drop("_pb", "_rb")


def sweep_lookup(points: DataFrame, point: str, ranges: DataFrame, lo: str, hi: str,
                 payload: list[str], bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """Distinct ``point`` values with the payload of the range holding them
    (null payload when none).  Ranges must not overlap (a geo-IP table)."""
    pts = (points.select(F.col(point).alias("_pos")).where(F.col("_pos").isNotNull())
           .distinct()
           .select("_pos", F.lit(1).alias("_kind"),
                   F.lit(None).cast("struct<_lo:bigint,_hi:bigint,%s>" % ",".join(
                       f"`{p}`:string" for p in payload)).alias("_r")))
    rng = bucketed_ranges(ranges, lo, hi, bits, "_b").select(
        F.greatest(F.col(lo), F.shiftleft(F.col("_b"), bits)).alias("_pos"),
        F.lit(0).alias("_kind"),
        F.struct(F.col(lo).alias("_lo"), F.col(hi).alias("_hi"),
                 *[F.col(p).cast("string").alias(p) for p in payload]).alias("_r"))
    both = pts.unionByName(rng).withColumn("_b", F.shiftright("_pos", bits))
    w = (Window.partitionBy("_b").orderBy("_pos", "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = both.withColumn("_hit", F.last("_r", ignorenulls=True).over(w))
    found = swept.where(F.col("_kind") == 1).select(
        F.col("_pos").alias(point),
        F.when(F.col("_hit._hi") >= F.col("_pos"), F.col("_hit")).alias("_hit"))
    return found.select(point, *[F.col(f"_hit.{p}").alias(p) for p in payload])


MAX_LEVEL = 32


def dyadic_blocks(ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """Canonical decomposition of each inclusive ``[lo, hi]`` into maximal
    aligned power-of-two blocks ``(_level, _block)``: block ``j`` of level
    ``k`` covers ``[j * 2^k, (j + 1) * 2^k - 1]``.  At each level only the
    leftmost and rightmost inside blocks can be maximal, so a range yields
    at most 2 * 33 rows."""
    lv = ranges.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(MAX_LEVEL))))
    first = F.expr(f"shiftright({lo} + shiftleft(1L, _level) - 1, _level)")
    last = F.expr(f"shiftright({hi} + 1, _level) - 1")
    cand = lv.withColumn("_block", F.explode(F.array_distinct(F.array(first, last))))
    inside = F.expr(f"shiftleft(_block, _level) >= {lo} AND "
                    f"shiftleft(_block + 1, _level) - 1 <= {hi}")
    parent_inside = F.expr(f"_level < {MAX_LEVEL} AND "
                           f"shiftleft(shiftright(_block, 1), _level + 1) >= {lo} AND "
                           f"shiftleft(shiftright(_block, 1) + 1, _level + 1) - 1 <= {hi}")
    return cand.where(inside & ~parent_inside)


def containing_ranges(points: DataFrame, point: str, ranges: DataFrame, lo: str,
                      hi: str) -> DataFrame:
    """Every (point, range) pair with ``lo <= point <= hi``, as an equi-join
    of the point's 33 ancestor blocks with the ranges' dyadic blocks: each
    joined row is a true containment, no candidate is filtered away."""
    anc = (points.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(MAX_LEVEL))))
           .withColumn("_block", F.expr(f"shiftright({point}, _level)")))
    return anc.join(dyadic_blocks(ranges, lo, hi), ["_level", "_block"]).drop("_level", "_block")


def disjoint_segments(ranges: DataFrame, lo: str, hi: str, n_ranges: int | None = None,
                      single_window_rows: int = 500_000) -> DataFrame:
    """Cut the (possibly overlapping) inclusive ranges at every range start
    and every range end + 1: at most 2n ``_seg_lo`` / ``_seg_hi`` segments over
    which the set of covering ranges is constant (gaps are among them).

    The next boundary comes from one window over the 2n boundaries while
    ``n_ranges`` is known to be small; otherwise from a window per /16, and for
    the last boundary of each from the first one of the next /16 that has any
    (a row per /16, at most 65537)."""
    starts = ranges.where(F.col(lo) <= F.col(hi)).select(F.col(lo).alias("_p"))
    ends = ranges.where(F.col(lo) <= F.col(hi)).select((F.col(hi) + 1).alias("_p"))
    points = starts.unionByName(ends).distinct()
    if n_ranges is not None and 2 * n_ranges <= single_window_rows:
        follow = points.select("_p", F.lead("_p").over(Window.orderBy("_p")).alias("_n"))
    else:
        points = points.withColumn("_b", F.shiftright("_p", DEFAULT_BUCKET_BITS))
        inner = points.withColumn("_in", F.lead("_p").over(Window.partitionBy("_b").orderBy("_p")))
        firsts = points.groupBy("_b").agg(F.min("_p").alias("_f"))
        after = firsts.select("_b", F.lead("_f").over(Window.orderBy("_b")).alias("_out"))
        follow = inner.join(F.broadcast(after), "_b").select("_p", F.coalesce("_in", "_out").alias("_n"))
    return follow.where("_n IS NOT NULL").select(F.col("_p").alias("_seg_lo"), (F.col("_n") - 1).alias("_seg_hi"))


def bits_for(n_segments: int) -> int:
    """Address bits of a bucket: about as many buckets as segments, so that the
    bucketed table has at most twice the segments and a bucket lists few."""
    return max(8, min(24, 32 - max(0, (max(n_segments, 1) - 1).bit_length())))


def shard_bounds(segs: DataFrame, lo: str, shards: int) -> list[int]:
    """Addresses that cut the segments into ``shards`` parts of nearly equal
    numbers of rows."""
    at = segs.approxQuantile(lo, [i / shards for i in range(1, shards)], 0.1 / shards)
    return sorted({int(x) for x in at})


def sharded_join(points: DataFrame, point: str, segs: DataFrame, lo: str, hi: str, payload: list[str],
                 bits: int, bounds: list[int]) -> DataFrame:
    """Left join with disjoint segments, shard by shard: each address part of
    the segments is broadcast for itself and fills the payload of the points in
    it.  The points are never shuffled, so this runs on a stream too."""
    out = points
    edges = [None, *bounds, None]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        part = segs
        if a is not None:
            part = part.where(F.col(lo) >= a)
        if b is not None:
            part = part.where(F.col(lo) < b)
        part = part.select(F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.struct(*payload).alias(f"_s{k}"))
        out = bucket_join(out, point, part, "_lo", "_hi", bits, "left", True).drop("_lo", "_hi")
    hit = F.coalesce(*[F.col(f"_s{k}") for k in range(len(edges) - 1)])
    return out.select(*points.columns, *[hit[p].alias(p) for p in payload])
