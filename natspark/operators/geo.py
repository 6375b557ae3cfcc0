"""Geo-IP resolution of target addresses, the geo filter, and app ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.functions.ipaddr import ip_to_long, ip_to_long_strict
from natspark.functions.split import item, jsplit
from natspark.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from natspark.operators.joins import lookup_join
from natspark.operators.rangejoin import (DEFAULT_BUCKET_BITS, bits_for, bucket_join, containing_ranges,
                                          disjoint_segments, shard_bounds, sharded_join, sweep_lookup)
from natspark.session import scratch_path

# Fixed values from the reference: the unresolved sentinel (capital K), the
# spelling its geo filter tests against (lower-case k), and the default
# application name.
UNRESOLVED = "UnKnown"
FILTER_SENTINEL = "Unknown"
OTHER_APP = "其他"

GEO_FIELDS = ("operator", "province", "city")
# Positions in the '|'-separated location text: continent, country,
# province, city, district, operator, region code, English name, short
# code, longitude, latitude.
LOCATION_INDEX = {"province": 2, "city": 3, "operator": 5}
MIN_LOCATION_FIELDS = 11


def parse_location(ranges: DataFrame, local: str = "local") -> DataFrame:
    """Operator, province and city from the location text, once per range.
    Fewer than 11 fields (trailing empties dropped) or a blank text leaves
    them null, i.e. unresolved."""
    parts = jsplit(F.col(local), r"\|")
    usable = (F.trim(F.col(local)) != F.lit("")) & (F.size(parts) >= MIN_LOCATION_FIELDS)
    return ranges.select("startip", "endip", *[
        F.when(usable, item(parts, LOCATION_INDEX[f])).alias(f) for f in GEO_FIELDS])


# Segment broadcasts that one plan may hold beside each other.
MAX_SHARDS = 64


def geo_segments(located: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Disjoint ``[seg_lo, seg_hi]`` segments of located ranges, each with the
    fields of the covering range of lowest ``endip`` (then of highest
    ``startip``, then by the fields)."""
    segs = disjoint_segments(located, "startip", "endip", n_ranges)
    covering = containing_ranges(segs, "_seg_lo", located, "startip", "endip")
    first = F.min_by(F.struct(*GEO_FIELDS), F.struct("endip", -F.col("startip"), *GEO_FIELDS))
    return covering.groupBy("_seg_lo", "_seg_hi").agg(first.alias("_g")).select(
        "_seg_lo", "_seg_hi", *[F.col(f"_g.{f}").alias(f) for f in GEO_FIELDS])


def _at_most_one(pts: DataFrame, n_ranges: int, segs: DataFrame, payload: list[str], bits: int,
                 max_broadcast_rows: int) -> DataFrame:
    """Left join of addresses ``_ip`` with disjoint segments.  The plan is
    chosen from the number of ranges alone: n ranges make at most 2n segments,
    listed under at most as many buckets again.

    Within the bound the segments are one broadcast.  Above it they are written
    once and cut into address shards within the bound, each a broadcast: the
    logs are not shuffled, in a batch or a stream.  Where that would take more
    than ``MAX_SHARDS``, or no broadcast is allowed, a batch resolves the
    distinct addresses by ``sweep_lookup`` and a stream joins on the bucket."""
    own = bits_for(2 * n_ranges)
    rows = 2 * (2 * n_ranges + 1)
    if rows <= max_broadcast_rows:
        return bucket_join(pts, "_ip", segs, "_seg_lo", "_seg_hi", own, "left", True)
    shards = -(-5 * rows // (4 * max_broadcast_rows)) if max_broadcast_rows > 0 else None
    if shards is not None and shards <= MAX_SHARDS:
        path = scratch_path(segs.sparkSession, "segments")
        segs.write.parquet(path)
        stored = segs.sparkSession.read.schema(segs.schema).parquet(path)
        bounds = shard_bounds(stored, "_seg_lo", shards)
        return sharded_join(pts, "_ip", stored, "_seg_lo", "_seg_hi", payload, own, bounds)
    if pts.isStreaming:      # no distinct and no unbounded window on a stream
        return bucket_join(pts, "_ip", segs, "_seg_lo", "_seg_hi", bits, "left", False)
    resolved = sweep_lookup(pts, "_ip", segs, "_seg_lo", "_seg_hi", payload, bits)
    return lookup_join(pts, resolved, "_ip", "left")


def resolve_geo(logs: DataFrame, ranges: DataFrame, ip_col: str = "targetIp",
                bits: int = DEFAULT_BUCKET_BITS,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``NAT_GEO``: logs plus operator, province and city of ``ip_col``,
    ``UnKnown`` when no range (inclusive ends) holds the address.

    Where ranges overlap, the one of lowest ``endip`` wins; overlaps are cut
    once on the range table (``geo_segments``), so every plan of
    ``_at_most_one`` gives one and the same row per log; the segments are
    broadcast, in shards where they exceed the row bound, and the logs are not
    shuffled."""
    located, n = parse_location(ranges), ranges.count()
    pts = logs.withColumn("_ip", ip_to_long_strict(F.col(ip_col)))
    joined = _at_most_one(pts, n, geo_segments(located, n), list(GEO_FIELDS), bits, max_broadcast_rows)
    return joined.select(*logs.columns,
                         *[F.coalesce(F.col(f), F.lit(UNRESOLVED)).alias(f)
                           for f in GEO_FIELDS])


def geo_filter(df: DataFrame, drop_unresolved: bool = False) -> DataFrame:
    """The reference's predicate, literally: at least one field differs from
    ``Unknown`` (lower-case k, so the ``UnKnown`` sentinel passes) and at
    least one is non-empty.  ``drop_unresolved=True`` tests the sentinel
    that is actually produced."""
    sentinel = UNRESOLVED if drop_unresolved else FILTER_SENTINEL
    c1 = None
    c2 = None
    for f in GEO_FIELDS:
        a = F.col(f) != F.lit(sentinel)
        b = F.col(f) != F.lit("")
        c1 = a if c1 is None else (c1 | a)
        c2 = b if c2 is None else (c2 | b)
    return df.where(c1 & c2)


def app_segments(apps: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Disjoint ``[seg_lo, seg_hi]`` segments of the application ranges,
    each with the winning app (largest ``ord`` among the half-open ranges
    covering it).  Computed on the range table alone: segments come from the
    2n boundaries, winners from an exact dyadic-block equi-join."""
    ranges = apps.select("start", (F.col("end") - 1).alias("_last"), "app", "ord")
    segs = disjoint_segments(ranges, "start", "_last", n_ranges)
    covering = containing_ranges(segs, "_seg_lo", ranges, "start", "_last")
    return covering.groupBy("_seg_lo", "_seg_hi").agg(F.max_by("app", "ord").alias("app"))


def app_name(df: DataFrame, apps: DataFrame, ip_col: str = "targetIp", out: str = "app",
             bits: int = DEFAULT_BUCKET_BITS,
             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Application of each address: half-open ``[start, end)`` ranges, the
    one with the largest ``ord`` wins where ranges overlap (the reference
    keeps the last match in list order), ``其他`` when none holds it.

    Overlaps are resolved once on the range table (``app_segments``), so
    each address matches at most one segment; see ``_at_most_one`` for the
    plans."""
    n = apps.count()
    segs = app_segments(apps, n).withColumnRenamed("app", "_app")
    pts = df.withColumn("_ip", ip_to_long(F.col(ip_col)))
    joined = _at_most_one(pts, n, segs, ["_app"], bits, max_broadcast_rows)
    return joined.select(*df.columns, F.coalesce(F.col("_app"), F.lit(OTHER_APP)).alias(out))
