"""Joins that keep a hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.operators.broadcast import row_count_at_most

DEFAULT_SALTS = 16
# Keys that the frequent-items sketch may name, and the items it tracks: it
# names every key of more than about 1 / SKETCH_ITEMS of the rows it counts.
MAX_HOT_KEYS, SKETCH_ITEMS = 256, 16_384


def frequent_keys(df: DataFrame, key: str, least_share: float) -> list:
    """At most ``MAX_HOT_KEYS`` non-null keys that hold ``least_share`` of the
    rows or more, by a frequent-items sketch: a table of bounded size per task,
    merged on the way.  A key that it misses or names in vain changes a plan,
    never a result."""
    known = df.where(F.col(key).isNotNull())
    top = F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS}, {SKETCH_ITEMS})")
    items, n = known.agg(top, F.count(F.lit(1))).first()
    return [i["item"] for i in items or [] if i["count"] >= max(2, least_share * n)]


def skew_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
              least_share: float | None = None) -> DataFrame:
    """Join ``big`` to a table with one row per key where both are large.

    The hot keys of ``big`` (``frequent_keys``; a key of half a shuffle
    partition's rows or more, unless ``least_share`` is given) meet their few
    rows of ``small`` by a broadcast and are not shuffled; rows without a key
    meet nothing; all others join plainly.  Nothing is written and no row gets
    a random number, so a task that runs again sends the same rows.  ``big`` is
    scanned once for the sketch and once per part: it should be a stored table,
    or cheap to compute.  ``how`` is inner or left."""
    spark = big.sparkSession
    if least_share is None:
        least_share = 0.5 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = frequent_keys(big, big_key, least_share)
    on = F.col(big_key) == F.col(small_key)
    known = F.col(big_key).isNotNull()

    def among(c: str) -> Column:
        return F.col(c).isin(hot) if hot else F.lit(False)

    parts = [big.where(known & ~among(big_key)).join(small.where(~among(small_key)), on, how)]
    if hot:
        parts.append(big.where(among(big_key)).join(F.broadcast(small.where(among(small_key))), on, how))
    if how == "left":
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema]
        parts.append(big.where(~known).select("*", *nothing))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                how: str = "inner", salts: int = DEFAULT_SALTS) -> DataFrame:
    """Shuffle join of a stream that spreads a hot key: each ``big`` row gets
    one of ``salts`` sub-keys from a hash of the whole row, ``small`` is
    replicated once per sub-key, and both sides are shuffled on (key, salt).
    Rows of one key that are equal stay together; a micro-batch that is a table
    (``foreachBatch``) takes ``skew_join``."""
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[big[c] for c in big.columns]), F.lit(salts)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                       F.lit(salts - 1).cast("bigint"))))
    cond = (b[big_key] == s[small_key]) & (b["_salt"] == s["_salt"])
    return b.join(s, cond, how).drop(b["_salt"]).drop(s["_salt"])


def large_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
               salts: int = DEFAULT_SALTS) -> DataFrame:
    """``skew_join``, or on a stream ``salted_join``."""
    if big.isStreaming:
        return salted_join(big, small, big_key, small_key, how, salts)
    return skew_join(big, small, big_key, small_key, how)


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "left",
                max_broadcast_rows: int = 0, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Equi-join ``big`` to a lookup table ``small`` on the column ``key``
    (present in both): a broadcast join when ``small`` has at most
    ``max_broadcast_rows`` rows, else a ``large_join``."""
    if max_broadcast_rows > 0 and row_count_at_most(small, max_broadcast_rows):
        return big.join(F.broadcast(small), key, how)
    renamed = small.withColumnRenamed(key, "_lk")
    return large_join(big, renamed, key, "_lk", how, salts).drop("_lk")
