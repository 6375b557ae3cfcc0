"""Source-side parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None,
                       key: str | None = None) -> DataFrame:
    """Spread a source that arrives in fewer partitions than the cluster has
    cores (one unsplittable file, a topic with few partitions) before the
    CPU-heavy parse.  Large inputs already have many partitions and pass
    through untouched, so no shuffle is added at scale.

    ``key`` should be unique per row (an offset): hash partitioning on it is
    deterministic under task retries and cannot concentrate a repeated line
    in one partition.  Without a key a round-robin repartition is used."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
