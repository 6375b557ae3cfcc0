"""Broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Default bound on rows shipped to every executor: at the 60-100 bytes per
# row of the lookup tables here (an address, a login or three short
# location fields, row overhead) that is at most about 200 MB once hashed.  Above it the join is a shuffle join, which AQE may
# still turn into a broadcast from runtime sizes and whose skewed
# partitions AQE splits.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows: one count per task,
    summed.  Meant for lookup tables, never for a plan that holds the logs."""
    return df.count() <= max_rows
