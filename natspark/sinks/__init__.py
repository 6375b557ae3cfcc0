"""Sinks: counts, user log, keyed record/index upserts, documents, text.

Writes are idempotent per micro-batch: every batch lands in its own
``batch_id=<n>`` partition written with dynamic partition overwrite, so a
replayed batch replaces its earlier attempt instead of duplicating it.  The
keyed stores (records, index) are read back as "latest row per key" across
batches, the role a wide-column table's put plays in the reference.  ``Store``
merges their closed days into sorted files.
"""

from natspark.sinks.store import INDEX, RECORDS, USER_LOG, Layout, Store, bucket_digits
from natspark.sinks.writers import (DAY_MS, append_dim_docs, batch_partition_write, console, day_of, in_days, index_rows,
                                    latest_by_key, read_keyed_store, record_rows,
                                    upsert_index, upsert_records, user_log_lines,
                                    write_counts, write_counts_jdbc, write_text_overwrite,
                                    write_user_log)

__all__ = ["DAY_MS", "INDEX", "RECORDS", "USER_LOG", "Layout", "Store", "bucket_digits",
           "append_dim_docs", "batch_partition_write", "console", "day_of", "in_days", "latest_by_key",
           "read_keyed_store", "record_rows", "upsert_index", "upsert_records",
           "user_log_lines", "write_counts", "write_counts_jdbc", "write_text_overwrite",
           "write_user_log"]
