"""Mixing sources to target weights, with built-in functions only.

Each row gets a hash-random key.  Within a source the keys are range-sorted:
equal-width key ranges (buckets) cut every source, hot ones included, into
small sort groups; the sums of earlier buckets plus a running sum inside the
bucket are the distributed prefix sums.  A source's target is spent on whole
epochs first; the rest of the budget is cut exactly, inside the one document
it ends in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import WORD, materialize

DEFAULT_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_BITS = 10


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = DEFAULT_WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of the sources: (skey, source_size) -> + target, budget.

    Sources in code point order take ``weights`` in turn and share the total
    size by them.  No target exceeds ``max_epochs`` times its source's size:
    with r = limit / weight, the sources of smallest r are the limited ones,
    and the level that the others share is the first that reaches no further
    limit.  One row per source enters the two ordered windows.
    """
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_n") % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("_ratio", "skey").rowsBetween(Window.unboundedPreceding,
                                                            Window.currentRow)
    ranked = (sizes
              .withColumn("_n", F.row_number().over(Window.orderBy("skey")) - 1)
              .withColumn("_w", w)
              .withColumn("_limit", F.col("source_size") * max_epochs)
              .withColumn("_ratio", F.col("_limit") / F.col("_w"))
              .withColumn("_limits", F.sum("_limit").over(by_ratio) - F.col("_limit"))
              .withColumn("_weights", F.sum("_w").over(by_ratio) - F.col("_w"))
              .withColumn("_total", F.sum("source_size").over(everything))
              .withColumn("_all_w", F.sum("_w").over(everything)))
    level = (F.col("_total") - F.col("_limits")) / (F.col("_all_w") - F.col("_weights"))
    free = (ranked.withColumn("_level", level)
            .withColumn("_share", F.min(F.when(F.col("_level") <= F.col("_ratio"),
                                               F.struct("_ratio", "skey", "_level")))
                        .over(everything)["_level"]))
    target = F.least(F.col("_limit").cast("double"), F.col("_share") * F.col("_w"))
    return free.select("skey", "source_size",
                       F.coalesce(target, F.lit(0.0)).alias("target"),
                       F.floor(F.coalesce(target, F.lit(0.0)) + F.lit(1e-6)).alias("budget"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: Sequence[float] = DEFAULT_WEIGHTS,
                max_epochs: int = MAX_EPOCHS, seed: int = 17,
                bucket_bits: int = BUCKET_BITS, carry: Sequence[str] | None = None) -> DataFrame:
    """How many words of each document the mix takes.

    Returns the columns ``carry`` of ``docs`` (all, by default; as struct
    ``doc``, so no name can clash; only these cross the shuffle) with ``size``, ``source_size``, ``target``, ``taken``, ``epochs`` (whole
    repeats) and ``cut`` (words of one further, partial repeat).

    The order key is the md5 of seed and id, so reruns agree; rows of equal
    key (repeated ids, null ids) are ordered by size and text hash, and equal rows
    are interchangeable.  A null text has size 0 and is never taken; a null
    source is a source of its own, after all others.  An empty table gives no
    rows.  ``2 ** bucket_bits`` sort groups per source bound a task's share.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    # "s..." sorts before "t", so a null source comes last in code point order.
    skey = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("t"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("doc"),
                       skey.alias("skey"), key.alias("key"), word_count(F.col(text_col)).alias("size"),
                       F.xxhash64(text_col).alias("tie"))
    bucket = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(2 ** (32 - bucket_bits))
              ).cast("int")
    rows = rows.withColumn("bucket", bucket)

    # Read three times below: written once, so the texts are counted once here
    # and once where the documents are placed.
    sums = materialize(rows.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size")),
                       "mix-sizes")
    targets = source_targets(sums.groupBy("skey").agg(F.sum("bucket_size").alias("source_size")),
                             weights, max_epochs)
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (sums.join(targets, "skey")
              .withColumn("before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
              .select("skey", "bucket", "before", "source_size", "target", "budget"))

    inside = (Window.partitionBy("skey", "bucket")
              .orderBy("key", "size", "tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("_run", F.sum("size").over(inside) - F.col("size"))
              .join(starts, ["skey", "bucket"]))
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    left = rest - F.col("before") - F.col("_run")
    return (placed.withColumn("epochs", whole.cast("long"))
            .withColumn("_part", F.least(F.greatest(left, F.lit(0)), F.col("size")))
            .withColumn("epochs", F.col("epochs") + F.when((F.col("_part") == F.col("size")) & (F.col("size") > 0),
                                                           1).otherwise(0))
            .withColumn("cut", F.when(F.col("_part") == F.col("size"), 0).otherwise(F.col("_part")).cast("long"))
            .withColumn("taken", F.col("epochs") * F.col("size") + F.col("cut"))
            .select("doc", "size", "source_size", "target", "taken", "epochs", "cut"))


def mixed_rows(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars",
               **options) -> DataFrame:
    """The mixture itself, with the columns of ``docs``: a document taken twice
    comes twice; the copy in which a source's budget ends keeps only the words
    that the budget still pays for.  Documents not taken go."""
    plan = mix_sources(docs, text_col=text_col, **options)
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("epochs").cast("int")),
                      F.when(F.col("cut") > 0, F.array("cut")).otherwise(F.array().cast("array<bigint>")))
    rows = plan.select("doc", F.explode(copies).alias("_words"))
    return _cut_rows(rows, docs.columns, text_col, n_chars_col)


def _cut_rows(rows: DataFrame, columns: list[str], text_col: str,
              n_chars_col: str | None) -> DataFrame:
    text = F.col("doc")[text_col]
    # The end of word number w is found by position, so no word is rewritten.
    words = F.regexp_extract_all(text, F.lit(rf"(\s*{WORD})"), F.lit(1))
    head = F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), "")
    new_text = F.when(F.col("_words") < 0, text).otherwise(head)
    out = []
    for c in columns:
        col = F.col("doc")[c]
        if c == text_col:
            col = new_text
        elif c == n_chars_col:
            col = F.when(F.col("_words") < 0, col).otherwise(F.length(new_text).cast("long"))
        out.append(col.alias(c))
    return rows.select(*out)
