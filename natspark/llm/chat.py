"""Chat formatting: the same dialogue from each participant's place.

For every participant the dialogue is rendered with that speaker as the
assistant and all others as named users; the mask marks what the assistant
says.  Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import materialize

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    """A text can't open or close a turn: "<|" gets a space inside."""
    return F.regexp_replace(text, r"<\|", "< |")


def _with_pieces(rows: DataFrame, part_turns: int) -> DataFrame:
    """Add ``piece``: 0, or in a part of more than ``part_turns`` rows the
    row's number in it divided by ``part_turns``.

    Rows are numbered without a task that holds a part: sorted into ranges
    (written, so that they stay), numbered inside each range's share of the
    part, and moved on by the counts of the ranges before.
    """
    full = (rows.groupBy("conv", "part").agg(F.count("*").alias("n")).where(F.col("n") > part_turns)
            .limit(1).count())
    if not full:
        return rows.withColumn("piece", F.lit(0).cast("long"))
    written = materialize(rows.withColumn("_id", F.monotonically_increasing_id()), "chat-rows")
    order = [F.col("turn").isNull(), F.col("turn"), F.col("speaker"), F.col("text"), F.col("_id")]
    ranged = materialize(written.repartitionByRange(F.col("conv"), F.col("part"), *order)
                         .withColumn("_range", F.spark_partition_id()), "chat-ranges")
    key = ["conv", "part", "_range"]
    before = Window.partitionBy("conv", "part").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv", "part")
    counts = (ranged.groupBy(*key).agg(F.count("*").alias("_n"))
              .select(*key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                      F.sum("_n").over(whole).alias("_rows")))
    c = counts.select(*[F.col(k).alias(f"_{k}") for k in key], "_before", "_rows")
    numbered = ranged.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)
    same = None
    for k in key:
        on = numbered[k].eqNullSafe(c[f"_{k}"])
        same = on if same is None else same & on
    piece = F.when(F.col("_rows") > part_turns, F.floor((F.col("_before") + F.col("_k")) / part_turns)).otherwise(0)
    return numbered.join(c, same).select("conv", "part", "turn", "speaker", "text", piece.cast("long").alias("piece"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", context: Sequence[str] = ("system",), part_turns: int = 1024) -> DataFrame:
    """(conv, speaker, part, piece, n_turns, n_own, rendered, mask): a row for
    each conversation, participant, part and piece.

    A turn is rendered as ``<|im_start|>who\\ntext<|im_end|>\\n`` where who is
    "assistant" for the speaker, "user name=..." for the others, and the name
    itself for the roles in ``context``, which are no participants.  ``mask``
    lists (start, end) in characters of ``rendered``, end exclusive: the
    speaker's texts with their closing marks.

    Turns are ordered by number (null last), then by speaker and text; a
    repeated turn is rendered again.  A null text is empty; a null speaker is
    the participant "unknown".  Rows without a conversation form one, of key
    null.  A conversation without participants gives no rows, and so does an
    empty table.

    A part holds ``part_turns`` consecutive turn numbers (turns without a
    number are a part of their own, the last), so a conversation of any length
    is rendered in pieces that follow each other.  A participant who doesn't
    speak in a part still has it.  A part of more than ``part_turns`` rows
    (repeated turns, turns or conversations without a number) is cut into
    pieces of at most so many, in order; other parts are piece 0.
    """
    part = F.coalesce(F.floor(F.col(turn_col) / part_turns).cast("long"), F.lit((1 << 62)))
    rows = turns.select(F.col(conv_col).alias("conv"), part.alias("part"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(speaker_col), F.lit("unknown")).alias("speaker"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = _with_pieces(rows, part_turns)
    parts = rows.groupBy("conv", "part", "piece").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").isNull().alias("last"), "turn", "speaker", "text"))).alias("turns"))
    people = (rows.where(~F.col("speaker").isin(list(context)))
              .select("conv", "speaker").distinct())
    each = parts.join(people, parts["conv"].eqNullSafe(people["conv"])).drop(people["conv"])

    def piece(t: Column) -> Column:
        own = t["speaker"] == F.col("speaker")
        who = (F.when(own, F.lit("assistant")).when(t["speaker"].isin(list(context)), t["speaker"])
               .otherwise(F.concat(F.lit("user name="), _escaped(t["speaker"]))))
        head = F.concat(F.lit(OPEN), who, F.lit("\n"))
        body = F.concat(_escaped(t["text"]), F.lit(CLOSE))
        return F.struct(own.alias("own"), head.alias("head"), body.alias("body"))

    made = each.withColumn("pieces", F.transform("turns", piece))
    long0 = F.lit(0).cast("long")
    # One pass adds up the lengths; a speaker's span is noted where it begins.
    start = F.struct(long0.alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct((end + 1).cast("long").alias("at"),
                        F.when(p["own"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return made.select(
        "conv", "speaker", "part", "piece", F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.aggregate("pieces", start, step, lambda acc: acc["spans"]).alias("mask"))
