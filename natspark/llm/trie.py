"""The prefix trie of conversations, shard by shard under a splitter skeleton.

A conversation is a path of turns; all that begin alike share a node per turn.
Paths (16 bytes a turn) are cut into ranges by sampled splitter paths.  Sorted,
the members of a node lie side by side, so a node met in two ranges is a prefix
of the splitter between them: the trie of the splitters (the skeleton, whose
size the number of shards bounds) is sent to every task.  A shard walks its
sorted paths and finishes every node outside the skeleton; of a skeleton node
it gives a partial count, and those are added up by a grouped reduction.

A path of more than ``part`` turns is cut into parts: part j is a row of its own
under a hash of all turns before it, so no row and no skeleton entry grows with
a conversation.  What later parts hold of a subtree is known from an earlier
walk of those parts alone: every node counts for its smallest member, and a
member's row carries the sums of its nodes in later parts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.llm.common import materialize

KEY = 16                    # bytes of a turn in a path

WALK_SCHEMA = ("kind string, part int, anchor binary, prefix binary, conv long, depth long, n long, bytes long, "
               "kids long, leaves long, saved long, more boolean, next_anchor binary, ends string, "
               "parent_conv long, parent_prefix binary, shard int, seq long")
_TYPES = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
_FIELDS = [(f.split()[0], _TYPES[f.split()[1]]) for f in WALK_SCHEMA.split(", ")]


# ------------------------------------------------------------- numbering turns

def number_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, pos, key, bytes): every turn's place in its conversation from 0,
    16 bytes that stand for its role and text, and the UTF-8 bytes of its text.

    Turns are ordered by number (null first), then by role and text; a repeated
    turn counts again.  Null roles and texts are empty.  Rows without a
    conversation are left out: they name none.

    No task holds a conversation: turns are sorted into ranges, numbered inside
    their range, and moved on by what ranges before hold of the conversation.
    Only a range's first conversation can have begun before it, so there are no
    more such shifts than ranges, and they can be broadcast.
    """
    src = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    key = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    ranged = (src.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv", key.alias("key"), F.octet_length("text").cast("long").alias("bytes"),
                      F.spark_partition_id().alias("range")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pos = None, 0
        for b in batches:
            at = []
            for c in b.column(0).to_pylist():
                pos = pos + 1 if c == last else 0
                last = c
                at.append(pos)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())],
                                             ["conv", "key", "bytes", "range", "pos"])

    local = materialize(ranged.mapInArrow(run, "conv long, key binary, bytes long, range int, pos long"), "trie-turns")
    counts = local.groupBy("conv", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shift = (counts.select("conv", "range", F.sum("n").over(before).alias("shift")).where("shift is not null"))
    moved = local.join(F.broadcast(shift), ["conv", "range"], "left")
    return moved.select("conv", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "key", "bytes")


def with_borrowed_heads(turns: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """(conv, depth, key, bytes, size) of rebuilt conversations: the first
    ``head`` (at most ``most``) turns of conversation ``base`` (all if it has
    fewer, none if it isn't there), then the own turns after the first ``head``.

    ``base`` and ``head`` are columns over ``conv``; ``turns`` is a stored table
    of ``number_turns``.  ``depth`` counts from 1; every conversation has one
    more row of depth 0, without a key, and ``size`` is its number of turns.
    """
    firsts = turns.where(F.col("pos") < most).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "bytes"))).alias("turns"))
    sizes = turns.groupBy("conv").agg(F.count("*").alias("own"))
    lent = firsts.select(F.col("conv").alias("base"), F.col("turns").alias("lent"))
    none = F.array().cast("array<struct<pos:bigint,key:binary,bytes:bigint>>")
    convs = (sizes.withColumn("base", base).withColumn("head", head.cast("int")).join(lent, "base", "left")
             .select("conv", "head", "own", F.coalesce(F.slice("lent", F.lit(1), F.col("head")), none).alias("lent")))
    convs = convs.select("conv", "head", "lent", F.size("lent").alias("got"),
                         (F.size("lent") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).cast("long").alias("size"))
    convs = materialize(convs, "trie-convs")
    own = (turns.join(convs.drop("lent"), "conv").where(F.col("pos") >= F.col("head"))
           .select("conv", (F.col("pos") - F.col("head") + F.col("got") + 1).alias("depth"), "key", "bytes", "size"))
    borrowed = convs.select("conv", "size", F.posexplode("lent").alias("at", "t")).select(
        "conv", (F.col("at") + 1).cast("long").alias("depth"), "t.key", "t.bytes", "size")
    roots = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("key"),
                         F.lit(0).cast("long").alias("bytes"), "size")
    return own.unionByName(borrowed).unionByName(roots)


# ------------------------------------------------------------------- the rows

def path_rows(turns: DataFrame, part: int) -> DataFrame:
    """A row per conversation and part: path, bytes of its turns, whether it
    goes on, and hashes of all turns up to its begin and its end."""
    rows = (turns.withColumn("part", F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / part).cast("int"))
            .groupBy("conv", "part").agg(
                F.sort_array(F.collect_list(F.struct("depth", "key", "bytes"))).alias("t"), F.max("size").alias("size")))
    t = F.filter("t", lambda x: x["depth"] > 0)
    rows = rows.select(
        "conv", "part", F.unhex(F.array_join(F.transform(t, lambda x: F.hex(x["key"])), "")).alias("path"),
        F.transform(t, lambda x: x["bytes"]).alias("sizes"),
        (F.col("size") > (F.col("part") + 1) * part).alias("more"), (F.col("size") > part).alias("long"))
    rows = materialize(rows, "trie-paths")
    empty = F.lit(b"")
    short = rows.where("not long").select("conv", "part", empty.alias("anchor"), empty.alias("next_anchor"),
                                          "path", "sizes", "more")
    # of conversations in several parts: a hash of the parts so far, from two running sums
    order = Window.partitionBy("conv").orderBy("part")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    a, b = (F.xxhash64("path", "part", F.lit(k)).cast("decimal(20,0)") for k in (1, 2))
    mark = lambda w: F.unhex(F.md5(F.concat_ws("|", F.sum("a").over(w), F.sum("b").over(w))))
    long = (rows.where("long").withColumn("a", a).withColumn("b", b)
            .select("conv", "part", F.when(F.col("part") == 0, empty).otherwise(mark(before)).alias("anchor"),
                    mark(upto).alias("next_anchor"), "path", "sizes", "more"))
    return materialize(short.unionByName(long), "trie-rows")


# ------------------------------------------------------------------ the shards

def splitters(rows: DataFrame, shards: int, oversample: int = 8) -> list[tuple]:
    """At most ``shards`` - 1 keys (part, anchor, path, conv) that cut the rows
    into nearly equal ranges, from a sample of ``shards * oversample`` rows.
    The conversation is in the key, so copies of one path are split too."""
    if shards < 2:
        return []
    at = F.xxhash64("conv", "part")
    sample = rows.select("part", "anchor", "path", "conv", at.alias("h")).orderBy("h").limit(shards * oversample)
    keys = sorted((r.part, bytes(r.anchor), bytes(r.path), r.conv) for r in sample.toLocalIterator())
    step = max(1, len(keys) // shards)
    return keys[step::step][:shards - 1]


def skeleton(cuts: list[tuple]) -> set[tuple]:
    """(part, anchor, prefix) of every prefix of a splitter path."""
    return {(p, a, path[:i]) for p, a, path, _ in cuts for i in range(0, len(path) + 1, KEY)}


@dataclass
class _Node:
    """A node on the walk's current path."""
    prefix: bytes
    size: int
    n: int = 0
    low: int | None = None
    kids: int = 0
    leaves: int = 0
    saved: int = 0
    more: bool = False
    next_anchor: bytes | None = None
    ends: object = None
    finished: list = field(default_factory=list)    # finished children: they wait for this node's smallest member


class _Walk:
    """Walks sorted paths and makes the records of ``WALK_SCHEMA``."""

    def __init__(self, frame: set[tuple], part_turns: int, chunk_ids: int = 4096):
        self.frame, self.part_turns, self.chunk_ids = frame, part_turns, chunk_ids
        self.made: list[tuple] = []
        self.stack: list[_Node] = []
        self.group = None
        self.path = b""
        self.seq = 0

    def row(self, shard: int, part: int, anchor: bytes, path: bytes, conv: int, sizes: list[int], more: bool,
            next_anchor: bytes, kids: int, leaves: int, saved: int) -> None:
        if self.group != (shard, part, anchor):
            self.close()
            self.group = (shard, part, anchor)
            self.stack = [_Node(b"", 0)]
            self.path = b""
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same:same + KEY] == self.path[same:same + KEY]:
            same += KEY
        while len(self.stack) > same // KEY + 1:
            self._leave()
        for i in range(same, len(path), KEY):
            self.stack.append(_Node(path[:i + KEY], sizes[i // KEY]))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.low = conv if node.low is None else min(node.low, conv)
        if more:
            node.more = True
            node.next_anchor = next_anchor
            node.kids += kids
            node.leaves += leaves
            node.saved += saved
        else:
            self._end(node, conv)

    def _end(self, node: _Node, conv: int) -> None:
        """A conversation ends here; ids come ascending."""
        shard, part, anchor = self.group
        if (part, anchor, node.prefix) in self.frame:
            if node.ends is None:
                node.ends = []
            node.ends.append(str(conv))
            if len(node.ends) >= self.chunk_ids:
                self._chunk(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv).encode())
        else:
            node.ends.update(b",%d" % conv)

    def _chunk(self, node: _Node) -> None:
        shard, part, anchor = self.group
        self.seq += 1
        self.made.append(("ends", part, anchor, node.prefix, *[None] * 9, ",".join(node.ends), None, None, shard, self.seq))
        node.ends = []

    def _leave(self) -> None:
        node = self.stack.pop()
        shard, part, anchor = self.group
        depth = part * self.part_turns + len(node.prefix) // KEY
        above = self.stack[-1] if self.stack else None
        virtual = part > 0 and not node.prefix          # stands for the last node of the part before
        partial = (part, anchor, node.prefix) in self.frame
        if partial and node.ends:
            self._chunk(node)
        if partial or virtual:
            for rec in node.finished:
                self.made.append((*rec, None, node.prefix, shard, None))
        else:
            if not node.kids and not node.more:
                node.leaves = 1
            node.saved += (node.n - 1) * node.size
            for rec in node.finished:
                self.made.append((*rec, node.low, None, shard, None))
        if virtual:
            return
        ends = None if partial else (node.ends or hashlib.sha256()).hexdigest()
        rec = ("part" if partial else "node", part, anchor, node.prefix if partial else None, node.low, depth, node.n,
               node.size, node.kids, node.leaves, node.saved, node.more, node.next_anchor, ends)
        if partial or above is None:
            self.made.append((*rec, None, None, shard, None))
        else:
            above.finished.append(rec)
        if above is not None:
            above.n += node.n
            above.low = node.low if above.low is None else min(above.low, node.low)
            if not partial:
                above.kids += 1
                above.leaves += node.leaves
                above.saved += node.saved

    def close(self) -> None:
        while self.stack:
            self._leave()

    def take(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.made) >= least and self.made:
            cols = [pa.array(c, t) for c, (_, t) in zip(zip(*self.made), _FIELDS)]
            self.made = []
            yield pa.RecordBatch.from_arrays(cols, [n for n, _ in _FIELDS])


def walk(rows: DataFrame, shards: int, part: int) -> tuple[DataFrame, int]:
    """The records of all shards, written; and the size of the skeleton."""
    cuts = splitters(rows, shards)
    frame = skeleton(cuts)
    order = ["part", "anchor", "path", "conv"]
    cols = [*order, "sizes", "more", "next_anchor", "kids", "leaves", "saved"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(*(b.column(i).to_pylist() for i in range(4)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect_right(cuts, k) for k in keys], pa.int32()), *b.columns], ["shard", *cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Walk(frame, part)
        for b in batches:
            for s, p, a, path, conv, *rest in zip(*(c.to_pylist() for c in b.columns)):
                w.row(s, p, a, path, conv, *rest)
                yield from w.take(20_000)
        w.close()
        yield from w.take(0)

    src = rows.select(*cols)
    kinds = {c: src.schema[c].dataType.simpleString() for c in cols}
    dealt = src.mapInArrow(assign, "shard int, " + ", ".join(f"{c} {kinds[c]}" for c in cols))
    dealt = (dealt.repartitionByRange(len(cuts) + 1, "shard") if cuts else dealt.coalesce(1))
    made = dealt.sortWithinPartitions("shard", *order).mapInArrow(run, WALK_SCHEMA)
    return materialize(made, "trie-walk"), len(frame)


def _hashed_ends(chunks: DataFrame) -> DataFrame:
    """(part, anchor, prefix, ends): SHA-256 of a skeleton node's chunks, in
    order, one after the other.  The hash of one node is a sequence by nature;
    chunks stream through and are never held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for b in batches:
            done = []
            for *k, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != key:
                    if key is not None:
                        done.append((*key, h.hexdigest()))
                    key, h = k, hashlib.sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            if done:
                yield out(done)
        if key is not None:
            yield out([(*key, h.hexdigest())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.string()))], ["part", "anchor", "prefix", "ends"])

    order = ["part", "anchor", "prefix", "shard", "seq"]
    return (chunks.select("part", "anchor", "prefix", "ends", "shard", "seq")
            .repartition("part", "anchor", "prefix").sortWithinPartitions(*order)
            .select("part", "anchor", "prefix", "ends")
            .mapInArrow(run, "part int, anchor binary, prefix binary, ends string"))


def _reduced(made: DataFrame, size: int) -> DataFrame:
    """The skeleton nodes: partial counts added up, then subtree sums from
    every node to each of its prefixes."""
    key = ["part", "anchor", "prefix"]
    ends = _hashed_ends(made.where("kind = 'ends'"))
    none = hashlib.sha256().hexdigest()
    nodes = (made.where("kind = 'part'").groupBy(*key).agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.sum("n").alias("n"), F.max("bytes").alias("bytes"),
        F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max("more").alias("more"), F.max("next_anchor").alias("next_anchor"))
        .join(ends, key, "left").withColumn("ends", F.coalesce("ends", F.lit(none))))
    nodes = materialize(nodes, "trie-skeleton", rows=size)
    turns = (F.length("prefix") / KEY).cast("int")
    up = F.expr(f"substring(prefix, 1, length(prefix) - {KEY})")
    own = nodes.where(F.length("prefix") > 0).groupBy("part", "anchor", up.alias("prefix")).agg(
        F.count("*").alias("inner"))
    nodes = (nodes.join(own, key, "left").withColumn("kids", F.col("kids") + F.coalesce("inner", F.lit(0)))
             .drop("inner"))
    nodes = (nodes.withColumn("leaves", F.when((F.col("kids") == 0) & ~F.col("more"), F.lit(1).cast("long"))
                              .otherwise(F.col("leaves")))
             .withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("bytes")))
    least = F.when(F.col("part") > 0, F.lit(1)).otherwise(F.lit(0))
    sums = (nodes.select("part", "anchor", "prefix", "leaves", "saved", F.explode(F.sequence(least, turns)).alias("i"))
            .groupBy("part", "anchor", F.expr(f"substring(prefix, 1, i * {KEY})").alias("prefix"))
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    out = nodes.drop("leaves", "saved").join(sums, key).withColumn("parent_prefix", F.when(turns > 0, up))
    return materialize(out, "trie-nodes", rows=size)


def _nodes(rows: DataFrame, shards: int, part: int, broadcast_nodes: int = 200_000) -> DataFrame:
    """(conv, depth, part, parent_conv, n, bytes, kids, leaves, saved, more,
    ends) of every node of the given rows."""
    made, size = walk(rows, shards, part)
    plain = ["conv", "depth", "part", "anchor", "parent_conv", "parent_prefix", "n", "bytes", "kids", "leaves", "saved",
             "more", "next_anchor", "ends"]
    known = made.where("kind = 'node'").select(*plain)
    if size:
        frame = _reduced(made, size)
        known = known.unionByName(frame.withColumn("parent_conv", F.lit(None).cast("long")).select(*plain))
        above = frame.select("part", "anchor", F.col("prefix").alias("parent_prefix"), F.col("conv").alias("up"))
        above = F.broadcast(above) if size <= broadcast_nodes else above
        known = (known.join(above, ["part", "anchor", "parent_prefix"], "left")
                 .withColumn("parent_conv", F.coalesce("parent_conv", "up")).drop("up"))
    # the first turns of a part hang below the last node of the part before
    last = known.where("next_anchor is not null").select((F.col("part") + 1).alias("part"),
                                                         F.col("next_anchor").alias("anchor"), F.col("conv").alias("up"))
    first = (F.col("part") > 0) & (F.col("depth") == F.col("part") * part + 1)
    joined = known.where(first).join(last, ["part", "anchor"], "left").withColumn(
        "parent_conv", F.coalesce("up", "parent_conv")).drop("up")
    return known.where(~first).unionByName(joined)


def prefix_trie(turns: DataFrame, shards: int | None = None, part: int = 256) -> DataFrame:
    """(conv, depth, parent_conv, n, kids, leaves, saved, ends): a row per
    distinct prefix of the conversations, the empty one included.

    ``turns`` has (conv, depth, key, bytes, size) rows as ``with_borrowed_heads``
    gives them, with a row of depth 0 for every conversation.  ``conv`` is the
    smallest member (the conversations that begin so), ``n`` their number,
    ``parent_conv`` the smallest member of the prefix one turn shorter (null
    for the root), ``kids`` the distinct next turns, ``leaves`` the nodes
    without any in the subtree (itself included), ``saved`` the sum over the
    subtree of (n - 1) times the bytes of the node's turn, and ``ends`` the
    SHA-256 of the decimal ids, ascending and comma-joined, of the members that
    end here.  No conversation gives no row.

    ``shards`` (the session's shuffle partitions if not given, 2048 at most)
    and ``part`` bound the skeleton: fewer than shards * (part + 1) nodes.  Any
    number of equal conversations is split between shards, since the id is in
    the sort key.
    """
    spark = turns.sparkSession
    shards = min(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), 2048)
    rows = path_rows(turns, part)
    zero = F.lit(0).cast("long")
    deep = rows.where("part > 0")
    if not deep.isEmpty():
        none = [zero.alias(c) for c in ("kids", "leaves", "saved")]
        nodes = materialize(_nodes(deep.select("*", *none), shards, part), "trie-deep")
        leaf = (F.col("kids") == 0) & ~F.col("more")
        each = nodes.groupBy("conv", "part").agg(
            F.max((F.col("depth") == F.col("part") * part + 1).cast("long")).alias("k"),
            F.sum(leaf.cast("long")).alias("l"), F.sum((F.col("n") - 1) * F.col("bytes")).alias("s"))
        # a row takes what its conversation stands for in later parts
        later = Window.partitionBy("conv").orderBy("part").rowsBetween(0, Window.unboundedFollowing)
        sums = (deep.select("conv", "part").join(each, ["conv", "part"], "left").fillna(0, ["k", "l", "s"])
                .select("conv", (F.col("part") - 1).alias("part"), F.col("k").alias("kids"),
                        F.sum("l").over(later).alias("leaves"), F.sum("s").over(later).alias("saved")))
        rows = materialize(rows.join(sums, ["conv", "part"], "left").fillna(0, ["kids", "leaves", "saved"]), "trie-sums")
    else:
        rows = rows.select("*", *[zero.alias(c) for c in ("kids", "leaves", "saved")])
    return _nodes(rows, shards, part).select("conv", "depth", "parent_conv", "n", "kids", "leaves", "saved", "ends")
