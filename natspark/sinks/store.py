"""A store of micro-batches that stays readable: closed days are merged.

Batches land in ``<path>/batch_id=<n>/<day>=<d>/`` (``batch_partition_write``).
``compact`` merges the batches of closed days, newest last, into sorted files
under ``<path>/_compacted/v=<k>/`` and then publishes version k of the manifest
in one step: a reader sees the old files or the new ones.  The manifest names
each merged day's version and the batch files that went into it, which readers
skip from then on and ``vacuum`` deletes.  Batches that come later (new ones or
replays) are read on top, and the next ``compact`` merges only their days.

A ``Layout`` says how a day's merged rows lie: buckets by the first hex digits
of the row key for point fetches, or sorted by search columns with Bloom
filters on them, so that a search opens few files and few row groups.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from natspark.sinks.folders import Folder


@dataclass(frozen=True)
class Layout:
    """``key``: rows of one key are versions of one row, that of the last batch
    stays (None: a log, every row of a batch stays).  ``day``: the partition
    column of the batches.  ``sort_by``: order inside a bucket, of columns that
    follow from the key (so do the day and the bucket).  ``bloom``:
    columns with Bloom filters.  ``digits``: leading hex digits of the key that
    name a bucket (16 ** digits buckets a day).  ``fmt``: format of the
    batches; merged files are Parquet."""

    key: str | None = "rowkey"
    day: str = "day"
    sort_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    digits: int = 0
    fmt: str = "parquet"

    def bucket(self, key: Column) -> Column:
        return F.substring(key, 1, self.digits) if self.digits else F.lit("all")


RECORDS = Layout(sort_by=("rowkey",), bloom=("rowkey",), digits=1)
ADDRESSES = ("targetIp", "targetPort", "sourceIp", "sourcePort", "convertedIp", "convertedPort")
INDEX = Layout(sort_by=("targetPort", "targetIp", "access_ms"), bloom=ADDRESSES)


def bucket_digits(rows: int, days: int, bucket_rows: int = 1_000_000) -> int:
    """Leading hex digits that cut a day of ``rows / days`` rows into buckets of
    about ``bucket_rows``; fixed when a store is made."""
    digits = 0
    while rows / max(days, 1) / 16 ** (digits + 1) >= bucket_rows and digits < 4:
        digits += 1
    return digits


USER_LOG = Layout(key=None, day="dt", sort_by=("value",), fmt="text")


class Store:
    """The batches and merged days below ``path``."""

    def __init__(self, spark: SparkSession, path: str, layout: Layout):
        self.spark, self.path, self.layout = spark, path.rstrip("/"), layout
        self.folder = Folder(spark, self.path)

    # ------------------------------------------------------------- manifest

    def version(self) -> int:
        """The last published version, 0 before the first."""
        done = [n for n in self.folder.names("_manifest") if n.endswith(".json") and not n.startswith("_")]
        return int(done[-1][:-5]) if done else 0

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "days": {}, "inputs": [], "schema": None}
        return json.loads(self.folder.read(f"_manifest/{version:08d}.json"))

    def _publish(self, manifest: dict) -> None:
        folder = Folder(self.spark, f"{self.path}/_manifest")
        folder.make()
        if not folder.publish(f"{manifest['version']:08d}.json", json.dumps(manifest)):
            raise RuntimeError(f"version {manifest['version']} was published by another writer")

    # -------------------------------------------------------------- reading

    def _schema(self, manifest: dict) -> StructType | None:
        if manifest["schema"]:
            return StructType.fromJson(manifest["schema"])
        if not self._batches():
            return None
        if self.layout.fmt == "text":
            return StructType([StructField("value", StringType())])
        parts = ("batch_id", self.layout.day)
        read = self.spark.read.parquet(self.path)
        return StructType([f for f in read.schema if f.name not in parts])

    def _batches(self) -> bool:
        return any(n.startswith("batch_id=") for n in self.folder.names())

    def _full(self, schema: StructType, *more: StructField) -> StructType:
        return StructType([*schema, *more, StructField(self.layout.day, LongType())])

    def _level0(self, schema: StructType) -> DataFrame:
        full = self._full(schema, StructField("batch_id", LongType()))
        return self.spark.read.schema(full).format(self.layout.fmt).load(self.path)

    def batch_files(self) -> dict[str, int]:
        """Path below the store of every batch file, and its day.  One listing;
        ``vacuum`` keeps it to the batches that no version holds."""
        if not self._batches():
            return {}
        schema = StructType([StructField("value", StringType())])
        found = {}
        for uri in self._level0(schema).inputFiles():
            name = "batch_id=" + uri.split("/batch_id=", 1)[1]
            found[name] = int(name.split(f"/{self.layout.day}=", 1)[1].split("/", 1)[0])
        return found

    def _fresh(self, schema: StructType, names: list[str]) -> DataFrame:
        full = self._full(schema, StructField("batch_id", LongType()))
        return (self.spark.read.schema(full).option("basePath", self.path).format(self.layout.fmt)
                .load([f"{self.path}/{n}" for n in names]))

    def _merged(self, schema: StructType, days: dict[str, int]) -> DataFrame:
        """The merged rows of the given days, each from its version."""
        base = f"{self.path}/_compacted"
        full = StructType([*schema, StructField("batch_id", LongType()), StructField("v", LongType()),
                           StructField(self.layout.day, LongType()), StructField("bucket", StringType())])
        paths = [f"{base}/v={v}/{self.layout.day}={d}" for d, v in sorted(days.items())]
        return self.spark.read.schema(full).option("basePath", base).parquet(*paths).drop("v")

    def _versions(self, merged: DataFrame | None, fresh: DataFrame) -> DataFrame:
        """``fresh`` batches beside merged rows.  With a key, ``_new`` tells
        them apart; without one, a fresh batch replaces what is merged of it on
        its days."""
        day = self.layout.day
        if self.layout.key is None:
            if merged is None:
                return fresh
            again = fresh.select("batch_id", day).distinct()
            return merged.join(again, ["batch_id", day], "left_anti").unionByName(fresh)
        both = fresh.withColumn("_new", F.lit(1))
        return both if merged is None else both.unionByName(merged.withColumn("_new", F.lit(0)))

    def _newest(self, rows: DataFrame) -> DataFrame:
        """By key the row of the highest batch, a fresh one among equals."""
        key = self.layout.key
        if key is None:
            return rows
        rest = [c for c in rows.columns if c not in (key, "_new")]
        order = F.struct("batch_id", "_new", *[c for c in rest if c != "batch_id"])
        return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")

    def read(self, day_from: int | None = None, day_to: int | None = None) -> DataFrame:
        """The store's rows with their ``batch_id``, day and ``bucket``.

        Days that are merged and have no later batch are read as they lie, with
        no shuffle; the others are merged on the fly.  Files that a version
        holds are not read again."""
        manifest = self.manifest()
        schema = self._schema(manifest)
        if schema is None:
            raise FileNotFoundError(f"no batch in {self.path}")
        wanted = lambda d: (day_from is None or d >= day_from) and (day_to is None or d <= day_to)
        held = set(manifest["inputs"])
        fresh = {n: d for n, d in self.batch_files().items() if n not in held and wanted(d)}
        days = {int(d): v for d, v in manifest["days"].items() if wanted(int(d))}
        open_days = set(fresh.values())
        columns = [*schema.fieldNames(), "batch_id", self.layout.day, "bucket"]
        parts = []
        closed = {d: v for d, v in days.items() if d not in open_days}
        if closed:
            parts.append(self._merged(schema, closed))
        if fresh:
            below = {d: v for d, v in days.items() if d in open_days}
            merged = self._merged(schema, below).drop("bucket") if below else None
            rows = self._newest(self._versions(merged, self._fresh(schema, sorted(fresh))))
            parts.append(self._with_bucket(rows))
        if not parts:
            empty = StructType([*schema, *[StructField(c, LongType()) for c in columns[-3:-1]],
                                StructField("bucket", StringType())])
            return self.spark.createDataFrame([], empty)
        out = parts[0].select(*columns)
        for p in parts[1:]:
            out = out.unionByName(p.select(*columns))
        return out

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        key = F.col(self.layout.key) if self.layout.key else F.lit("")
        return rows.withColumn("bucket", self.layout.bucket(key))

    def fetch(self, hits: DataFrame, day_from: int | None = None, day_to: int | None = None,
              small: bool = False) -> DataFrame:
        """Rows whose key and day are in ``hits``.  With few hits (``small``:
        they may be broadcast) their days and buckets prune the scan."""
        on = [self.layout.day, "bucket", self.layout.key]
        wanted = self._with_bucket(hits.select(self.layout.key, self.layout.day)).select(*on)
        wanted = F.broadcast(wanted) if small else wanted
        return self.read(day_from, day_to).join(wanted, on, "left_semi")

    # -------------------------------------------------------------- merging

    def write_sorted(self, rows: DataFrame, version: int, tasks: int | None = None) -> None:
        """Rows with ``batch_id`` and day as the files of a version: ranges of
        (day, bucket, order, key), so that a task writes few files and no day
        or address is a single task's.  Rows of one key lie together after that
        one shuffle, and the newest of them stays."""
        self._sorted(rows, tasks).write.partitionBy(self.layout.day, "bucket").mode("overwrite").options(
            **self._filters()).parquet(f"{self.path}/_compacted/v={version}")

    def _filters(self) -> dict[str, str]:
        """Bloom filters as large as the values of a row group need."""
        return {"parquet.bloom.filter.adaptive.enabled": "true",
                **{f"parquet.bloom.filter.enabled#{c}": "true" for c in self.layout.bloom}}

    def _sorted(self, rows: DataFrame, tasks: int | None) -> DataFrame:
        day, key = self.layout.day, self.layout.key
        # a bucket that is the same for all is added at the end: as a constant
        # it would hide from Spark that rows of one key lie together
        buckets = ["bucket"] if self.layout.digits else []
        rows = self._with_bucket(rows) if buckets else rows
        names = list(dict.fromkeys([day, *buckets, *self.layout.sort_by, *([key] if key else [])]))
        order = [F.col(c) for c in names]
        ranged = rows.repartitionByRange(tasks, *order) if tasks else rows.repartitionByRange(*order)
        if key is not None:
            rest = [c for c in rows.columns if c not in (*names, "_new")]
            newest = F.struct("batch_id", *([F.col("_new")] if "_new" in rows.columns else []),
                              *[c for c in rest if c != "batch_id"])
            ranged = (ranged.groupBy(*names).agg(F.max_by(F.struct(*rest), newest).alias("_r"))
                      .select(*names, "_r.*"))
        return (ranged if buckets else self._with_bucket(ranged)).sortWithinPartitions(*order)

    def compact(self, before_day: int | None = None) -> int:
        """Merge the batch files of days before ``before_day`` (all days if not
        given) with what is merged of them; return the manifest's version.

        Nothing to merge leaves the version as it is.  A merge that fails
        leaves files that no manifest names; the next one of that number
        replaces them.  Of two at a time one publishes and the other fails."""
        manifest = self.manifest()
        held = set(manifest["inputs"])
        files = {n: d for n, d in self.batch_files().items() if before_day is None or d < before_day}
        fresh = sorted(n for n in files if n not in held)
        if not fresh:
            return manifest["version"]
        schema = self._schema(manifest)
        open_days = {files[n] for n in fresh}
        below = {int(d): v for d, v in manifest["days"].items() if int(d) in open_days}
        merged = self._merged(schema, below).drop("bucket") if below else None
        version = manifest["version"] + 1
        self.write_sorted(self._versions(merged, self._fresh(schema, fresh)), version)
        days = manifest["days"] | {str(d): version for d in open_days}
        alive = set(self.batch_files())
        self._publish({"version": version, "days": days, "schema": schema.jsonValue(),
                       "inputs": sorted(held & alive | set(fresh))})
        return version

    def load(self, rows: DataFrame, tasks: int | None = None) -> int:
        """Bulk load: ``rows`` (a stored table with the day column) become merged
        days at once, without a batch; their days must be new.  Of the rows of
        one key the largest stays."""
        manifest = self.manifest()
        version, day = manifest["version"] + 1, self.layout.day
        rows = rows if "batch_id" in rows.columns else rows.withColumn("batch_id", F.lit(0).cast("bigint"))
        self.write_sorted(rows, version, tasks)
        names = self.folder.names(f"_compacted/v={version}")
        days = {n.split("=", 1)[1]: version for n in names if n.startswith(f"{day}=")}
        if set(days) & set(manifest["days"]):
            raise ValueError(f"days {sorted(set(days) & set(manifest['days']))} are there already")
        schema = StructType([f for f in rows.schema if f.name not in ("batch_id", day)])
        self._publish({"version": version, "days": manifest["days"] | days, "schema": schema.jsonValue(),
                       "inputs": manifest["inputs"]})
        return version

    def vacuum(self) -> int:
        """Delete batch files that the current version holds and versions that
        it doesn't name; return the number of files and folders deleted.  Run
        it when no reader of an older version is left."""
        manifest = self.manifest()
        gone = 0
        for name in manifest["inputs"]:
            self.folder.delete(name)
            gone += 1
        for batch in self.folder.names():
            if batch.startswith("batch_id="):
                for d in self.folder.names(batch):
                    if not any(not n.startswith(("_", ".")) for n in self.folder.names(f"{batch}/{d}")):
                        self.folder.delete(f"{batch}/{d}")
                if not any(not n.startswith(("_", ".")) for n in self.folder.names(batch)):
                    self.folder.delete(batch)
        used = {(int(d), v) for d, v in manifest["days"].items()}
        for v in self.folder.names("_compacted"):
            for d in self.folder.names(f"_compacted/{v}"):
                if d.startswith(f"{self.layout.day}=") and (int(d.split("=")[1]), int(v[2:])) not in used:
                    self.folder.delete(f"_compacted/{v}/{d}")
                    gone += 1
        return gone
