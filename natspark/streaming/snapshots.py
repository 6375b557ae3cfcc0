"""Dimension tables as each micro-batch saw them.

A micro-batch loads the users afresh, as the reference does at every window
firing.  If it fails and is run again, the users may have changed meanwhile,
and a part of its sinks would hold other rows.  Here a batch's users are kept
under its id before they are used: the second run reads what the first one saw.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.operators.enrich import latest_users
from natspark.sinks.folders import Folder


class Snapshots:
    """Users by batch id below ``path``: ``data/<name>`` tables, and a pointer
    per batch, published in one step.  Users that haven't changed since the
    last batch are kept once.  The pointers of the last ``keep`` batches stay,
    and the tables they name."""

    def __init__(self, spark: SparkSession, path: str, load: Callable[[], DataFrame], keep: int = 100):
        self.spark, self.path, self.load, self.keep = spark, path.rstrip("/"), load, keep
        self.pointers = Folder(spark, f"{self.path}/batches")
        self.data = Folder(spark, f"{self.path}/data")

    def _batches(self) -> list[str]:
        return [n for n in self.pointers.names() if n.endswith(".json") and not n.startswith("_")]

    def _pointer(self, name: str) -> dict:
        return json.loads(self.pointers.read(name))

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema("framedip string, loginname string").parquet(f"{self.path}/data/{name}")

    def of(self, batch_id: int) -> DataFrame:
        """(framedip, loginname): one login per address, as of the first time
        that this batch asked."""
        name = f"{batch_id:012d}.json"
        known = self._batches()
        if name not in known:
            self.pointers.make()
            table = uuid.uuid4().hex
            latest_users(self.load()).select("framedip", "loginname").write.parquet(f"{self.path}/data/{table}")
            row = F.xxhash64("framedip", "loginname")
            n, a, b = self._table(table).agg(
                F.count("*"), F.bit_xor(row), F.sum(row.cast("decimal(20,0)"))).first()
            mark = f"{n}:{a}:{b}"
            last = self._pointer(known[-1]) if known else {}
            if last.get("mark") == mark:
                self.data.delete(table)
                table = last["table"]
            # another attempt of the batch may have been first: its users count
            self.pointers.publish(name, json.dumps({"table": table, "mark": mark}))
            self._forget([n for n in sorted({*known, name}) if n <= name])
        return self._table(self._pointer(name)["table"])

    def _forget(self, known: list[str]) -> None:
        old = known[:-self.keep]
        if old:
            used = {self._pointer(n)["table"] for n in known[-self.keep:]}
            for n in old:
                table = self._pointer(n)["table"]
                self.pointers.delete(n)
                if table not in used:
                    self.data.delete(table)
