"""Tables whose partitions are replaced in one step.

    <path>/data/<unit>=<value>/version=<id>/[inner partitions]/*.parquet
    <path>/manifest/<number>.json

A run first writes its rows under a version id of its own, where no reader
looks.  Then it publishes: the next manifest names, for every value of the unit
(a batch, a day), the version that is live.  Readers take the last manifest and
read exactly the folders it names, so a run that stops before it publishes
leaves everything as it was, and one that publishes replaces all its units at
once: values it covers but has no rows for are gone.

A manifest also holds the schema, so an empty table is a table (of no rows), and
one that was never written is none.  Its size is the number of units, not of
rows or files.  It is put in place by a rename; two writers that publish the same
number do not both succeed."""

from __future__ import annotations

import json
import uuid
from contextlib import nullcontext
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from velotide.session import freed_shuffles, open_writers

VERSION = "version"
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a null partition value
VALUES_OF_A_SPLIT = 32  # partition values a scan task meets at most: files of 4 MB (open cost) in a split of 128 MB


class ConcurrentPublish(RuntimeError):
    """Another run published in between."""


class VersionedTable:
    """``unit`` is the partition column that is replaced as a whole, ``inner`` the
    partition columns inside it.  Files are written with ``codec`` (None: the session's)."""

    def __init__(self, spark: SparkSession, path: str, unit: str, inner: Iterable[str] = (), codec: str | None = None):
        self.spark, self.path, self.unit, self.inner = spark, path.rstrip("/"), unit, list(inner)
        self.options = {"compression": codec} if codec else {}

    # ---------------------------------------------------------- manifests ---
    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self) -> list[int]:
        fs, path = self._fs()
        folder = path(f"{self.path}/manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, number: int | None = None) -> dict | None:
        """The last manifest (or one by number); None for a table never published."""
        numbers = self._numbers()
        if not numbers:
            return None
        fs, path = self._fs()
        number = numbers[-1] if number is None else number
        stream = fs.open(path(f"{self.path}/manifest/{number:010d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) | {"number": number}

    def exists(self) -> bool:
        return bool(self._numbers())

    def live(self) -> dict[str, str]:
        """Live version of each unit value (as in its folder's name)."""
        m = self.manifest()
        return m["live"] if m else {}

    # ------------------------------------------------------------- writing ---
    def stage(self, df: DataFrame, sort_by: Iterable[str] = (), laid_out: bool = False) -> str:
        """Write ``df`` under a version id of its own; no reader sees it yet.
        ``laid_out``: a task's rows are of few partition values already (read from
        a table of the same layout, or dealt by it before), so they are not shuffled."""
        version = uuid.uuid4().hex
        by = [self.unit, *self.inner]
        # REBALANCE: a busy partition is split over several writer tasks, quiet ones are merged
        out = df if laid_out else df.hint("rebalance", *by)
        out = out.withColumn(VERSION, F.lit(version))  # not shuffled with every row
        if sort_by:
            out = out.sortWithinPartitions(*by, *sort_by)
        with freed_shuffles(self.spark), open_writers(self.spark, VALUES_OF_A_SPLIT) if laid_out else nullcontext():
            out.write.mode("append").partitionBy(self.unit, VERSION, *self.inner).options(**self.options).parquet(f"{self.path}/data")
        return version

    def staged_values(self, version: str) -> list[str]:
        """Unit values that a version holds rows of (folder names; no data is read)."""
        fs, path = self._fs()
        found = fs.globStatus(path(f"{self.path}/data/{self.unit}=*/{VERSION}={version}"))
        return sorted(s.getPath().getParent().getName().split("=", 1)[1] for s in found or [])

    def publish(self, version: str, schema: StructType, covers: Iterable | Callable[[str], bool] | None = None, note: dict | None = None) -> int:
        """Make a staged version live and return the manifest's number.  ``covers``
        says which unit values the run stands for: all (None), a list of values, or
        a condition on the folder's value; covered values without rows are gone.
        ``note`` is kept with the manifest (say, what input the run has seen)."""
        before = self.manifest() or {"live": {}, "number": -1, "note": {}}
        values = self.staged_values(version)
        if covers is None:
            kept = {}
        else:
            covered = covers if callable(covers) else {str(v) for v in covers}.__contains__
            stray = [v for v in values if not covered(v)]
            if stray:
                raise ValueError(f"rows outside what the run covers: {self.unit} = {', '.join(stray[:5])}")
            kept = {v: x for v, x in before["live"].items() if not covered(v)}
        body = {"unit": self.unit, "inner": self.inner, "schema": json.loads(schema.json()), "live": kept | {v: version for v in values},
                "note": before.get("note", {}) if note is None else note}
        self._put(before["number"] + 1, json.dumps(body, sort_keys=True))
        return before["number"] + 1

    def _put(self, number: int, text: str) -> None:
        fs, path = self._fs()
        target, part = path(f"{self.path}/manifest/{number:010d}.json"), path(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        out = fs.create(part, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(part, target):
            fs.delete(part, False)
            raise ConcurrentPublish(f"{self.path}: manifest {number} is there already")

    def replace(self, df: DataFrame, covers=None, sort_by: Iterable[str] = (), note: dict | None = None, laid_out: bool = False) -> "VersionedTable":
        """Stage and publish.  ``covers="present"``: the values that ``df`` has."""
        version = self.stage(df, sort_by, laid_out)
        self.publish(version, df.schema, self.staged_values(version) if covers == "present" else covers, note)
        return self

    # ------------------------------------------------------------- reading ---
    def read(self, number: int | None = None) -> DataFrame:
        """The live rows.  Unit and inner columns are partition columns, so filters
        on them prune folders."""
        m = self.manifest(number)
        if m is None:
            raise FileNotFoundError(f"{self.path} was never published")
        schema = StructType.fromJson(m["schema"])
        folders = [f"{self.path}/data/{m['unit']}={v}/{VERSION}={x}" for v, x in sorted(m["live"].items())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        full = StructType(list(schema.fields)).add(VERSION, StringType())
        return self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    # ------------------------------------------------------------ cleaning ---
    def vacuum(self, keep: int = 2) -> int:
        """Delete versions that none of the last ``keep`` manifests names, and older
        manifests; returns the number of folders deleted.  Not beside a running writer."""
        fs, path = self._fs()
        numbers = self._numbers()
        held = {(v, x) for n in numbers[-keep:] for v, x in self.manifest(n)["live"].items()}
        gone = 0
        for s in fs.globStatus(path(f"{self.path}/data/{self.unit}=*/{VERSION}=*")) or []:
            p = s.getPath()
            if (p.getParent().getName().split("=", 1)[1], p.getName().split("=", 1)[1]) not in held:
                fs.delete(p, True)
                gone += 1
        for n in numbers[:-keep]:
            fs.delete(path(f"{self.path}/manifest/{n:010d}.json"), False)
        return gone


def open_table(spark: SparkSession, path: str) -> VersionedTable | None:
    """The versioned table at a path, with its unit as published; None if there is none."""
    m = VersionedTable(spark, path, "").manifest()
    return VersionedTable(spark, path, m["unit"], m["inner"]) if m else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by path: its live rows if it is versioned, else its files."""
    table = open_table(spark, path)
    return table.read() if table else spark.read.parquet(path)
