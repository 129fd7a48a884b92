"""Compaction beside a running stream.

Micro-batches write folders of their own and publish them in a commit log (a
versioned table's manifest, by day and batch).  Readers follow the log.  Merging a
day's small batches writes one new folder and publishes it in place of the old
ones in a single entry: a reader sees the batches or the merged rows, never both
and never neither, and the stream goes on in its own folders meanwhile.  A
publication that finds another one has come first is tried again on top of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.operators.versions import ConcurrentPublish, VersionedTable
from velotide.streaming.status_stream import to_raw

UNIT = "slot"  # <day>.<batch>, or <day>.merged
TRIES = 20


class StreamTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path, UNIT)

    def _publish(self, version: str, schema, covers) -> None:
        for _ in range(TRIES):
            try:
                self.table.publish(version, schema, covers)
                return
            except ConcurrentPublish:
                continue
        raise ConcurrentPublish(f"{self.table.path}: {TRIES} other publications came first")

    def write_batch(self, ingested_at=None):
        """foreachBatch function; a batch written again replaces its own slots."""
        def write(batch: DataFrame, batch_id: int) -> None:
            day = F.coalesce(F.date_format("poll_time", "yyyy-MM-dd"), F.lit("none"))
            rows = to_raw(batch, ingested_at).withColumn(UNIT, F.concat(day, F.lit(f".{batch_id}")))
            self._publish(self.table.stage(rows, ["station_id"]), rows.schema, lambda slot: slot.endswith(f".{batch_id}"))
        return write

    def small_slots(self, before: str) -> dict[str, list[str]]:
        """Slots by day, of days before ``before`` that have several; those of the
        last micro-batch stay out, since the stream may write that one again."""
        live = [slot.partition(".") for slot in self.table.live()]
        last = max((int(b) for _, _, b in live if b != "merged"), default=-1)
        days: dict[str, list[str]] = {}
        for day, dot, batch in live:
            if day < before and batch != str(last):
                days.setdefault(day, []).append(day + dot + batch)
        return {day: slots for day, slots in days.items() if len(slots) > 1}

    def merge(self, day: str, slots: list[str]) -> str:
        """Write the rows of some slots of a day as one; not yet seen by readers."""
        rows = self.table.read().filter(F.col(UNIT).isin(slots)).withColumn(UNIT, F.lit(f"{day}.merged"))
        return self.table.stage(rows, ["station_id"])

    def compact(self, before: str) -> list[str]:
        """Merge each day's slots; batches of the day that come meanwhile stay beside."""
        done = []
        for day, slots in sorted(self.small_slots(before).items()):
            version = self.merge(day, slots)
            covered = {*slots, f"{day}.merged"}
            self._publish(version, self.table.read().schema, covered.__contains__)
            done.append(day)
        return done

    def read(self) -> DataFrame:
        return self.table.read().drop(UNIT)
