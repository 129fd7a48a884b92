"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` is the store: each run is a table of 128-bit line hashes in hash
buckets, every bucket one file sorted by hash.  A new batch is dealt into the same
buckets once and merge-joined with each run bucket by bucket: no run is shuffled
or sorted again.  Lines seen before are dropped, and the batch's new hashes become
a run of level 0: the batch's lines are written once, in the buckets, and the run is
those of them not seen before.  Once a level holds ``fan_out`` runs and another batch comes,
they are merged into one run of the next level, so a store of n batches has at most
``fan_out * log(n)`` runs.  Within a batch the smallest document holding a
line keeps it; batches come in ascending ranges of doc_id, so over all batches
the smallest document keeps every line.

A line's key is the line without ``\\x20 \\x09-\\x0D`` at its ends, A-Z in lower
case; only keys of ``min_chars`` code points or more count.

Defined results: a null or empty text is one empty line; a null doc_id counts
as the largest; rows with an equal doc_id are one document and lose the same
lines; extra columns pass through untouched (the operator's own columns start
with ``_ld_``)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.llm.common import LOWER, SPACES, UPPER, as_key, written
from velotide.session import scratch_path

MIN_CHARS, BATCHES = 10, 6
HASH = ["h1", "h2"]


class LineRuns:
    """Levelled sorted runs: bucketed tables over folders of the shared file system."""

    def __init__(self, spark: SparkSession, fan_out: int = 4, buckets: int | None = None):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows in the store's buckets: one task per bucket."""
        return df.repartition(self.buckets, *HASH)

    def _write(self, dealt: DataFrame, level: int) -> str:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{level}_{uuid.uuid4().hex[:12]}"
        self.paths[name] = scratch_path(self.spark, f"line-run-{level}")
        dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", self.paths[name]).saveAsTable(name)
        self.levels[level].append(name)
        return self.paths[name]

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def run(self, name: str) -> DataFrame:
        """Hashes of a run; a batch written with ``seen`` is a run by the others."""
        held = self.spark.table(name)
        return (held.filter(~F.col("seen")) if "seen" in held.columns else held).select(*HASH)

    def all(self) -> DataFrame | None:
        tables = [self.run(name) for name in self.runs()]
        return reduce(DataFrame.union, tables) if tables else None

    def with_seen(self, dealt: DataFrame) -> DataFrame:
        """Rows in the store's buckets with ``seen``: whether a run holds their hash."""
        seen = F.lit(False)
        for k, name in enumerate(self.runs()):
            run = self.run(name).withColumn(f"_in{k}", F.lit(True)).hint("merge")
            dealt, seen = dealt.join(run, HASH, "left"), seen | F.col(f"_in{k}").isNotNull()
        out = dealt.withColumn("seen", seen)
        return out.drop(*[c for c in out.columns if c.startswith("_in")])

    def make_room(self) -> None:
        """Merge full levels: a run is merged when there is more to come."""
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan_out:
            merged, self.levels[level] = self.levels[level], []
            # runs are disjoint: the merge needs no dedup.  Read as plain files, so that
            # the new run is dealt anew and has one file per bucket
            files = self.spark.read.schema("h1 long, h2 long, seen boolean").parquet(*[self.paths[name] for name in merged])
            self._write(self.dealt(files.filter(~F.coalesce("seen", F.lit(False))).select(*HASH)), level + 1)
            self._drop(merged)
            level += 1

    def add(self, new: DataFrame) -> None:
        """A run of new hashes."""
        self.make_room()
        self._write(self.dealt(new.select(*HASH)), 0)

    def admit(self, dealt: DataFrame) -> DataFrame:
        """Rows in the store's buckets with ``seen``, one row a hash, and a run of those
        not seen: written once, where they lie."""
        self.make_room()
        rows = self.with_seen(dealt)
        return self.spark.read.schema(rows.schema).parquet(self._write(rows, 0))

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the catalog's entry; its files stay

    def close(self) -> None:
        self._drop(self.runs())


@contextmanager
def sorted_buckets(spark: SparkSession):
    """Bucket files of one task each are read as sorted, as they are."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def line_key(line):
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, row hash, position, 128-bit key hash) of the lines that count."""
    lines = docs.select(as_key("doc_id").alias("doc"), F.xxhash64("text").alias("row"),
                        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    keyed = lines.select("doc", "row", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select("doc", "row", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper doc_id bounds of about equal batches, ascending."""
    if batches <= 1:
        return []
    q = [i / batches for i in range(1, batches)]
    found = docs.select(F.percentile_approx("doc_id", F.array(*map(F.lit, q)), 1000).alias("q")).first().q
    return sorted({int(x) for x in found or []})


def dropped_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, fan_out: int = 4,
                  runs: LineRuns | None = None) -> DataFrame:
    """(doc, row, positions dropped in ascending order), for texts that lose a line."""
    spark = docs.sparkSession
    store = runs or LineRuns(spark, fan_out)
    bounds = batch_bounds(docs, batches)
    batch = F.lit(0)
    for b in bounds:
        batch = batch + (F.col("doc") > b).cast("int")
    path = scratch_path(spark, "line-hashes")
    hashed_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc long, row long, pos int, h1 long, h2 long, batch int").parquet(path)
    out = None
    with sorted_buckets(spark):
        for b in range(len(bounds) + 1):
            mine = lines.filter(F.col("batch") == b).drop("batch")
            owners = store.dealt(mine.groupBy(*HASH).agg(F.min("doc").alias("first"), F.max("doc").alias("last")))
            # nothing comes after the last batch
            owners = store.admit(owners) if b < len(bounds) else written(store.with_seen(owners), "line-owners")
            rule = owners.filter(F.col("seen") | (F.col("first") != F.col("last")))
            lost = mine.join(rule, HASH).filter(F.col("seen") | (F.col("doc") != F.col("first"))).select("doc", "row", "pos")
            out = lost if out is None else out.unionByName(lost)
    if runs is None:
        store.close()
    # distinct: repeated rows of one document name a position more than once
    return out.groupBy("doc", "row").agg(F.sort_array(F.collect_set("pos")).alias("positions"))


def line_dedup(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``_ld_lines`` (lines
    before) and ``_ld_dropped`` (lines taken out).  The kept lines are the slices
    between the dropped positions: one linear pass over the array of lines."""
    lost = dropped_lines(docs, batches, min_chars).select(
        F.col("doc").alias("_ld_doc"), F.col("row").alias("_ld_row"), F.col("positions").alias("_ld_positions"))
    d = docs.withColumn("_ld_doc", as_key("doc_id")).withColumn("_ld_row", F.xxhash64("text"))
    d = d.join(lost, ["_ld_doc", "_ld_row"], "left")
    d = d.withColumn("_ld_all", F.split(F.coalesce("text", F.lit("")), "\n"))
    slices = ("flatten(zip_with(concat(array(0), transform(_ld_positions, p -> p + 1)), "
              "concat(_ld_positions, array(size(_ld_all))), (a, b) -> slice(_ld_all, a + 1, b - a)))")
    d = d.withColumn("text", F.expr(f"CASE WHEN _ld_positions IS NULL THEN text ELSE array_join({slices}, '\n') END"))
    d = d.withColumn("_ld_lines", F.size("_ld_all").cast("long"))
    d = d.withColumn("_ld_dropped", F.coalesce(F.size("_ld_positions"), F.lit(0)).cast("long"))
    d = d.withColumn("_ld_dropped", F.when(F.col("_ld_positions").isNull(), F.lit(0)).otherwise(F.col("_ld_dropped")).cast("long"))
    return d.select(*docs.columns, "_ld_lines", "_ld_dropped")
