"""Run log: one row per task attempt (retries and failures both FAILED,
told apart by try_number), appended to a table partitioned by start day."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide import schemas
from velotide.operators.incremental import table_exists

# --- fixed values ------------------------------------------------------------
RUNNING, SUCCESS, FAILED, UNFINISHED = "RUNNING", "SUCCESS", "FAILED", "UNFINISHED"
# ----------------------------------------------------------------------------


def log_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A handful of attempt records (one per task attempt) as a DataFrame."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.RUN_LOG.fields) for r in rows],
                                 schemas.RUN_LOG)


def append_run_log(df: DataFrame, path: str) -> None:
    (df.withColumn("start_day", F.to_date("start_time")).sortWithinPartitions("dag_id", "batch_id", "task_id")
     .write.mode("append").partitionBy("start_day").parquet(path))


def attempt_summary(log: DataFrame) -> DataFrame:
    """Per (run, task): attempts, the last attempt's status and error."""
    return log.groupBy("run_id", "task_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max("try_number").alias("last_try"),
        F.max_by("status", "try_number").alias("last_status"),
        F.max_by("error_message", "try_number").alias("last_error"))


def attempts(ends: DataFrame, starts: DataFrame) -> DataFrame:
    """One row per attempt (run, task, try): its end if there is one; an attempt that
    started and never ended (its driver died) is UNFINISHED."""
    key = ["run_id", "task_id", "try_number"]
    both = starts.select(*schemas.RUN_LOG.names).unionByName(ends.select(*schemas.RUN_LOG.names))
    ended = F.col("status") != RUNNING
    # an end carries all of the attempt; of a start and an end the end counts
    last = F.max_by(F.struct(*[c for c in schemas.RUN_LOG.names if c not in key]), F.struct(ended.cast("int"), "end_time"))
    out = both.groupBy(*key).agg(last.alias("r")).select(*key, "r.*")
    return out.withColumn("status", F.when(F.col("status") == RUNNING, F.lit(UNFINISHED)).otherwise(F.col("status"))).select(*schemas.RUN_LOG.names)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """The attempts of a log folder as RunLogger writes it."""
    none = spark.createDataFrame([], schemas.RUN_LOG)
    ends, starts = (spark.read.parquet(p) if table_exists(spark, p) else none for p in (path, f"{path}_started"))
    return attempts(ends, starts)


class RunLogger:
    """Appends a record when an attempt starts (``<path>_started``) and one when it
    ends (``path``).  A retried run (same ``run_id``) counts on: its attempts follow
    those in the log, unfinished ones included.  A log that cannot be read or
    written is warned about; it neither fails a task nor hides a task's error."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, dag_id: str, batch_id: str | None = None):
        self.spark, self.path, self.run_id, self.dag_id, self.batch_id = spark, path, run_id, dag_id, batch_id
        self.tries: dict[str, int] = {}
        try:  # a run has a few dozen tasks
            done = read_attempts(spark, path).filter(F.col("run_id") == run_id).groupBy("task_id").agg(F.max("try_number").alias("n"))
            self.tries = {r.task_id: r.n for r in done.collect()}
        except Exception as e:
            warnings.warn(f"run log {path} cannot be read: {e}")

    def _append(self, path: str, **fields) -> None:
        row = dict(run_id=self.run_id, dag_id=self.dag_id, batch_id=self.batch_id, **fields)
        try:
            append_run_log(log_rows(self.spark, [row]), path)
        except Exception as e:
            warnings.warn(f"run log {path} cannot be written: {e}")

    def task(self, task_id: str, fn, try_number: int | None = None):
        n = self.tries[task_id] = try_number or self.tries.get(task_id, 0) + 1
        start = dt.datetime.now(dt.timezone.utc)
        self._append(f"{self.path}_started", task_id=task_id, try_number=n, start_time=start, status=RUNNING)

        def ended(status, error):
            self._append(self.path, task_id=task_id, try_number=n, start_time=start, end_time=dt.datetime.now(dt.timezone.utc),
                         status=status, error_message=error)

        try:
            out = fn()
        except Exception as e:
            ended(FAILED, str(e))
            raise
        ended(SUCCESS, None)
        return out
