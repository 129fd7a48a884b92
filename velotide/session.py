"""SparkSession set-up shared by the jobs, the bench and the tests."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Trip times are wall-clock (timestamp_ntz) and
# status times are instants; all instants are read and written in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size shuffle partitions by data, not by core count: set
    # spark.sql.shuffle.partitions high on a cluster and let AQE merge
    # partitions up to the advisory size
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # (bytes as shuffled; sorted in memory before a write they take 10 to 20 times that)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # incremental models replace only the day partitions present in the batch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # whole-stage codegen fuses scan, broadcast joins and the rule arrays into
    # one method; HotSpot leaves methods over 8 KB of bytecode interpreted
    # unless told otherwise, which made those stages 3x slower
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "velotide",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return a session with the platform's settings.

    On a cluster ``master`` stays ``None`` so the launcher's master is used and
    ``spark.sql.shuffle.partitions`` should be sized to the data (AQE coalesces
    small partitions at runtime).  Tests pass ``local[*]`` and a small number.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    asked = dict(extra or {})
    if shuffle_partitions is not None:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    given = _launcher_conf()
    for k, v in ({k: v for k, v in BASE_CONF.items() if k not in given} | asked).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # an already running session keeps its static settings; SQL ones can be set
    for k, v in asked.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    apply_job_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _launcher_conf() -> set[str]:
    """Keys the launcher gave (--conf, spark-defaults.conf), or a running context has."""
    from pyspark import SparkConf, SparkContext

    if SparkContext._active_spark_context is not None:
        return {k for k, _ in SparkContext._active_spark_context.getConf().getAll()}
    SparkContext._ensure_initialized()
    return {k for k, _ in SparkConf().getAll()}


# what results depend on: always set; the other settings only when nobody gave them
REQUIRED_CONF = ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode")


def apply_job_conf(spark: SparkSession) -> None:
    """Set the SQL settings the models rely on, on a session made elsewhere;
    tuning values that the launcher gave stay."""
    given = _launcher_conf()
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and (k in REQUIRED_CONF or k not in given):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system) and must be set: executors cannot share a machine-local folder.
    Only under a local master a temporary folder is made, and removed when the
    driver's Python ends."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: configuration only
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise ValueError("spark.checkpoint.dir must name a shared folder") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="velotide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder (shared on a cluster) for a
    job's intermediate files: landing copies, stream inputs, checkpoints."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/velotide-work/{name}-{uuid.uuid4().hex[:12]}"


OPEN_WRITERS = 4  # files a task keeps open at once: each holds a row group in memory


@contextlib.contextmanager
def _set(spark: SparkSession, key: str, value: str, default: str | None = None):
    before = spark.conf.get(key, default) if default is not None else spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_writers(spark: SparkSession, most: int = OPEN_WRITERS):
    """Writes inside keep a file per partition value open instead of sorting a
    task's rows by it, which takes memory (and spills) for all of them.  A task
    that meets more than ``most`` values sorts what is left."""
    return _set(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most))


def freed_shuffles(spark: SparkSession):
    """Writes inside delete their shuffle files as they end, not when the driver's
    garbage collector finds them unused: a job of many writes holds those of one."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a run over ``input_bytes`` on ``total_cores`` cores.

    * shuffle partitions: enough that each holds about the target size of
      the largest shuffle (the trips, which the models shuffle at most once
      per aggregate), and at least two waves of tasks; AQE then merges
      small partitions and splits skewed ones.
    * scan splits of the same target size.
    * broadcast threshold kept at 64 MB: the broadcast sides (identity,
      stations, calendar) are thousands of rows; anything larger is planned
      as a shuffle join.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
