"""Session helpers: one place for the engine's Spark settings."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep small CPU-heavy stages (regex folds, window sorts) spread over the
    # cores; at corpus scale partitions are far above this floor anyway
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the checkpointed DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "qaprep", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster leave ``master`` unset; the launcher decides.  Locally the
    shuffle width defaults to the core count, not Spark's 200.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local") and "spark.driver.memory" not in (extra or {}):
        # local mode: the driver JVM is the whole cluster; 1g default thrashes
        b = b.config("spark.driver.memory", "12g")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only when the session names none (local tests) do we pick a fresh
    scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            # executors cannot share a machine-local folder
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="qaprep-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/qaprep-{name}-{uuid.uuid4().hex}"


#: whether Spark deletes the shuffles of a query as it ends
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str = "stage", free: bool = False) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and read it back.

    Used where several consumers read a costly stage: each reads only the
    columns it needs, and a lost executor re-reads the table instead of
    replaying the stage.  ``free`` deletes the stage's shuffles once it is stored;
    else they stay until the driver happens to collect its garbage."""
    path, conf = shared_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_SHUFFLES_GO, None)
    if free:
        conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if free:
            conf.unset(_SHUFFLES_GO) if before is None else conf.set(_SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of ``materialise`` that nothing reads any more."""
    folders = {f.rpartition("/")[0] for f in table.inputFiles()}
    sc = table.sparkSession.sparkContext
    for folder in folders:
        if "/qaprep-" not in folder:
            raise ValueError(f"not a stored stage: {folder}")
        p = sc._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def bucket_bits(spark: SparkSession, minimum: int = 6, maximum: int = 16) -> int:
    """Number of hash-prefix bits used for order buckets.

    Four buckets per shuffle partition keeps the per-bucket window small and
    the broadcast offsets table at most 2**16 rows.
    """
    try:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present
        parts = 200
    bits = math.ceil(math.log2(max(parts, 1) * 4))
    return max(minimum, min(maximum, bits))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: as a zip file, unless ``PYTHONPATH`` has it."""
    import zipfile
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(":"):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="qaprep-code-"), "qaprep_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "qaprep")):
            for name in (n for n in names if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
