"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. AQE re-plans joins and coalesces shuffle output;
# skew-join splits hot partitions; the session zone fixes timestamp text.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # JSON with repeated keys: last value wins, as in Python json.loads
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str | None = None, app: str = "goldleaf",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Where nothing is configured, a fresh local folder serves a master
    that runs in this one process; on a cluster that is an error, since
    executors would each write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="goldleaf-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir() or local


SPLIT_MB = 16
PARTITION_MB = 2


def _at_most(spark: SparkSession, key: str, mb: int) -> None:
    """Lower a size setting of this session to ``mb``; a lower one stays."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get(key).strip().lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > mb << 20:
        spark.conf.set(key, f"{mb}m")


def small_splits(spark: SparkSession) -> None:
    """Let scans of this session have splits of at most ``SPLIT_MB``.

    For jobs that sort whole rows before they shuffle them (the map-side limit of
    the latest-row window): a typed row takes some twenty times its bytes in a
    Parquet file, so that tasks of 128 MB sort gigabytes and spill them. A lower
    setting stays."""
    _at_most(spark, "spark.sql.files.maxPartitionBytes", SPLIT_MB)


def small_partitions(spark: SparkSession, *inputs: DataFrame) -> None:
    """``small_splits``, and the same for what is sorted after a shuffle: one
    partition for every ``PARTITION_MB`` of the files of ``inputs``, which AQE
    merges up to ``SPLIT_MB`` of shuffled rows. A fixed number of partitions
    would grow with the tables until every sort spills its rows to disk. A larger
    number of partitions stays."""
    small_splits(spark)
    _at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", SPLIT_MB)
    try:
        sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs]
    except Exception:  # a Connect session exposes no plan: leave the number as it is
        return
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = -(-sum(sizes) // (PARTITION_MB << 20))
    if wanted > int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(key, str(wanted))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root.

    Streaming checkpoints, landed files and published table versions go
    here, so executors on any host can read what another one wrote.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/goldleaf/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "ensure_checkpoint_dir", "small_partitions", "small_splits", "scratch_path", "DEFAULT_CONF"]
