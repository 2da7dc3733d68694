"""Session defaults and the few cluster-level helpers every operator shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings this engine relies on. AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; ANSI stays on, so every
# parse is a try_* function. No join is broadcast on a *static estimate*
# (-1): a side is broadcast either because its row count was checked
# (``broadcast_if_small``) or because AQE measured its shuffle output below
# the adaptive threshold at run time.
ENGINE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "8MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def scale_settings(shuffle_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run.

    ``shuffle_bytes`` is the expected size of the largest shuffle (the
    contest view after column pruning, not the raw input). Partitions aim at
    ``target_partition_bytes`` so one sorts or hashes in executor memory
    without heavy spill, with at least 3 and at most 20 waves of the cores
    (more reducers only multiply shuffle blocks). AQE then coalesces the
    partitions that turn out small and splits skewed ones.
    """
    want = int(shuffle_bytes // target_partition_bytes) + 1
    parts = min(max(3 * total_cores, want), 20 * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "arenaspark") -> SparkSession:
    """A session with the engine defaults; on a cluster pass no master."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("ARENASPARK_DRIVER_MEMORY", "8g"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only in local mode, where
    the driver is the one executor, is a scratch folder made when it is unset; on
    a cluster a machine-local folder would lose data, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="arenaspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage, and what is read twice from it is the same rows in the
    same files both times."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows.

    Counts behind a limit, so each task stops after ``max_rows + 1`` rows and
    only one number reaches the driver. Checked anew at every call: a table that
    has grown is noticed."""
    return df.select(F.lit(1).alias("one")).limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint only behind a proven row bound; otherwise leave the
    strategy to Catalyst/AQE (sort-merge or shuffled hash join)."""
    if has_at_most(df, max_rows):
        return F.broadcast(df)
    return df


def local_test_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench (local mode only)."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    return build_session(f"local[{cores}]", shuffle_partitions)
