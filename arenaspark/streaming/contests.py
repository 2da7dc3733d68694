"""Incremental upkeep of the two-sided team table with Structured Streaming.

The batch pipeline recomputes team statistics from the whole contest history.
When contests arrive as new files, the same operators run unchanged on a
streaming DataFrame: Spark keeps the per-entity partial aggregates as state
(checkpointed in the shared checkpoint folder) and each micro-batch only
reads the new files. Each batch writes the whole table to a folder of its own
(``version=<batch>``; a replayed batch writes the same folder again), so readers
of an earlier version are not disturbed; ``latest_team_table`` reads the newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arenaspark.operators.contests import two_sided_summary
from arenaspark.session import ensure_checkpoint_dir
from arenaspark.specs import ContestSpec


def running_team_table(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                       checkpoint: str | None = None, spec: ContestSpec = ContestSpec(),
                       fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Start one stream: contest files in ``source_dir`` -> team table versions in ``sink_dir``.

    ``available_now`` processes what is there and stops (batch-like
    scheduling); otherwise it keeps running with the default trigger.
    """
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/team_table"
    contests = spark.readStream.schema(schema).format(fmt).load(source_dir)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/version={epoch}")

    w = (two_sided_summary(contests, spec).writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    return (w.trigger(availableNow=True) if available_now else w).start()


def latest_team_table(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The newest complete version of the team table (A1 and A2 columns)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(sink_dir.rstrip("/"))
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in fs.listStatus(fs_path) if f.getPath().getName().startswith("version=")
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    newest = max(done, key=lambda p: int(p.getName().split("=")[1]))
    return spark.read.parquet(newest.toString())
