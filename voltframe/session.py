"""Session settings the plans rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Run-time re-planning: small partitions are merged, hot join keys are split even
# when the split costs one more exchange, and a side is only broadcast when its
# measured size is below spark.sql.autoBroadcastJoinThreshold.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A sort-merge join becomes a hash join when every measured build partition is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Rows of the grid become ten quads each, or pairs, in the task that reads them: tasks start small, so that what
    # they group and sort afterwards fits their memory at every size of the tables.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
}

# Whether the files of an execution's exchanges are deleted when it ends.
DELETE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders of intermediates that this process has written and not yet cleaned up.
WRITTEN: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local master, where driver and executors are one process, may do without: it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {context.master} share")
        folder = tempfile.mkdtemp(prefix="voltframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write a shared intermediate once as a table in the shared folder and read it back.

    The lineage ends there, so a lost executor recomputes nothing before it, and what was exchanged for it is deleted at
    once, where it would stay on disk beside the exchanges of the report until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    before = spark.conf.get(DELETE_EXCHANGES, None)
    spark.conf.set(DELETE_EXCHANGES, "true")
    try:
        writer.parquet(folder, compression=compression)
    finally:
        if before is None:
            spark.conf.unset(DELETE_EXCHANGES)
        else:
            spark.conf.set(DELETE_EXCHANGES, before)
    return spark.read.schema(df.schema).parquet(folder)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new name in the shared folder, remembered for `cleanup`."""
    folder = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    WRITTEN.append(folder)
    return folder


def cleanup(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediates written by this process, from the `since`-th on; returns how many.

    Call it when nothing that was built on them is still to be computed.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in WRITTEN[since:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
    gone = len(WRITTEN) - since
    del WRITTEN[since:]
    return gone
