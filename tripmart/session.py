"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "tripmart", master: str | None = None, **confs: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC and adaptive execution.

    Shuffle partitions are left to the caller (see ``shuffle_partitions``); adaptive execution
    merges the small ones and splits skewed join and rebalance partitions.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **confs,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(shuffled_bytes: int, slots: int) -> int:
    """How many shuffle partitions keep each one near 128 MB, and every slot busy."""
    return max(slots, math.ceil(shuffled_bytes / TARGET_PARTITION_BYTES))


def cluster_settings(input_bytes: int, shuffled_bytes: int, slots: int) -> dict[str, str]:
    """Scan and shuffle sizes for a large run, to pass to ``build_session``.

    Scans keep Spark's 128 MB splits until every slot has some 50 of them, and then read larger ones,
    up to 1 GB, so that 100 TB are some 100,000 tasks and not close to a million.
    """
    split = min(max(input_bytes // (slots * 50), TARGET_PARTITION_BYTES), 8 * TARGET_PARTITION_BYTES)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes, slots)),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the whole of Spark runs on this machine.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"Set {SHARED_DIR_CONF} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tripmart-")


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class Stage:
    """Writes intermediate results as tables and reads them back.

    A staged table is computed once however often it is used, ends the lineage, and outlives lost
    executors. Each ``Stage`` has a folder of its own, so nothing is ever overwritten. ``close``, or the
    end of a ``with`` block, removes that folder; tables read from it can't be used any more.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_dir(spark)}/stage-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def close(self) -> None:
        remove_folder(self.spark, self.root)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()

    def table(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))
