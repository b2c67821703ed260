"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    # Parsed timestamps and their formatted text must agree on every executor.
    "spark.sql.session.timeZone": "UTC",
    # AQE sizes shuffle partitions and output files, and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # INT96, the default, has no column statistics, so key ranges could not be skipped.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Keys that streams remember are kept on disk; the default holds all of them in memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "stratalake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds to them or overrides them.

    Keyword names use ``__`` for the dots of a setting:
    ``build_session(spark__sql__shuffle__partitions="20000")``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


PARTITION_BYTES = 512 * 1024 * 1024
MIN_PARTITIONS, MAX_PARTITIONS = 200, 50_000


def shuffle_partitions_for(input_bytes: int) -> int:
    """How many partitions to shuffle an input of this stored size into.

    Spark's default of 200 would make partitions of 500 GB out of 100 TB. AQE merges partitions
    that turn out small, but splits only those of skewed joins and of file layout, so the number
    is chosen on the high side. Beyond the maximum the map outputs would become too many pieces.
    """
    return min(max(MIN_PARTITIONS, -(-input_bytes // PARTITION_BYTES)), MAX_PARTITIONS)


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Set the number of shuffle partitions, unless the job was started with one."""
    if not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions_for(input_bytes))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, which all executors share.

    A local master may do without the setting and then uses a folder of this machine; a cluster
    may not, for its executors would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stratalake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
