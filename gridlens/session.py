"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when the split costs a later aggregation one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Plans of many steps write each step's result: what was shuffled for it goes when the step has ended.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Hourly windows x districts outgrow the heap on a large stream; RocksDB keeps state off it.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TASKS_PER_CORE = 4
DEFAULT_PARTITIONS = "200"
CHECKPOINT_SETTING = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    # The default of 200 shuffle partitions is too many for one machine, above all for streaming state,
    # and starves a large cluster, where adaptive execution merges what turns out small.
    cores = spark.sparkContext.defaultParallelism
    if not spark.sparkContext.master.startswith("local"):
        if spark.conf.get(INITIAL_PARTITIONS, None) is None:
            size_shuffles(spark, TASKS_PER_CORE * cores)
    elif spark.conf.get("spark.sql.shuffle.partitions") == DEFAULT_PARTITIONS:
        spark.conf.set("spark.sql.shuffle.partitions", str(cores))
    return spark


def size_shuffles(spark: SparkSession, partitions: int) -> None:
    """Start shuffles with at least ``partitions`` partitions. Aim at a few hundred MB per partition."""
    partitions = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))


def build_session(app_name: str = "gridlens", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


_named: list[str] = []


def use_folder(path: str) -> None:
    """The folder for written intermediate tables of a local session that names none, as in tests."""
    _named[:] = [path]


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Where it names none: a folder in the warehouse, which
    every executor reaches too, or in one process the one given to ``use_folder``."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named and _named and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        named = _named[0]
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/gridlens/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Lost executors then re-read files instead of repeating the work, and the planner knows the real
    size: a settled table is broadcast only when it is below ``spark.sql.autoBroadcastJoinThreshold``,
    otherwise the join shuffles both sides.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
