"""Batch results as files. Every writer is one distributed write; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def write_large_csv(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """CSV in files of at most ``rows_per_file`` rows."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, optionally in folders per value. Rows are brought together by folder first, so that not
    every task writes into every folder; adaptive execution splits a folder that holds most rows."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table bucketed by a unique key, for a dimension that every batch or micro-batch joins.

    Joins on the key then shuffle the events only. Use at least ``spark.sql.shuffle.partitions`` buckets.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_report(df: DataFrame, path: str) -> None:
    """A report table as JSON lines."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_batch_tables(tables: dict[str, DataFrame], folder: str, as_parquet: Collection[str]) -> None:
    """Tables that are read again as Parquet, the rest as CSV."""
    for name, table in tables.items():
        if name in as_parquet:
            write_parquet(table, f"{folder}/{name}")
        else:
            write_csv(table, f"{folder}/{name}.csv")


def read_batch_tables(spark: SparkSession, tables: dict[str, DataFrame], folder: str,
                      as_parquet: Collection[str]) -> dict[str, DataFrame]:
    """What ``write_batch_tables`` wrote, with the same types."""
    found = {}
    for name, table in tables.items():
        reader = spark.read.schema(table.schema)
        if name in as_parquet:
            found[name] = reader.parquet(f"{folder}/{name}")
        else:
            found[name] = reader.option("header", True).csv(f"{folder}/{name}.csv")
    return found


def export_dashboard_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        write_report(table, f"{folder}/{name}")
