"""What the training-data operators share: reading tables, words, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridlens.session import settle

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column = "text") -> Column:
    """A null text counts as the empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names that ``df`` does not have, so that extra columns never clash with helper columns."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        return name

    return tuple(free(n) for n in names)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the folder of ``spark.checkpoint.dir`` and go on from the files (no lineage to recompute)."""
    return settle(df, label)
