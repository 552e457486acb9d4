"""Folders of raw CSV files whose separators and columns may differ from file to file.

The layout of a file is read from its head: one small task for each file takes the first lines and stops, so the folder is
scanned once. Layouts are a table of files; the driver sees the different ones only.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridlens.functions.text import clean_header
from gridlens.operators.events import cap_rows_per_source
from gridlens.session import scratch_path, settle

# Candidate separators; on equal counts the earlier one wins.
SEPARATORS = (";", ",", "\t")
# Fixed value: the encoding raw files come in. A UTF-8 byte-order mark is taken off headers under it too.
ENCODING = "ISO-8859-1"
NO_SEPARATOR = "\u0001"
SOURCE = "_source"
MALFORMED = "_malformed"
#: Files of another layout than the usual one whose paths are broadcast; with more of them rows are joined by path.
BROADCAST_FILES = 1 << 17
#: A size so large that Spark makes every file one task of its own and splits none.
ONE_FILE = str(1 << 40)


def _lines(spark: SparkSession, path: str | Sequence[str], encoding: str, header: bool) -> DataFrame:
    """file and line of every row; ``header`` leaves out the first one of each file, by its position."""
    return (
        spark.read.schema("line string").option("sep", NO_SEPARATOR).option("quote", "").option("header", header)
        .option("encoding", encoding).option("pathGlobFilter", "*.csv")
        .csv(path if isinstance(path, str) else list(path))
        .select(F.col("_metadata.file_path").alias(SOURCE), "line")
    )


def file_heads(spark: SparkSession, path: str | Sequence[str], encoding: str = ENCODING, num_lines: int = 5) -> DataFrame:
    """file, n, line: the first lines of each file.

    A session of its own, whose settings give each file to one task; a task hands over the first lines and ends, so the rest
    of its file is not read.
    """
    own = spark.newSession()
    for name, value in (("spark.sql.files.maxPartitionBytes", ONE_FILE), ("spark.sql.files.openCostInBytes", ONE_FILE),
                        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(num_lines))):
        own.conf.set(name, value)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = 0
        for batch in batches:
            batch = batch.slice(0, num_lines - taken)
            places = pa.array(range(taken, taken + batch.num_rows), pa.int32())
            taken += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), places, batch.column(1)], ["file", "n", "line"])
            if taken == num_lines:
                return

    schema = "file string, n int, line string"
    kept = scratch_path(spark, "file-heads")
    _lines(own, path, encoding, header=False).mapInArrow(first, schema).write.parquet(kept)
    return spark.read.schema(schema).parquet(kept)


def file_layouts(spark: SparkSession, path: str | Sequence[str], encoding: str = ENCODING,
                 num_lines: int = 5) -> DataFrame:
    """Header line and separator of each file, judged by its first lines."""
    def occurrences(separator: str) -> Column:
        return F.sum(F.length("line") - F.length(F.replace("line", F.lit(separator), F.lit(""))))

    counts = file_heads(spark, path, encoding, num_lines).groupBy("file").agg(
        F.min_by("line", "n").alias("header"), *[occurrences(s).alias(f"_c{i}") for i, s in enumerate(SEPARATORS)]
    )
    best = F.greatest(*[F.col(f"_c{i}") for i in range(len(SEPARATORS))])
    separator = reduce(
        lambda rest, i: F.when(F.col(f"_c{i}") == best, F.lit(SEPARATORS[i])).otherwise(rest),
        reversed(range(len(SEPARATORS))), F.lit(SEPARATORS[0]),
    )
    return counts.select("file", "header", separator.alias("separator"))


def detect_separator(spark: SparkSession, path: str | Sequence[str], encoding: str = ENCODING,
                     num_lines: int = 5) -> DataFrame:
    return file_layouts(spark, path, encoding, num_lines).select("file", "separator")


@dataclass(frozen=True)
class Layout:
    """What the files of one header line have in common."""

    header: str
    separator: str
    files: int

    @property
    def names(self) -> list[str]:
        found = next(csv.reader([clean_header(self.header)], delimiter=self.separator))
        return [clean_header(name) for name in found]

    @property
    def places(self) -> dict[str, int]:
        """Place of each column, under its name in lower case."""
        found = {name.lower(): i for i, name in enumerate(self.names)}
        if len(found) < len(self.names):
            raise PySparkValueError(f"a column name is repeated in the header {self.header!r}")
        return found


def _different(layouts: DataFrame) -> list[Layout]:
    """The different layouts, in the order of their first files."""
    found = layouts.groupBy("header", "separator").agg(F.count("*").alias("files"), F.min("file").alias("first"))
    return [Layout(r["header"], r["separator"], r["files"]) for r in found.orderBy("first").collect()]


def _with_kind(rows: DataFrame, layouts: DataFrame, kinds: Sequence[Layout]) -> DataFrame:
    """``rows`` with the number of their file's layout. Only files of another layout than the usual one are looked up."""
    usual = max(range(len(kinds)), key=lambda i: kinds[i].files)
    if len(kinds) == 1:
        return rows.withColumn("_kind", F.lit(usual))
    spark = rows.sparkSession
    numbers = spark.createDataFrame([(k.header, k.separator, i) for i, k in enumerate(kinds)], "header string, separator string, _other int")
    others = layouts.join(F.broadcast(numbers), ["header", "separator"]).filter(F.col("_other") != usual).select(
        F.col("file").alias("_file"), "_other")
    others = settle(others, "other-layouts")
    if sum(k.files for k in kinds) - kinds[usual].files <= BROADCAST_FILES:
        others = F.broadcast(others)
    joined = rows.join(others, F.col(SOURCE) == F.col("_file"), "left")
    return joined.withColumn("_kind", F.coalesce("_other", F.lit(usual))).drop("_file", "_other")


def _cells(spark: SparkSession, path: str | Sequence[str], layouts: DataFrame, kinds: Sequence[Layout],
           encoding: str) -> DataFrame:
    """SOURCE, ``_kind`` and the cells of every row, in one scan. With one separator Spark's reader splits the rows; lines of
    different ones are split by their file's. Both take headers off by position."""
    places = [f"_{i}" for i in range(1 + max(len(k.names) for k in kinds))]
    schema = ", ".join(f"`{p}` string" for p in places)
    separators = sorted({k.separator for k in kinds})
    if len(separators) == 1:
        rows = (
            spark.read.schema(schema).option("header", True).option("sep", separators[0]).option("encoding", encoding)
            .option("mode", "PERMISSIVE").option("pathGlobFilter", "*.csv")
            .csv(path if isinstance(path, str) else list(path))
            .select(F.col("_metadata.file_path").alias(SOURCE), F.array(*places).alias("_cells"))
        )
        return _with_kind(rows, layouts, kinds)
    lines = _with_kind(_lines(spark, path, encoding, header=True), layouts, kinds)
    own = F.get(F.array(*[F.lit(k.separator) for k in kinds]), F.col("_kind"))

    def split(separator: str) -> Column:
        return F.from_csv("line", schema, {"sep": separator, "mode": "PERMISSIVE"})

    first, *rest = separators
    row = reduce(lambda other, s: F.when(own == s, split(s)).otherwise(other), rest, split(first))
    # A generator, so that neither a filter nor the columns split a line once more each.
    return lines.select(SOURCE, "_kind", F.inline(F.array(row))).select(SOURCE, "_kind", F.array(*places).alias("_cells"))


def read_csv_folder(spark: SparkSession, path: str | Sequence[str], encoding: str = ENCODING,
                    separator: str | None = None, columns: Sequence[str] | None = None,
                    max_per_file: int | None = None, max_total: int | None = None,
                    keep_source: bool = False, first_files: int | None = None,
                    keep_malformed: bool = False) -> DataFrame:
    """Every CSV file of a folder, stacked by column name, all columns as text.

    The layouts are taken from the heads of the files; the driver sees one row per different layout. ``separator`` is used
    for all files; with ``columns`` too, every file must have just these columns, in whatever order.
    Only the first line of a file is its header: a later line that looks like it is a row.
    Rows with more fields than the header are left out; ``keep_malformed`` keeps them, marked, so that they can be
    counted.
    ``max_per_file`` and ``max_total`` limit the rows of each file, ``first_files`` the files by name.
    """
    layouts = file_layouts(spark, path, encoding)
    if first_files is not None:
        layouts = layouts.orderBy("file").limit(first_files)
        path = [r["file"] for r in layouts.select("file").collect()]
    if separator:
        layouts = layouts.withColumn("separator", F.lit(separator))
    kinds = _different(layouts)
    if not kinds:
        raise FileNotFoundError(f"no CSV files in {path}")
    if separator and columns:
        wanted = {c.lower() for c in columns}
        if wrong := next((k for k in kinds if set(k.places) != wanted), None):
            raise PySparkValueError(f"{wrong.files} files have the header {wrong.header!r}, not {list(columns)}")
        names = list(columns)
    else:
        spellings: dict[str, str] = {}  # of those that differ in case the first counts
        for kind in kinds:
            for name in kind.names:
                spellings.setdefault(name.lower(), name)
        names = list(spellings.values())

    rows = _cells(spark, path, layouts, kinds, encoding)

    def cell(place_of: list[int | None]) -> Column:
        place = F.lit(place_of[0]) if len(set(place_of)) == 1 else F.get(F.array(*[F.lit(p).cast("int") for p in place_of]), F.col("_kind"))
        return F.get("_cells", place.cast("int"))

    stacked = rows.select(
        *[cell([k.places.get(name.lower()) for k in kinds]).alias(name) for name in names],
        SOURCE, cell([len(k.names) for k in kinds]).isNotNull().alias(MALFORMED))
    if not keep_malformed:
        stacked = stacked.filter(~F.col(MALFORMED)).drop(MALFORMED)
    if max_per_file or max_total:
        order = [c for c in stacked.columns if c != SOURCE]
        stacked = cap_rows_per_source(stacked, SOURCE, order, max_per_file, None if max_per_file else max_total)
    return stacked if keep_source else stacked.drop(SOURCE)


def sample_first_files(spark: SparkSession, path: str, rows: int = 200_000, files: int = 3,
                       encoding: str = ENCODING) -> DataFrame:
    """The first files by name, ``rows`` spread evenly over them."""
    return read_csv_folder(spark, path, encoding, first_files=files, max_total=rows)
