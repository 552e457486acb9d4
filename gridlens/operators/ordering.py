"""Positions and quantiles over a total order, computed by every task at once.

``row_number()`` over a whole table, or over one hot group, runs in one task. Here rows are range
partitioned, each range is numbered where it lies, and only one small row per range travels.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlens.session import settle

PARTITION_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def add_sequence(df: DataFrame, order_by: Sequence[str | Column], name: str = "secuencia",
                 per: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Number rows 1..n by ``order_by``, restarting for each ``per`` group.

    Give a stored table (a scan or ``settle``): its row position breaks ties, so that a large group of
    equal rows is spread over many ranges instead of landing in one.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in [*per, *order_by]] + [F.col("_row")]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(partitions, *order) if partitions else numbered.repartitionByRange(*order)
    placed = settle(
        ranged.sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id()).drop("_row"),
        "sequence",
    )
    span = F.shiftrightunsigned("_pos", PARTITION_BITS)
    spans = (
        placed.groupBy(span.alias("_span"), *per)
        .agg(F.min("_pos").alias("_first"), F.count("*").alias("_size"))
        .withColumn("_before", _sum_before("_size", per, "_span"))
    )
    spans = settle(spans.select(*[F.col(c).alias(f"_span_{c}") for c in per], "_span", "_first", "_before"), "spans")
    same_group = [F.col(c).eqNullSafe(F.col(f"_span_{c}")) for c in per]
    joined = placed.join(spans, reduce(lambda a, b: a & b, same_group, span == F.col("_span")))
    position = F.col("_pos") - F.col("_first") + F.col("_before") + 1
    return joined.select(*df.columns, position.alias(name))


#: Ranges of the sort key whose rows are counted to find a cut, and rows that are drawn to find the ranges.
CUT_RANGES, CUT_SAMPLE = 64, 4096


def first_rows(df: DataFrame, order_by: Sequence[str | Column], n: int | Column, name: str = "secuencia",
               per: Sequence[str] = (), ranges: int = CUT_RANGES) -> DataFrame:
    """The first ``n`` rows by ``order_by``, of each ``per`` group, numbered like ``add_sequence`` numbers them.

    Rows are counted by ranges of their key first. Only those up to the range that holds the n-th are shuffled and written:
    ``n`` and at most one range more, however long the table is. The table is read three times, so give a stored one. The
    ranges come from a bounded draw, which decides how many rows are too many and not which rows are right. A row's range is
    found by halving, in one comparison for each power of two below ``ranges``, and whether it is kept in one more.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in [*per, *order_by]]
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    # Copies of a row are drawn each by itself.
    drawn = df.select(key.alias("_k"), F.monotonically_increasing_id().alias("_row"))
    drawn = drawn.orderBy(F.xxhash64("_k", "_row")).limit(CUT_SAMPLE)
    listed = drawn.agg(F.array_sort(F.collect_list("_k")).alias("_all"))
    picked = F.transform(F.slice(F.sequence(F.lit(1), F.lit(ranges)), 1, ranges - 1), lambda i: F.get(
        "_all", F.floor(i * F.size("_all") / F.lit(ranges)).cast("int")))
    edges = settle(listed.select(F.array_distinct(F.filter(picked, lambda k: k.isNotNull())).alias("_edges")), "cut-edges")

    # Each step is a projection of its own that uses the key of the one before, so the key is worked out once a row.
    ranged = df.select(*per, key.alias("_key"), edges.scalar().alias("_edges"), F.lit(0).alias("_range"))
    for half in (1 << bit for bit in reversed(range((ranges - 1).bit_length()))):
        past = F.get("_edges", F.col("_range") + F.lit(half - 1)) < F.col("_key")
        ranged = ranged.withColumn("_range", F.col("_range") + F.when(past, half).otherwise(0))
    counted = ranged.groupBy(*per, "_range").agg(F.count("*").alias("_size"))
    counted = settle(counted.withColumn("_before", _sum_before("_size", per, "_range")), "cut-counts")
    wanted = F.lit(n) if isinstance(n, int) else n
    cuts = counted.filter(F.col("_before") < wanted).groupBy(*[F.col(c).alias(f"_cut_{c}") for c in per]).agg(F.max("_range").alias("_last"))
    # The upper edge of the last wanted range; the topmost one has none, and none wanted keeps nothing.
    cuts = cuts.select("*", F.get(edges.scalar(), F.col("_last")).alias("_edge"))
    cuts = settle(cuts, "cuts")

    def up_to(last: Column, edge: Column) -> Column:
        return last.isNotNull() & (edge.isNull() | (key <= edge))

    if per:
        same = [F.col(c).eqNullSafe(F.col(f"_cut_{c}")) for c in per]
        kept = df.join(cuts, reduce(lambda a, b: a & b, same)).filter(up_to(F.col("_last"), F.col("_edge")))
    else:
        cut = cuts.select(F.struct("_last", "_edge")).scalar()
        kept = df.filter(up_to(cut["_last"], cut["_edge"]))
    kept = settle(kept.select(*df.columns), "first-ranges")
    numbered = add_sequence(kept, order_by, name, per)
    return numbered.filter(F.col(name) <= wanted)


def _sum_before(measure: str, per: Sequence[str], order: str) -> Column:
    """Running total of the earlier rows. Used on span tables only: one row per range and group."""
    window = Window.partitionBy(*per).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(window), F.lit(0))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    discrete: bool = False, partitions: int | None = None) -> DataFrame:
    """Exact quantiles of several numeric columns as rows (columna, probabilidad, valor).

    Continuous quantiles interpolate linearly between neighbours; discrete ones are the smallest value
    whose cumulative share reaches the probability. Values are counted first (a value that fills a third
    of the table is one row afterwards), range partitioned, and only the ranges that hold a wanted rank
    are looked into. Nulls and NaN do not count.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "columna", "valor"
    )
    counted = (
        values.filter(F.col("valor").isNotNull() & ~F.isnan("valor"))
        .groupBy("columna", "valor").agg(F.count("*").alias("_n"))
    )
    order = ["columna", "valor"]
    ranged = counted.repartitionByRange(partitions, *order) if partitions else counted.repartitionByRange(*order)
    placed = settle(
        ranged.sortWithinPartitions(*order).withColumn("_span", F.spark_partition_id()), "value-counts"
    )

    spans = placed.groupBy("columna", "_span").agg(F.sum("_n").alias("_size"))
    spans = settle(spans.withColumn("_before", _sum_before("_size", ["columna"], "_span")), "value-spans")

    probability = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    totals = spans.groupBy("columna").agg(F.sum("_size").alias("_total"))
    targets = totals.select("columna", "_total", probability.alias("probabilidad"))
    if discrete:
        lower = F.greatest(F.ceil(F.col("probabilidad") * F.col("_total")) - 1, F.lit(0))
        targets = targets.select("columna", "probabilidad", lower.alias("_low"), lower.alias("_high"),
                                 F.lit(0.0).alias("_weight"))
    else:
        exact = F.col("probabilidad") * (F.col("_total") - 1)
        targets = targets.select("columna", "probabilidad", F.floor(exact).alias("_low"),
                                 F.ceil(exact).alias("_high"), (exact - F.floor(exact)).alias("_weight"))
    # One row per wanted rank: at most columns x probabilities x 2.
    ranks = targets.select("*", F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_rank"))
    hits = ranks.join(spans, "columna").filter(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_size"))
    )

    wanted = placed.join(F.broadcast(hits.select("columna", "_span").distinct()), ["columna", "_span"], "left_semi")
    inside = Window.partitionBy("columna", "_span").orderBy("valor").rowsBetween(Window.unboundedPreceding, -1)
    located = wanted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    found = located.join(F.broadcast(hits), ["columna", "_span"]).filter(
        F.col("_rank").between(F.col("_before") + F.col("_inside"),
                               F.col("_before") + F.col("_inside") + F.col("_n") - 1)
    )
    low = F.max(F.when(F.col("_rank") == F.col("_low"), F.col("valor")))
    high = F.max(F.when(F.col("_rank") == F.col("_high"), F.col("valor")))
    weight = F.max("_weight")
    # Interpolate from the nearer neighbour, as numpy does.
    value = F.when(weight >= 0.5, high - (high - low) * (1 - weight)).otherwise(low + (high - low) * weight)
    return found.groupBy("columna", "probabilidad").agg(value.alias("valor"))


def sketched_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                       relative_error: float = 0.01) -> DataFrame:
    """The same rows from a mergeable sketch: one pass, no sort, error bounded by ``relative_error``."""
    accuracy = max(1, round(1 / relative_error))
    chances = [float(p) for p in probabilities]
    sketch = df.agg(*[
        F.percentile_approx(F.col(c).cast("double"), chances, accuracy).alias(c) for c in columns
    ])
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in chances]).alias("p"), F.col("valores").alias("v"))
    return (
        sketch.unpivot([], list(columns), "columna", "valores")
        .select("columna", F.explode(pairs).alias("q"))
        .select("columna", F.col("q.p").alias("probabilidad"), F.col("q.v").alias("valor"))
    )


def quantile_row(quantiles: DataFrame, names: dict[tuple[str, float], str]) -> DataFrame:
    """Turn quantile rows into one row; ``names`` maps (column, probability) to an output column."""
    return quantiles.agg(*[
        F.max(F.when((F.col("columna") == column) & (F.col("probabilidad") == float(p)), F.col("valor"))).alias(name)
        for (column, p), name in names.items()
    ])


def random_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` pseudo-random rows (all rows when there are fewer), the same ones on every run.

    Rows are ordered by a keyed hash. Counting the first hash digits finds the digit up to which rows can
    matter, so the top-n sees about ``n`` rows instead of ``n`` per task.
    """
    draw = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    digits = df.groupBy(F.substring(draw, 1, 4).alias("_digits")).agg(F.count("*").alias("_n"))
    # At most 65,536 digit groups.
    running = Window.orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        digits.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .filter(F.col("_before") < n).agg(F.max("_digits").alias("_last"))
    )
    drawn = df.withColumn("_draw", draw).filter(F.substring("_draw", 1, 4) <= cut.scalar())
    return drawn.orderBy("_draw", *df.columns).limit(n).drop("_draw")
