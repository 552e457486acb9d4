import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import settle
from gridlens.operators.events import cap_rows_per_source, event_envelope, ordered_events
from gridlens.operators.ordering import add_sequence, exact_quantiles, random_rows, sketched_quantiles


@pytest.fixture
def skewed(spark):
    """A third of the rows share one source, one key and all values."""
    rng = random.Random(7)
    data = [("hot", 1, 1.0)] * 400 + [(f"s{rng.randrange(5)}", rng.randrange(200), rng.random()) for _ in range(800)]
    rng.shuffle(data)
    return settle(spark.createDataFrame(data, "source string, key int, value double").repartition(3)), data


def test_sequence_over_several_ranges(skewed):
    df, data = skewed
    out = rows(add_sequence(df, ["key", "value", "source"], "n", partitions=6))
    assert sorted(r[3] for r in out) == list(range(1, len(data) + 1))
    in_order = [r[:3] for r in sorted(out, key=lambda r: r[3])]
    assert [(k, x, s) for s, k, x in in_order] == sorted((k, x, s) for s, k, x in data)


def test_hot_rows_are_spread(skewed, spark):
    df, _ = skewed
    order = [F.col("key"), F.col("_row")]
    placed = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(6, *order)
    hot = placed.filter("source = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) > 1


def test_sequence_restarts_per_group_and_keeps_null_groups(spark):
    df = settle(spark.createDataFrame([("a", 3), ("a", 1), (None, 5), (None, 4), ("b", 9)], "g string, x int"))
    out = add_sequence(df, ["x"], "n", per=["g"], partitions=3)
    assert sorted(rows(out), key=str) == sorted(
        [("a", 1, 1), ("a", 3, 2), (None, 4, 1), (None, 5, 2), ("b", 9, 1)], key=str
    )


def test_cap_per_source_and_total(skewed):
    df, data = skewed
    capped = rows(cap_rows_per_source(df, "source", ["key", "value"], per_source=50).groupBy("source").count())
    counts = {s: sum(1 for d in data if d[0] == s) for s in {d[0] for d in data}}
    assert dict(capped) == {s: min(50, n) for s, n in counts.items()}
    even = rows(cap_rows_per_source(df, "source", ["key", "value"], total=61).groupBy("source").count())
    assert all(n == 61 // 6 for _, n in even)
    few = rows(cap_rows_per_source(df, "source", ["key"], total=2).groupBy("source").count())
    assert all(n == 1 for _, n in few)
    with pytest.raises(ValueError):
        cap_rows_per_source(df, "source", ["key"])


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_quantiles_equal_numpy(skewed, partitions):
    df, data = skewed
    chances = [0.0, 0.01, 0.25, 1 / 3, 0.5, 2 / 3, 0.99, 1.0]
    out = {(c, p): x for c, p, x in rows(exact_quantiles(df, ["key", "value"], chances, partitions=partitions))}
    for i, c in enumerate(("key", "value"), 1):
        for p in chances:
            assert out[c, p] == float(np.quantile(np.array([d[i] for d in data], float), p)), (c, p)


def test_discrete_quantiles_are_values(skewed):
    df, data = skewed
    values = sorted(d[2] for d in data)
    out = {p: x for _, p, x in rows(exact_quantiles(df, ["value"], [1 / 3, 2 / 3], discrete=True, partitions=5))}
    for p, x in out.items():
        assert x == values[int(np.ceil(p * len(values))) - 1]


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert rows(exact_quantiles(df, ["x"], [0.5])) == [("x", 0.5, 2.0)]


def test_sketch_is_close(skewed):
    df, data = skewed
    values = np.sort([d[2] for d in data])
    for _, p, x in rows(sketched_quantiles(df, ["value"], [0.25, 0.75], 0.01)):
        rank = np.searchsorted(values, x) / len(values)
        # The hot value fills ranks of its own.
        assert abs(rank - p) <= 0.02 or x == 1.0


def test_random_rows_are_exact_and_repeatable(skewed):
    df, data = skewed
    numbered = settle(add_sequence(df, ["key", "value", "source"], "n"))
    first, again = (sorted(rows(random_rows(numbered, "n", 100))) for _ in range(2))
    assert len(first) == 100 and first == again
    assert sorted(rows(random_rows(numbered, "n", 100, seed=1))) != first
    assert len(rows(random_rows(numbered, "n", 10_000))) == len(data)


def test_replay_order(spark):
    data = [("10", "2023-01-02"), ("9", "2023-01-02"), ("5", None), ("7", ""), ("1", "2023-01-01")]
    df = settle(spark.createDataFrame(data, "NRO_DOC_FAC string, FECHA_EMISION string"))
    order = ["5", "7", "1", "9", "10"]
    assert [r[0] for r in rows(ordered_events(df))] == order
    assert [r[0] for r in rows(ordered_events(df, max_events=3))] == order[:3]
    wrapped = event_envelope(df, "20250101_000000").select("_id_evento", "datos.NRO_DOC_FAC")
    assert sorted(rows(wrapped)) == [(f"SIM-20250101_000000-{i:08d}", k) for i, k in enumerate(order, 1)]
    assert len(rows(event_envelope(df, "x", max_events=2))) == 2


@pytest.mark.parametrize("n", [1, 7, 250, 5000])
def test_first_rows_equal_the_first_numbers(spark, n):
    from pyspark.sql import functions as F

    from gridlens.operators import ordering

    raw = spark.range(3000).select(
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("b"),
        F.when(F.col("id") % 2 == 0, F.lit("s")).when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 9).cast("string")).alias("s"))
    table = settle(raw.repartition(6), "rows")
    for per in ([], ["s"]):
        order = ["b", "a"]
        every = ordering.add_sequence(table, [*order, "s"], "n", per).filter(F.col("n") <= n)
        first = ordering.first_rows(table, [*order, "s"], n, "n", per)
        assert sorted(map(repr, first.collect())) == sorted(map(repr, every.collect()))


def test_first_rows_write_few(spark, monkeypatch):
    """Beyond the wanted rows only one range of the key is shuffled and written."""
    from pyspark.sql import functions as F

    from gridlens.operators import ordering

    seen = []
    number = ordering.add_sequence
    monkeypatch.setattr(ordering, "add_sequence", lambda df, *a, **k: (seen.append(df.count()), number(df, *a, **k))[1])
    table = settle(spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("v")), "values")
    assert ordering.first_rows(table, ["v"], 100).count() == 100
    assert seen[0] < 1500
    assert ordering.first_rows(table.limit(0), ["v"], 100).count() == 0
    assert ordering.first_rows(table.limit(3), ["v"], 100).count() == 3


@pytest.mark.parametrize("per", [[], ["s"]])
def test_first_rows_work_out_a_key_once_a_row(spark, monkeypatch, per):
    """Counting must not compare a row with every edge: nothing runs inside a lambda, where the key is worked out again."""
    from gridlens.operators import ordering

    plans = {}
    write = ordering.settle
    monkeypatch.setattr(ordering, "settle", lambda df, label: (
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString()), write(df, label))[1])
    table = settle(spark.range(500).select("id", (F.col("id") % 3).alias("s")), "values")
    order = [F.lpad(F.col("id").cast("string"), 20, "0")]
    assert ordering.first_rows(table, order, 7, "n", per).count() == 7 * max(1, 3 * len(per))
    assert "lambda" not in plans["cut-counts"] and "lambda" not in plans["first-ranges"]
    assert plans["cut-counts"].count("lpad(") == 1 and plans["first-ranges"].count("lpad(") == 1


@pytest.mark.parametrize("ranges", [1, 2, 5, 64])
def test_first_rows_of_any_number_of_ranges(spark, ranges):
    from gridlens.operators import ordering

    table = settle(spark.range(900).select((F.col("id") * 37 % 101).alias("v"), "id").repartition(3), "values")
    got = sorted(rows(ordering.first_rows(table, ["v", "id"], 123, "n", ranges=ranges), "n", "v", "id"))
    wanted = sorted((i * 37 % 101, i) for i in range(900))[:123]
    assert got == [(n, *row) for n, row in enumerate(wanted, 1)]
