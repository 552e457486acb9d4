"""Operator 12 against every query compared with every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.llm import collisions

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    good = [(n, i, [float(np.float32(x)) for x in e]) for n, (i, e, *_) in enumerate(rows)
            if e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    out = []
    for n, i, q in good:
        if i is None or i % every:
            continue
        near = []
        for m, j, v in good:
            if m != n and len(v) == len(q):
                score = 0.0
                for x, y in zip(q, v):
                    score += x * y
                near.append((-score, j is None, j or 0, j))
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(near, key=lambda s: s[:3])[:k])]
    return out


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return [tuple(r) for r in df.collect()]


def recall(got, want):
    a, b = {r[:1] + r[2:] for r in got}, {r[:1] + r[2:] for r in want}
    return len(a & b) / len(b)


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + k, [float(x) for x in v], 1) for k, v in enumerate(vectors)], SCHEMA)


def shapes():
    random = np.random.default_rng(5)
    centres = random.standard_normal((12, 32)) * 3
    yield "isotropic", random.standard_normal((1500, 32))
    yield "clusters", centres[random.integers(0, 12, 1500)] + random.standard_normal((1500, 32)) * 0.4
    plane = np.zeros((1500, 32))
    plane[:, :2] = random.standard_normal((1500, 2))
    yield "plane", plane
    yield "lengths", random.standard_normal((1500, 32)) * random.lognormal(0, 1.5, (1500, 1))


@pytest.mark.parametrize("name, vectors", list(shapes()))
def test_recall(spark, name, vectors):
    df = table(spark, vectors)
    got = found(collisions.search(df, F.col("vec_id") % 20 == 0, block=400, part=16).withColumnRenamed("id", "vec_id"))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert len(got) == len(want)
    assert recall(got, want) >= 0.97, name
    by_query = {}
    for q, r, v, s in sorted(got):
        by_query.setdefault(q, []).append((r, -s))
    assert all([r for r, _ in g] == list(range(1, 21)) and g == sorted(g) for g in by_query.values())


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [1.0, 0.5]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [2.0, 0.0]),
            (40, None), (60, [0.0, 0.0]), (80, [1.0, nan]), (5, [inf, 1.0]), (7, [None, 1.0]), (100, [1.0, 2.0, 3.0]),
            (120, []), (9, [-0.0, 1.0]), (11, [0.0, 1.0]), (2**60, [1.0, 0.0]), (2**60 + 1, [1.0, 0.0])]
    df = spark.createDataFrame([(i, e, None) for i, e in rows], SCHEMA)
    got = sorted(found(collisions.nearest_vectors(df)), key=repr)
    assert got == sorted(brute(rows), key=repr)
    assert {r[0] for r in got} == {0, 20, 2**60} - ({2**60} if 2**60 % 20 else set())


def test_copies(spark):
    """A vector that most rows hold: equal scores go by id, across its copies and other vectors."""
    random = np.random.default_rng(3)
    other = random.standard_normal((60, 8))
    other[7] = other[8] = [3.0] * 8
    vectors = np.concatenate((other[:30], np.tile([1.0] * 8, (400, 1)), other[30:]))
    df = table(spark, vectors).repartition(6)
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert sorted(found(collisions.nearest_vectors(df))) == sorted(want)


def test_few_empty_and_extra(spark):
    df = table(spark, [[1.0, 2.0], [2.0, 1.0], [1.0, 1.0]])
    assert len(found(collisions.nearest_vectors(df))) == 2
    assert found(collisions.nearest_vectors(df.limit(0))) == []
    assert found(collisions.nearest_vectors(df.limit(1))) == []
    more = df.select("*", *[F.lit(3).alias(c) for c in ("id", "vector", "query", "row", "node", "d", "least", "q", "score", "rank")])
    assert sorted(found(collisions.nearest_vectors(more))) == sorted(found(collisions.nearest_vectors(df)))


def test_threshold():
    """What it promises: vectors at the radius reach it nearly always, those at twice the radius hardly ever."""
    least = collisions.threshold()
    random = np.random.default_rng(1)
    at = np.abs(random.standard_normal((20_000, collisions.PROJECTIONS)))
    assert ((at <= collisions.WIDTH).sum(1) >= least).mean() >= collisions.CHANCE - 0.003
    assert ((2 * at <= collisions.WIDTH).sum(1) >= least).mean() < 0.08
