"""Operator 6 on vectors that vary along few directions, and of several lengths."""

import numpy as np
import pytest

from gridlens.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    unit = {}
    for k, (i, e, label) in enumerate(rows):
        v = np.array(e, float)
        unit[k] = v / np.linalg.norm(v)
    n = len(rows)
    near = [[m for m in range(n) if m != k and rows[m][2] == rows[k][2] and len(unit[m]) == len(unit[k])
             and unit[k] @ unit[m] >= vectors.COSINE] for k in range(n)]
    least = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for k in range(n):
            low = min([least[k], *[least[m] for m in near[k]]])
            changed, least[k] = changed or low < least[k], low
    return sorted((rows[k][0], len(near[k]), least[k]) for k in range(n))


def rows_of(vectors_, labels=1):
    return [(k, [float(x) for x in v], k % labels) for k, v in enumerate(vectors_)]


def shapes():
    random = np.random.default_rng(2)
    plane = np.zeros((600, 64))
    plane[:, :2] = random.standard_normal((600, 2))
    few = np.zeros((600, 64))
    few[:, :4] = random.standard_normal((600, 4))
    base = random.standard_normal((150, 16))
    lengths = [list(v[:2 + k % 5]) for k, v in enumerate(random.standard_normal((200, 8)))]
    return [("plane", rows_of(plane)), ("subspace", rows_of(few, 2)),
            ("copies", rows_of(np.concatenate((base, base + random.standard_normal(base.shape) * 0.15)))),
            ("lengths", rows_of(lengths + lengths[:40] + [[1.0], [2.0], [-1.0], [0.5, 0.5, 0.5, 0.0], [0.5, 0.5, 0.5]]))]


@pytest.mark.parametrize("name, rows", shapes(), ids=lambda x: x if isinstance(x, str) else "")
def test_no_link_is_lost(spark, name, rows, monkeypatch):
    monkeypatch.setattr(vectors, "lists_for", lambda n: 24)  # many borders
    monkeypatch.setattr(vectors, "LIST_BLOCK", 64)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.vector_components(df).collect())
    assert got == brute(rows)
