"""Operators 6 and 7 against all pairs."""

import numpy as np
from pyspark.sql import functions as F

from gridlens.llm import simhash, vectors
from gridlens.llm.components import components


def _least(n, links, ids):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [low.get(find(i)) for i in range(n)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(300, 200), (200, 250), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 140)} == {100} and got[300] == got[250] == 200
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_masks_leave_every_choice_of_blocks():
    for blocks in (6, 8):
        chosen = [m & (1 << 64) - 1 for m in simhash.masks(blocks, 4)]
        for _ in range(50):
            flips = sum(1 << int(b) for b in np.random.default_rng(blocks).choice(64, 4, replace=False))
            assert any(not m & flips for m in chosen)


def test_fingerprint_components(documents, odd):
    rows = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    texts = rows.collect()
    prints = [simhash._fingerprint(r.text, 4) for r in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 4]
    want = sorted(zip([r.doc_id for r in texts], [format(p & (1 << 64) - 1, "016x") for p in prints],
                      _least(len(texts), links, [r.doc_id for r in texts])), key=repr)
    assert sorted(map(tuple, simhash.document_components(rows).collect()), key=repr) == want


def test_dense_group_of_near_fingerprints(spark):
    random = np.random.default_rng(3)
    base = random.integers(0, 1 << 62)
    values = {int(base)}
    for _ in range(400):
        values.add(int(base) ^ sum(1 << int(b) for b in random.choice(62, random.integers(1, 4), replace=False)))
    values |= {int(v) for v in random.integers(0, 1 << 62, 200)}
    values = sorted(values)
    links = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    want = dict(zip(values, _least(len(values), links, values)))
    got = {r.node: r.component for r in simhash.near_components(spark.createDataFrame([(v,) for v in values], "f long"), "f").collect()}
    groups = {}
    for v, c in want.items():
        groups.setdefault(c, []).append(v)
    for group in groups.values():
        if len(group) > 1:
            assert len({got[v] for v in group}) == 1
    assert len({got[v] for v in got}) == sum(len(g) > 1 for g in groups.values())


def test_one_document_of_each_group(odd, clashing, empty):
    rows = odd.select("doc_id", "text")
    groups = {r.group for r in simhash.near_duplicates(rows, words=5).collect()}
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert sorted(r.doc_id for r in kept.filter("doc_id in (1, 2)").collect()) == [1]
    assert simhash.one_of_each(clashing).columns == clashing.columns
    assert simhash.one_of_each(empty).count() == 0 and simhash.document_components(empty).count() == 0


def _vectors():
    random = np.random.default_rng(5)
    rows = [(i, random.normal(size=16).tolist(), int(i % 3)) for i in range(120)]
    centre = random.normal(size=16)
    rows += [(200 + i, (centre + random.normal(size=16) * 0.08).tolist(), 1) for i in range(80)]
    rows += [(300, rows[0][1], 0), (300, rows[0][1], 0), (301, (np.array(rows[0][1]) * 3).tolist(), 0), (302, rows[0][1], 1)]
    rows += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] * 16, 0), (403, [None] * 16, 0), (404, [1.0], 0),
             (405, rows[0][1], None), (None, rows[5][1], 2), (406, [float("inf")] + [0.0] * 15, 0)]
    return rows


def test_vectors_against_all_pairs(spark):
    rows = _vectors()
    ok = [v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v) and lab is not None for _, v, lab in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2]:
                a, b = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                    links.append((i, j))
    degree = np.bincount([x for p in links for x in p], minlength=len(rows))
    component = _least(len(rows), links, [r[0] for r in rows])
    want = sorted(((r[0], int(d), c, r[0] == c) for r, d, c in zip(rows, degree, component)), key=repr)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, vectors.vector_components(frame).collect()), key=repr)
    assert got == want
    assert vectors.vector_components(frame.limit(0)).count() == 0
    assert vectors.vector_components(frame.filter("vec_id between 400 and 404")).count() == 5


def test_recall_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    noisy = frame.union(frame.filter("vec_id < 200").select(
        (F.col("vec_id") + 10_000).alias("vec_id"),
        F.transform("embedding", lambda v, i: (v + F.sin(i * 7.0 + F.col("vec_id")) * 0.035).cast("float")).alias("embedding"), "label"))
    table = noisy.toPandas()
    x = np.stack(table.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (table.label.to_numpy()[:, None] == table.label.to_numpy()[None])
    np.fill_diagonal(near, False)
    found = vectors.vector_components(noisy).agg(F.sum("n_links")).first()[0]
    assert near.sum() > 300 and found >= 0.99 * near.sum() and found <= near.sum()
