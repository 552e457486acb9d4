"""Operator 6: near-duplicate vectors by product quantisation.

Coarse centroids and the codebooks of the residuals' subspaces are fitted on ``SAMPLE`` vectors at most; every vector is
indexed. A vector lies in the inverted list of its nearest centroid and is looked for in every list whose border is
within half the distance of a linked pair: there is no limit on the number of probes. Two linked vectors in two lists lie on
either side of the border, so one of them is that near to it and no link is lost, however the vectors are spread. In a
list the distance to each code comes from tables (asymmetric: the query is not quantised) and a pair stays a candidate
unless code distance and quantisation error together prove it too far; candidates are reranked by the exact cosine.

Equal vectors of a label are one class with a count. Large lists are met block by block, and a block returns counts and
the links of its components' trees, never its pairs.

Lengths are fitted together up to the next power of two, shorter vectors filled up with zeros, which no cosine feels.

Defined cases: vectors that are null, zero, or that hold null or non-finite components link with nothing, nor do vectors with a
null label or of different lengths; extra columns are not looked at; repeated ids are vectors of their own; vectors with a null id link and
count, and a component of null ids only has a null component_id; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlens.llm.common import stored
from gridlens.llm.components import components

COSINE = 0.93
SAMPLE = 16_384
SUBSPACES, CODES = 8, 64
ROUNDS = 8
#: Vectors of a list, and vectors looked for in it, that meet in one task.
LIST_BLOCK, QUERY_BLOCK = 2048, 8192


def lists_for(rows: int) -> int:
    """Coarse lists grow with the root of the number of vectors."""
    return int(min(4096, max(16, round(rows ** 0.5 / 4))))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * x @ centres.T, axis=1)


def _means(x: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    centres = x[random.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = _nearest(x, centres)
        size = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class Index:
    """Coarse centroids and a codebook for each subspace: bounded by the parameters above."""

    centres: np.ndarray
    books: list[np.ndarray]
    cosine: float

    @property
    def reach(self) -> float:
        """Distance of unit vectors at the least cosine."""
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine)))

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.books), axis=1)

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each unit vector, and for each list whether it is looked into."""
        d = (self.centres ** 2).sum(1) - 2 * x @ self.centres.T
        own = np.argmin(d, axis=1)
        between = np.sqrt(np.maximum(((self.centres[:, None] - self.centres[None]) ** 2).sum(2), 1e-18))
        gap = (d - d[np.arange(len(x)), own][:, None]) / (2 * between[own])
        gap[np.arange(len(x)), own] = 0.0
        return own, gap <= self.reach / 2 + 1e-9

    def codes(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of each residual and the distance to what they stand for."""
        parts = self.parts(residual)
        codes = np.stack([_nearest(p, b) for p, b in zip(parts, self.books)], axis=1)
        error = sum(((p - b[c]) ** 2).sum(1) for p, b, c in zip(parts, self.books, codes.T))
        return codes, np.sqrt(error)

    def near(self, queries: np.ndarray, members: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member of list ``at``) with at least the least cosine."""
        centre = self.centres[at]
        codes, error = self.codes(members - centre)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        step = max(1, (1 << 21) // max(len(members), 1))
        for k in range(0, len(queries), step):
            some = queries[k:k + step]
            far = np.zeros((len(some), len(members)))
            for part, book, code in zip(self.parts(some - centre), self.books, codes.T):
                table = (part ** 2).sum(1)[:, None] + (book ** 2).sum(1) - 2 * part @ book.T
                far += table[:, code]
            i, j = np.nonzero(np.sqrt(np.maximum(far, 0)) <= self.reach + error + 1e-6)
            for m in range(0, len(i), 1 << 18):
                a, b = i[m:m + (1 << 18)], j[m:m + (1 << 18)]
                good = np.einsum("ij,ij->i", some[a], members[b]) >= self.cosine
                found.append((a[good] + k, b[good]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))


def fit(sample: np.ndarray, rows: int, cosine: float, seed: int = 11) -> Index:
    random = np.random.default_rng(seed)
    centres = _means(sample, lists_for(rows), random)
    residual = sample - centres[_nearest(sample, centres)]
    books = [_means(p, CODES, random) for p in np.array_split(residual, min(SUBSPACES, sample.shape[1]), axis=1)]
    return Index(centres, books, cosine)


def _unit(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors of length 1, filled up with zeros to ``width``."""
    x = np.zeros((len(vectors), width))
    for row, v in zip(x, vectors):
        row[:len(v)] = v
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: str | Column) -> Column:
    """Neither null nor zero, all components finite."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    vector = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda v: v != 0), F.lit(False))


def _links(classes: DataFrame, index: Index) -> DataFrame:
    """node, links (vectors linked, copies counted), root (smallest class of the block's component), per block."""
    plain = (index.centres, index.books, index.cosine)
    width, lists = index.centres.shape[1], len(index.centres)

    @F.pandas_udf("struct<own: int, probes: array<int>>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        own, looked = Index(*plain).probes(_unit(vectors, width))
        return pd.DataFrame({"own": own, "probes": [np.flatnonzero(r) for r in looked]})

    placed = stored(classes.withColumn("at", place("vector")), "placed")
    members = placed.select("label", "d", F.col("at.own").alias("list"), "node", "n", "vector", F.col("at.probes").alias("probes"))
    queries = placed.select("label", "d", F.explode("at.probes").alias("list"), "node", "n", "vector", F.col("at.own").alias("own"))
    group = ["label", "d", "list"]
    sizes = members.groupBy(*group).agg(F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("blocks"))
    asked = queries.groupBy(*group).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts"))
    sizes = stored(sizes.join(asked, group), "list-sizes")
    spread = F.xxhash64("node")
    members = members.join(sizes, group).select(
        *group, F.pmod(spread, "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "n", "vector", "probes")
    queries = queries.join(sizes, group).select(
        *group, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(spread, "parts").cast("int").alias("part"), "node", "n", "vector", "own")
    queries = queries.toDF(*[f"q_{c}" for c in queries.columns])

    def meet(key: tuple, m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        if not len(m) or not len(q):
            return none
        here = int(key[2])
        i, j = Index(*plain).near(_unit(q["q_vector"], width), _unit(m["vector"], width), here)
        a, b = q["q_node"].to_numpy(), m["node"].to_numpy()
        i, j = i[a[i] != b[j]], j[a[i] != b[j]]
        if not len(i):
            return none
        nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
        left, right = place[:len(a)][i], place[len(a):][j]
        root = np.arange(len(nodes))
        while True:  # smallest node reachable within the block
            low = root.copy()
            np.minimum.at(low, left, root[right])
            np.minimum.at(low, right, root[left])
            low = low[low]
            if (low == root).all():
                break
            root = low
        links = np.bincount(left, m["n"].to_numpy()[j], len(nodes))
        # A member that does not look into the query's list is credited here, all others where they look.
        looks = np.zeros((len(m), lists), bool)
        for row, probed in zip(looks, m["probes"]):
            row[probed] = True
        once = ~looks[j, q["q_own"].to_numpy()[i]]
        links += np.bincount(right[once], q["q_n"].to_numpy()[i[once]], len(nodes))
        met = np.unique(np.concatenate((left, right)))
        return pd.DataFrame({"node": nodes[met], "links": links[met].astype(np.int64), "root": nodes[root[met]]})

    keys = [*group, "block", "part"]
    return members.groupBy(*keys).cogroup(queries.groupBy(*[f"q_{k}" for k in keys])).applyInPandas(meet, "node long, links long, root long")


def _sizes(classes: DataFrame) -> list[tuple[int, int, int]]:
    """Least and greatest length, and number, of the vectors of each group of lengths (a power of two each)."""
    power = F.ceil(F.log2("d"))
    rows = classes.groupBy(power.alias("power")).agg(F.min("d").alias("least"), F.max("d").alias("most"), F.count("*").alias("n"))
    return [(r["least"], r["most"], r["n"]) for r in rows.collect()]


def near_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """id, n_links, component_id, kept for every row."""
    own = rows.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    good = usable("vector") & F.col("label").isNotNull()
    grouped = own.filter(good).groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()).withColumn("d", F.size("vector")), "vector-classes")
    sizes = _sizes(classes)
    out = own.select("id", "vector", "label", F.coalesce(good, F.lit(False)).alias("good"))
    if not sizes:
        return out.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))

    parts = []
    for shortest, width, count in sizes:
        some = classes.filter(F.col("d").between(shortest, width))
        share = max(1, -(-count // SAMPLE))
        sample = some.filter(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select("vector").toPandas()
        sample = sample if len(sample) else some.limit(1).select("vector").toPandas()
        index = fit(_unit(sample["vector"], width), count, cosine)
        parts.append(stored(_links(some, index), "links-of-blocks"))
    met = reduce(DataFrame.union, parts)
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(met.filter("node <> root"), "node", "root")
    described = classes.join(links, "node", "left").join(joined, "node", "left").select(
        "label", "vector", "least", "n", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "node").alias("component"))
    described = stored(described, "vector-links")
    smallest = described.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = described.join(smallest, "component").select(
        "label", "vector", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    linked = out.filter("good").drop("good").join(by_class, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = out.filter(~F.col("good")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.union(alone)
    return every.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def vector_components(rows: DataFrame) -> DataFrame:
    """The contract's rows."""
    return near_vectors(rows).withColumnRenamed("id", "vec_id")


def sql() -> str:
    """DuckDB SQL for ``vector_components``: every pair of a label."""
    return f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
    reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
    least AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
    degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.y, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(least.y, vec_id)) AS kept
    FROM embeddings LEFT JOIN least ON least.x = vec_id LEFT JOIN degree ON degree.x = vec_id"""
