"""Operator 12: nearest neighbours by inner product, by counting collisions of query-centred windows.

Vectors get one more component, which gives all of them the length of the longest, and queries a zero there: the nearest by
distance are then those of largest inner product. Every projection on a random direction is one sorted array. Around a query's
own projection a window of half-width ``WIDTH`` x radius is opened in each array: two binary searches give its ends, and the
ranks of the vectors tell which of them lie inside. A vector within the radius falls into each window with at least a known
probability, so one that collides in ``threshold`` of them is verified by its exact inner product. The first radius is that of
the nearest of a few vectors of the block. While fewer than the wanted number are verified within the radius it grows, by
``GROWTH`` or to the distance of the last wanted one (virtual rehashing: the arrays stay, the windows widen). Windows of the
largest radius hold everything.

Vectors are dealt to blocks by a hash, and every block is an index of its own that is met by all queries in parts; a block
returns the best of each query and never its candidates. The number of blocks grows with the rows, blocks do not. The work is
that of the method: queries x rows x projections. Directions are drawn with a fixed seed.

Equal vectors (told apart by two 64-bit hashes) are one class, so a vector that a third of all rows hold is searched once. Of
its copies only the ``k`` + 1 of smallest id can be among anybody's ``k`` nearest; Spark keeps so many in each task before they
are exchanged.

Defined cases: vectors that are null, zero, or hold null or non-finite components are neither queries nor candidates; a query
meets the vectors of its own length only; null ids are candidates, after all others among equal scores, and never queries;
rows of one id are rows of their own, each a candidate of the others; fewer candidates than ``k`` are all returned; an empty
table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb, erf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlens.llm.common import stored
from gridlens.llm.vectors import usable

NEAREST = 20
QUERY_EVERY = 20
PROJECTIONS = 64
#: Half a window, in radii.
WIDTH = 1.0
GROWTH = 1.1
#: Least probability that a vector at the radius reaches the threshold.
CHANCE = 0.9995
#: Vectors of an index (ranks take 16 bits), and queries that meet it in one task.
BLOCK, PART = 16_384, 512
#: Queries whose collisions are counted at once.
AT_ONCE = 32
FOUND = "q long, node long, score double"


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, chance: float = CHANCE) -> int:
    """The most collisions that a vector at the radius reaches with probability ``chance``."""
    p = erf(width / np.sqrt(2))
    above, at = 0.0, projections + 1
    while above < chance and at > 1:
        at -= 1
        above += comb(projections, at) * p ** at * (1 - p) ** (projections - at)
    return at


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, added component by component: the same double whatever rows stand beside."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[:, k]
    return total


@dataclass(frozen=True)
class Arrays:
    """Sorted projections of the vectors of a block, and each vector's rank in them."""

    vectors: np.ndarray
    directions: np.ndarray
    values: np.ndarray  # projections x vectors, each row sorted
    ranks: np.ndarray  # projections x vectors
    longest: float

    @classmethod
    def build(cls, vectors: np.ndarray, longest: float, projections: int = PROJECTIONS, seed: int = 7) -> Arrays:
        if not 0 < len(vectors) < 1 << 16 or projections > 255:
            raise ValueError("ranks are 16-bit, counts 8-bit numbers")
        directions = np.random.default_rng(seed).standard_normal((projections, vectors.shape[1] + 1))
        spare = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(1), 0.0))
        values = directions[:, :-1] @ vectors.T + directions[:, -1:] * spare
        order = np.argsort(values, axis=1, kind="stable")
        ranks = np.empty(values.shape, np.uint16)
        np.put_along_axis(ranks, order, np.broadcast_to(np.arange(len(vectors), dtype=np.uint16), values.shape), axis=1)
        return cls(vectors, directions, np.take_along_axis(values, order, axis=1), ranks, longest)

    def collisions(self, centre: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """queries x vectors: in how many arrays the window around the query holds the vector."""
        counts = np.zeros((len(centre), len(self.vectors)), np.uint8)
        for value, rank, own in zip(self.values, self.ranks, centre.T):
            low = np.searchsorted(value, own - reach, side="left")
            size = np.searchsorted(value, own + reach, side="right") - low
            # A rank below the window wraps round to a large number.
            counts += (rank - low.astype(np.uint16)[:, None]) < size.astype(np.uint16)[:, None]
        return counts

    def nearest(self, queries: np.ndarray, k: int, ties: np.ndarray, least: int, width: float = WIDTH,
                growth: float = GROWTH) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places of its ``k`` best vectors, and their scores; ``ties`` orders equal scores."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(queries), AT_ONCE):
            out += self._nearest(queries[at:at + AT_ONCE], min(k, len(self.vectors)), ties, least, width, growth)
        return out

    def _nearest(self, queries: np.ndarray, k: int, ties: np.ndarray, least: int, width: float,
                 growth: float) -> list[tuple[np.ndarray, np.ndarray]]:
        centre = queries @ self.directions[:, :-1].T
        level = (queries ** 2).sum(1) + self.longest ** 2
        farthest = self.longest + np.sqrt((queries ** 2).sum(1))
        few = self.vectors[::k]
        radius = np.sqrt(np.maximum(level - 2 * (queries @ few.T).max(axis=1), 0.0)) + 1e-3 * farthest
        found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(queries)
        open_ = np.arange(len(queries))
        while len(open_):
            full = radius >= farthest
            counts = self.collisions(centre[open_], np.where(full, np.inf, width * radius)[open_])
            for row, j in zip(counts, open_.tolist()):
                place = np.flatnonzero(row >= least)
                score = self.vectors[place] @ queries[j]
                last = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else -np.inf
                distance = np.sqrt(max(level[j] - 2 * last, 0.0)) if len(score) >= k else np.inf
                if distance > radius[j] and not full[j]:
                    radius[j] = min(max(growth * radius[j], distance if np.isfinite(distance) else 0.0), farthest[j])
                    continue
                # The exact product decides among those that rounding may have put on either side.
                place = place[score >= last - 1e-9 * farthest[j] ** 2]
                exact = products(self.vectors[place], np.broadcast_to(queries[j], (len(place), queries.shape[1])))
                best = np.lexsort((ties[place], -exact))[:k]
                found[j] = place[best], exact[best]
            open_ = np.array([j for j in open_.tolist() if found[j] is None], np.int64)
        return found


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """Classes of equal vectors: node, h1, h2, d, length, vector, asked, least and their first ``k`` + 1 rows."""
    first = Window.partitionBy("h1", "h2").orderBy(F.col("id").asc_nulls_last(), "row")
    heads = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    grouped = heads.groupBy("h1", "h2").agg(
        F.min_by("vector", "place").alias("vector"), F.array_sort(F.collect_list(F.struct("place", "id", "row"))).alias("heads"))
    asked = rows.filter("query").select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
    described = grouped.join(asked, ["h1", "h2"], "left").select(
        "h1", "h2", "vector", "heads", F.coalesce("asked", F.lit(False)).alias("asked"), F.size("vector").alias("d"),
        norm.alias("length"), F.get("heads", F.lit(0))["id"].alias("least"))
    return stored(described.withColumn("node", F.monotonically_increasing_id()), "vector-classes")


def _met(classes: DataFrame, k: int, projections: int, width: float, growth: float, chance: float, block: int,
         part: int, seed: int) -> DataFrame:
    """q, node, score: of each block the classes nearest to each asked class, itself included."""
    sizes = stored(classes.groupBy("d").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.max("length").alias("longest"),
        F.greatest(F.ceil(F.sum(F.col("asked").cast("long")) / part), F.lit(1)).cast("int").alias("parts")), "vector-sizes")
    # A block of a hash is a little larger than another; by half more than ``block`` it has as good as never.
    spread = F.xxhash64("node")
    own = classes.join(sizes, "d")
    members = own.select(
        "d", F.pmod(spread, "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", F.col("least").isNull().alias("nameless"),
        F.coalesce("least", F.lit(0)).alias("least"), "vector", "longest")
    asked = own.filter("asked").select(
        F.col("d").alias("q_d"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q_block"),
        F.pmod(spread, "parts").cast("int").alias("q_part"), F.col("node").alias("q"), F.col("vector").alias("q_vector"))
    least = threshold(projections, width, chance)

    def meet(members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(asked):
            return pd.DataFrame({"q": np.empty(0, np.int64), "node": np.empty(0, np.int64), "score": np.empty(0)})
        arrays = Arrays.build(np.stack(members["vector"]).astype(float), float(members["longest"].iloc[0]), projections, seed)
        ties = np.argsort(np.lexsort((members["node"], members["least"], members["nameless"])), kind="stable")
        found = arrays.nearest(np.stack(asked["q_vector"]).astype(float), k + 1, ties, least, width, growth)
        sizes = [len(p) for p, _ in found]
        return pd.DataFrame({
            "q": np.repeat(asked["q"].to_numpy(), sizes),
            "node": members["node"].to_numpy()[np.concatenate([p for p, _ in found])],
            "score": np.concatenate([s for _, s in found])})

    return members.groupBy("d", "block", "part").cogroup(asked.groupBy("q_d", "q_block", "q_part")).applyInPandas(meet, FOUND)


def search(rows: DataFrame, query: Column, k: int = NEAREST, id_column: str = "vec_id", vector: str = "embedding",
           projections: int = PROJECTIONS, width: float = WIDTH, growth: float = GROWTH, chance: float = CHANCE,
           block: int = BLOCK, part: int = PART, seed: int = 7) -> DataFrame:
    """query_id, rank, id, score for every row for which ``query`` holds: its ``k`` nearest other rows."""
    own = rows.filter(usable(vector)).select(
        F.col(id_column).cast("long").alias("id"), F.transform(vector, lambda v: v.cast("double") + F.lit(0.0)).alias("vector"),
        F.coalesce(query, F.lit(False)).alias("query"))
    own = own.select("*", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(seed), "vector").alias("h2"),
                     F.monotonically_increasing_id().alias("row"))
    own = stored(own, "search-rows")
    classes = _classes(own, k)
    met = stored(_met(classes, k, projections, width, growth, chance, block, part, seed), "block-nearest")
    best_classes = Window.partitionBy("q").orderBy(F.desc("score"), F.col("least").asc_nulls_last(), "node")
    near = met.join(classes.select("node", "least", "heads"), "node").withColumn("r", F.row_number().over(best_classes)).filter(
        F.col("r") <= k + 1)
    # At most k + 1 classes of k + 1 rows for each asked class.
    rows_of = F.transform("heads", lambda v: F.struct(
        (-F.col("score")).alias("order"), v["id"].isNull().alias("nameless"), v["id"].alias("id"), v["place"].alias("place"), v["row"].alias("row")))
    lists = near.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list(rows_of))), 1, k + 1).alias("near"))
    asked = own.filter("query").join(classes.select("h1", "h2", F.col("node").alias("q")), ["h1", "h2"]).select(
        "q", F.col("id").alias("query_id"), "row")
    others = asked.join(lists, "q").select(
        "query_id", F.slice(F.filter("near", lambda v: v["row"] != F.col("row")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("at", "v")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("v.id").alias("id"), (-F.col("v.order")).alias("score"))


def nearest_vectors(rows: DataFrame) -> DataFrame:
    """The contract's rows."""
    return search(rows, F.col("vec_id") % QUERY_EVERY == 0).withColumnRenamed("id", "vec_id")


def sql() -> str:
    """DuckDB SQL for the exact answer: every query against every row."""
    return f"""
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs AS (
        SELECT q.r, q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score
        FROM v q JOIN v ON q.r <> v.r AND len(q.e) = len(v.e) WHERE q.vec_id % {QUERY_EVERY} = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST) AS INT) AS rank, vec_id, score
    FROM pairs QUALIFY rank <= {NEAREST}"""
