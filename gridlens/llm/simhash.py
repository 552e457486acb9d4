"""Operator 7: SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into blocks. Two fingerprints that differ in at most ``distance`` bits agree on all but ``distance``
blocks, so they share the bits of some choice of the others; rows are joined on every such choice and the Hamming
distance verified. Documents with one fingerprint are one node. A block group is first linked to its leaders only;
the components that result are joined with each other, and never with themselves, so thousands of near copies need about
as many comparisons as there are copies and still no link is lost.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; null ids take part, a component of
null ids only has a null component_id; repeated rows are repeated in the result; very long texts are hashed whole, chunk by
chunk; extra columns are kept by ``one_of_each`` and not looked at elsewhere; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from gridlens.llm import shingle_sets
from gridlens.llm.common import fresh, stored
from gridlens.llm.components import components, joined_components

BITS = 64
WORDS = 4
DISTANCE = 4
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half the XXH64 of all shingles, as a signed long."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        octets = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def _fingerprint(text: str | None, words: int) -> int:
    return _majority(shingle_sets.shingle_hashes(text, words))


def fingerprint(text: str, words: int = WORDS) -> Column:
    """64-bit SimHash of a text column as a long."""
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, words) for t in texts], dtype="int64")

    return of(F.col(text))


def hex_digits(value: str) -> Column:
    return F.lower(F.lpad(F.hex(value), BITS // 4, "0"))


def masks(blocks: int, distance: int) -> list[int]:
    """Signed 64-bit masks of every choice of ``blocks - distance`` blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    chosen = [sum(block[i] for i in c) for c in combinations(range(blocks), blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]


def blocks_for(nodes: int, distance: int) -> int:
    """Blocks such that a key has at least as many values as there are fingerprints; any number gives the same links."""
    blocks = distance + 2
    while blocks < BITS and (blocks - distance) * BITS // blocks < (max(nodes, 2) - 1).bit_length():
        blocks += 1
    return blocks


def near_components(nodes: DataFrame, value: str, distance: int = DISTANCE) -> DataFrame:
    """node, component for the distinct fingerprints that have another within ``distance`` bits."""
    nodes = stored(nodes.select(F.col(value).alias("f")).distinct(), "fingerprints")
    chosen = masks(blocks_for(nodes.count(), distance), distance)
    key = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("f").bitwiseAND(F.lit(m)).alias("m"))
                              for i, m in enumerate(chosen)]))
    keyed = nodes.select("f", key.alias("k")).select("f", "k.c", "k.m")

    def apart(a: str, b: str) -> Column:
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))

    # Groups of two and more, with three leaders each.
    leaders = (
        keyed.groupBy("c", "m").agg(F.min("f").alias("l1"), F.max("f").alias("l2"),
                                    F.min(F.struct(F.xxhash64("f"), "f"))["f"].alias("l3"))
        .filter("l1 <> l2")
    )
    shared = stored(keyed.join(leaders, ["c", "m"]), "blocks")
    to = F.explode(F.array_distinct(F.array("l1", "l2", "l3")))
    stars = shared.select("f", to.alias("l")).filter((F.col("f") != F.col("l")) & (apart("f", "l") <= distance)).distinct()
    first = stored(components(stars, "f", "l"), "components")

    # What lies in different components so far: all members against those outside their group's largest component.
    member = shared.select("c", "m", "f").join(first.withColumnRenamed("node", "f"), "f", "left")
    member = stored(member.withColumn("component", F.coalesce("component", "f")), "members")
    most = (
        member.groupBy("c", "m", "component").agg(F.count("*").alias("n"))
        .groupBy("c", "m").agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("k"))
        .filter("k > 1").drop("k")
    )
    mixed = member.join(most, ["c", "m"])
    left = mixed.filter("component <> largest").select("c", "m", F.col("f").alias("f1"), F.col("component").alias("c1"))
    right = mixed.select("c", "m", F.col("f").alias("f2"), F.col("component").alias("c2"))
    met = left.join(right, (left.c == right.c) & (left.m == right.m) & (F.col("c1") != F.col("c2"))
                    & (apart("f1", "f2") <= distance))
    return joined_components(first, met)


def leader_pairs(marked: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """f1, f2: each node (``fingerprint``) with the smallest and the largest node whose SimHash (``sim``) is in its component."""
    sims = stored(marked.select("fingerprint", "sim").distinct(), "sims")
    near = near_components(sims, "sim", distance).withColumnRenamed("node", "sim")
    grouped = sims.join(near, "sim", "left").select(F.col("fingerprint").alias("f"), F.coalesce("component", "sim").alias("g"))
    grouped = stored(grouped, "sim-groups")
    leaders = grouped.groupBy("g").agg(F.min("f").alias("l1"), F.max("f").alias("l2")).filter("l1 <> l2")
    to = F.explode(F.array("l1", "l2"))
    return grouped.join(leaders, "g").select("f", to.alias("l")).filter("f <> l").select(
        F.least("f", "l").alias("f1"), F.greatest("f", "l").alias("f2")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: tuple[str, ...] = (),
                    words: int = WORDS, distance: int | None = None) -> DataFrame:
    """id, fingerprint (long), component_id (smallest id reachable), and the columns ``keep``, a row for each document.

    Fingerprints within ``distance`` bits are linked. Without a distance the fingerprint is a digest of the text's set of
    shingles, and sets of a Jaccard similarity of at least ``shingle_sets.SIMILARITY`` are linked, all of them: what SimHash
    blocks bring together is verified first, and the sets are then joined between the components that this left.
    """
    mark = fingerprint(text, words) if distance is not None else shingle_sets.digest(docs, text, words, _majority)
    marked = docs.select(F.col(id_column).alias("id"), mark.alias("fingerprint"), F.struct(F.lit(0).alias("_"), *keep).alias("kept"))
    if distance is None:
        marked = marked.select("id", "fingerprint.*", "kept").withColumnRenamed("node", "fingerprint")
    marked = stored(marked, "simhash")
    if distance is None:
        linked = shingle_sets.near_components(marked, docs, text, words, leader_pairs(marked)).withColumnRenamed("node", "fingerprint")
    else:
        linked = near_components(marked, "fingerprint", distance).withColumnRenamed("node", "fingerprint")
    classes = marked.groupBy("fingerprint").agg(F.min("id").alias("least")).join(linked, "fingerprint", "left")
    classes = classes.withColumn("component", F.coalesce("component", "fingerprint"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = classes.join(smallest, "component").select("fingerprint", F.col("component").alias("group"), "component_id")
    return marked.join(by_class, "fingerprint").select("id", "fingerprint", "group", "component_id", "kept")


def one_of_each(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 5,
                distance: int | None = None) -> DataFrame:
    """One document of each group: the smallest id, of equal ids the smallest row hash, of equal rows one."""
    mark, = fresh(docs, "_row")
    row = F.xxhash64(*docs.columns)
    rows = near_duplicates(docs.withColumn(mark, row), text, id_column, (mark,), words, distance)
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col(f"kept.{mark}").alias("row"))
    first = rows.groupBy("group").agg(F.min(place).alias("p"), F.count("*").alias("n"))
    chosen = stored(
        rows.groupBy("group", place.alias("p")).agg(F.count("*").alias("times"))
        .join(first.drop("n"), ["group", "p"]).select(F.col("p.id").alias("_i"), F.col("p.row").alias("_r"), "times"),
        "chosen")
    marked = docs.withColumn(mark, row)
    same = F.col(id_column).eqNullSafe(F.col("_i")) & (F.col(mark) == F.col("_r"))
    single = marked.join(chosen.filter("times = 1"), same, "left_semi")
    repeated = marked.join(chosen.filter("times > 1"), same, "left_semi").dropDuplicates([id_column, mark])
    return single.union(repeated).select(*docs.columns)


def document_components(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return near_duplicates(docs, distance=DISTANCE).select(
        F.col("id").alias("doc_id"), hex_digits("fingerprint").alias("fingerprint"), "component_id")
