"""Near copies by the Jaccard similarity of their sets of word shingles: every pair.

1. Shingles are ordered by rarity: by their count in a table of ``COUNTERS`` counters over all documents, then by hash. Any
   fixed order gives the same links, so that shingles share counters costs time, never a link.
2. Documents with one set are one node. Similar sets share one of their rarest ``n - ceil(t n) + 1`` shingles (prefix filter).
3. Pairs that a sketch has found (``simhash.leader_pairs``) are compared first. The sets that share such a shingle are then
   compared with three leaders, if they are not in one component yet; the components that result are joined with each other, and
   never with themselves, so thousands of near copies need about as many comparisons as there are copies.
4. Candidate pairs pass the length filter and a filter by parities of their sets, a bit or two for each shingle (a bit that
   differs is a shingle that differs, so no link is lost). What is left is verified on the whole sets, which are read again from
   the documents that take part in such a pair, found by a bitmap of fixed size.

A shingle that stands in one prefix only makes no pair. Such shingles, nearly all, are left out before prefixes are shuffled: the
others are found by counting 40 bits of each, and passed on as a bitmap of bounded size. What it lets through besides costs time.

Shingles are told apart by the 64 bits of their hash, sets by 64 bits of a digest.

Defined cases: null, empty and blank texts have the empty set, node 0, and are copies of each other; ids are not looked at, so null
and repeated ones do not matter, and repeated rows are one node; very long texts are taken whole, one set in memory at a time;
an empty table has no nodes; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from gridlens.llm.common import stored, whole
from gridlens.llm.components import components, joined_components
from gridlens.llm.lines import bitmap, in_bitmap

#: Jaccard similarity as a fraction.
SIMILARITY = (4, 5)
SEED = 42
#: Counters of the rarity order.
COUNTERS = 1 << 18
#: Bits of a shingle by which shared ones are counted are those above these.
LOW_BITS = 24
#: Bits of the bitmap of shared shingles, as powers of two: 16 for each, within these bounds.
LEAST_BITS, MOST_BITS = 20, 26
#: Turns the order of the digests round for the third leader.
_TURN = 0x5DEECE66D1234567


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of all shingles in their order; of a shorter text its own, of a blank one none."""
    parts = (text or "").encode().lower().split()  # bytes: only A-Z, and only the six ASCII blanks
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    spans = map(slice, starts[: len(parts) - width + 1].tolist(), ends[width - 1:].tolist())
    n = len(parts) - width + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED)), np.uint64, n)


def _set(text: str | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _node(shingles: np.ndarray) -> int:
    """Digest of a set as a signed long, 0 only for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes()) | 1).view(np.int64)) if len(shingles) else 0


def _parity(shingles: np.ndarray) -> bytes:
    """Parities of the shingles dealt out by their low bits, to as many bits as the next power of two from 64."""
    bits = 1 << max(6, (len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _differ_at_least(left: bytes, right: bytes) -> int:
    """Shingles that only one of two sets has: at least as many as bits of their parities that differ."""
    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, width)) for z in (x, y))  # parities of fewer, wider slots
    return int(np.bitwise_count(x ^ y).sum())


def rarity(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """How many sets have the shingles of each counter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                np.add.at(counts, (_set(value.as_py(), words) % np.uint64(COUNTERS)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["i", "n"])

    rows = docs.select(whole(text).alias("t")).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[rows["i"].to_numpy()] = rows["n"].to_numpy()
    return counts


def digest(docs: DataFrame, text: str, words: int, sketch: Callable[[np.ndarray], int]) -> Column:
    """node, n (shingles of the set), prefix (its rarest shingles, rarest first), parity, sim (``sketch`` of all shingles,
    repeats included), h (hash of the text) of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs, text, words))
    a, b = SIMILARITY

    @F.pandas_udf("node long, n int, prefix array<long>, parity binary, sim long")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            hashes = shingle_hashes(value, words)
            s = np.unique(hashes)
            order = np.lexsort((s, shared.value[(s % np.uint64(COUNTERS)).astype(np.int64)]))
            kept = len(s) + (-a * len(s) // b) + 1 if len(s) else 0  # n - ceil(t n) + 1
            rows.append((_node(s), len(s), s[order[:kept]].view(np.int64), _parity(s), sketch(hashes)))
        return pd.DataFrame(rows, columns=["node", "n", "prefix", "parity", "sim"])

    found = of(F.col(text))
    return F.struct(found["node"].alias("node"), found["n"].alias("n"), found["prefix"].alias("prefix"),
                    found["parity"].alias("parity"), found["sim"].alias("sim"), F.xxhash64(whole(text)).alias("h"))


def shared_prefixes(marked: DataFrame) -> DataFrame:
    """f, n, p, k: each node's prefix shingles k at place p, of those that stand in one prefix only hardly any; stored."""
    key = F.shiftright("k", LOW_BITS)
    often = marked.select(F.explode("prefix").alias("k")).groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    often = stored(often.filter("n > 1").select("k"), "shared-shingles")
    bits = min(max((16 * often.count()).bit_length(), LEAST_BITS), MOST_BITS)
    rows = marked.select(F.col("fingerprint").alias("f"), "n", F.posexplode("prefix").alias("p", "k"))
    shared = rows.withColumn("bits", bitmap(often, F.col("k"), bits)).filter(in_bitmap(F.col("bits"), key, bits)).drop("bits")
    return stored(shared.dropDuplicates(["f", "k"]), "prefixes")


def may_be_similar(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``pairs`` that pass the length and the parity filter."""
    a, b = SIMILARITY

    @F.pandas_udf(BooleanType())
    def near(n1: pd.Series, n2: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        # Sets that differ in d of n1 + n2 shingles have a similarity of (n1 + n2 - d) / (n1 + n2 + d).
        out = [(n - d) * b >= (n + d) * a for n, d in zip(n1 + n2, map(_differ_at_least, left, right))]
        return pd.Series(out, dtype=bool)

    both = pairs
    for i in "12":
        both = both.join(nodes.select(F.col("f").alias(f"f{i}"), F.col("n").alias(f"n{i}"), F.col("parity").alias(f"s{i}")), f"f{i}")
    fits = (F.col("n1") * a <= F.col("n2") * b) & (F.col("n2") * a <= F.col("n1") * b)
    return both.filter(fits).filter(near("n1", "n2", "s1", "s2")).select(*pairs.columns)


def similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, words: int) -> DataFrame:
    """The rows of ``pairs`` (f1 and f2 are nodes) whose sets are similar. ``nodes``: f, n, parity, h (of one text)."""
    a, b = SIMILARITY
    pairs = stored(may_be_similar(pairs, nodes), "set-pairs")
    ends = pairs.select(F.explode(F.array("f1", "f2")).alias("f")).distinct()
    texts = stored(nodes.join(ends, "f", "left_semi").select("h").distinct(), "set-texts")

    @F.pandas_udf("node long, shingles binary")
    def whole_set(values: pd.Series) -> pd.DataFrame:
        sets = [_set(v, words) for v in values]
        return pd.DataFrame({"node": [_node(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    @F.pandas_udf(BooleanType())
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            common = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            out.append(common * b >= ((len(x) + len(y)) // 8 - common) * a)
        return pd.Series(out, dtype=bool)

    every = docs.select(F.xxhash64(whole(text)).alias("h"), F.col(text).alias("t"))
    wanted = every.withColumn("bits", bitmap(texts, F.col("h"))).filter(in_bitmap(F.col("bits"), F.col("h"))).drop("bits")
    read = wanted.join(texts, "h", "left_semi").dropDuplicates(["h"])
    sets = stored(read.select(whole_set("t").alias("s")).select("s.node", "s.shingles"), "sets")
    both = pairs.join(sets.select(F.col("node").alias("f1"), F.col("shingles").alias("s1")), "f1").join(
        sets.select(F.col("node").alias("f2"), F.col("shingles").alias("s2")), "f2")
    return both.filter(alike("s1", "s2")).select(*pairs.columns)


def near_components(marked: DataFrame, docs: DataFrame, text: str, words: int, found: DataFrame) -> DataFrame:
    """node, component for the sets that have another similar one. ``marked``: fingerprint (the node), n, prefix, parity, h.
    ``found``: pairs of nodes (f1, f2) that are compared before all others."""
    a, b = SIMILARITY
    nodes = stored(marked.groupBy(F.col("fingerprint").alias("f")).agg(
        F.first("n").alias("n"), F.first("parity").alias("parity"), F.min("h").alias("h")), "nodes")
    sketched = stored(components(similar(found, nodes, docs, text, words), "f1", "f2"), "sketched-components")
    keyed = shared_prefixes(marked)
    turned = F.col("f").bitwiseXOR(F.lit(_TURN))
    leaders = (
        keyed.groupBy("k").agg(F.min("f").alias("l1"), F.max("f").alias("l2"), F.min(turned).bitwiseXOR(F.lit(_TURN)).alias("l3"))
        .filter("l1 <> l2")
    )
    shared = stored(keyed.join(leaders, "k"), "shared-prefixes")
    to = F.explode(F.array_distinct(F.array("l1", "l2", "l3")))
    stars = shared.select("f", to.alias("l")).filter("f <> l").select(
        F.least("f", "l").alias("f1"), F.greatest("f", "l").alias("f2")).distinct()
    open_stars = stored(may_be_similar(stars, nodes), "possible-stars")
    for f, c in (("f1", "c1"), ("f2", "c2")):
        own = sketched.select(F.col("node").alias(f), F.col("component").alias(c))
        open_stars = open_stars.join(own, f, "left").withColumn(c, F.coalesce(c, f))
    open_stars = similar(open_stars.filter("c1 <> c2"), nodes, docs, text, words)
    first = stored(joined_components(sketched, open_stars), "components")

    # What lies in different components so far: all members against those outside their group's largest component.
    member = shared.select("k", "f", "n", "p").join(first.withColumnRenamed("node", "f"), "f", "left")
    member = stored(member.withColumn("component", F.coalesce("component", "f")), "members")
    most = (
        member.groupBy("k", "component").agg(F.count("*").alias("n"))
        .groupBy("k").agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("k_components"))
        .filter("k_components > 1").drop("k_components")
    )
    mixed = member.join(most, "k")
    left = mixed.filter("component <> largest").select(
        F.col("k").alias("k1"), F.col("f").alias("f1"), F.col("n").alias("n1"), F.col("p").alias("p1"), F.col("component").alias("c1"))
    right = mixed.select(
        F.col("k").alias("k2"), F.col("f").alias("f2"), F.col("n").alias("n2"), F.col("p").alias("p2"), F.col("component").alias("c2"))
    # Length and positional filters; shingles before a common one may be common too.
    need = F.ceil((F.col("n1") + F.col("n2")) * a / (a + b) - 1e-9)
    common = F.least("p1", "p2") + 1 + F.least(F.col("n1") - F.col("p1") - 1, F.col("n2") - F.col("p2") - 1)
    met = left.join(right, (F.col("k1") == F.col("k2")) & (F.col("c1") != F.col("c2")) & (F.col("n1") * a <= F.col("n2") * b)
                    & (F.col("n2") * a <= F.col("n1") * b) & (common >= need))
    # Pairs with the leaders were compared already; a pair is compared once.
    pairs = met.select(F.least("f1", "f2").alias("f1"), F.greatest("f1", "f2").alias("f2"),
                       F.when(F.col("f1") < F.col("f2"), F.col("c1")).otherwise(F.col("c2")).alias("c1"),
                       F.when(F.col("f1") < F.col("f2"), F.col("c2")).otherwise(F.col("c1")).alias("c2"))
    pairs = pairs.distinct().join(stars, ["f1", "f2"], "left_anti")
    return joined_components(first, similar(pairs, nodes, docs, text, words))
