"""Operator 1: byte-level BPE encoding and decoding with higher-order functions.

A text is cut into pieces by the pre-tokenizer's pattern. The bytes of a piece are an array of ids; ``aggregate`` folds
over it and in each round merges the pair of neighbours with the lowest rank, found in a literal map of all pairs. The
map is an array of small maps, so a lookup costs the same for any vocabulary. Distinct pieces are counted over the whole
corpus, and the most frequent ones (``HEAD`` at most, so the table is bounded) are encoded once and looked up; the fold
runs where a piece stands only for the others. Documents are never shuffled.

Pieces of more than ``LONG`` bytes (no blank, digit or sign for hundreds of letters) are merged with a heap instead,
because a fold over an array costs the square of its length.

Decoding maps ids to the bytes of their tokens and concatenates these (in Arrow batches: an array of a few hundred
million short strings costs the JVM ten times as much).

Defined cases: null and empty texts give no ids and decode to the empty string; equal rows give equal results; an empty
table gives an empty result; very long texts and pieces are encoded whole; columns that clash with helper columns stay.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, MapType, StringType, StructField, StructType

from gridlens.llm.common import fresh, stored, whole

#: Most pieces whose ids are looked up instead of merged anew, and slots of that table.
HEAD, HEAD_SLOTS = 1 << 19, 1 << 20
#: Of so many slots one holds a piece so frequent that no other moves it.
FIXED = 64
PAIR_BUCKETS = 1 << 17
#: Bytes from which a piece is merged with a heap.
LONG = 256
HASH_SEED = 42  # of Spark's xxhash64

#: White space as Unicode defines it; \s of Java is ASCII only.
_WHITE = r"\x09-\x0D\x20\x85\xA0  -     　"


def java_pattern(pattern: str) -> str:
    r"""The pre-tokenizer's pattern with Unicode white space for \s and \S."""
    inside = pattern.replace(r"[^\s", f"[^{_WHITE}")
    return inside.replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]")


def pieces(text: str | Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, and the pairs that merge: (left id, right id) to the id of the merged token. Lower ids merge first."""

    tokens: tuple[bytes, ...]
    pairs: dict[tuple[int, int], int]

    @cached_property
    def byte_ids(self) -> list[int]:
        ids = {t: i for i, t in enumerate(self.tokens) if len(t) == 1}
        return [ids[bytes([b])] for b in range(256)]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece, with a heap: for long pieces and for what is proved offline."""
        ids = [self.byte_ids[b] for b in piece]
        after, before = list(range(1, len(ids))) + [-1], list(range(-1, len(ids) - 1))
        heap = [(new, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (new := self.pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            new, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := self.pairs.get((ids[left], ids[right]))) is not None:
                    heapq.heappush(heap, (found, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]


def from_ranks(path: str) -> Vocabulary:
    """A file of ``token rank`` lines. Any two tokens whose bytes together are a token merge, at that token's rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pairs = {(ranks[t[:k]], ranks[t[k:]]): i for t, i in ranks.items()
             for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
    return Vocabulary(_by_id(ranks), pairs)


def _by_id(ranks: dict[bytes, int]) -> tuple[bytes, ...]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return tuple(tokens)


def printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 as it is, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def from_merges(path: str) -> Vocabulary:
    """A byte-level BPE model with a list of merges. Ids must rise with the merges, so that ids can stand for ranks."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    ids, back = model["vocab"], printable_bytes()
    pairs = {(ids[a], ids[b]): ids[a + b] for a, b in map(_two, model["merges"])}
    order = list(pairs.values())
    if order != sorted(order):
        raise ValueError("ids do not rise with the merges")
    return Vocabulary(_by_id({bytes(back[c] for c in t): i for t, i in ids.items() if all(c in back for c in t)}), pairs)


def _two(merge: str | list[str]) -> list[str]:
    return merge.split(" ") if isinstance(merge, str) else merge


def _hash(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, seed=HASH_SEED)


def one_row(spark: SparkSession, sizes: np.ndarray, keys: np.ndarray, values: np.ndarray) -> Column:
    """An array of small maps as a one-row subquery: a literal of every plan that uses it. ``sizes``: entries of each map.

    Add it as a column and use the column exactly once (``let``): Spark then puts the subquery where it is used. Used
    twice, it would become a column and be copied into every row.
    """
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    maps = pa.MapArray.from_arrays(pa.array(ends), pa.array(keys, pa.int64()), pa.array(values, pa.int64()))
    row = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), maps)
    return spark.createDataFrame(pa.table({"buckets": row})).scalar()


def pair_table(spark: SparkSession, vocabulary: Vocabulary) -> Column:
    """The pairs that merge, as left << 16 | right, and their ranks as an entry of ``fold`` has them."""
    n = len(vocabulary.pairs)
    keys = np.fromiter((a << 16 | b for a, b in vocabulary.pairs), np.int64, n)
    values = np.fromiter(vocabulary.pairs.values(), np.int64, n) << _RANK_AT
    bucket = np.fromiter((_hash(k.to_bytes(8, "little")) % PAIR_BUCKETS for k in memoryview(keys)), np.int64, n)
    order = np.argsort(bucket, kind="stable")
    return one_row(spark, np.bincount(bucket, minlength=PAIR_BUCKETS), keys[order], values[order])


def merge_tables(spark: SparkSession, vocabulary: Vocabulary) -> Column:
    """What ``fold`` reads: the pairs, the ids of the 256 bytes, and by two bytes the first entry of the one before the other."""
    own, pairs = vocabulary.byte_ids, vocabulary.pairs
    first = np.fromiter((pairs[a, b] << _RANK_AT | a if (a, b) in pairs else _NO_MERGE | a for a in own for b in own), np.int64, 1 << 16)
    row = pa.table({"first": pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), pa.array(first))})
    return F.struct(pair_table(spark, vocabulary).alias("pairs"), F.array(*[F.lit(i).cast("long") for i in own]).alias("bytes"),
                    spark.createDataFrame(row).scalar().alias("first"))


def find(table: Column, buckets: int, key: Column) -> Column:
    """The value of ``key`` in an array of small maps (a power of two), or null."""
    return F.get(table, F.xxhash64(key).bitwiseAND(F.lit(buckets - 1)).cast("int"))[key]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once. The end of an ``aggregate`` over nothing: unlike an element of a
    transformed array it does not work out the type of its whole body for each row."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


#: A token, its place in the piece and the rank of the merge with its right neighbour in one long: rank << 34 | place << 17 | token.
_TOKEN_BITS, _RANK_AT = 17, 34
_NO_MERGE = 1 << 60


def fold(piece: Column, tables: Column) -> Column:
    """Ids of a piece: merges in order of rank, leftmost first. Each round looks up the two new neighbours only.

    The least entry of a state is the lowest rank and of equal ones the leftmost, as places come before tokens.
    """
    def token(entry: Column) -> Column:
        return entry.bitwiseAND(F.lit((1 << _TOKEN_BITS) - 1))

    def rank(a: Column, b: Column) -> Column:
        found = find(tables["pairs"], PAIR_BUCKETS, F.shiftleft(a, 16).bitwiseOR(b))
        return F.coalesce(found, F.lit(_NO_MERGE))

    def place(entry: Column) -> Column:
        return entry.bitwiseAND(F.lit(((1 << _TOKEN_BITS) - 1) << _TOKEN_BITS))

    def merged(state: Column, least: Column) -> Column:
        new = F.shiftright(least, _RANK_AT)

        def at(j: Column) -> Column:
            def moved(entry: Column, i: Column) -> Column:
                after = token(F.get(state, j + 2))  # null after the last token: no pair
                one = rank(new, after).bitwiseOR(place(least)).bitwiseOR(new)
                other = rank(token(entry), new).bitwiseOR(entry.bitwiseAND(F.lit((1 << _RANK_AT) - 1)))
                return F.when(F.abs(i - j) > 1, entry).when(i == j, one).when(i < j, other).otherwise(F.lit(-1).cast("long"))

            return F.array_remove(F.transform(state, moved), F.lit(-1).cast("long"))

        return let(F.size(F.filter(state, lambda e: place(e) < place(least))), at)

    def next_round(state: Column, _: Column) -> Column:
        return let(F.array_min(state), lambda least: F.when(least >= _NO_MERGE, state).otherwise(merged(state, least)))

    # Bytes as characters of Latin-1, whose code is the byte.
    characters = F.transform(F.split(F.decode(F.encode(piece, "UTF-8"), "ISO-8859-1"), ""), F.ascii)

    def start(codes: Column) -> Column:
        def entry(code: Column, i: Column) -> Column:
            after = F.get(codes, i + 1)
            paired = F.get(tables["first"], F.shiftleft(code, 8).bitwiseOR(after))
            alone = F.get(tables["bytes"], code).bitwiseOR(F.lit(_NO_MERGE))
            return F.coalesce(paired, alone).bitwiseOR(F.shiftleft(i.cast("long"), _TOKEN_BITS))

        return F.transform(codes, entry)

    rounds = F.sequence(F.lit(1), F.greatest(F.octet_length(piece) - 1, F.lit(1)))
    return F.aggregate(rounds, let(characters, start), next_round, lambda state: F.transform(state, lambda e: token(e).cast("int")))


def long_pieces(found: Column, vocabulary: Vocabulary) -> Column:
    """Map from the long pieces of an array to their ids."""
    @F.pandas_udf(MapType(StringType(), ArrayType(IntegerType())))
    def merge(arrays: pd.Series) -> pd.Series:
        return pd.Series([{p: vocabulary.merge(p.encode()) for p in a} for a in arrays], dtype=object)

    return merge(F.filter(found, lambda p: F.octet_length(p) > LONG))


def frequent_pieces(found: DataFrame, column: str, limit: int = HEAD) -> DataFrame:
    """piece, often: the distinct pieces of all rows that occur most often, about ``limit`` and never more than a hundredth
    above it; no long ones."""
    counts = stored(
        found.select(F.explode(column).alias("piece")).filter(F.octet_length("piece") <= LONG)
        .groupBy("piece").agg(F.count("*").alias("often")), "pieces")
    different = counts.count()
    if different <= limit:
        return counts
    cut = counts.agg(F.percentile_approx("often", 1 - limit / different, 100_000)).first()[0]
    return counts.filter(F.col("often") > cut)


def head_table(encoded: DataFrame, value: str, slots: int = HEAD_SLOTS) -> Column:
    """(piece, often, ``value``) rows, bounded in number, as a table for ``look_up``.

    Cuckoo hashing: a piece lies in one of the two slots that its hash names, so a look-up reads two slots at most. The most
    frequent pieces come first, lie in their first slot where it is free, and stay. A piece that finds no slot is left out;
    it is then merged where it stands. One task places all rows, so that the driver holds no copy but that of the plan.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = list(batches)
        if not met:
            return
        rows = pa.Table.from_batches(met)
        order = np.argsort(-rows["often"].to_numpy(), kind="stable")
        hashes = rows["h"].to_numpy()[order]
        first, second = hashes & (slots - 1), (hashes >> 32) & (slots - 1)
        taken = np.full(slots, -1, np.int64)
        one, two, held = memoryview(first), memoryview(second), memoryview(taken)
        for i in range(len(order)):
            a, b = one[i], two[i]
            slot = a if held[a] < 0 or held[b] >= 0 and held[a] > held[b] else b  # the less frequent one moves
            for _ in range(64):
                other = held[slot]
                if 0 <= other < slots // FIXED:
                    break
                held[slot] = i
                if other < 0:
                    break
                i, slot = other, two[other] if slot == one[other] else one[other]
        at = pa.array(order[taken], mask=taken < 0) if len(order) else pa.nulls(slots, pa.int64())
        ends = pa.array([0, slots], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, rows[c].combine_chunks().take(at)) for c in ("piece", "v")],
                                         ["pieces", "values"])

    rows = encoded.select("piece", F.col(value).alias("v"), F.xxhash64("piece").alias("h"), F.col("often").cast("long").alias("often"))
    schema = StructType([StructField("pieces", ArrayType(StringType())), StructField("values", ArrayType(rows.schema["v"].dataType))])
    table = stored(rows.repartition(1).mapInArrow(place, schema), "head")
    return table.select(F.struct("pieces", "values")).scalar()


def look_up(table: Column, piece: Column, slots: int = HEAD_SLOTS) -> Column:
    """The value of a piece in a head table, or null."""
    def at(slot: Column) -> Column:
        return let(slot.bitwiseAND(F.lit(slots - 1)).cast("int"), lambda s: F.when(
            F.get(table["pieces"], s) == piece, F.get(table["values"], s)))

    return F.coalesce(at(F.xxhash64(piece)), at(F.shiftright(F.xxhash64(piece), 32)))


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", ids: str = "ids",
           head: int = HEAD) -> DataFrame:
    """``docs`` with the ids of the text as array<int>."""
    spark = docs.sparkSession
    found, far, tables = fresh(docs, "_pieces", "_far", "_tables")
    merges = merge_tables(spark, vocabulary)

    cut = docs.select(pieces(whole(text), pattern).alias(found))
    common = frequent_pieces(cut, found, head).withColumn(tables, merges)
    coded = common.select("piece", "often", let(F.col(tables), lambda t: fold(F.col("piece"), t)).alias("ids"))
    looked_up = F.struct(merges.alias("merges"), head_table(coded, "ids").alias("head"))

    rows = docs.withColumn(found, pieces(whole(text), pattern)).withColumn(far, long_pieces(F.col(found), vocabulary))

    def of(piece: Column, t: Column) -> Column:
        return F.coalesce(look_up(t["head"], piece), F.when(
            F.octet_length(piece) > LONG, F.col(far)[piece]).otherwise(fold(piece, t["merges"])))

    coded = let(F.col(tables), lambda t: F.flatten(F.transform(found, lambda p: of(p, t))))
    return rows.withColumn(tables, looked_up).select(*[docs[c] for c in docs.columns], coded.alias(ids))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "decoded",
           packed: str | None = None, keep_ids: bool = True) -> DataFrame:
    """``rows`` with the bytes that the ids stand for (null for unknown ids); under ``packed`` also the ids themselves as
    little-endian unsigned 32-bit integers. Without ``keep_ids`` the ids travel one way only."""
    tokens = vocabulary.tokens
    kept = [c for c in rows.columns if keep_ids or c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array([*tokens, b""], pa.binary())
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            absent = lists.is_null().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            own = lists.flatten().to_numpy()  # of null lists nothing
            unknown = (own < 0) | (own >= len(tokens))
            lost = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(unknown)))[ends]))
            joined = table.take(pa.array(np.where(unknown, len(tokens), own)))
            absent_too = absent.copy()
            absent_too[lost] = True
            at = np.frombuffer(joined.buffers()[1], np.int32)[:len(own) + 1]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns.append(_binary(at[ends], joined.buffers()[2], absent_too))
            if packed:
                columns.append(_binary(4 * ends, pa.py_buffer(own.astype("<u4")), absent))
            yield pa.RecordBatch.from_arrays(columns, [*kept, name, *([packed] if packed else [])])

    schema = StructType([rows.schema[c] for c in kept] + [StructField(n, BinaryType()) for n in (name, packed) if n])
    return rows.mapInArrow(run, schema)


def _binary(ends: np.ndarray, data: pa.Buffer | None, absent: np.ndarray) -> pa.Array:
    """Binary values that lie one behind the other in ``data``; null where ``absent``."""
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(absent), [None, pa.py_buffer(ends.astype(np.int64)), data])
    return pa.compute.if_else(pa.array(absent), None, values).cast(pa.binary()) if absent.any() else values.cast(pa.binary())


def round_trip(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    import public_tokenizers

    vocabulary = from_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = encode(docs.select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN).drop("text")
    both = decode(coded, vocabulary, packed="packed", keep_ids=False)
    return both.select(
        "doc_id", F.floor(F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
