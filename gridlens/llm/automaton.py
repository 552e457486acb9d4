"""Operator 11: ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton, which every task builds from a broadcast list. Each term is guarded by a blank on
both sides and so are all terms of a text, so the automaton reports whole terms only. Documents are scanned where they lie;
there is no index of them and no shuffle of texts. One scan counts documents, terms and the documents that hold each term; a
second one scores, maps terms to the items that hold them, and keeps each item's best documents of a task. Only these travel:
at most ``k`` rows for each item and task.

The broadcast is bounded: items are dealt to blocks whose different terms take ``BLOCK_BYTES`` at most (an item that is larger
by itself is a block of its own) and ``BLOCK_PAIRS`` pairs of item and term, and blocks are scanned one after the other.

Defined cases: a null, empty or blank text has no terms and is never ranked; rows of one item id (null included) are one item
that holds the terms of all of them, repeated ones included; an item without terms has no rows; every document row is ranked by
itself, also those of one id; null ids follow all others among equal scores; very long texts are scanned whole, in one task;
an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridlens.llm.common import stored, whole

#: What a term is made of, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, FLAT, LENGTH_PART, STEEP = 1_000_000_000, 1000, 75, 8
BEST = 10
#: Bounds of what is broadcast at once.
BLOCK_BYTES = 4 << 20
BLOCK_PAIRS = 1 << 19
#: Cells of documents x items that are scored at once in a task.
CELLS = 1 << 21
COUNTED = "term int, df long, terms long"
RANKED = "item int, id long, score long"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Every byte that is not part of a term becomes a blank; A-Z are lower-cased; bytes of other code points stay.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
               for c in range(256))


def lowered(text: str = "text"):
    return F.translate(whole(text), _UPPER, _UPPER.lower())


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, term, n: how often each item holds each of its terms."""
    words = F.explode(F.regexp_extract_all(lowered(text), F.lit(TERM), F.lit(0)))
    return items.select(F.col(item_id).alias("item"), words.alias("term")).groupBy("item", "term").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Block:
    """The terms of some items: term texts, and for each term the items that hold it and how often."""

    terms: list[bytes]
    start: np.ndarray
    items: np.ndarray
    times: np.ndarray

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", k)
        found.make_automaton()
        return found


class _Scan:
    """Counts the block's terms in texts: every output of the automaton is one whole term."""

    def __init__(self, block: Block):
        self.automaton, self.width = block.automaton(), len(block.terms)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text; and of each text and term met: text's place, term, count."""
        sizes, hits, each = np.zeros(len(texts), np.int64), [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            octets = text.encode("utf-8").translate(_TABLE)
            sizes[k] = len(octets.split())
            found = [v for _, v in self.automaton.iter(f" {octets.decode('latin-1')} ")] if self.width and sizes[k] else []
            hits.append(np.array(found, np.int64))
            each[k] = len(found)
        flat = np.repeat(np.arange(len(texts)), each) * max(self.width, 1) + np.concatenate([*hits, np.empty(0, np.int64)])
        cell, times = np.unique(flat, return_counts=True)
        return sizes, cell // max(self.width, 1), cell % max(self.width, 1), times.astype(np.int64)


def _texts(batch: pa.RecordBatch, name: str, at_once: int) -> Iterator[tuple[int, list[str]]]:
    column = batch.column(name)
    for at in range(0, len(column), at_once):
        yield at, column.slice(at, at_once).to_pylist()


def count_terms(docs: DataFrame, text: str, block) -> DataFrame:
    """term, df, terms: for each term the documents that hold it; under term -1 the documents with a term, and all their terms.

    A task adds up before it returns, so it returns a row for each term at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(block.value)
        df, some, total = np.zeros(scan.width, np.int64), 0, 0
        for batch in batches:
            for _, texts in _texts(batch, "text", 256):
                sizes, _, term, _ = scan(texts)
                df += np.bincount(term, minlength=scan.width)[:scan.width]
                some, total = some + int((sizes > 0).sum()), total + int(sizes.sum())
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1], met)), pa.int32()), pa.array(np.concatenate(([some], df[met])), pa.int64()),
             pa.array(np.concatenate(([total], np.zeros(len(met), np.int64))), pa.int64())], ["term", "df", "terms"])

    return docs.select(whole(text).alias("text")).mapInArrow(run, COUNTED).groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("terms").alias("terms"))


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _best(item: np.ndarray, ids: np.ndarray, known: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each item."""
    order = np.lexsort((ids, ~known, -score, item))
    group = item[order]
    first = np.concatenate(([True], group[1:] != group[:-1])) if len(group) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0)) if len(group) else group
    return order[np.arange(len(group)) - begin < k]


def score_documents(docs: DataFrame, text: str, id_column: str, block, weight: np.ndarray, documents: int, terms: int,
                    items: int, k: int = BEST) -> DataFrame:
    """item (its place in the block), id, score: the ``k`` best documents of each item in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = block.value
        scan = _Scan(here)
        span = np.diff(here.start)
        kept = [np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64)]
        floor, waiting, count = np.ones(items, np.int64), [], 0

        def merge() -> None:
            nonlocal kept, waiting, count
            every = [np.concatenate(c) for c in zip(kept, *waiting)]
            best = _best(*every, k)
            kept, waiting, count = [c[best] for c in every], [], 0
            full = np.bincount(kept[0], minlength=items) >= k
            low = np.full(items, np.iinfo(np.int64).max)
            np.minimum.at(low, kept[0], kept[3])
            floor[full] = low[full]  # an equal score may still come first by its id

        for batch in batches:
            ids = batch.column("id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for at, texts in _texts(batch, "text", max(1, min(256, CELLS // items))):
                sizes, place, term, tf = scan(texts)
                flat = 100 - LENGTH_PART + (LENGTH_PART * sizes * documents) // terms
                gain = weight[term] * ((SCALE * tf) // (FLAT * tf + STEEP * flat[place]))
                wide = span[term]
                entry = np.repeat(here.start[term] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
                scores = np.zeros((len(texts), items), np.int64)
                np.add.at(scores, (np.repeat(place, wide), here.items[entry]), np.repeat(gain, wide) * here.times[entry])
                doc, item = np.nonzero(scores >= floor)
                waiting.append((item.astype(np.int64), ids[at + doc], known[at + doc], scores[doc, item]))
                count += len(doc)
                if count > 4 * k * items:
                    merge()
        merge()
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[0], pa.int32()), pa.array(kept[1], pa.int64(), mask=~kept[2]), pa.array(kept[3], pa.int64())],
            ["item", "id", "score"])

    return docs.select(F.col(id_column).cast("long").alias("id"), whole(text).alias("text")).mapInArrow(run, RANKED)


def _blocks(terms: DataFrame, block_bytes: int, block_pairs: int) -> DataFrame:
    """``terms`` with a block for each item, such that no block of several items exceeds the bounds."""
    size = terms.groupBy("item").agg(F.sum(F.octet_length("term")).alias("bytes"), F.count("*").alias("pairs"))
    size = stored(size, "item-sizes")
    total = size.agg(F.sum("bytes").alias("bytes"), F.sum("pairs").alias("pairs")).first()
    blocks = max(1, math.ceil((total["bytes"] or 0) / block_bytes), math.ceil((total["pairs"] or 0) / block_pairs))
    while True:
        dealt = size.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
        over = dealt.groupBy("block").agg(F.sum("bytes").alias("bytes"), F.sum("pairs").alias("pairs"), F.count("*").alias("items"))
        if not over.filter((F.col("items") > 1) & ((F.col("bytes") > block_bytes) | (F.col("pairs") > block_pairs))).limit(1).count():
            break
        blocks *= 2
    key = dealt.select(F.col("item").alias("_item"), "block")
    return stored(terms.join(key, F.col("item").eqNullSafe(F.col("_item"))).drop("_item"), "item-terms")


def _collected(rows: DataFrame) -> tuple[Block, list]:
    """The block of ``rows`` (item, term, n), which the caller has bounded, and its items in order of their place."""
    table = rows.select("item", F.encode("term", "UTF-8").alias("term"), "n").toArrow()
    items = table.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    terms = table.column("term").combine_chunks().dictionary_encode()
    which, holder = terms.indices.to_numpy(zero_copy_only=False), items.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(which, kind="stable")
    start = np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(terms.dictionary)))))
    block = Block(terms.dictionary.to_pylist(), start, holder[order].astype(np.int64),
                  table.column("n").to_numpy()[order].astype(np.int64))
    return block, items.dictionary.to_pylist()


def search(docs: DataFrame, items: DataFrame, k: int = BEST, text: str = "text", id_column: str = "doc_id",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
           block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents."""
    spark = docs.sparkSession
    terms = _blocks(item_terms(items, item_id, item_text), block_bytes, block_pairs)
    kind = items.schema[item_id].dataType
    found = spark.createDataFrame([], f"item_id {kind.simpleString()}, doc_id long, score long")
    for row in terms.select("block").distinct().toLocalIterator():
        block, names = _collected(terms.filter(F.col("block") == row["block"]))
        shared = spark.sparkContext.broadcast(block)
        counted = count_terms(docs, text, shared).toArrow().to_pydict()  # a row for each term of the block
        by_term = dict(zip(counted["term"], zip(counted["df"], counted["terms"])))
        documents, all_terms = by_term.get(-1, (0, 0))
        if not all_terms:
            shared.destroy()
            break
        df = np.array([by_term.get(t, (0, 0))[0] for t in range(len(block.terms))], np.int64)
        part = score_documents(docs, text, id_column, shared, weights(df, documents), documents, all_terms, len(names), k)
        named = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {kind.simpleString()}")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        top = part.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")
        found = found.union(stored(top.join(named, "item").select("item_id", F.col("id").alias("doc_id"), "score"), "ranked"))
        shared.destroy()
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score")


def sql(k: int = BEST) -> str:
    """DuckDB SQL for ``search`` over documents and benchmark."""
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    words = f"regexp_extract_all({lower}, '{TERM}')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
    sized AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
    total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM sized),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
    item AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({words}) AS term FROM benchmark) GROUP BY ALL),
    scored AS (
        SELECT item_id, r, CAST(sum(times * w * (({SCALE} * tf) // ({FLAT} * tf
               + {STEEP} * ({100 - LENGTH_PART} + ({LENGTH_PART} * n * documents) // terms)))) AS BIGINT) AS score
        FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN sized USING (r), total GROUP BY item_id, r)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INT) AS rank,
           doc_id, score
    FROM scored JOIN sized USING (r) WHERE score > 0
    QUALIFY rank <= {k}"""
