"""Operator 11 against a plain count of every document's terms."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridlens.llm import automaton

ITEMS = [(1, "the lazy DOG the dog"), (2, "words ÉTÉ 日本語のテキスト number"), (2, "line"), (3, None), (4, ""), (None, "fox dog 12"),
         (5, "nowhere"), (6, "x" * 3000 + " text")]


def brute(docs, items, k=10):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = [(i, Counter(re.findall(automaton.TERM, (t or "").translate(lower)))) for i, t in docs]
    words = [(i, c, sum(c.values())) for i, c in words if c]
    total, every = len(words), sum(n for _, _, n in words)
    df = Counter(t for _, c, _ in words for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, Counter()).update(re.findall(automaton.TERM, (text or "").translate(lower)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, c, n in words:
            m = 25 + (75 * n * total) // every
            s = sum(q * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, q in terms.items() if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"block_bytes": 20, "block_pairs": 3}])
def test_odd_documents_and_items(odd, items, bounds):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    got = found(automaton.search(odd, items, k=4, **bounds))
    assert got == brute(docs, ITEMS, 4)
    assert {r[0] for r in got} == {1, 2, None, 6}


def test_whole_words_only(spark, items):
    docs = spark.createDataFrame([(1, "doge hotdog dog-dog"), (2, "dogs"), (3, "DOG\x00fox"), (4, "ſ dogİ")], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found(automaton.search(docs, items))
    assert got == brute(rows, ITEMS)
    assert {r[2] for r in got} == {1, 3}


def test_ties_and_cells(spark, items, monkeypatch):
    """A group of copies larger than the result, over several tasks, scored a document at a time."""
    monkeypatch.setattr(automaton, "CELLS", 1)
    docs = spark.range(500, 0, -1, 7).select(F.col("id").alias("doc_id"), F.lit("the fox and the dog").alias("text"))
    docs = docs.union(spark.range(600, 900).select(F.col("id"), F.lit("other words"))).union(spark.createDataFrame([(None, "a dog")], "doc_id long, text string"))
    got = found(automaton.search(docs, items))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS)


def test_empty_tables_and_extra_columns(empty, odd, items, clashing):
    assert found(automaton.search(empty, items)) == []
    assert found(automaton.search(odd, items.limit(0))) == []
    assert found(automaton.search(odd, items.filter("text is null"))) == []
    more = items.select("*", *[F.lit(1).alias(c) for c in ("item", "term", "n", "block", "score")])
    more_docs = clashing.withColumn("item", F.lit(2)).withColumn("terms", F.lit("dog"))
    assert found(automaton.search(more_docs, more)) == found(automaton.search(clashing.select("doc_id", "text"), items))
