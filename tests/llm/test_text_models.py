"""Operators 4, 9 and 10."""

import array
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridlens.llm import quality, repair, suffix_tree
from gridlens.session import scratch_path

MODEL = public_tokenizers.path("word_bpe_49k.json")


def test_isotonic_pools():
    x, y = quality.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.5, 0.2, 0.9, 0.8]), np.array([1.0, 3, 2, 2]))
    assert np.allclose(x, [1.75, 3.5]) and np.allclose(y, [0.275, 0.85])


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = (rows[rows.quality == q].score.to_numpy() for q in (1, 0))
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert (rows.predicted == rows.quality).mean() > 0.9 and rows[rows.quality == 1].predicted.mean() > 0.97
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.join(labels.filter("quality = 1"), "doc_id").count() >= 0.97 * labels.filter("quality = 1").count()


def test_quality_defined_cases(spark, odd, empty, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 0), (None, 1, 0), (6, 0, 0), (7, 1, 0), (8, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0) for r in rows)
    assert {r.score for r in quality.score_documents(odd, labels.limit(0)).collect()} == {0.999 * 0.5 + 0.001 / 3}
    assert quality.score_documents(empty, labels).count() == 0
    assert quality.accepted(clashing, labels).columns == clashing.columns


def _tokens(text):
    return (text or "").encode().lower().split() + [b""]


def test_base_scores_and_counts(documents, odd):
    rows = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    fold = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2
    count = Counter()
    for r in rows.collect():
        if not fold(r.doc_id):
            count.update(_tokens(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted(((r.doc_id, fold(r.doc_id), len(_tokens(r.text)), sum(t in count for t in _tokens(r.text)), n,
                    round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in _tokens(r.text)), 6)) for r in rows.collect()), key=repr)
    found = suffix_tree.document_scores(rows)
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in found.collect()), key=repr) == want
    held = found.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_probabilities_sum_to_one(spark):
    random = np.random.default_rng(2)
    words = [f"w{k}" for k in range(12)]
    step = random.dirichlet(np.full(12, 0.2), 12)
    texts = []
    for _ in range(300):
        at, text = 0, []
        for _ in range(20):
            at = int(random.choice(12, p=step[at]))
            text.append(words[at])
        texts.append(" ".join(text))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counts = suffix_tree.count_words(docs.select("text"))
    total = counts.agg(F.sum("n"), F.count("*")).first()
    known, n = suffix_tree.head_words(counts, total[1])
    coded = suffix_tree.code(docs, "doc_id", "text", known, n)
    tree = suffix_tree.grow(coded, n, *total)
    assert len(tree.levels) == 2 and all(len(level.states) for level in tree.levels)
    unknown = 1 / (total[0] + total[1] + 1)
    for context in ([1, 2], [3, 1], [5, 5], [0, 4], [2, 7]):
        mass = 0.0
        for word in range(len(known)):
            ids = np.array([*context, word])
            mass += 10.0 ** suffix_tree._walk(tree, ids, np.array([True, False, False]))[-1]
        rest = 10.0 ** suffix_tree._walk(tree, np.array([*context, -1]), np.array([True, False, False]))[-1] * unknown
        assert abs(mass + rest - 1) < 1e-9
    scores = suffix_tree.document_scores(docs).agg(F.sum("score"), F.sum("base_score")).first()
    assert scores[0] > 0.8 * scores[1]


def test_scores_of_an_empty_table(empty):
    assert suffix_tree.document_scores(empty).count() == 0


def test_repair_round_trip():
    random = np.random.default_rng(1)
    for ids in (np.empty(0, np.int64), np.arange(5), np.full(1000, 7), np.tile([1, 2, 3, 1, 2], 400), random.integers(0, 40, 20_000)):
        rules, symbols = repair.compress(ids, 50)
        lengths = repair.rule_lengths(rules, 50)
        assert (repair.expand(symbols, rules, lengths, 50) == ids).all()
    assert len(symbols) < len(ids) and lengths.sum() > len(lengths)


def test_random_access():
    ids = np.tile(np.arange(17), 500)
    rules, symbols = repair.compress(ids, 100)
    row = {"rules": rules.astype("<u4").tobytes(), "lengths": repair.rule_lengths(rules, 100).astype("<u4").tobytes(),
           "symbols": symbols.astype("<u2").tobytes(), "width": 2, "base": 100}
    for start, stop in ((0, 1), (5, 900), (8499, 8500), (0, 8500), (33, 33)):
        assert (repair.read_span(row, start, stop) == ids[start:stop]).all()


def test_words_as_the_library():
    tokenizer = Tokenizer.from_file(MODEL)
    coded = repair._Words(tokenizer, "H")
    for text in ("Hello, World's 42nd test!!", "ÉCOLE école ßÄ ΑΣ İx", "a\x1fb c\x1cd", "x<|endoftext|>y <|startoftext|>", "日本 語　x\x85y",
                 "tab\tnew\nline", "", "don't I'LL 'S", "\x00\x7f ok", "a_b-c d__e"):
        ids = np.frombuffer(b"".join(coded[w] for w in repair._words(text)), "<u2").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_give_the_documents_back(spark, odd, empty):
    tokenizer = Tokenizer.from_file(MODEL)
    path = scratch_path(spark, "ids")
    repair.write(repair.encode(odd, MODEL, shard_documents=3), path, tokenizer.get_vocab_size())
    got = repair.decode(spark, path).join(repair.segment_starts(spark, path), ["shard", "segment"]).orderBy("shard", "segment", "place").collect()
    coded = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in odd.collect()]
    coded.sort(key=lambda x: (x[0] is not None, x[0] or 0, array.array("I", x[1]).tobytes()))
    start, want = 0, []
    for doc_id, ids in coded:
        want.append((doc_id, start, len(ids), zlib.crc32(array.array("I", ids).tobytes())))
        start += len(ids)
    assert [(r.id, r.before + r.offset, r.n_tokens, r.crc) for r in got] == want
    nothing = scratch_path(spark, "ids")
    repair.write(repair.encode(empty, MODEL), nothing, tokenizer.get_vocab_size())
    assert repair.decode(spark, nothing).count() == 0
