"""Operators 1 and 3 against the libraries, and the pieces they are made of."""

import array
import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridlens.llm import byte_pairs, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_pairs.from_ranks(RANKS)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {t: i for i, t in enumerate(vocabulary.tokens) if t}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_heap_merges_as_the_library(vocabulary, library):
    for piece in ("a" * 1000, "ababab" * 50, " encyclopedia", "日本語", "éè" * 40):
        assert vocabulary.merge(piece.encode()) == [i for i in library.encode_ordinary(piece)]


def test_round_trip_of_odd_texts(odd, library):
    got = sorted(byte_pairs.round_trip(odd).collect(), key=repr)
    want = []
    for doc_id, text, *_ in map(tuple, odd.collect()):
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(array.array("I", ids).tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert list(map(tuple, got)) == sorted(want, key=repr)


def test_small_head_changes_nothing(documents, vocabulary, library):
    coded = byte_pairs.encode(documents.limit(20), vocabulary, public_tokenizers.PATTERN, head=50)
    for row in coded.collect():
        assert row.ids == library.encode_ordinary(row.text)


def test_extra_columns_stay(clashing, vocabulary):
    coded = byte_pairs.encode(clashing.drop("ids"), vocabulary, public_tokenizers.PATTERN)
    assert coded.columns == [*clashing.drop("ids").columns, "ids"]
    assert coded.filter("_pieces <> 8 or _tables <> 9").count() == 0


def test_unknown_ids_decode_to_null(spark, vocabulary):
    rows = spark.createDataFrame([([1, 2],), ([10 ** 9],), ([],)], "ids array<int>")
    assert [r.decoded is None for r in byte_pairs.decode(rows, vocabulary).collect()] == [False, True, False]


def test_empty_table(empty):
    assert byte_pairs.round_trip(empty).count() == 0
    assert token_counts.document_counts(empty).count() == 0


def test_counts_of_odd_texts(odd):
    model = Tokenizer.from_file(MODEL)
    got = sorted(map(tuple, token_counts.document_counts(odd).collect()), key=repr)
    want = []
    for doc_id, text, *_ in map(tuple, odd.collect()):
        n = len(model.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert got == sorted(want, key=repr)


def test_proved_strings_are_one_token():
    vocabulary, model = byte_pairs.from_merges(MODEL), Tokenizer.from_file(MODEL)
    proved = token_counts.proved_whole(vocabulary)
    assert len(proved) > 45_000
    for text in proved[::97]:
        assert len(model.encode(text, add_special_tokens=False).ids) == 1


def test_pattern_cuts_like_the_library(spark):
    import regex

    texts = ["a b c  d", "it's we'll\n\n x\x85y", "\x1c\x1d 12ab ²٣", "tail   ", "　"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(byte_pairs.pieces(F.col("t"), public_tokenizers.PATTERN)).collect()
    space = r"[\x09-\x0D\x20\x85\xA0  -     　]"
    pattern = public_tokenizers.PATTERN.replace(r"[^\s", "[^" + space[1:-1]).replace(r"\S", "[^" + space[1:]).replace(r"\s", space)
    assert [r[0] for r in got] == [regex.findall(pattern, t) for t in texts]


def test_driver_holds_no_copy_of_the_head(documents, vocabulary, library, monkeypatch):
    def collected(*_):
        raise AssertionError("the pieces came to the driver")

    docs = documents.orderBy("doc_id").limit(5)
    want = {r.doc_id: library.encode_ordinary(r.text or "") for r in docs.collect()}
    monkeypatch.setattr(type(documents), "toArrow", collected)
    coded = byte_pairs.encode(docs, vocabulary, public_tokenizers.PATTERN)
    assert {r.doc_id: r.ids for r in coded.collect()} == want


def test_frequent_pieces_lie_in_their_first_slot(spark):
    rows = spark.range(600).select(F.concat(F.lit("piece"), "id").alias("piece"), ((F.col("id") * 7919) % 600).alias("often"), F.col("id").alias("v"))
    table = spark.range(1).select(byte_pairs.head_table(rows, "v", 1024).alias("t")).first().t
    placed = dict(zip(table.pieces, table.values))
    hashes = {r.piece: r.h for r in rows.select("piece", F.xxhash64("piece").alias("h")).collect()}
    often = {r.piece: (r.often, r.v) for r in rows.collect()}
    top = sorted(often, key=often.get, reverse=True)[:16]
    assert sum(table.pieces[hashes[p] & 1023] == p for p in top) >= 15
    assert len(placed) > 560 and all(placed[p] == often[p][1] for p in placed if p)


def test_equal_ranks_merge_from_the_left(spark, vocabulary):
    texts = ["a" * k for k in range(1, 60)] + [c * k for c in ("ab", "é", "the", "日本", "\x00", "0 ") for k in (2, 5, 17, 40)] + ["x" * 256]
    tables = byte_pairs.merge_tables(spark, vocabulary)
    rows = spark.createDataFrame([(t,) for t in texts], "p string").withColumn("t", tables)
    for row in rows.select("p", byte_pairs.let(F.col("t"), lambda t: byte_pairs.fold(F.col("p"), t)).alias("ids")).collect():
        assert row.ids == vocabulary.merge(row.p.encode())


def test_decoding_keeps_rows_apart(spark, vocabulary):
    lists = [[5, 300, 7], None, [], [10 ** 6], [-1, 3], [300] * 1000, [0]]
    rows = spark.createDataFrame([(k, ids) for k, ids in enumerate(lists)], "k int, ids array<int>").coalesce(1)
    for row in byte_pairs.decode(rows, vocabulary, packed="packed").collect():
        ids = lists[row.k]
        known = ids is not None and all(0 <= i < len(vocabulary.tokens) for i in ids)
        assert row.decoded == (b"".join(vocabulary.tokens[i] for i in ids) if known else None)
        assert row.packed == (None if ids is None else b"".join((i % 2 ** 32).to_bytes(4, "little") for i in ids))
