"""Operator 13: the index against all boundaries, cuts against slices of code points."""

import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gridlens.llm import rank_index
from tests.llm.conftest import by_id

LETTERS = st.text(alphabet="aé日\U0001f600\n", max_size=400)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(LETTERS, st.integers(1, 40)), max_size=5), st.sampled_from([1, 3, 127]), st.sampled_from([3, 64, 1 << 20]))
def test_every_boundary_is_exact(parts, error, chunk):
    text = "".join(t * n for t, n in parts)
    octets = text.encode()
    index = rank_index.learn(octets, error, chunk)
    want = np.cumsum([0] + [len(c.encode()) for c in text])
    assert index.n == len(text)
    assert (index.offset(np.arange(len(want))) == want).all()
    assert np.abs(want - index.predict(np.arange(len(want)))).max() <= error


def test_a_line_is_one_segment():
    assert len(rank_index.learn(b"a" * 500_000).first) == 1
    assert len(rank_index.learn(("日" * 300_000).encode()).first) == 1
    assert 2 <= len(rank_index.learn(("a" * 9000 + "日" * 9000).encode()).first) <= 4


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}" if form == "psm" else f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, form, a, b - a, out


def check(df):
    cut = rank_index.transform(df.select("doc_id", "text")).withColumn("back", rank_index.restored())
    rows = cut.collect()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")
        assert (r.segments is None) == (r.form == "plain")
    return {r.form for r in rows}


def test_odd_documents(odd):
    check(odd)


def test_documents_and_sentinels(spark, documents):
    assert check(documents) == {"plain", "psm", "spm"}
    texts = ["<P>", "a<S>b", "<M", "<P<S", "S><M", "><<S", "<", "é<P日", "<<<<", "P>S>M>"] * 12
    tricky = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert check(tricky) == {"plain", "psm", "spm"}


def test_long_text(spark):
    long = "".join(chr(97 + k % 26) + "日é"[k % 2] * (k % 7 // 5) for k in range(1_500_000))
    check(spark.createDataFrame([(k, long) for k in range(3)], "doc_id long, text string"))


def test_empty_table_and_clashing_columns(empty, clashing):
    assert rank_index.document_forms(empty).collect() == []
    more = clashing.select("*", *[F.lit(k).alias(c) for k, c in enumerate(("n", "form", "output", "segments", "prefix_chars"))])
    assert by_id(rank_index.document_forms(more), "*") == by_id(rank_index.document_forms(clashing.select("doc_id", "text")), "*")
    kept = rank_index.transform(more)
    assert sorted(kept.columns) == sorted(set(more.columns) | {"middle_chars"})
    assert by_id(kept, "doc_id", "output") == by_id(rank_index.transform(clashing.select("doc_id", "text")), "doc_id", "output")
