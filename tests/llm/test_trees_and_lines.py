"""Operators 5 and 8."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from gridlens.llm import lines, merkle


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def _tree(text):
    paragraphs = []
    for line in text.split("\n"):
        leaves = [_md5(x) for x in re.findall(r"[^.!?]{1,64}[.!?]*|[.!?]+", line)]
        paragraphs.append((_md5("".join(leaves)), leaves))
    sections = [_md5(r) for r in re.split("(?<=[01]) ", " ".join(d for d, _ in paragraphs))]
    return _md5("".join(sections)), sections, paragraphs


def _like(a, b):
    if a[0] == b[0]:
        return 1.0
    x, y = ({leaf for _, found in t[2] for leaf in found} for t in (a, b))
    return 1.0 if not x and not y else 2 * len(x & y) / (len(x) + len(y))


def test_fingerprints_against_plain_python(documents):
    rows = documents.select("doc_id", "text").collect()
    rows.sort(key=lambda r: -r.doc_id)
    want = {}
    for k, r in enumerate(rows):
        other = rows[(k + 1) % len(rows)].text
        cut = len(r.text) // 3
        edited = r.text[:len(r.text) - cut] + other[:cut]
        own, changed, following = _tree(r.text), _tree(edited), _tree(other)
        want[r.doc_id] = (len(r.text), hashlib.sha256(edited.encode()).hexdigest(), own[0], changed[0],
                          round(_like(own, changed), 9), round(_like(own, following), 9))
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
           for r in merkle.fingerprints(documents).collect()}
    assert got == want


def test_next_document_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 7)
    ids = [5 * k for k in range(100)] + [17, 17, None, None]
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(5)
    rows = merkle.with_next(docs, "doc_id", ["doc_id", "text"]).collect()
    order = sorted((i for i in ids if i is not None), reverse=True) + [None, None]
    assert len(rows) == len(ids)
    following = defaultdict(list)
    for r in rows:
        following[r.doc_id].append(r.next_doc_id)
    for a, b in zip(order, order[1:] + order[:1]):
        following[a].remove(b)
    assert not any(following.values())
    assert sorted(r.next_text for r in rows) == sorted(r.text for r in rows)


def test_one_document_is_its_own_successor(spark, empty, odd):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    row = merkle.fingerprints(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0
    assert merkle.fingerprints(empty).count() == 0
    rows = merkle.fingerprints(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1


def test_edits_name_the_changed_paragraphs(spark):
    text = [f"Paragraph {k} has some words. And a second sentence." for k in range(60)]
    changed = [*text]
    changed[7], changed[41] = "Something else.", "Paragraph 41 has other words. And a second sentence."
    rows = spark.createDataFrame([("\n".join(text), "\n".join(changed))], "a string, b string")
    trees = rows.select(merkle.tree("a").alias("a"), merkle.tree("b").alias("b"))
    found = trees.select(merkle.edits(F.col("a"), F.col("b")).alias("e"), merkle.edits(F.col("a"), F.col("a")).alias("none"),
                         merkle.likeness(F.col("a"), F.col("b")).alias("l")).first()
    assert found.e == [7, 41] and found.none == [] and 0.9 < found.l < 1


def _removed(rows):
    """Lines that an earlier line matches, by looking at every pair."""
    every = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        for k, line in enumerate((text or "").split("\n")):
            words = {w for w in re.split(r"[\x20\x09-\x0D]+", line) if w}
            every.append((doc_id, k, words))
    out = defaultdict(list)
    for i, (doc_id, k, words) in enumerate(every):
        if words and any(w and 5 * len(words & w) >= 4 * len(words | w) for _, _, w in every[:i]):
            out[doc_id].append(k)
    return out


def test_lines_against_all_pairs(documents):
    rows = documents.filter("doc_id < 60").select("doc_id", "text")
    want = _removed([tuple(r) for r in rows.collect()])
    assert want and {r.doc_id: r.removed for r in lines.document_lines(rows).collect() if r.removed} == dict(want)


def test_family_of_near_lines(spark):
    base = [f"word{k}" for k in range(30)]
    texts = []
    for k in range(150):
        near = [*base]
        near[k % 30], near[(k * 7) % 30] = f"x{k}", f"y{k}"
        texts.append((k, " ".join(near) + f"\nsomething of its own {k} a{k} b{k}"))
    texts.append((500, " ".join(base[:24]) + " z1 z2"))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id: r.removed for r in lines.document_lines(docs).collect() if r.removed} == dict(_removed(texts))


def test_cleaned_texts(spark):
    docs = spark.createDataFrame([(1, "a b c\n\nd e f", 1), (2, "d e f\nnew line here", 2), (3, "c b a", 3), (4, None, 4), (5, "", 5), (None, "a b c", 6),
                                  (6, "g", 7), (6, "g", 7)], "doc_id long, text string, removed int")
    got = sorted(map(tuple, lines.dedup_lines(docs).collect()), key=lambda r: r[2])
    assert got == [(1, "a b c\n\nd e f", 1), (2, "new line here", 2), (3, "", 3), (4, None, 4), (5, "", 5), (None, "", 6), (6, "g", 7), (6, "g", 7)]
    assert lines.dedup_lines(docs, least_words=5).filter("text = ''").count() == 1


def test_lines_of_odd_and_empty_tables(odd, empty, clashing):
    assert lines.document_lines(odd).count() == odd.count()
    assert lines.document_lines(empty).count() == 0
    assert lines.dedup_lines(clashing).columns == clashing.columns
