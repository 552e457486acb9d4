r"""Operator 5: document fingerprints as Merkle trees, with DataFrame functions only.

A text is cut into paragraphs at line ends, a paragraph into leaves at sentence ends (and after ``LEAF`` characters without
one). A leaf is the digest of its characters, a paragraph the digest of its leaves, a section the digest of a run of
paragraphs, the root the digest of the sections. Sections end at paragraphs whose digest ends in 0 or 1, so an edit moves
no borders elsewhere. Equal roots mean equal texts; where roots differ, only differing sections and paragraphs are
entered to find the edits (``edits``), and the share of common leaves is the likeness.

``with_next`` gives every document its successor in an order over all documents without a window over all of them: documents
are numbered by range partitioning, cut into blocks of ``RANGE_ROWS``, the first document of each block is also sent to the
block before, and windows run within blocks. There are as many blocks as the documents need, whatever their ids; nothing passes
the driver.

Defined cases: null texts count as empty, an empty text is one empty paragraph without leaves; two texts without leaves
have likeness 1, a text without leaves has 0 to any other; null ids come last; equal ids are ordered by a hash of their
texts, equal rows are interchangeable, and rows of one id (or none) are spread over blocks like all others; very long texts are
cut whole; columns that clash with helper columns are kept; a single document is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlens.llm.common import whole
from gridlens.operators.ordering import add_sequence

LEAF = 64
#: Documents in a block of neighbours.
RANGE_ROWS = 1024

_LEAVES = rf"[^.!?]{{1,{LEAF}}}[.!?]*|[.!?]+"


def tree(text: str | Column = "text") -> Column:
    """struct<root, sections, paragraphs: array<struct<digest, leaves>>> of a text."""
    def paragraph(line: Column) -> Column:
        leaves = F.transform(F.regexp_extract_all(line, F.lit(_LEAVES), F.lit(0)), lambda leaf: F.md5(leaf))
        return F.get(F.transform(F.array(leaves), lambda x: F.struct(
            F.md5(F.array_join(x, "")).alias("digest"), x.alias("leaves"))), F.lit(0))

    paragraphs = F.transform(F.split(whole(text), "\n", -1), paragraph)

    def complete(found: Column) -> Column:
        return F.get(F.transform(F.array(sections(F.transform(found, lambda p: p["digest"]))), lambda s: F.struct(
            F.md5(F.array_join(s, "")).alias("root"), s.alias("sections"), found.alias("paragraphs"))), F.lit(0))

    return F.get(F.transform(F.array(paragraphs), complete), F.lit(0))


def runs(digests: Column) -> Column:
    """Runs of paragraph digests that make a section, as strings."""
    return F.split(F.array_join(digests, " "), "(?<=[01]) ", -1)


def sections(digests: Column) -> Column:
    return F.transform(runs(digests), lambda run: F.md5(run))


def leaves(a: Column) -> Column:
    return F.flatten(F.transform(a["paragraphs"], lambda p: p["leaves"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of leaves that two trees have in common: 1 for equal roots, else twice the common over all different leaves."""
    own, other = F.array_distinct(leaves(a)), F.array_distinct(leaves(b))
    total = F.size(own) + F.size(other)
    share = F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(own, other)) / total)
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(share)


def edits(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``a`` that ``b`` does not have; equal sections are not entered."""
    digests = F.transform(a["paragraphs"], lambda p: p["digest"])
    own_runs = runs(digests)
    other = F.transform(b["paragraphs"], lambda p: p["digest"])
    open_run = F.array_except(F.transform(own_runs, lambda r: F.md5(r)), b["sections"])
    numbered = F.flatten(F.transform(own_runs, lambda r: F.transform(
        F.split(r, " "), lambda d: F.array_contains(open_run, F.md5(r)) & ~F.array_contains(other, d))))
    places = F.transform(numbered, lambda changed, i: F.when(changed, i))
    return F.when(a["root"] == b["root"], F.array().cast("array<int>")).otherwise(F.filter(places, lambda i: i.isNotNull()))


def with_next(docs: DataFrame, id_column: str, columns: list[str], prefix: str = "next_") -> DataFrame:
    """``docs`` with ``columns`` of the next document in descending order of the id (after the last: the first)."""
    packed = docs.select(F.struct("*").alias("doc"), F.col(id_column).cast("long").alias("id"), F.xxhash64(*columns).alias("h"))
    numbered = add_sequence(packed, [F.col("id").desc_nulls_last(), "h"], "n").select("doc", "n")
    rows = numbered.agg(F.count("*")).scalar()
    block, last = F.floor((F.col("n") - 1) / RANGE_ROWS), F.floor((rows - 1) / RANGE_ROWS)
    # The first document of each block is the next one of the block before, that of the first block of the last.
    here = F.struct(block.alias("block"), F.lit(0).alias("extra"))
    before = F.struct(F.when(block == 0, last).otherwise(block - 1).alias("block"), F.lit(1).alias("extra"))
    is_first = (F.col("n") - 1) % RANGE_ROWS == 0
    sent = numbered.withColumn("to", F.explode(F.when(is_first, F.array(here, before)).otherwise(F.array(here)))).select(
        "doc", "n", "to.block", "to.extra")
    window = Window.partitionBy("block").orderBy("extra", "n")
    joined = sent.select("doc", "extra", *[F.lead(F.col("doc")[c]).over(window).alias(f"next_{i}") for i, c in enumerate(columns)])
    return joined.filter("extra = 0").select(
        "doc.*", *[F.col(f"next_{i}").alias(prefix + c) for i, c in enumerate(columns)])


def edited_text(text: Column, other: Column) -> Column:
    """The last third of the code points replaced by the first as many of the other text."""
    size = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - size), F.substring(other, F.lit(1), size))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    texts = docs.select("doc_id", whole("text").alias("text"))
    rows = with_next(texts, "doc_id", ["text"]).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    trees = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        tree("text").alias("own"), tree("edited").alias("changed"), tree("next_text").alias("other"))
    own, changed, other = F.col("own"), F.col("changed"), F.col("other")
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", own["root"].alias("fingerprint"), changed["root"].alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, other).alias("near_next"),
        F.size(own["sections"]).alias("n_sections"), F.size(edits(own, changed)).alias("n_changed_paragraphs"))


def sql() -> str:
    """DuckDB SQL for ``fingerprints``."""
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    n AS (
        SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS other, length(text) // 3 AS k
        FROM t WINDOW w AS (ORDER BY doc_id DESC NULLS LAST)),
    e AS (SELECT *, substr(text, 1, length(text) - k) || substr(other, 1, k) AS edited FROM n),
    every AS (
        SELECT doc_id, 'own' AS part, text AS s FROM e UNION ALL SELECT doc_id, 'edited', edited FROM e
        UNION ALL SELECT doc_id, 'other', other FROM e),
    leaves AS (
        SELECT doc_id, part, list_transform(string_split(s, chr(10)), lambda p: list_transform(
            regexp_extract_all(p, '[^.!?]{{1,{LEAF}}}[.!?]*|[.!?]+'), lambda x: md5(x))) AS paragraphs FROM every),
    digests AS (
        SELECT doc_id, part, list_distinct(flatten(paragraphs)) AS leaves,
               list_transform(paragraphs, lambda p: md5(array_to_string(p, ''))) AS digests FROM leaves),
    runs AS (
        SELECT *, string_split(regexp_replace(array_to_string(digests, ' '), '([01]) ', '\1|', 'g'), '|') AS runs FROM digests),
    trees AS (
        SELECT *, list_transform(runs, lambda r: md5(r)) AS sections,
               md5(array_to_string(list_transform(runs, lambda r: md5(r)), '')) AS root FROM runs)
    SELECT e.doc_id, CAST(length(e.text) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, a.root AS fingerprint,
           b.root AS edited_fingerprint,
           CASE WHEN a.root = b.root OR len(a.leaves) + len(b.leaves) = 0 THEN 1.0
                ELSE 2.0 * len(list_intersect(a.leaves, b.leaves)) / (len(a.leaves) + len(b.leaves)) END AS near_edited,
           CASE WHEN a.root = c.root OR len(a.leaves) + len(c.leaves) = 0 THEN 1.0
                ELSE 2.0 * len(list_intersect(a.leaves, c.leaves)) / (len(a.leaves) + len(c.leaves)) END AS near_next,
           CAST(len(a.sections) AS INTEGER) AS n_sections,
           CAST(CASE WHEN a.root = b.root THEN 0 ELSE list_sum(list_transform(a.runs, lambda r:
               CASE WHEN list_contains(b.sections, md5(r)) THEN 0 ELSE len(list_filter(string_split(r, ' '),
                    lambda d: NOT list_contains(b.digests, d))) END)) END AS INTEGER) AS n_changed_paragraphs
    FROM e JOIN trees a ON a.doc_id = e.doc_id AND a.part = 'own' JOIN trees b ON b.doc_id = e.doc_id AND b.part = 'edited'
    JOIN trees c ON c.doc_id = e.doc_id AND c.part = 'other'"""
