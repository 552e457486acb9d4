"""Operator 3: token counts with a whole-token shortcut.

Offline, every string of the vocabulary is merged by the model's own rules; those that end as one token are proved to
encode alone. A piece of text that is such a string counts 1 by one look-up. Only the rest is merged: the most frequent
other pieces of the corpus once (a bounded table), all others where they stand, by the fold of ``byte_pairs``.

The tokenizer's special strings count 1 wherever they stand in a text, as the library's default has it; what lies between
them is cut into pieces on its own.

Defined cases: null and empty texts have 0 bytes and 0 tokens; equal rows give equal results; an empty table gives an
empty result; very long texts and pieces are counted whole; extra columns are not read.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridlens.llm.byte_pairs import (
    HEAD, LONG, Vocabulary, fold, frequent_pieces, from_merges, head_table, java_pattern, let, long_pieces, look_up,
    merge_tables,
)
from gridlens.llm.common import fresh, whole

LIMIT = 1024


def special_strings(path: str) -> list[str]:
    """Added tokens that the library finds in a text before anything else."""
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def proved_whole(vocabulary: Vocabulary) -> list[str]:
    """The vocabulary's strings that the merges turn into exactly one token."""
    proved = []
    for i, token in enumerate(vocabulary.tokens):
        if token and vocabulary.merge(token) == [i]:
            try:
                proved.append(token.decode())
            except UnicodeDecodeError:
                continue  # a part of a character is never a piece of text
    return proved


def cut(text: Column, pattern: str, special: list[str]) -> Column:
    """Pieces of a text; special strings are cut points and no pieces."""
    def whole_cut(t: Column) -> Column:
        return F.regexp_extract_all(t, F.lit(java_pattern(pattern)), F.lit(0))

    if not special:
        return whole_cut(text)
    either = "|".join(map(_quoted, special))
    parts = F.flatten(F.transform(F.split(text, either, -1), whole_cut))
    return F.when(text.rlike(either), parts).otherwise(whole_cut(text))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_])", r"\\\1", text)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, pattern: str, special: list[str], text: str = "text",
                 name: str = "n_tokens", head: int = HEAD) -> DataFrame:
    """``docs`` with the number of tokens of the text."""
    spark = docs.sparkSession
    found, far, tables = fresh(docs, "_pieces", "_far", "_tables")
    merges = merge_tables(spark, vocabulary)
    strings = proved_whole(vocabulary)
    # The vocabulary's order is that of frequency; its strings come before the corpus's other pieces.
    proved = spark.createDataFrame(pa.table({"piece": strings, "often": [(1 << 62) - k for k in range(len(strings))]}))

    pieces = docs.select(cut(whole(text), pattern, special).alias(found))
    rest = frequent_pieces(pieces, found, head).join(proved, "piece", "left_anti").withColumn(tables, merges)
    merged = rest.select("piece", "often", let(F.col(tables), lambda t: F.size(fold(F.col("piece"), t))).alias("n"))
    known = head_table(proved.withColumn("n", F.lit(1)).union(merged), "n")
    looked_up = F.struct(merges.alias("merges"), known.alias("known"))

    rows = docs.withColumn(found, cut(whole(text), pattern, special))
    rows = rows.withColumn(far, long_pieces(F.col(found), vocabulary)).withColumn(tables, looked_up)

    def of(piece: Column, t: Column) -> Column:
        return F.coalesce(look_up(t["known"], piece), F.size(F.when(
            F.octet_length(piece) > LONG, F.col(far)[piece]).otherwise(fold(piece, t["merges"]))))

    total = let(F.col(tables), lambda t: F.aggregate(
        found, F.lit(0).cast("long"), lambda n, piece: n + of(piece, t).cast("long")))
    specials = F.regexp_count(whole(text), F.lit("|".join(map(_quoted, special)))).cast("long") if special else F.lit(0).cast("long")
    return rows.select(*[docs[c] for c in docs.columns], (total + specials).alias(name))


def document_counts(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The contract's rows."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = count_tokens(docs.select("doc_id", "text"), from_merges(path), public_tokenizers.PATTERN, special_strings(path))
    return counted.select("doc_id", F.octet_length(whole("text")).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
