"""From raw documents to training ids: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns documents; the last one returns token ids. ``run`` writes each result
as Parquet to the folder of ``spark.checkpoint.dir`` and reads it again as the next stage's documents.

Defined cases, for all stages: null texts count as empty ones, and a null text that no stage changes stays null; an empty text is
scored like any other, has no line to lose, is a copy of every other empty one, is never taken by the mix (it has no words) and so
is not encoded; very long texts are worked on whole; null ids are documents like others, ordered after them; rows equal in all
columns are one after near-dedup; an empty table gives an empty result of the same columns; extra columns are kept by all stages but
the last, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlens import tune
from gridlens.llm import byte_pairs, lines, mixing, quality, simhash
from gridlens.llm.common import read, stored, whole

#: Shorter lines ("Yes.") recur without having been copied.
LEAST_LINE_WORDS = 5
SHINGLE_WORDS = 5


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, unchanged. It learns from the labels that are not held out."""
    tune(spark)
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the lines that repeat earlier ones."""
    tune(spark)
    cleaned = lines.dedup_lines(docs, least_words=LEAST_LINE_WORDS)
    if "n_chars" in cleaned.columns:
        cleaned = cleaned.withColumn("n_chars", F.length(whole("text")).cast(docs.schema["n_chars"].dataType))
    return cleaned


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark)
    return simhash.one_of_each(docs, words=SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their sources' weights ask for."""
    tune(spark)
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and round_trip (the ids decode to the text) of every document."""
    tune(spark)
    import public_tokenizers

    vocabulary = byte_pairs.from_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = byte_pairs.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.encode(whole("text"), "UTF-8")
    return byte_pairs.decode(coded, vocabulary).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", classify_quality),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_near),
    ("curriculum mix", mix_sources),
    ("byte-level bpe", encode_texts),
]

#: A ridge on random features is not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
