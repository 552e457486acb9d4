"""Which lines are long enough for line dedup in the pipeline."""

import corpus_pipeline


def test_long_lines_of_few_different_words_are_deduplicated(spark):
    line = "again and " * 40
    docs = spark.createDataFrame([(1, f"{line}\nyes it is so"), (2, f"other words stand here first\n{line}\nyes it is so")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()}
    assert got == {1: f"{line}\nyes it is so", 2: "other words stand here first\nyes it is so"}
