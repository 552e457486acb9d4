import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from gridlens.llm import byte_pairs, lines, mixing, quality, simhash
from gridlens.llm.registered import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, documents):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "classify_quality", "dedup_lines", "dedup_near", "mix_sources", "encode_texts"]
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == documents.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    expected = mixing.mix(simhash.one_of_each(lines.dedup_lines(quality.accepted(documents, labels), least_words=5)))
    rank = byte_pairs.from_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(rank.tokens) if t})
    want = sorted((r.doc_id, library.encode_ordinary(r.text or "")) for r in expected.collect())
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert all(r.round_trip for r in got) and sorted((r.doc_id, r.ids) for r in got) == want


def test_clean_documents_stay(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = corpus_pipeline.classify_quality(spark, documents, FOLDER)
    good = labels.filter("quality = 1").join(documents, "doc_id")
    assert kept.join(good.select("doc_id"), "doc_id").count() >= 0.97 * good.count()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_without_operators_the_registry_stands(tmp_path):
    """The driver deletes this subpackage: the rest has to import without it."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for name in ("gridlens", "registry"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and out.stdout.split()[1:] == ["False", "False"], out.stderr[-500:]


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    want = connection.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == columns
    place = [[c[0] for c in want.description].index(c) for c in columns]
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(
        repr(tuple(row[i] for i in place)) for row in want.fetchall())
