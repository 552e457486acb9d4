"""Which pairs of lines operator 8 looks at, and that none is lost by it."""

import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from gridlens.llm import lines
from tests.llm.test_trees_and_lines import _removed


def test_long_lines_with_one_rare_word_in_common_are_not_verified(spark, monkeypatch):
    """Every two of the lines share one word; none is similar to another one."""
    texts = [[] for _ in range(150)]
    for j, k in combinations(range(150), 2):
        texts[j].append(f"w{j}x{k}")
        texts[k].append(f"w{j}x{k}")
    looked_at, verified = [], lines.verified

    def counted(pairs, *rest):
        looked_at.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(lines, "verified", counted)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert not lines.document_lines(docs).filter("n_removed > 0").count()
    assert len(looked_at) == 2 and looked_at[1] == 0


def test_short_lines_of_few_words_by_all_pairs(spark):
    chosen = random.Random(5)
    words = [f"v{k}" for k in range(14)]
    rows = [(k, "\n".join(" ".join(chosen.sample(words, chosen.randint(1, 11))) for _ in range(4))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(_removed(rows))
    assert want and {r.doc_id: r.removed for r in lines.document_lines(docs).collect() if r.removed} == want


def test_lines_with_enough_words(spark):
    texts = ["", " ", "a", " a", "a b", "\t a\r b \x0b", "a a a a", "a b c d e", "x" * 200_000, "a b c d " * 50_000, "\xa0 b c d\x1c e"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    for least in (0, 1, 2, 5):
        got = {r.s: r.found for r in rows.select("s", lines.has_words("s", least).alias("found")).collect()}
        assert got == {t: len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= max(least, 1) for t in texts}
    assert rows.filter(lines.has_words("s", 3)).agg(F.count("*")).first()[0] == 4
