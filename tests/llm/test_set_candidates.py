"""What near-dedup shuffles: prefix shingles that two sets share, whole sets only of pairs that their parities leave."""

import random

import numpy as np
from pyspark.sql import functions as F

from gridlens.llm import shingle_sets, simhash


def test_parities_never_differ_more_than_the_sets():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 63, 64, 65, 200, 1000, 5000):
        base = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        for kept, more in ((n, 0), (n, 1), (n - n // 10, n // 10), (n // 2, n // 2), (n // 2, 0), (0, n), (n, 3 * n)):
            other = np.unique(np.concatenate([base[:kept], rnd.integers(0, 1 << 63, more, dtype=np.uint64)]))
            apart = len(np.setxor1d(base, other))
            least = shingle_sets._differ_at_least(shingle_sets._parity(base), shingle_sets._parity(other))
            assert least <= apart and (least > 0 or not apart or n < 64)
            if n >= 200 and kept <= n // 2 and kept + more == n:
                assert 9 * least > 2 * n  # not similar, and seen to be so


def test_few_pairs_and_shingles_are_shuffled(spark, monkeypatch):
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    passage = " ".join(word() for _ in range(80))
    texts = [" ".join(word() for _ in range(150)) + " " + passage for _ in range(24)]
    texts += [texts[0] + " " + word(), texts[1] + " " + word(), texts[1], None, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    mark = shingle_sets.digest(docs, "text", 5, simhash._majority)
    marked = docs.select("doc_id", mark.alias("d")).select("doc_id", "d.*").withColumnRenamed("node", "fingerprint").persist()
    seen, real = {}, shingle_sets.stored

    def stored(df, label):
        kept = real(df, label)
        seen[label] = seen.get(label, 0) + kept.count()
        return kept

    monkeypatch.setattr(shingle_sets, "stored", stored)
    none = spark.createDataFrame([], "f1 long, f2 long")
    found = {r.node: r.component for r in shingle_sets.near_components(marked, docs, "text", 5, none).collect()}
    ids = {}
    for r in marked.select("doc_id", "fingerprint").collect():
        ids.setdefault(found.get(r.fingerprint, r.fingerprint), []).append(r.doc_id)
    assert sorted(sorted(x) for x in ids.values() if len(x) > 1) == [[0, 24], [1, 25, 26], [27, 28]]
    # The 24 texts share a passage in pairs; only those that are similar are verified on their sets.
    assert 2 <= seen["set-pairs"] <= 4
    prefix = marked.dropDuplicates(["fingerprint"]).select("fingerprint", F.posexplode("prefix").alias("p", "k"))
    often = prefix.groupBy("k").agg(F.count("*").alias("c")).filter("c > 1")
    assert often.count() > 0
    shared = prefix.join(often, "k").count()
    # A row of each is let through by chance now and then.
    assert shared <= seen["prefixes"] <= shared + 40 < prefix.count() / 2
    marked.unpersist()
