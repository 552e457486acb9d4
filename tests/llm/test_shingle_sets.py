"""Near copies by set similarity against all pairs."""

import random

import corpus_pipeline
from gridlens.llm import simhash


def _sets(text, words=5):
    parts = (text or "").lower().split()
    return frozenset(tuple(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))) if parts else frozenset()


def _alike(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def _texts():
    """Texts of 40 to 300 words with copies that have up to a few words changed, and a passage that many share."""
    rnd = random.Random(11)
    word = lambda: f"w{rnd.randrange(3000)}"
    passage = [word() for _ in range(12)]
    texts = []
    for k in range(60):
        base = [word() for _ in range(rnd.randrange(40, 300))] + (passage if k % 2 else [])
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(4)):
            copy = list(base)
            for _ in range(rnd.randrange(1, max(2, len(base) // 35))):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts + [None, "", " \n", "two words", "Two  Words", "three other words"]


def test_one_of_each_group_of_similar_texts(spark):
    texts = _texts()
    sets = [_sets(t) for t in texts]
    group = list(range(len(texts)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    links = [(i, j) for i in range(len(texts)) for j in range(i) if _alike(sets[i], sets[j])]
    between = [1 for i, j in links if sets[i] and len(sets[i] & sets[j]) < 0.95 * len(sets[i] | sets[j])]
    assert len(between) > 20
    for i, j in links:
        i, j = find(i), find(j)
        group[max(i, j)] = min(i, j)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.component_id for r in simhash.near_duplicates(docs, words=5).collect()}
    assert found == {i: find(i) for i in range(len(texts))}
    kept = corpus_pipeline.dedup_near(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i in range(len(texts))})


def test_simhash_blocks_come_first(spark, monkeypatch):
    """The pipeline's near-dedup takes its first pairs from SimHash blocks; each is verified before it counts as a link."""
    words = [f"w{i}" for i in range(400)]
    near = [" ".join(words), " ".join([*words[:-1], "other"])]
    texts = [*near, " ".join(reversed(words)), "a b c d e f", None]
    assert bin((simhash._fingerprint(near[0], 5) ^ simhash._fingerprint(near[1], 5)) & ((1 << 64) - 1)).count("1") <= simhash.DISTANCE
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    real = simhash.leader_pairs

    def pairs(marked, *a):
        found = real(marked, *a)
        ids = {r.fingerprint: r.id for r in marked.collect()}
        seen.extend(sorted((ids[r.f1], ids[r.f2])) for r in found.collect())
        # A pair of different texts that a sketch could bring together by chance.
        back = {i: f for f, i in ids.items()}
        return found.union(spark.createDataFrame([tuple(sorted((back[0], back[2])))], "f1 long, f2 long"))

    monkeypatch.setattr(simhash, "leader_pairs", pairs)
    kept = sorted(r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, "").collect())
    assert seen == [[0, 1]] and kept == [0, 2, 3, 4]
