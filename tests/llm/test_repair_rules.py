"""Re-Pair goes on until no frequent pair is left."""

from collections import Counter

import numpy as np

from gridlens.llm import repair


def _most_frequent(symbols):
    """The highest count of a pair, of a run of one symbol every second place."""
    counts, last = Counter(), None
    for k, pair in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())):
        if last == (k - 1, pair):  # overlaps the place before
            last = None
            continue
        counts[pair] += 1
        last = (k, pair)
    return max(counts.values(), default=0)


def test_no_frequent_pair_remains():
    random = np.random.default_rng(7)
    passage = random.integers(0, 40_000, 400)
    copied = np.concatenate([np.concatenate((passage, random.integers(0, 40_000, 30))) for _ in range(500)])
    cases = (copied, np.full(5000, 7), np.tile([1, 1, 1, 2], 900), random.integers(0, 300, 30_000), random.zipf(1.3, 40_000) % 40_000)
    for ids in cases:
        rules, symbols = repair.compress(ids, 40_000)
        lengths = repair.rule_lengths(rules, 40_000)
        assert (repair.expand(symbols.astype(np.int32), rules.astype(np.int64), lengths, 40_000) == ids).all()
        assert _most_frequent(symbols) < repair.LEAST
    rules, symbols = repair.compress(copied, 40_000)
    assert repair.rule_lengths(rules, 40_000).max() >= 100


def test_rare_pair_in_a_full_place_hides_no_frequent_one():
    def place(a, b):
        hashed = (np.uint32(a) * np.uint32(0x9E3779B1)) ^ (np.asarray(b, np.uint32) * np.uint32(0x85EBCA77))
        return hashed >> np.uint32(32 - repair.PLACE_BITS)

    with np.errstate(over="ignore"):
        a, b = next((a, int(b[0])) for a in range(100, 4000)
                    if len(b := 4000 + np.flatnonzero(place(a, np.arange(4000, 40_000)) == place(1, 2))))
    ids = np.concatenate([np.array([1, 2, 40_000 + k]) for k in range(100)] + [np.array([a, b])])
    rules, symbols = repair.compress(ids, 50_000)
    assert rules.tolist() == [[1, 2]] and len(symbols) == len(ids) - 100


def test_later_rounds_count_what_can_be_frequent(monkeypatch):
    """A pair that is too rare once is not counted again; pairs of new symbols are, and those left over by the limit of a round."""
    counted, count = [], repair._count
    monkeypatch.setattr(repair, "_count", lambda left, right: counted.append(len(left)) or count(left, right))
    monkeypatch.setattr(repair, "PLACE_BITS", 1)  # every place of the hash is full
    random = np.random.default_rng(3)
    ids = np.concatenate([random.permutation(20_000), np.tile([30_000, 30_001, 30_002, 30_003], 50)])
    rules, symbols = repair.compress(ids, 40_000, round_pairs=2)
    assert len(rules) and _most_frequent(symbols) < repair.LEAST
    assert counted[0] > 20_000 and max(counted[1:]) < 500
