"""Operator 10 cuts plain texts itself, as the library does; each word and piece of them is met once."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gridlens.llm import repair

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_texts_of_all_plain_characters():
    tokenizer = Tokenizer.from_file(FILE)
    coded = repair._Words(tokenizer, "H")
    characters = [c for c in map(chr, range(0x110)) if c not in "\x1c\x1d\x1e\x1f"]
    plain = [c for c in characters if repair._PLAIN.fullmatch(c)]
    assert len(plain) == 95 + 5 + 62
    chosen = random.Random(3)
    texts = ["", " ", "it's WE'LL they'RE 'ST ''d o'", "Straße ÀÉÎÕÜ ÿß x² 3½ ªº µ", "a<|endoftext|>b", "<| x", "été", "İΣ K"]
    texts += [a + b for a in plain for b in plain]
    texts += ["".join(chosen.choices(characters, k=60)) for _ in range(300)] + ["".join(chosen.choices(plain, k=60)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(coded.text(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_plain_texts_need_no_normalizer():
    class Unused:
        def normalize_str(self, text):
            raise AssertionError(text)

    tokenizer = Tokenizer.from_file(FILE)
    coded = repair._Words(tokenizer, "H")
    coded.normal = Unused()
    text = "Él dijo: «no» a".replace("«", "'").replace("»", "'") + " Straße, 1984; l'été s'ÉTEINT."
    assert np.frombuffer(coded["Straße"], "<u2").tolist() == tokenizer.encode("Straße", add_special_tokens=False).ids
    assert np.frombuffer(coded.text(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_remembered_words_are_bounded():
    coded = repair._Words(Tokenizer.from_file(FILE), "H")
    for k in range(40):
        coded.text(f"w{'abcdefghij'[k % 10] * (k // 10 + 1)} ñ{k} 中{k}")
        coded.forget(20)
        assert len(coded) + len(coded.pieces) + len(coded.plain) <= 20


def test_pairs_are_counted_alike_by_both_ways():
    chosen = np.random.default_rng(1)
    for high, n in ((2 ** 17, 5000), (50, 3000), (2 ** 32 - 1, 2000), (3, 0), (3, 1)):
        left, right = (chosen.integers(0, high, n).astype(np.uint32) for _ in range(2))
        want = np.unique((left.astype(np.uint64) << np.uint64(32)) | right, return_inverse=True, return_counts=True)
        assert all((a == b).all() for a, b in zip(want, repair._count(left, right)))
