import re

import numpy as np

from lodebar.llm import words

TEXTS = ["The the THE\x0bthe", "", None, " a\tb\nc\x0cd\re ", "café Été x", "x" * 70, "a b " * 40, " y \x1cz"]


def plain(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def taken(texts):
    out = {}
    for first, h, at in words.word_hashes(texts):
        for i in range(len(at) - 1):
            out[first + i] = h[at[i] : at[i + 1]].tolist()
    return [out.get(i, []) for i in range(len(texts))]


def test_equal_words_and_only_those_have_equal_hashes(monkeypatch):
    for part in (1 << 20, 16):  # whole, and long texts in parts
        monkeypatch.setattr(words, "PART", part)
        seen = {}
        for text, hashes in zip(TEXTS, taken(TEXTS), strict=True):
            assert len(plain(text)) == len(hashes)
            for w, h in zip(plain(text), hashes, strict=True):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_sums_between():
    assert words.sums_between(np.array([1.0, 2, 4]), np.array([0, 0, 2, 3, 3])).tolist() == [0, 3, 4, 0]
