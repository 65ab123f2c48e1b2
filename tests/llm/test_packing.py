import random
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from lodebar.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


_DIRECT = Tokenizer.from_file(FILE)


def coded(text):
    ids = _DIRECT.encode(text or "", add_special_tokens=False).ids + [0]
    return b"".join(i.to_bytes(4, "little") for i in ids)


def check(rows, docs, length):
    """Every token of every document once, in gapless sequences of at most ``length``."""
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    left = sorted((d, k, s // 4, len(b[s : s + 4 * length]) // 4, zlib.crc32(b[s : s + 4 * length])) for d, t in docs for b in [coded(t)] for k, s in enumerate(range(0, len(b), 4 * length)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == left
    return len(seqs), -(-sum(x[3] for x in left) // length)


def test_words_looked_up_one_by_one_give_the_ids_of_the_whole_text():
    texts = ["Don't STOP, it's 12:30\u2003now!", "a\x1cb c\x85d\xa0e", "<|endoftext|> x<|startoftext|>y", "e\u0301t\u00e9 \u0301a \u1e9e\u0130 \u03a3\u03a3", "", "   ", "\U0001f600\u200d\U0001f600 \u0915\u094d\u0937", "x" * 5000, "\ufb01 \u212b\u00a0\u3000z", "a\x01b \x01 \x01.", "Tree. TREE, tree tree, \u00c9TÉ. ΣΣ, İ, e\u0301. . , ., a., \u0301,"]
    got = packing.WordCachedTokenizer(FILE).encode(texts)
    assert [g + b"\0\0\0\0" for g in got] == [coded(t) for t in texts]


def test_table_of_words_begins_anew_when_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    t = packing.WordCachedTokenizer(FILE)
    for text in ("a b c", "c d e f g", "a a b"):
        assert t.encode([text])[0] + b"\0\0\0\0" == coded(text)


def test_pack_is_whole_and_tight(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["tree", "erthing", "a,b", "Zug"]) for _ in range(rng.randrange(0, 90)))) for i in range(600)]
    docs += [(600, None), (601, ""), (602, "word " * 1000), (603, "x"), (603, "x"), (None, "lost")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, sequence_id int")
    rows = packing.pack(df, FILE, length=128, open_bins=16).collect()
    used, least = check([r for r in rows if r.doc_id is not None], [d for d in docs if d[0] is not None], 128)
    assert used <= 1.05 * least + 2
    assert packing.pack(df.limit(0), FILE).count() == 0


def test_fullest_closes_first():
    fit = packing.BestFit(10, 2, 0)
    closed = [b for n, size in enumerate((6, 7, 8)) for b in fit.put((n,), size)]
    assert [m[0][0][0] for _, m in closed] == [2]
    assert [b for b in fit.put((3,), 3)][0][1] == [((1,), 0), ((3,), 7)]
