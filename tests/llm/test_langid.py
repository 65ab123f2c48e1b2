import random

import numpy as np
import pytest

from lodebar.llm import langid

VOCAB = {"aa": ["bado", "kedu", "lomi", "sara"], "bb": ["xyzt", "wqrp", "vjkh", "zzxw"], "cc": ["жук", "дом", "лес"]}


def text(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang]) for _ in range(n))


def plain_shares(p, count, members, rounds):
    """EM, one text at a time."""
    share = np.full(len(members), 1 / len(members))
    for _ in range(rounds):
        r = share * p[:, members]
        r = r / r.sum(axis=1, keepdims=True) * count[:, None]
        share = r.sum(axis=0) / r.sum()
    return share


def plain_set(p, count, penalty, rounds):
    """The chosen set and its shares, for one text: sets of the largest shares as long as one more language pays."""
    k = p.shape[1]
    full = plain_shares(p, count, list(range(k)), rounds)
    ranked = sorted(range(k), key=lambda i: -full[i])
    single = (count[:, None] * np.log(p)).sum(axis=0)
    best, value = {int(single.argmax()): 1.0}, single.max()
    for size in range(2, k + 1):
        members = ranked[:size]
        if full[members[-1]] <= 0.01:
            break
        share = full[members] / full[members].sum()
        for _ in range(rounds // 2):
            r = share * p[:, members]
            share = (r / r.sum(axis=1, keepdims=True) * count[:, None]).sum(axis=0)
            share = share / share.sum()
        now = (count * np.log(p[:, members] @ share)).sum() - (size - 1) * penalty * np.log(count.sum())
        if now <= value:
            break
        best, value = dict(zip(members, share, strict=True)), now
    return best


@pytest.mark.parametrize("cells", [1 << 20, 300])
def test_chosen_sets_agree_with_plain_em(cells, monkeypatch):
    """Every text's set and shares against the plain loop; in slices of languages and runs of texts too."""
    monkeypatch.setattr(langid, "CELLS", cells)
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, (6, langid.BUCKETS)) * (rng.random((6, langid.BUCKETS)) < 0.3)
    p = ((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * langid.BUCKETS)).T.astype(np.float32)
    m = langid.Mixture(list("abcdef"), p, rounds=12)
    offsets, buckets, number = [0, 0], [], []
    for _ in range(60):
        weight = rng.dirichlet(np.full(6, 0.3)) if rng.random() < 0.7 else np.eye(6)[rng.integers(6)]
        drawn, n = np.unique(rng.choice(langid.BUCKETS, rng.integers(1, 400), p=(p @ weight).astype(float) / (p @ weight).astype(float).sum()), return_counts=True)
        buckets.append(drawn)
        number.append(n.astype(float))
        offsets.append(offsets[-1] + len(drawn))
    got = m.shares(np.array(offsets), np.concatenate(buckets), np.concatenate(number))
    assert got[0] == [] and len({len(g) for g in got}) > 3
    for found, bucket, count in zip(got[1:], buckets, number, strict=True):
        want = plain_set(p[bucket].astype(float), count, m.penalty, 12)
        assert {i for i, _ in found} == set(want) and all(np.isclose(s, want[i]) for i, s in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)


def test_more_than_a_thousand_languages(spark):
    def own(i):
        rng = random.Random(i)
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(4))

    rows = [(f"l{i:04}", int(b), 40) for i in range(1200) for b in langid._buckets(own(i).encode())]
    model = spark.createDataFrame(rows, "lang string, bucket int, n long").dropDuplicates(["lang", "bucket"])
    texts = [(i, (own(i) + " ") * 9) for i in (3, 700, 1199)]
    got = langid.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == [(i, f"l{i:04}") for i, _ in texts]


def test_learns_predicts_and_splits_mixtures(spark):
    rng = random.Random(5)
    rows = [(i, text(rng, lang, 40), lang) for i, lang in enumerate(list(VOCAB) * 20)] + [(900, None, "aa"), (901, "words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    cases = [(1, text(rng, "aa", 30), 5), (2, text(rng, "bb", 30), 5), (3, text(rng, "cc", 400), 5), (4, None, 5), (5, "", 5), (6, "12 %% 3\n", 5), (7, text(rng, "aa", 60) + " " + text(rng, "bb", 30), 5), (8, text(rng, "bb", 60_000), 5), (1, "bado", 6)]
    got = langid.predict(spark.createDataFrame(cases, "doc_id long, text string, Score int"), model).collect()
    by = {(r.doc_id, r.text and len(r.text)): r for r in got}
    assert len(got) == len(cases) and "Score" not in got[0].asDict()
    assert [by[c[0], c[1] and len(c[1])].lang_pred for c in cases] == ["aa", "bb", "cc", "und", "und", "und", "aa", "bb", "aa"]
    mixed = next(r for r in got if r.doc_id == 7)
    assert [s.lang for s in mixed.shares] == ["aa", "bb"] and 0.55 < mixed.score < 0.8
    assert all(len(r.shares) == 1 and r.score == 1 for r in got if r.doc_id in (1, 2, 3, 8))
    none = langid.predict(docs, langid.learn(docs.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    from lodebar.llm.queries import op4_langid

    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = op4_langid(spark, "/root/testdata/sf0.01").where("held_out").join(truth, "doc_id").toPandas()
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.99
