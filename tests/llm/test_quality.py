import math
import random

import numpy as np
import pytest

from lodebar.llm import quality

GOOD, BAD = ["tree", "river", "stone", "light", "music"], ["BUY!!", "$$$", "click", "now!!", "%%%"]


def plain_weights(docs, good):
    """Counts in dictionaries over the same buckets."""

    def grams(text):
        return [b for first, h, at in quality.word_hashes([text]) for part, _ in quality.gram_buckets(h, at) for b in part.tolist()]

    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, t in docs:
        for g in grams(t):
            raw[g] += 1
            target[g] += i in good
    p = (raw + 0.5) / (raw + 0.5).sum()
    q = (target + 0.5 * quality.BUCKETS * p) / (target.sum() + 0.5 * quality.BUCKETS)
    return {i: sum(math.log(q[g] / p[g]) for g in grams(t)) for i, t in docs}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(BAD if i % 5 == 0 else GOOD) for _ in range(rng.randrange(10, 60)))) for i in range(200)]
    return docs + [(200, None), (201, ""), (202, " ".join(rng.choice(GOOD) for _ in range(30_000)))]


def test_pairs_stay_inside_texts():
    for _, h, at in quality.word_hashes(["a b c", "", "d", "e f", None]):
        (_, one), (pair, two) = quality.gram_buckets(h, at)
        assert np.diff(one).tolist() == [3, 0, 1, 2, 0] and np.diff(two).tolist() == [2, 0, 0, 1, 0] and len(pair) == 3


def test_weights_and_selection(spark, corpus):
    docs = spark.createDataFrame([(*d, 9) for d in corpus], "doc_id long, text string, KEEP int")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(100)] + [(0, 1, 0), (7, None, 0), (999, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.resample(docs, labels).collect()}
    want = plain_weights(corpus, {i for i in range(100) if i % 5})
    assert len(got) == len(corpus) and all(math.isclose(got[i].log_weight, want[i], abs_tol=1e-6) for i in want)
    assert all(got[i].keep == (i % 5 > 0) for i in range(200)) and got[202].keep
    n = quality.resample(docs, labels, keep_share=0.25).where("keep").count()
    assert n == round(0.25 * len(corpus))
    assert quality.resample(docs, labels.limit(0)).where("not keep").count() == 0
    assert quality.resample(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("temperature", [0.0, 1.0, 5.0])
def test_kept_rows_are_the_gumbel_top_k(spark, temperature):
    """Keys and kept rows against plain Python; at a temperature of 1 noise already decides about some."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(GOOD + BAD[: i % 6]) for _ in range(rng.randrange(1, 400)))) for i in range(300)]
    labels = [(i, int(i % 6 < 3), 0) for i in range(0, 300, 2)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.resample(*frames, temperature=temperature, keep_share=0.3).collect()
    weights = plain_weights(docs, {i for i, good, _ in labels if good})
    words = {i: len(t.split()) for i, t in docs}
    scaled = {i: w * quality.LENGTH / (2 * words[i] - 1 + quality.LENGTH) for i, w in weights.items()}
    noise = {r.doc_id: r.n for r in frames[0].select("doc_id", quality.noise("doc_id", 1.0, 7).alias("n")).collect()}
    top = sorted(scaled, key=lambda i: -(scaled[i] + temperature * noise[i]))[:90]
    assert {r.doc_id for r in got if r.keep} == set(top)
    largest = set(sorted(scaled, key=lambda i: -scaled[i])[:90])
    assert (set(top) == largest) == (temperature == 0)
    assert abs(np.mean(list(noise.values())) - 0.577) < 0.25 and 1.0 < np.std(list(noise.values())) < 1.6


def test_kth_largest(spark):
    rng = random.Random(4)
    values = [rng.choice([rng.gauss(0, 1), 1e-9 * rng.random(), 2.0, -1e300, 5e-324]) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").cache()
    for k in (1, 2, 700, 1500, 2999, 3000):
        assert quality.kth_largest(rows, "v", k) == sorted(values, reverse=True)[k - 1]
    assert quality.kth_largest(rows, "v", 0) == math.inf


def test_best_bound():
    good, weight = np.array([True, False, True, False, True]), np.array([3.0, 1.0, 2.0, 2.5, 4.0])
    errs = {b: (good & (weight < b)).sum() / 3 + (~good & (weight >= b)).sum() / 2 for b in (0, 1.5, 2.25, 2.75, 3.5, 5)}
    assert errs[quality.best_bound(good, weight)] == min(errs.values())
    assert quality.best_bound(np.ones(3, bool), np.arange(3.0)) == -math.inf
