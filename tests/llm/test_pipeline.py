import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage reads and returns on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs.toPandas(), after.toPandas()))
        docs = after
    return out


def test_columns_and_kept_rows(stages):
    for _, before, after in stages[:-1]:
        assert list(after.columns) == list(before.columns)
        assert set(after.doc_id) <= set(before.doc_id) and len(after)
        texts = before.set_index("doc_id").text
        assert all(texts[i] == t for i, t in zip(after.doc_id, after.text, strict=True))
    assert set(stages[-1][2].doc_id) == set(stages[-1][1].doc_id)


def test_language_and_quality_keep_good_documents(spark, stages):
    assert len(stages[0][2]) == len(stages[0][1])
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    _, before, after = stages[1]
    kept = set(after.doc_id)
    good = [i for i in before.doc_id if labels.get(i) == 1]
    bad = [i for i in before.doc_id if labels.get(i) == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_one_of_each_component_stays(stages):
    _, before, after = stages[2]
    sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text, strict=True)}
    low = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    assert set(after.doc_id) == {i for i in ids if low[i] == i}


def test_no_test_item_is_left(spark, stages):
    _, before, after = stages[3]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text
    holds = lambda t: any(x in t for x in items)
    leaking = {i for i, t in zip(before.doc_id, before.text, strict=True) if holds(t)}
    assert not leaking & set(after.doc_id) and set(before.doc_id) - set(after.doc_id) <= {
        i for i, t in zip(before.doc_id, before.text, strict=True) if any(len(shingles(x) & shingles(t)) >= 0.4 * len(shingles(x)) for x in items)
    }


def test_odd_rows_pass_through_every_stage(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice(["thing", "er", "ation", "the", "onder"]) + rng.choice("abcdef") for _ in range(60))
    rows = [(i, text(), "en", "s", 1) for i in range(20)] + [(50, None, None, None, None), (51, "", "en", "s", 0), (52, "12 %%", "en", "s", 5), (None, text(), "en", "s", 9), (3, "w" * 100_000, "en", "s", 9)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs, SF).count() > 0
    left = {r.doc_id for r in cp.identify_language(spark, docs, SF).collect()}
    assert not left & {50, 51, 52} and None in left
    assert cp.drop_near_duplicates(spark, docs, SF).count() == len(rows)


def test_run_ends_in_packed_pieces(spark, stages):
    rows = cp.run(spark, SF).agg(F.countDistinct("doc_id"), F.max(F.col("offset") + F.col("length"))).first()
    assert rows[0] == stages[-1][2].doc_id.nunique() and rows[1] <= 2048
