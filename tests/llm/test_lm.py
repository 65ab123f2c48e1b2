import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodebar.llm import lm


def tokens(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def walk(docs, learned, mu):
    """Token by token along states, arcs and failure arcs kept in dictionaries."""
    one, two = Counter(), Counter()
    for d in docs:
        if learned(d[0]):
            t = tokens(d[1])
            one.update(t)
            two.update(zip([None, *t], t))
    n, v = sum(one.values()), len(one)
    root = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    out = []
    for d in docs:
        state, total, base = None, 0.0, 0.0
        t = tokens(d[1])
        for w in t:
            base += math.log10(root(w))
            if two[state, w]:
                total += math.log10((two[state, w] + mu * root(w)) / (one[state] + mu))
            else:
                total += math.log10(mu / (one[state] + mu)) + math.log10(root(w))
            state = w
        out.append((d[0], len(t), sum(one[w] > 0 for w in t), n, round(base, 6), round(total, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(1 << 24, 1 << 25), (700, 300)])
def test_scores_agree_with_a_walk_in_dictionaries(spark, sizes):
    rng = random.Random(1)
    vocab = ["The", "the", "of", "tree", "É", "a,b", "x1", "zz"] + [f"w{i}" for i in range(60)]
    docs = [(i, " \n".join(rng.choices(vocab, k=rng.randrange(0, 40)))) for i in range(80)]
    docs += [(80, None), (81, ""), (82, "long " * 3000), (83, "unseen words only"), (5, docs[5][1]), (None, "the tree"), *[(90, "hot row")] * 50, *[(None, None)] * 3]
    learn = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 != 1
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double").repartition(3)
    from lodebar.llm.common import crc32_of_id

    got = lm.score(df, F.pmod(crc32_of_id("doc_id"), F.lit(5)) != 1, 7.0, *sizes).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=repr) == walk(docs, learn, 7.0)
    assert lm.score(df.limit(0), F.lit(True)).count() == 0
    none = lm.score(df, F.lit(False)).collect()
    assert len(none) == len(docs) and all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score - r.base_score) < 1e-6 for r in none)


def test_better_than_single_words_on_held_out_text(spark):
    from lodebar.llm.queries import op1_lm_score

    held = op1_lm_score(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]
