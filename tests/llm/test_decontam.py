import random
import re
from collections import Counter

import numpy as np
import pytest

from lodebar.llm import decontam


def postings(index, t):
    return index.entry_of[index.at[t] : index.at[t + 1]].tolist(), index.impact_of[index.at[t] : index.at[t + 1]].tolist()


def brute_scores(index, terms):
    total = Counter()
    for t in terms:
        for entry, w in zip(*postings(index, t), strict=True):
            total[entry] += w
    return total


@pytest.fixture(scope="module")
def items():
    rng = random.Random(8)
    word = lambda: rng.choice(["the", "of", "in"]) if rng.random() < 0.3 else f"t{rng.randrange(900)}"
    return [(i, " ".join(word() for _ in range(rng.randrange(8, 40))) + ("\n" if i % 2 else ". ") + " ".join(word() for _ in range(rng.randrange(2, 9)))) for i in range(150)]


@pytest.mark.parametrize("span", [1, 3, 64])
def test_wand_finds_all_above_the_threshold_and_no_others(items, monkeypatch, span):
    monkeypatch.setattr(decontam, "SPAN", span)
    index = decontam.Index(items)
    rng = random.Random(1)
    for threshold in (0.02, 0.1, 0.3, 0.6):
        queries = []
        for _ in range(60):
            terms = set(rng.sample(range(len(index.vocabulary)), rng.randrange(0, 80)))
            if rng.random() < 0.5:
                terms |= {t for t in range(len(index.vocabulary)) if rng.randrange(150) in postings(index, t)[0]}
            queries.append(sorted(terms))
        asks = np.repeat(np.arange(60), [len(q) for q in queries])
        owner, entry, score = index.search(asks, np.array([t for q in queries for t in q], np.int64), 60, threshold)
        for k, terms in enumerate(queries):
            want = {i: s for i, s in brute_scores(index, terms).items() if s >= threshold + 1e-9}
            got = dict(zip(entry[owner == k].tolist(), score[owner == k].tolist(), strict=True))
            assert set(want) <= set(got) and all(s >= threshold - 1e-9 for s in got.values())
            assert all(abs(got[i] - s) < 1e-9 for i, s in want.items())


@pytest.mark.parametrize("work", [1, 500, 1 << 18])
def test_every_passage_is_a_query(items, monkeypatch, work):
    """Also those without an n-gram of any item; what is retrieved is what BM25 finds passage by passage."""
    monkeypatch.setattr(decontam, "WORK", work)
    index = decontam.Index(items)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "of", f"t{rng.randrange(900)}"]) for _ in range(k)) for k in (0, 1, 30, index.longest, 2 * index.longest + 1, 900)]
    texts += ["", None, "nothing known here", *(items[k][1] for k in (7, 8, 20, 33))]
    asked = []
    plainly = decontam.Index.search
    monkeypatch.setattr(decontam.Index, "search", lambda self, asks, terms, n, *more: (asked.append(n), plainly(self, asks, terms, n, *more))[1])
    got, want, passages = set(), set(), 0
    for first, hashes, offsets in decontam.word_hashes(texts, letters=True):
        got |= {(first + t, s, e, i) for t, s, e, i in index.passages(hashes, offsets)}
        for t in range(len(offsets) - 1):
            low, high = int(offsets[t]), int(offsets[t + 1])
            starts = [s for s in range(low, high, index.longest) if s == low or s + index.longest < high] or [low]
            for s in starts:
                passages += 1
                e = min(high, s + 2 * index.longest)
                terms = [k for k, v in enumerate(index.vocabulary.tolist()) if v in set(hashes[s:e].tolist())]
                want |= {(first + t, s, e, index.entries[x]) for x, score in brute_scores(index, terms).items() if score >= 1}
    assert sum(asked) == passages > 20
    assert got == want and len(want) > 5


def plain(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, least=0.6, n=5):
    """Shares of n-grams over whole texts: texts that hold an item in one place."""
    out = {}
    for d, text in docs:
        w = plain(text)
        own = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}
        for i, t in items:
            x = plain(t)
            g = {tuple(x[j : j + n]) for j in range(max(1, len(x) - n + 1))}
            if len(own & g) >= least * len(g):
                out.setdefault(d, set()).add(i)
    return out


def test_planted_items_are_found_and_clean_texts_left_alone(spark, items, monkeypatch):
    rng = random.Random(2)
    filler = lambda k: " ".join(rng.choice(["the", "of", "in", f"t{rng.randrange(900)}", f"u{rng.randrange(900)}"]) for _ in range(k))
    docs = []
    for d in range(200):
        text = filler(rng.randrange(0, 300))
        if d % 4 == 0:
            t = items[rng.randrange(150)][1]
            t = {0: t, 1: t.upper(), 2: t.replace(" ", ", "), 3: t[: int(len(t) * 0.8)]}[d // 4 % 4]
            text = text[: len(text) // 2].rsplit(" ", 1)[0] + " " + t + " " + text[len(text) // 2 :]
        docs.append((d, text))
    docs += [(200, None), (201, ""), (202, " ".join(filler(50_000).split()) + " " + items[3][1]), (203, items[4][1]), (203, items[4][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, Leaks int")
    bench = spark.createDataFrame([*items, (None, "no id at all here now"), (900, None), (901, "...")], "item_id long, text string")
    want = brute(docs, items)
    scores = []
    for most, together in ((1 << 20, 96 << 20), (6_000, 96 << 20), (6_000, 1)):  # one part, several, and several turns
        monkeypatch.setattr(decontam, "PART_BYTES", most)
        monkeypatch.setattr(decontam, "TOGETHER", together)
        got = decontam.decontaminate(df, bench).collect()
        scores.append(sorted((r.doc_id, r.contaminated, r.leaks) for r in got))
        assert len(got) == len(docs)
        found = {r.doc_id: {x.item_id for x in r.leaks} for r in got if r.contaminated}
        assert all(want[d] <= found.get(d, set()) for d in want)
        assert set(found) == set(want)
    assert len(want) > 45
    assert scores[0] == scores[1] == scores[2]  # parts change no verdict and no score
    assert decontam.decontaminate(df.limit(0), bench).count() == 0
    assert decontam.decontaminate(df, bench.limit(0)).where("contaminated").count() == 0


def test_answer_is_last_line_or_sentence():
    assert "What now?\nYes."[decontam.question_words("What now?\nYes.") :] == "\nYes."
    assert "A b c. D e."[decontam.question_words("A b c. D e.") :] == "D e."
    assert 0 < decontam.question_words("word word word word") < 19


def test_short_items_and_grams():
    index = decontam.Index([(1, "hi there"), (2, "?!"), (3, "a b c d e f")])
    assert index.ids == [1, 3] and len(index.question[1]) + len(index.answer[1]) == 2
    assert len(decontam.grams(np.zeros(0, np.uint64), 5)) == 0


def brute_by_rule(docs, items, least=0.6, n=5):
    """Texts with ``least`` of the n-grams of an item's question or of the whole item, or of its answer and half of it of its question."""
    shingles = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    out = {}
    for d, text in docs:
        own = shingles(plain(text))
        for i, t in items:
            q = shingles(plain(t[: decontam.question_words(t)]))
            whole = plain(t)
            inside = max(0, len(plain(t[: decontam.question_words(t)])) - n + 1)
            a = {tuple(whole[j : j + n]) for j in range(inside, len(whole) - n + 1)}
            has = lambda g, share, own=own: bool(g) and len(own & g) >= share * len(g) - 1e-9
            if has(shingles(whole), least) or has(q, least) or (has(a, least) and has(q, least / 2)):
                out.setdefault(d, set()).add(i)
    return out


def test_an_answer_counts_with_a_reworded_question_only(spark):
    w = lambda p, k: " ".join(f"{p}{i}" for i in range(k))
    items = [(1, w("q", 24) + "\n" + w("a", 10)), (2, "one two three"), (3, w("z", 30))]
    asks = w("q", 24).split()
    docs = [(1, w("f", 9) + " " + w("a", 10)), (2, " ".join(asks[13:]) + " " + w("a", 10)), (3, " ".join(asks[:9]) + " x"), (4, "zero one two three four"), (5, "one two x three four")]
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {d: sorted(i) for d, i in brute_by_rule(docs, items).items()}
    assert want == {2: [1]}
    assert found == {1: [], 2: [1], 3: [], 4: [2], 5: []}


def test_all_that_verification_accepts_is_retrieved(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "of", "in"]) if rng.random() < 0.4 else f"t{rng.randrange(900)}"
    words = lambda k: " ".join(word() for _ in range(k))
    rare = lambda k: " ".join(f"r{rng.randrange(10**9)}" for _ in range(k))
    # long answers, short answers, and rare words in one half only
    items = [(i, {0: words(12) + "\n" + rare(40), 1: words(30) + "\n" + words(4), 2: words(20) + " " + rare(12) + "\n" + words(3)}[i % 3]) for i in range(90)]
    docs = []
    for i, t in items:
        q = t[: decontam.question_words(t)].split()
        docs.append((len(docs), rare(15) + " " + " ".join(q) + " " + rare(15)))  # the question alone
        docs.append((len(docs), rare(15) + " " + " ".join(q[: -(-len(q) * 7 // 10)]) + " " + rare(15)))  # most of it
        docs.append((len(docs), rare(15) + " " + " ".join(t.split()[: -(-len(t.split()) * 2 // 3)]) + " " + rare(15)))
    want = brute_by_rule(docs, items)
    got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: {x.item_id for x in r.leaks} for r in got if r.contaminated} == want
    assert len(want) > 150
