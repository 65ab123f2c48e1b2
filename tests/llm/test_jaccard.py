import random
import re

import numpy as np
import pytest

from lodebar.llm import jaccard
from lodebar.llm.components import components


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(docs, percent=75):
    sets = [(d, shingles(t)) for d, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i))) for i, (d, s) in enumerate(sets)), key=repr)


def varied(rng, words, share):
    return [rng.choice(["alpha", "beta", "gamma"]) + str(rng.randrange(999)) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(9)
    new = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    out = []
    common = new(60)
    for _ in range(12):
        base = new(rng.choice([3, 6, 20, 80, 200]))
        out += [" ".join(varied(rng, base, s)) for s in (0, 0, 0.01, 0.02, 0.04, 0.06, 0.1)]
        out.append(" ".join(base + new(len(base) // 3)))  # around the threshold by size
        out.append(" ".join(base + new(len(base) // 4)).upper())
        out.append(" ".join(common + new(rng.randrange(1, 30))))
    big = new(120)
    out += [" ".join(varied(rng, big, 0.012)) for _ in range(60)]  # a large group in which not all pairs link
    out += [" ".join(big[i : i + 60]) for i in range(0, 60, 4)]  # chains
    out += ["", None, "  \n", "one two", "one  TWO", "one two three four", "x " * 9000]
    rng.shuffle(out)
    rows = list(enumerate(out))
    walk = new(150)
    step = [" ".join(walk[i : i + 60]) for i in (0, 7, 14, 21)]  # each links with the next one only
    chain = [(1000, step[0]), (None, step[1]), (1002, step[2]), (None, step[3])]
    lone = [(None, " ".join(varied(rng, new(50), 0))), (None, " ".join(new(50))), (None, " ".join(new(50)))]
    nameless = new(70)
    lone += [(None, " ".join(nameless)), (None, " ".join(nameless[:-3])), (None, " ".join(nameless))]
    apart, shared = " ".join(new(40)), new(40)
    ids = [(2000, apart), (2000, " ".join(shared)), (2000, " ".join(shared[:-2])), (2001, " ".join(shared[1:])), (2002, apart), (2002, " ".join(new(30)))]
    return rows + chain + lone + ids + [rows[3], (None, out[5]), (None, None), (None, None), (None, "")]


@pytest.mark.parametrize("small", [False, True])
def test_components_agree_with_all_pairs(spark, docs, small, monkeypatch):
    if small:  # tiles in grids of blocks, and several packed arrays a task
        monkeypatch.setattr(jaccard, "BLOCK", 5)
        monkeypatch.setattr(jaccard, "SLICE", 500)
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, N string").repartition(3)
    got = jaccard.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(docs)


def kept_by_brute_force(rows):
    """(how many rows of each component stay, which (id, text) may)."""
    root = {i: i for i in range(len(rows))}
    sets = [shingles(t) for _, t in rows]
    for _ in rows:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if x and y and root[i] != root[j] and 100 * len(x & y) >= 75 * len(x | y):
                    low, high = sorted((root[i], root[j]))
                    root = {n: low if r == high else r for n, r in root.items()}
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(root[i] if sets[i] else -1 - i, []).append((d, t))
    return groups


def test_one_row_of_each_component_stays(spark, docs):
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, __Text string").repartition(3)
    left = [(r.doc_id, r.text) for r in jaccard.one_of_each(df).collect()]
    groups = kept_by_brute_force(docs)
    assert len(left) == len(groups)
    for rows in groups.values():
        ids = [d for d, _ in rows if d is not None]
        stays = [r for r in left if r in rows]
        assert any(d == (min(ids) if ids else None) for d, _ in stays)


def test_ids_shared_by_different_texts_lose_no_text(spark):
    w = lambda p: " ".join(f"{p}{i}" for i in range(20))
    rows = [(1, w("w")), (5, w("w")), (5, w("v")), (7, w("v")), (9, w("u")), (9, w("u")), (None, w("t")), (None, w("t"))]
    left = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted([(1, w("w")), (5, w("v")), (9, w("u")), (None, w("t"))], key=repr)


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 700):
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        for _ in range(40):
            x, y = (np.unique(rng.choice(pool[: rng.integers(1, 2 * n + 1)], rng.integers(1, n + 1))) for _ in range(2))
            size = min(len(jaccard.bitmap(x)), len(jaccard.bitmap(y)))
            p, q = jaccard.folded([jaccard.bitmap(x), jaccard.bitmap(y)], size)
            differ = np.bitwise_count(p ^ q).sum()
            assert differ <= len(np.setxor1d(x, y))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 75 * (len(x) + len(y) - both):
                assert jaccard.may_link(differ, np.int64(len(x) + len(y)), 75)
                bands = jaccard.band_of(np.array([len(x), len(y)]), 75)
                assert abs(int(bands[0]) - int(bands[1])) <= 1


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (500, 499), (500, 499), (None, 3)]
    root = {n: n for p in pairs if None not in p and p[0] != p[1] for n in p}
    for _ in range(200):
        for a, b in pairs:
            if a in root and b in root and a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == root
