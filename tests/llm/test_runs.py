import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from lodebar.llm import queries
from lodebar.llm.runs import collapse_runs, find_runs, least_overlap

SF = "/root/testdata/sf0.001"


def brute(w, least=6, times=4):
    """Every maximal stretch for every period, kept if no smaller period gives the same stretch."""
    found = {}
    for q in range(1, len(w) // times + 1):
        at = q
        while at < len(w):
            if w[at] != w[at - q]:
                at += 1
                continue
            start = at - q
            while at < len(w) and w[at] == w[at - q]:
                at += 1
            if at - start >= max(least, times * q):
                found.setdefault((start, at), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def test_smallest_overlap():
    assert least_overlap(6, 4) == 5 and least_overlap(4, 4) == 3 and least_overlap(10, 4) == 8
    for least in range(1, 30):
        for times in range(4, 9):
            assert least_overlap(least, times) == min(max(least, times * q) - q for q in range(1, 200))


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_runs_agree_with_trying_every_period(letters):
    rng = random.Random(letters)
    for n in [*range(14), *(rng.randrange(14, 90) for _ in range(400))]:
        w = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.7:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(3, 11)
            w = w[:a] + [w[a + i % p] for i in range(n - a)]
            w = w[: a + rng.randrange(n - a + 1)] + w[rng.randrange(n) :]
        assert find_runs(np.array(w, np.int64)) == brute(w), w


def test_other_bounds_and_nested_runs():
    rng = random.Random(5)
    for least, times in ((1, 4), (4, 4), (9, 5), (12, 7)):
        for _ in range(150):
            block = [rng.randrange(2) for _ in range(rng.randrange(1, 9))]
            w = ([9] * rng.randrange(3) + block * rng.randrange(1, 7)) * rng.randrange(1, 5) + block[:3]
            assert find_runs(np.array(w), least, times) == brute(w, least, times), (w, least, times)


def test_long_texts_stay_cheap():
    began = time.process_time()
    assert find_runs(np.zeros(400_000, np.int64)) == [(0, 400_000, 1)]
    long = np.tile(np.arange(30_000), 7)
    assert find_runs(long) == [(0, 210_000, 30_000)]
    pair = np.tile(np.repeat([0, 1], [40, 40]), 1000)
    found = find_runs(pair)
    assert len(found) == 2001 and (0, 80_000, 80) in found
    a, b = [0], [0, 1]
    while len(b) < 120_000:
        a, b = b, b + a
    assert all(n >= 4 * q for _, n, q in find_runs(np.array(b)))
    assert time.process_time() - began < 30


def by_contract(doc, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc).encode() if doc is not None else b"")
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    row = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *row, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(collapsed(words, runs))))


def test_whole_query_agrees_with_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect())
    assert got == sorted(by_contract(*d) for d in docs)
    assert sum(r[1] > 0 for r in got) >= 10


def test_odd_rows(spark, tmp_path):
    tail = " ".join(["x y"] * 10)
    rows = [(1, None, 7), (2, "", 7), (3, " \t\x0b\x0c\r\n", 7), (4, "A a A a A a A a", 7), (5, "z " + tail, 7), (5, "z " + tail, 7), (None, "w " * 9, 7), (6, "é b " * 8 + "c", 7), (7, "q " * 2_000, 7), (30, "one two three four", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, RUNS int")
    got = {(r.doc_id, r.n_words): r for r in collapse_runs(df).collect()}
    assert collapse_runs(df).count() == len(rows) and collapse_runs(df.limit(0)).count() == 0
    assert got[1, 0].runs == [] and got[1, 0].collapsed == "" and got[3, 0].collapsed == ""
    assert [tuple(r) for r in got[4, 8].runs] == [(0, 8, 2)] and got[4, 8].collapsed == "A a"
    assert [tuple(r) for r in got[5, 21].runs] == [(1, 20, 2)] and got[5, 21].collapsed == "z x y"
    assert got[None, 9].collapsed == "w" and got[6, 9].collapsed == "é b c" and got[7, 2_000].collapsed == "q"
    df.write.parquet(f"{tmp_path}/documents.parquet")
    made = sorted((tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert made == sorted((by_contract(d, t) for d, t, _ in rows), key=repr)
