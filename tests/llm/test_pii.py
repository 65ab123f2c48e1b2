import os
import random
import re

import duckdb
import pytest

from lodebar.llm import pii, queries

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def found(spark, texts):
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "n int, text string")).orderBy("n").collect()
    return [[(s.kind, s.start, s.end) for s in r.pii] for r in rows]


def base(spans):
    return [s for s in spans if s[0] in pii.BASE]


ODD = [
    None, "", "a@b.c", "a@b", "a@b@c.d", "x@y.z+w@v.u", "a@b.c..d@e.f", "a@b.-c.", "@b.c", "1.2.3.4.5.6.7.8", "1.2.3.4.5", "256.1.1.1 1.2.3.4", "001.002.003.0255", "0.0.0.0", "1.2.3", "12345678901234567890123.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111", "4111--1111-1111-1111", "44111111111111111", "4111 1111 1111 1111 2", "0000000000000", "+1 (499) 555-6503", "+1234", "+1 2 3 4 5 6 7 8 9)", "+1+123456789", "++49 30 123456",
    "é\U0001f600 a@b.c é +49 30 123456 𝄞 10.0.0.1", "+4111111111111111", "x%y@z-.-", "tel +1.2.3.4 5678", "a\n@b.c\nd@e.f\n", "4111 1111\n1111 1111",
]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(12)
    parts = [*"aZ09.@+-% ()\n", "é", "@b.c", "+49", " 4111 1111 1111 1111", "1.2.3.4", "10.", "12", "-", "a@b.co"]
    texts = [*ODD, *("".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(1500))]
    for text, got in zip(texts, found(spark, texts), strict=True):
        assert base(got) == brute(text), text
    assert sum(map(len, map(brute, texts))) > 500


def test_many_and_long_matches(spark):
    """Texts on which the plain patterns would take hours or run out of stack."""
    n, mail = 20_000, "a@b" + ".c" * 200_000
    want = {
        "a" * 300_000: [], "1" * 300_000: [], "1 " * 200_000: [], mail: [("email", 0, len(mail))], "1." * 40_000: [("ip", 8 * i, 8 * i + 7) for i in range(10_000)],
        "+" * 100_000 + "1 " * 50_000: [], "a@b.c " * n: [("email", 6 * i, 6 * i + 5) for i in range(n)], "A" * 200_000: [],
        "10.0.0.1 +49 30 123456\n" * n: [("ip", 23 * i, 23 * i + 8) for i in range(n)] + [("phone", 23 * i + 9, 23 * i + 22) for i in range(n)],
    }
    for got, spans in zip(found(spark, list(want)), want.values(), strict=True):
        assert base(got) == spans


def test_added_kinds_need_their_checks_and_words(spark):
    got = found(
        spark,
        ["IBAN DE89 3704 0044 0532 0130 00.", "DE89370400440532013000", "DE88370400440532013000", "XDE89370400440532013000", "GB82WEST12345698765432, x", "my SSN: 219-09-9999", "219-09-9999", "social security 219-00-9999", "ssn order 219-09-9999", "ssn 1219-09-9999"],
    )
    assert [[s[0] for s in g if s[0] not in pii.BASE] for g in got] == [["iban"], ["iban"], [], [], ["iban"], ["ssn"], [], [], [], []]
    assert got[0][-1] == ("iban", 5, 32) and got[5] == [("ssn", 8, 19)]


def test_words_nearby_move_scores(spark):
    rows = spark.createDataFrame([(1, "server 10.0.0.1"), (2, "version 10.0.0.1"), (3, "see 10.0.0.1"), (4, "server" + " " * 60 + "10.0.0.1")], "n int, text string")
    scores = {r.n: r.pii[0].score for r in pii.personal_data(rows).collect()}
    assert scores == {1: 0.9, 2: 0.3, 3: 0.6, 4: 0.6}


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a@b.c", 5), (1, "a@b.c", 5), (None, None, None)], "doc_id long, text string, PII int")
    out = pii.personal_data(df)
    assert out.columns == ["doc_id", "text", "pii"] and sorted(len(r.pii) for r in out.collect()) == [0, 1, 1]
    assert pii.personal_data(df.limit(0)).count() == 0


def test_no_python_and_no_shuffle_in_the_plan(spark):
    plan = queries.op12_personal_data(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("name", ["op12_personal_data", "op13_fill_in_middle"])
def test_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
