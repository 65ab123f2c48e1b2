"""The operators' queries over the driver's tables, with the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodebar.llm import decontam, embedding_dedup, html_extract, infill, jaccard, langid, lm, packing, pii, quality, runs, url_filter, warc
from lodebar.llm.common import crc32_of_id, read_table

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.pmod(crc32_of_id("doc_id"), F.lit(5)) == 1
    scored = lm.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    small, _, least = quality.weighed_ids(docs, read_table(spark, sf_dir, "labels"))
    return small.withColumn("keep", F.col("key") >= F.lit(least))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.withColumn("held_out", F.pmod(crc32_of_id("doc_id"), F.lit(3)) == 1)
    model = langid.learn(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "shares")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).drop("html")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.packed_and_read(read_table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest AS g, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON payload_digest = g
"""


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).drop("text")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), bare AS (
  SELECT page_id, split_part(split_part(coalesce(rest, ''), '#', 1), '?', 1) AS b FROM cut
), parts AS (
  SELECT page_id, translate(split_part(b, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(b, length(split_part(b, '/', 1)) + 1) AS path FROM bare
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))

def planted_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which every tenth document by CRC-32 of its id ends in a repeated stretch of its words.

    With n words, h the CRC-32 and g = h // 10: words from a = g % n on repeat the p = 1 + (n - a) // (3 + g % 8) words there.
    """
    h = crc32_of_id("doc_id")
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")
    chosen = docs.withColumn("__g", F.floor(h / 10)).withColumn("__words", F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), words))
    n, g = F.size("__words"), F.col("__g")
    placed = chosen.withColumn("__a", (g % n).cast("int")).withColumn("__p", (1 + F.floor((n - F.col("__a")) / (3 + g % 8))).cast("int"))
    a, p = F.col("__a"), F.col("__p")
    period = F.slice("__words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.when(F.col("__words").isNull(), F.col("text")).otherwise(F.array_join(F.concat(F.slice("__words", F.lit(1), a), tail), " "))
    return placed.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_tails(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.collapse_runs(docs)
    largest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-largest["start"]).alias("start"), largest["length"].alias("length"), (-largest["period"]).alias("period"),
        F.floor(1000 * largest["length"] / -largest["period"]).cast("long").alias("exponent_milli"),
        hashed(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")).alias("runs_sha256"), hashed(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in pii.BASE]
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *counts, F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("pii")).alias("spans"))


def _op12_sql() -> str:
    """The same spans by plain patterns: matches and what lies between them give the places."""
    simple = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    turned = "(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4))"
    rest = f"list_reduce(list_prepend(0, [strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1 FOR c IN regexp_extract_all({turned}, '.')]), lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97)"
    twice = f"list_sum([CASE WHEN i % 2 = 1 THEN d ELSE 2 * d - CASE WHEN d > 4 THEN 9 ELSE 0 END END FOR d, i IN [CAST(c AS INTEGER) FOR c IN regexp_extract_all(reverse({digits}), '.')]])"
    near = "lower(right(before, 40) || ' ' || left(after, 40))"
    free = lambda edge: f"NOT regexp_matches(before, '{edge}$') AND NOT regexp_matches(after, '^{edge}')"
    tests = {
        "email": "true", "ip": "list_max([CAST(ltrim(x, '0') || CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE '' END AS HUGEINT) FOR x IN string_split(m, '.')]) <= 255",
        "card": f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {twice} % 10 = 0 ELSE false END", "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"{free('[A-Za-z0-9]')} AND {rest} = 1",
        "ssn": f"{free('[0-9-]')} AND NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$') AND regexp_matches({near}, '\\bssn\\b|social security') AND NOT regexp_matches({near}, 'order|part no')",
    }
    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS k, '{name}' AS kind, m, s, before, after FROM (SELECT doc_id, unnest(ms) AS m, unnest([list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) FOR i IN range(1, len(ms) + 1)]) AS s,"
        f" unnest(g[1:len(ms)]) AS before, unnest(g[2:]) AS after FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS g FROM d) WHERE len(ms) > 0) WHERE {tests[name]}"
        for k, (name, pattern) in enumerate(simple.items())
    )
    spans = lambda where: f"coalesce(string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(m) AS BIGINT), ',' ORDER BY k, s) FILTER (WHERE {where}), '')"
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS ({found}) SELECT d.doc_id, {', '.join(f'count(*) FILTER (WHERE k = {k}) AS n_{name}' for k, name in enumerate(pii.BASE))},"
        f" sha256({spans('k < 4')}) AS base_sha256, {spans('k IS NOT NULL')} AS spans FROM d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id"
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    back = infill.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", hashed(F.col("output")).alias("output_sha256"), hashed(back).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, len(l) - CASE WHEN l[-1] = '' THEN 1 ELSE 0 END AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), e AS (
  SELECT *, CASE WHEN low = 0 THEN '' WHEN low = len(l) THEN text ELSE array_to_string(l[1:low], chr(10)) || chr(10) END AS p,
         CASE WHEN high = 0 THEN '' WHEN high = len(l) THEN text ELSE array_to_string(l[1:high], chr(10)) || chr(10) END AS pm FROM c
), o AS (
  SELECT *, substr(pm, length(p) + 1) AS m, substr(text, length(pm) + 1) AS s FROM e
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM o
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_quality": op2_quality,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_langid": op4_langid,
    "op5_html_extract": op5_html_extract,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_pack": op10_pack,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_personal_data": op12_personal_data,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLES: dict[str, str] = {"op6_warc": OP6_SQL, "op8_url_filter": OP8_SQL, "op12_personal_data": _op12_sql(), "op13_fill_in_middle": OP13_SQL}
