import hashlib
import re

from lodebar.llm import queries
from lodebar.llm.infill import fill_in_middle, restored

from pyspark.sql import functions as F


def brute(doc, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ROWS = [
    (1, None, 0), (2, "", 0), (3, "\n", 0), (4, "\n\n\n", 0), (5, "one line", 0), (6, "a\nb\nc", 0), (7, "a\r\nb c\n", 0), (8, "\U0001f600é\n𝄞x\nlast", 0), (9, "has <P> in it\nx", 0), (10, "<S>", 0),
    (11, "ends in <\n<\nP>\n>S", 0), (12, "<\n<P\nM>x\n<<", 0), (13, "x\0y\nz", 0), (None, "no id\nat all\n", 0), (14, "same\nrow\n", 0), (14, "same\nrow\n", 0), (15, "w" * 300_000 + "\n" + "y\n" * 50_000, 0),
]


def made(spark, **options):
    rows = [*ROWS, *((i, "l1\nl2 é\n\nl4", 0) for i in range(100, 140))]
    df = spark.createDataFrame(rows, "doc_id long, text string, Form int")
    out = fill_in_middle(df, **options)
    return rows, out, out.withColumn("back", restored(F.col("output"), F.col("form"))).collect()


def test_every_form_agrees_with_brute_force_and_comes_back(spark):
    rows, out, got = made(spark)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == sorted(((d, *brute(d, t)) for d, t, _ in rows), key=key)
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_rates(spark):
    rows, _, got = made(spark, rate=50, spm_rate=0)
    assert sorted((repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got)) == sorted(repr((d, *brute(d, t, 50, 0))) for d, t, _ in rows)
    assert {r.form for r in got} == {"plain", "psm"}


def test_empty_table_and_query_columns(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(df).count() == 0
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_fill_in_middle(spark, str(tmp_path)).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
