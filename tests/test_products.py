"""Streams that make products, broken off and taken up again, against products of everything."""

import pytest
from pyspark.sql import functions as F

from lodebar.operators import bars, instruments, resume, sinks, wide
from lodebar.operators.sinks import scratch
from lodebar.sources import feeds
from lodebar.streaming import latest, products, tail_source
from lodebar.streaming import queries as streams
from lodebar.streaming.intake import TextIntake, text_schemas
from lodebar.streaming.products import ProductWriter, both_feeds
from lodebar.streaming.tables import MasterTable, Upsert, Versions



@pytest.fixture(scope="module", autouse=True)
def for_few_rows(spark):
    """Settings under which many plans over a few rows run quickly."""
    own = {"spark.sql.shuffle.partitions": "1", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


TICK = "seqno long, symbol string, ts string, lastprice long, decimal int, totalvol long, totalamount long, lasttradeqty long, preclose long, open long, high long, low long, shortsellflag int"
QUOTE = "seqno long, symbol string, ts string, bidprice long, bidsize long, askprice long, asksize long, decimal int"


def ticks(spark, *rows):
    made = [(n, s, f"2026-03-0{t}", p, 2, v, v * p, 1, p - 1, p, p + 2, p - 2, n % 3) for n, s, t, p, v in rows]
    return spark.createDataFrame(made, TICK).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def quotes(spark, *rows):
    made = [(n, s, f"2026-03-0{t}", p - 5, n, p + 5, n + 1, 2) for n, s, t, p in rows]
    return spark.createDataFrame(made, QUOTE).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# two days, minutes: b is silent for long, c begins late, a ends a bar on its boundary and trades on both sides of midnight
TICKS = [
    (1, "a", "2 09:00:10", 100, 10), (2, "b", "2 09:00:20", 500, 3), (3, "a", "2 09:01:00", 101, 15), (4, "a", "2 09:01:30", 102, 21), (5, "c", "2 09:03:05", 70, 1), (6, "a", "2 23:59:30", 103, 30),
    (7, "b", "3 00:00:00", 501, 9), (8, "a", "3 09:00:05", 104, 2), (9, "a", "3 09:00:06", 99, 4), (10, "c", "3 09:02:00", 71, 5), (11, "b", "3 09:05:30", 502, 1), (12, "a", "3 09:05:31", 98, 9),
]
QUOTES = [(101, "a", "2 09:00:30", 100), (102, "b", "2 09:02:10", 500), (103, "a", "2 09:03:01", 102), (104, "d", "2 23:58:00", 40), (105, "a", "3 09:00:04", 104), (106, "b", "3 09:04:00", 502), (107, "a", "3 09:06:00", 98)]
NAMES = [("a", "Aa"), ("b", "Bb")]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(*n, 900, 100, 2) for n in NAMES], "symbol string, name string, limitup long, limitdown long, decimal int")


def batches(spark, *cuts):
    """Both feeds up to each cut by time, then the rest with rows that close everything."""
    t, q = ticks(spark, *TICKS), quotes(spark, *QUOTES)
    ends = both_feeds(ticks(spark, (900, "~", "9 00:00:30", 1, 1)), quotes(spark, (901, "~", "9 00:00:30", 1)))
    out, low = [], None
    for cut in (*cuts, None):
        within = (F.lit(True) if low is None else F.col("ts") >= F.lit(f"2026-03-0{low}").cast("timestamp_ntz")) & (F.lit(True) if cut is None else F.col("ts") < F.lit(f"2026-03-0{cut}").cast("timestamp_ntz"))
        out.append(both_feeds(t.where(within), q.where(within)))
        low = cut
    out[-1] = out[-1].unionByName(ends)
    return t, q, out


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def writer(spark, names, t, q, *which, **options):
    return ProductWriter(scratch(spark, "w"), t.schema, q.schema, lambda s: names, products=which or ("snapshot", "kline", "wide"), **options)


def whole(t, q, names):
    return {"snapshot": bars.snapshot(t, names), "kline": bars.kline(t, names), "wide": wide.rows(t, q, names).withColumn("symbol", F.col("InstrumentID"))}


def test_batches_make_the_product_of_everything(spark, names):
    t, q, parts = batches(spark, "2 09:01:20", "3 09:00:06")
    w = writer(spark, names, t, q)
    for n, part in enumerate(parts):
        w(part, n)
    for name, want in whole(t, q, names).items():
        assert rows(w.read(spark, name)) == rows(want), name
    control = w.control(spark)
    assert (control["ticks"], control["quotes"], control["late"], control["bars"]) == (13, 8, 0, 7)
    assert Versions(spark, f"{w.path}/control").known() == [1, 2]


def before_spread(df):
    """The part of the plan that works on rows after they have been spread over bars."""
    return df._jdf.queryExecution().executedPlan().toString().split("Generate explode(sequence(")[0]


def test_carried_wide_rows_do_not_travel(spark, names):
    t, q, _ = batches(spark)
    assert "Exchange" not in before_spread(wide.rows(t, q, names))


def test_rows_of_a_product_travel_before_they_are_spread(spark, names):
    t, q, _ = batches(spark)
    for made in (bars.snapshot(t, names, by_bar=True), bars.kline(t, names, by_bar=True), wide.rows(t, q, names, by_bar=True)):
        above = before_spread(made)
        assert "Exchange" not in above and above.count("Sort [") == 1


def test_folders_are_named_once_for_each_bar(spark, names):
    t, q, _ = batches(spark)
    for made in (bars.snapshot(t, names, by_bar=True), bars.kline(t, names, by_bar=True)):
        assert "yyyyMMddHHmm" not in before_spread(made)
    for made in (bars.snapshot(t, names, by_bar=True), bars.kline(t, names, by_bar=True), wide.rows(t, q, names, by_bar=True)):
        keys = sinks.partitioned(made.drop(*sinks.PARTS)).select(*sinks.PARTS, "symbol")
        assert rows(made.select(*sinks.PARTS, "symbol")) == rows(keys)


def test_bars_are_read_from_numbers_of_folders(spark):
    own = spark.createDataFrame([(1, "2026-03-02 00:00:00"), (2, "2026-03-02 09:05:00"), (3, "2024-02-29 23:59:00"), (4, None)], "n int, bar string").withColumn("bar", F.col("bar").cast("timestamp_ntz"))
    path = scratch(spark, "product")
    sinks.write_product(own.withColumn("symbol", F.lit("a")), path)
    got = resume.with_bars(spark.read.parquet(path))
    assert rows(got.drop("symbol")) == rows(own)
    assert "gettimestamp" not in got._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(sinks.produced_bars(spark, path)) == rows(own.select("bar"))


def test_tasks_that_spread_rows_stay_small(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    with sinks.small_tasks(spark):
        assert spark.conf.get(name) == f"{8 << 20}b"
    assert spark.conf.get(name) == before


def test_closed_bars_are_not_copied_before_a_step(spark, monkeypatch):
    kept = []
    own = streams.sinks.staged
    monkeypatch.setattr(streams.sinks, "staged", lambda df, label: (kept.append(own(df, label)), kept[-1])[1])
    seen = streams.open_bars(spark, "/root/testdata/sf0.001")
    copied = [k for k in kept if {"bar", "update_flag"} <= set(k.columns)]
    newest = seen.where("step = 1").agg(F.max("bar")).first()[0]
    assert [r.bar for k in copied for r in k.select("bar").distinct().collect()] == [newest]


@pytest.mark.parametrize("product", ["snapshot", "kline", "wide"])
def test_files_are_sorted_by_symbol(spark, names, product):
    t, q, parts = batches(spark)
    w = writer(spark, names, t, q, product)
    w(parts[0], 0)
    files = spark.read.parquet(f"{w.path}/{product}").inputFiles()
    assert len(files) == 7
    for f in files:
        symbols = [r.symbol for r in spark.read.parquet(f).select("symbol").collect()]
        assert symbols == sorted(symbols)


class Killed(Exception):
    pass


@pytest.mark.parametrize("place", ["product", "open", "control"])
def test_a_batch_that_was_killed_runs_again(spark, names, monkeypatch, place):
    t, q, parts = batches(spark, "2 09:03:30")
    w = writer(spark, names, t, q, "kline")
    w(parts[0], 0)
    with monkeypatch.context() as m:
        if place == "product":
            own = products.write_product
            m.setattr(products, "write_product", lambda rows, path: (own(rows.limit(3), path), (_ for _ in ()).throw(Killed())))
        else:
            before = Versions.write

            def write(self, rows, batch):
                if self.path.endswith(place):
                    rows.limit(1).write.mode("overwrite").parquet(f"{self.path}/id={batch}/_temporary/0")  # what a killed job leaves
                    raise Killed
                before(self, rows, batch)

            m.setattr(Versions, "write", write)
        with pytest.raises(Killed):
            w(parts[1], 1)
    w(parts[1], 1)
    if place == "control":
        w(parts[1], 1)  # Spark may run a batch again that has ended, too
    assert rows(w.read(spark, "kline")) == rows(bars.kline(t, names))


def test_late_rows_stay_beside_and_revise_nothing(spark, names):
    t, q, parts = batches(spark)
    w = writer(spark, names, t, q, "snapshot")
    w(parts[0], 0)
    before = rows(w.read(spark, "snapshot"))
    late = both_feeds(ticks(spark, (50, "a", "2 09:00:40", 1, 1), (51, "z", "3 09:05:00", 2, 2)), quotes(spark, (52, "a", "2 09:00:00", 9)))
    w(late, 1)
    assert rows(w.read(spark, "snapshot")) == before and w.control(spark)["late"] == 3
    assert sorted((r.seqno, r.feed, str(r.bar)) for r in w.late(spark).collect()) == [(50, "tick", "2026-03-02 09:01:00"), (51, "tick", "2026-03-03 09:05:00"), (52, "quote", "2026-03-02 09:00:00")]


def test_the_slower_feed_holds_bars_back(spark, names):
    t, q, _ = batches(spark)
    w = writer(spark, names, t, q, "snapshot")
    w(both_feeds(t, q.where("seqno < 103")), 0)
    assert {str(r.bar) for r in w.read(spark, "snapshot").select("bar").distinct().collect()} == {"2026-03-02 09:01:00", "2026-03-02 09:02:00"}
    w(both_feeds(t.limit(0), q.where("seqno >= 103")), 1)
    assert w.control(spark)["bars"] == 6 and rows(w.read(spark, "snapshot")) == rows(bars.snapshot(t.where("seqno < 11"), names))


def test_open_bars_are_replaced_and_not_counted(spark, names):
    t, q, _ = batches(spark)
    w = ProductWriter(scratch(spark, "w"), t.schema, None, lambda s: names, products=("kline",), open_bars=True)
    for n, limit in enumerate((1, 4, 4, 12)):  # the third batch is empty
        low = (0, 1, 4, 4)[n]
        w(t.where(f"seqno > {low} and seqno <= {limit}"), n)
        assert rows(w.read(spark, "kline")) == rows(bars.kline(t.where(f"seqno <= {limit}"), names)), n


def test_too_many_open_bars_close_the_oldest(spark, names):
    t, q, _ = batches(spark)
    w = ProductWriter(scratch(spark, "w"), t.schema, None, lambda s: names, delay="100 days", products=("snapshot",), most_open=2)
    w(t, 0)
    control = w.control(spark)
    assert len(control["evicted"]) == 5 and control["closed"] == control["evicted"][-1]
    assert w.read(spark, "snapshot").select("bar").distinct().count() == 5
    w(ticks(spark, (60, "a", "2 09:00:50", 5, 5)), 1)
    assert [r.seqno for r in w.late(spark).collect()] == [60] and w.control(spark)["evicted"] == []


def test_products_of_unknown_kind_are_refused(spark, names):
    t, q, _ = batches(spark)
    with pytest.raises(ValueError):
        ProductWriter("/x", t.schema, None, lambda s: names, products=("wide",))


def test_missing_bars_are_made_from_the_bars_before(spark, names):
    t, _, _ = batches(spark)
    want, path = bars.snapshot(t, names), scratch(spark, "product")
    sinks.write_product(want.where("seqno not in (1, 4, 6, 8)").where(~F.col("bar").cast("string").isin("2026-03-02 09:01:00", "2026-03-02 09:04:00", "2026-03-03 09:02:00", "2026-03-03 09:06:00")), path)
    held = rows(resume.with_bars(spark.read.parquet(path)))
    resume.resume(t, names, path)
    got = resume.with_bars(spark.read.parquet(path))
    made = F.col("bar").cast("string").isin("2026-03-02 09:04:00", "2026-03-03 09:02:00", "2026-03-03 09:06:00")
    assert set(held) <= set(rows(got))
    assert rows(got.where(made & F.lit(True)).where("bar > timestamp_ntz '2026-03-03 09:02:00'")) == rows(want.where("bar > timestamp_ntz '2026-03-03 09:02:00'"))
    again = rows(got)
    resume.resume(t, names, path)
    assert rows(resume.with_bars(spark.read.parquet(path))) == again


def line(s, t, p, v):
    return f"{s},{t},0,{p},{p},{p},{p},0,0,1,{v},{v},1,,T,0,N,2,0,0,0"


def test_files_of_finished_dates_are_not_read(spark, names, tmp_path):
    first, second = tmp_path / "snapshot.csv.20260302", tmp_path / "snapshot.csv.20260303"
    first.write_text("\n".join([line("a", 20260302090010000, 100, 1), line("b", 20260302090130000, 200, 1)]) + "\n")
    second.write_text("\n".join([line("a", 20260303090010000, 110, 2), line("b", 20260303090230000, 210, 2)]) + "\n")
    pattern, path = str(tmp_path / "snapshot.csv.*"), scratch(spark, "product")

    def read(since=None):
        parsed = feeds.parsed(tail_source.lines(spark, pattern, since=since), feeds.TICKS)
        good = feeds.accepted(parsed).withColumn("seqno", F.unix_micros(F.col("ts").cast("timestamp")))
        return good.drop("line", "file", "position", "date", "time")

    want = bars.snapshot(read(), names)
    wanted = rows(want)
    sinks.write_product(want.where("bar < timestamp_ntz '2026-03-03 09:03:00'"), path)
    first.write_bytes(b"\xff\xfe garbage\n" * 10)
    since = resume.last_date(spark, path)
    assert str(since) == "2026-03-03" and read(since).count() == 2
    resume.resume(read(since), names, path)
    assert rows(resume.with_bars(spark.read.parquet(path))) == wanted


def test_text_lines_are_numbered_counted_and_put_aside(spark, names):
    schemas = text_schemas(spark)
    w = ProductWriter(scratch(spark, "w"), schemas["tick"], schemas["quote"], lambda s: names, products=("kline",))
    intake = TextIntake(f"{w.path}/intake", w)
    batch = lambda *lines: spark.createDataFrame([(f, p, x, feed) for f, p, x, feed in lines], "file string, position long, line string, feed string")
    one = batch(
        ("s", 0, "symbol,time", "tick"), ("s", 10, line("a", 20260302090010000, 100, 1), "tick"), ("s", 20, line("", 20260302090010000, 1, 1), "tick"), ("s", 30, line("b", 20260302090020000, -5, 2), "tick"),
        ("o", 0, "a,20260302090011000,1,2,3,4", "quote"), ("o", 30, "a,x,1,2,3,4", "quote"), ("s", 40, "", "tick"),
    )
    two = batch(("s", 50, line("a", 20260302090110000, 120, 4), "tick"), ("o", 60, "a,20260302090111000,1,2,3,4", "quote"))
    three = batch(("s", 60, line("a", 20260302100110000, 120, 4), "tick"), ("o", 90, "a,20260302100111000,1,2,3,4", "quote"))
    for n, part in enumerate((one, one, two, two, three)):
        intake(part, (0, 0, 1, 1, 2)[n])
    got = sorted((str(r.bar)[11:16], r.symbol, r.seqno, r["count"]) for r in w.read(spark, "kline").collect())
    assert got == [("09:01", "a", 1, 1), ("09:01", "b", 2, 1), ("09:02", "a", 3, 1), ("09:02", "b", 2, 0)]
    metrics = sorted(map(tuple, intake.metrics(spark).collect()))
    assert metrics == [(0, 7, 2, 2, 1, 1, 0, 0), (1, 2, 0, 1, 1, 0, 0, 0), (2, 2, 0, 1, 1, 0, 0, 0)]
    assert sorted((r.problem, r.file, r.position) for r in intake.rejected(spark).collect()) == [("no symbol", "s", 20), ("not a number", "o", 30)]


def test_upserts_keep_two_versions_and_survive_reruns(spark):
    table = Upsert(scratch(spark, "u"), "k string, v long", "k")
    frame = lambda *r: spark.createDataFrame(list(r), "k string, v long")
    for n, part in ((0, frame(("a", 1), ("b", 2))), (1, frame(("b", 3))), (1, frame(("b", 4))), (2, frame(("c", 5)))):
        table(part, n)
    assert rows(table.read(spark)) == rows(frame(("a", 1), ("b", 4), ("c", 5)))
    assert Versions(spark, table.path).known() == [1, 2]


def test_an_upsert_reads_its_batch_once(spark):
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda k: (seen.add(1), k)[1], "string").asNondeterministic()
    table = Upsert(scratch(spark, "u"), "k string, v long", "k")
    for n in range(2):
        table(spark.createDataFrame([("a", n), ("b", n)], "k string, v long").withColumn("k", mark("k")), n)
    assert sorted(map(tuple, table.read(spark).collect())) == [("a", 1), ("b", 1)]
    assert seen.value == 4


def test_latest_state_takes_rows_in_any_order_and_a_first_state(spark, tmp_path):
    t, q = ticks(spark, *TICKS), quotes(spark, *QUOTES)
    table, source, checkpoint = Upsert(scratch(spark, "latest"), latest.STATE, "symbol"), f"file://{tmp_path}/in", scratch(spark, "c")
    stored = lambda rows: rows.withColumn("ts", F.col("ts").cast("timestamp"))
    first = latest.feed_rows(t.where("seqno = 9"), "tick")
    with latest.keyed_state(spark):
        for part in (t.where("seqno in (1, 8, 11)"), t.where("seqno in (2, 3, 5, 6, 7, 10)")):
            stored(part).write.mode("append").parquet(source)
            stream = spark.readStream.schema(stored(t).schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
            made = latest.latest_state(stream, first=first).writeStream.foreachBatch(table).outputMode("update")
            made.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    got = {r.symbol: (r.tick_seqno, r.tick_lastprice, str(r.day), r.day_volume) for r in table.read(spark).collect()}
    assert got == {"a": (9, 99, "2026-03-03", 2), "b": (11, 502, "2026-03-03", -8), "c": (10, 71, "2026-03-03", 0)}


def test_the_master_is_folded_batch_by_batch(spark):
    made = [(1, "a", "A", 100, 50, 2), (2, "b", "B", 7, 0, 0), (3, "a", "A*", 0, 0, 0), (4, "a", "A**", 0, 60, 3), (5, "b", "B", 0, 9, 0), (6, "c", "C", 0, 0, 0)]
    every = spark.createDataFrame(made, "seqno long, symbol string, name string, limitup long, limitdown long, decimal int")
    table = MasterTable(scratch(spark, "master"), every)
    seen = []
    for n, part in enumerate(((4, 5), (1, 6), (1, 6), (2, 3))):
        table(every.where(F.col("seqno").isin(*part)), (0, 1, 1, 2)[n])
        seen += part
        assert rows(table.read(spark)) == rows(instruments.merged(every.where(F.col("seqno").isin(*seen)))), n
