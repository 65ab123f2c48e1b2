import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodebar.operators.sinks import scratch
from lodebar.streaming import tail_source
from lodebar.streaming.bars import BarWriter, _by_bar, stalled_bars, with_instruments
from lodebar.streaming.tail_source import follow


def read(reader, start, end):
    return [r for p in reader.partitions(start, end) for r in reader.read(p)]


@pytest.mark.parametrize("chunk", [1, 3, 16, 1 << 20])
def test_reader_gives_whole_lines_once(tmp_path, chunk, monkeypatch):
    monkeypatch.setattr(tail_source, "BLOCK", 5)
    f = tmp_path / "a.csv"
    reader = tail_source.TailReader(str(tmp_path / "*.csv"), chunk)
    f.write_bytes(b"one\r\ntw")
    at = reader.latestOffset()
    assert read(reader, reader.initialOffset(), at) == [("one", "a.csv", 0)]
    with f.open("ab") as out:
        out.write("o\n\nthree is longer than a chunk\né\nrest".encode())
    after = reader.latestOffset()
    got = read(reader, at, after)
    assert [r[0] for r in got] == ["two", "", "three is longer than a chunk", "é"] and [r[2] for r in got] == [5, 9, 10, 39]
    assert read(reader, after, reader.latestOffset()) == []
    f.write_bytes(b"new\n")
    assert [r[0] for r in read(reader, after, reader.latestOffset())] == ["new"]
    (tmp_path / "b.csv").write_bytes(b"x\n")
    assert [r[0] for r in read(reader, {str(f): 4}, reader.latestOffset())] == ["x"]


def test_batch_has_byte_positions_and_dates(spark, tmp_path):
    (tmp_path / "feed.csv.20260102").write_bytes(b"a\nbb\n\nlast")
    (tmp_path / "feed.csv.20260105").write_bytes(b"c\n")
    (tmp_path / "feed.csv.old").write_bytes(b"d\n")
    rows = tail_source.lines(spark, str(tmp_path / "feed.csv.*"), 2)
    got = [(r.file[-8:], r.position, r.line, r.date and r.date.day) for r in rows.collect()]
    dated = [("20260102", 0, "a", 2), ("20260102", 2, "bb", 2), ("20260102", 5, "", 2), ("20260102", 6, "last", 2), ("20260105", 0, "c", 5)]
    assert sorted(got, key=repr) == sorted([*dated, (".csv.old", 0, "d", None)], key=repr)
    assert [r.line for r in tail_source.latest_date(rows).collect()] == ["c"]


def test_stream_follows_a_growing_file_over_a_restart(spark, tmp_path):
    f = tmp_path / "feed.csv"
    out, checkpoint = scratch(spark, "tail"), scratch(spark, "tail-checkpoint")

    def run():
        q = follow(spark, str(tmp_path / "*.csv")).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start()
        q.processAllAvailable()
        q.stop()
        return sorted(r.line for r in spark.read.parquet(out).collect())

    f.write_bytes(b"a\nb\nhal")
    assert run() == ["a", "b"]
    with f.open("ab") as more:
        more.write(b"f\nc\n")
    assert run() == ["a", "b", "c", "half"]


TICK = "seqno long, symbol string, ts timestamp, lastprice long, decimal int"


def ticks(spark, *rows):
    return spark.createDataFrame([(i, s, t, p, 2) for i, s, t, p in rows], "seqno long, symbol string, ts string, lastprice long, decimal int").withColumn("ts", F.col("ts").cast("timestamp"))


def test_late_is_what_the_watermark_has_passed(spark, tmp_path):
    """A bar may come in several batches; a batch that runs again changes nothing; late rows count for the latest state."""
    writer = BarWriter(f"file://{tmp_path}/w", "minute")
    ntz = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    first = ntz(ticks(spark, (1, "a", "2026-01-01 09:00:10", 100), (2, "a", "2026-01-01 09:01:10", 110)))
    second = ntz(ticks(spark, (3, "a", "2026-01-01 09:01:20", 120), (4, "a", "2026-01-01 09:00:30", 100), (5, "b", "2026-01-01 09:00:40", 90)))
    third = ntz(ticks(spark, (6, "a", "2026-01-01 09:02:00", 130), (7, "c", "2026-01-01 08:00:00", 10)))
    for batch, n in ((first, 0), (second, 1), (second, 1), (third, 2)):
        writer(batch, n)
    late = spark.read.parquet(f"file://{tmp_path}/w/late").collect()
    assert sorted(r.seqno for r in late) == [4, 5, 7]
    assert sorted(r.seqno for r in spark.read.parquet(f"file://{tmp_path}/w/rows").collect()) == [1, 2, 3, 6]
    assert {(r.symbol, r.lastprice) for r in writer.latest(spark).collect()} == {("a", 130), ("b", 90), ("c", 10)}


def test_each_batch_is_named_from_the_master_as_it_is_then(spark):
    names, seen = [], []
    step = with_instruments(lambda s: s.createDataFrame([("a", f"n{len(names)}")], "symbol string, name string"), lambda rows, n: seen.append((n, rows.first()["name"])))
    for n in range(2):
        step(ticks(spark, (1, "a", "2026-01-01 09:00:10", 100)), n)
        names.append(n)
    assert seen == [(0, "n0"), (1, "n1")]


def test_rows_behind_a_bar_do_not_change_it(spark, tmp_path):
    source, out, checkpoint = f"file://{tmp_path}/in", scratch(spark, "stall"), scratch(spark, "c")
    steps = [
        [(1, "a", "2026-01-01 09:00:10", 100), (2, "a", "2026-01-01 09:01:30", 200)],
        [(3, "a", "2026-01-01 09:00:40", 900)],
        [(5, "a", "2026-01-01 09:01:40", 300), (4, "a", "2026-01-01 09:01:50", 400), (6, "a", "2026-01-01 09:02:10", 500)],
    ]
    for rows in steps:
        ticks(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.05)
    stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(source).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    q = stalled_bars(stream, "minute", 600_000).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    until = time.time() + 60
    while time.time() < until and not (q.lastProgress and q.lastProgress["batchId"] > 2):
        time.sleep(0.1)
    q.stop()
    got = sorted((r.bar.minute, r["count"], r.close, r.why) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1, 1.0, "next"), (1, 1, 9.0, "late"), (2, 3, 3.0, "next")]


def test_rows_of_a_symbol_are_counted_by_bar_without_working_on_frames(monkeypatch):
    nine, ten = pd.Timestamp("2026-01-01 09:00"), pd.Timestamp("2026-01-01 10:00")
    frame = lambda *rows: pd.DataFrame(list(rows), columns=["bar", "seqno", "price"])
    frames = [frame((ten, 5, 1.0), (nine, 4, 2.0), (pd.NaT, 9, 9.0)), frame((ten, 3, 3.0), (nine, 6, 4.0))]
    for slow in ("groupby", "sort_values"):
        monkeypatch.setattr(pd.DataFrame, slow, None)
    assert _by_bar(iter(frames)) == {ten: (2, 5, 1.0), nine: (2, 6, 4.0)}


def test_a_silent_symbol_is_flushed(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", scratch(spark, "stall")
    ticks(spark, (1, "a", "2026-01-01 09:00:10", 100), (2, "a", "2026-01-01 09:01:30", 110), (3, "b", "2026-01-01 09:00:10", 50)).write.parquet(source)
    stream = spark.readStream.schema(TICK).parquet(source).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    q = stalled_bars(stream, "minute", 500).writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "c")).trigger(processingTime="100 milliseconds").start()
    until = time.time() + 40
    while time.time() < until and not (q.lastProgress and q.lastProgress["batchId"] > 0 and q.lastProgress["stateOperators"][0]["numRowsTotal"] == 0):
        time.sleep(0.2)
    q.stop()
    got = sorted((r.symbol, r["count"], r.close, r.why) for r in spark.read.parquet(out).select("symbol", F.col("count"), "close", "why").collect())
    assert [(g[0], g[2], g[3]) for g in got] == [("a", 1.0, "next"), ("a", 1.1, "stall"), ("b", 0.5, "stall")]
