import hashlib
import io
import random
import zipfile

import pyarrow as pa
import pytest

from lodebar.llm import warc
from lodebar.llm.common import scratch_path


def opened(raw):
    return warc.ZipArchive(pa.BufferReader(raw))


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_is_read_by_others_and_by_us(zip64):
    members = [("a.txt", b"x" * 10), ("archive/é.bin", bytes(range(256)) * 9), ("empty", b"")]
    raw = b"".join(warc.zipped(members, zip64))
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
    z = opened(raw)
    assert [(n, z.bytes_of(n)) for n in z.members] == members
    assert (warc.struct.pack("<I", warc._END64) in raw) == zip64


def test_archives_of_others():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("stored", b"PK\x05\x06 looks like an end")
        z.writestr(zipfile.ZipInfo("deflated"), b"y" * 500, zipfile.ZIP_DEFLATED)
        with z.open("streamed", "w", force_zip64=True) as f:
            f.write(b"z" * 77)
        z.comment = b"a comment with PK\x05\x06 inside, longer than the record of the end"
    z = opened(out.getvalue())
    assert {n: z.bytes_of(n) for n in z.members} == {"stored": b"PK\x05\x06 looks like an end", "streamed": b"z" * 77}
    for broken in (b"", b"nothing", out.getvalue()[: -len(z.file.read()) or 60]):
        with pytest.raises((ValueError, warc.struct.error)):
            opened(broken)


def test_ranges_are_read_together_and_apart():
    data = bytes(random.Random(1).randbytes(5000))
    z = opened(b"".join(warc.zipped([("d", data)])))
    for wanted in ([(0, 10), (10, 90), (300, 5), (305, 4000)], [(4999, 1)], [], [(7, 0), (7, 3)]):
        assert list(z.ranges("d", wanted)) == [data[a : a + n] for a, n in wanted]


def test_record_round_trip_and_damage():
    payload = "<p>é\r\n\r\n</p>".encode()
    digest = hashlib.sha256(payload).hexdigest()
    raw = warc.record(5, "http://a/b\r\nX: y", payload, digest, None)
    assert warc.parsed(raw) == (5, "http://a/b%0D%0AX:%20y", "response", None, len(payload), digest, payload)
    assert warc.parsed(warc.record(None, None, payload, digest, 3)) == (None, None, "revisit", 3, len(payload), digest, None)
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"<p>", b"<q>"))


def test_pages_through_archives(spark):
    rng = random.Random(2)
    long, short = "<html>" + "é" * 120, "x" * 99
    rows = [(i, f"http://h/{i}", "".join(rng.choices("abc <>&é\n", k=rng.randrange(0, 900)))) for i in range(60)]
    rows += [(100, "u", long), (90, None, long), (95, "u", long), (90, "again", long), (None, "u", long), (101, "u", short), (102, "u", short), (103, "u", None), (104, "u", ""), (105, "u", "z" * 3_000_000), (None, "n", "q" * 200), (None, "n", "q" * 200)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, DIGEST string").repartition(3)
    for zip64, size in ((False, 1 << 20), (True, 2000)):
        manifest = warc.write_archives(df, scratch_path(spark, "t"), zip64, size)
        got = warc.read_archives(manifest).collect()
        want = []
        for i, u, h in rows:
            p = (h or "").encode()
            ids = [j for j, _, x in rows if x == h and j is not None] if len(p) >= 100 else []
            first = min(ids, default=None)
            revisit = first is not None and first != i
            want.append((i, u, "revisit" if revisit else "response", first if revisit else None, len(p), hashlib.sha256(p).hexdigest(), None if revisit else p))
        key = lambda r: tuple((x is None, x if x is not None else 0) for x in (r[0], r[1], r[4]))
        assert sorted([(*r[:6], r[6] and bytes(r[6])) if r[6] else (*r[:6], b"" if r[2] == "response" else None) for r in map(tuple, got)], key=key) == sorted(want, key=key)
        assert manifest.agg({"records": "sum"}).first()[0] == len(rows) and (manifest.count() > 3) == (size == 2000)
    assert warc.packed_and_read(df.limit(0)).count() == 0
