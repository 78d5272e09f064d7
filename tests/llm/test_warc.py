import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from gleanwell.llm import warc

PAGES = "page_id long, url string, html string, size string, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", "extra") for r in rows], PAGES)


ROWS = [
    (1, "http://a/é\r\n", "x" * 99), (2, None, "x" * 99), (3, "http://b", "y" * 100), (4, "http://c", "y" * 100),
    (0, "http://d", "é" * 50 + "\r\n\r\n"), (5, "http://e", "é" * 50 + "\r\n\r\n"), (6, "", None), (7, "", ""),
    (8, "u", "<p>" + "long " * 100_000), (4, "http://c", "y" * 100), (3, "http://b2", "y" * 100), (None, "n", "y" * 100), (None, "n", "z" * 200),
]


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        least = min(ids) if len(data) >= 100 and ids else None
        revisit = least is not None and page != least
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    return sorted(map(repr, out))


def test_round_trip(spark, tmp_path):
    folder = warc.archive(pages(spark, ROWS), f"file://{tmp_path}/archive")
    got = sorted(repr(tuple(r)) for r in warc.page_summary(spark, folder).collect())
    assert got == expected(ROWS)
    assert not [f for f in os.listdir(tmp_path / "archive") if not f.endswith(".warc.gz")]


def test_predicates_and_payloads(spark, tmp_path):
    folder = warc.archive(pages(spark, ROWS), f"file://{tmp_path}/archive")
    table = warc.load(spark, folder)
    one = table.filter((F.col("record_type") == "response") & (F.col("record_id") == "urn:page:8")).collect()
    assert [bytes(r.payload) for r in one] == [ROWS[8][2].encode()]
    assert one[0].headers["WARC-Type"] == "response"
    assert table.filter(F.col("record_id").isin("urn:page:0", "urn:page:5")).count() == 2
    assert table.filter(F.col("target_uri").startswith("http://c")).count() == 2
    light = warc.load(spark, folder, "none")
    both = [sorted((r.record_id, r.payload_bytes, r.payload_digest) for r in t.collect()) for t in (table, light)]
    assert both[0] == both[1] and light.filter("payload IS NOT NULL").count() == 0


def test_unwanted_records_are_not_read(tmp_path):
    blocks = [warc.packed(warc.record_bytes({
        "record_type": "response", "record_id": f"r{i}", "target_uri": None, "payload_digest": "0", "payload": os.urandom(50_000)})) for i in range(20)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(blocks))

    class Counting:
        def __init__(self, file):
            self.file, self.got = file, 0

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            data = self.file.read(n)
            self.got += len(data)
            return data

    with open(path, "rb") as file:
        counted = Counting(file)
        found = list(warc.records(counted, path.stat().st_size, lambda f: f["WARC-Record-ID"] == "<r7>"))
    assert len(found) == 1 and len(warc.payload_of(*found[0])) == 50_000
    assert counted.got < 50_000 + 30 * warc.FIRST


@pytest.mark.parametrize("zipped", [True, False])
def test_archives_of_others(spark, tmp_path, zipped):
    def record(kind, name, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    big = os.urandom(200_000)
    parts = [record("warcinfo", "i", b"software: x"), record("resource", "r", big), record("metadata", "m", b"")]
    name = "x.warc.gz" if zipped else "x.warc"
    (tmp_path / name).write_bytes(b"".join(gzip.compress(p) if zipped else p for p in parts))
    table = warc.load(spark, f"file://{tmp_path}")
    assert {r.record_id: r.payload_bytes for r in table.collect()} == {"i": 11, "r": 200_000, "m": 0}
    assert bytes(table.filter("record_type = 'resource'").first().payload) == big


def all_records(tmp_path, data):
    path = tmp_path / "damaged.warc.gz"
    path.write_bytes(data)
    with open(path, "rb") as file:
        return list(warc.records(file, len(data), lambda f: True))


HEAD = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %s\r\n\r\n"
BIG = os.urandom(20_000)
WHOLE = HEAD % b"20000" + BIG + b"\r\n\r\n"
DAMAGED = {
    "plain, cut in the payload": WHOLE[:9000], "plain, cut in the head": WHOLE[:30], "plain, no number": HEAD % b"many" + b"x", "two bytes": b"\x1f\x8b",
    "plain, negative": HEAD % b"-5" + b"x", "plain, no length": b"WARC/1.0\r\nWARC-Type: x\r\n\r\nabc",
    "member, cut in the payload": warc.packed(WHOLE)[:9000], "member, cut in the head": warc.packed(WHOLE)[:20],
    "member, no blank line": warc.packed(b"WARC/1.0\r\nWARC-Type: x\r\n"), "member, longer head without blank line": warc.packed(b"a: " + BIG.hex().encode()),
    "member, shorter than declared": warc.packed(WHOLE[:15_000]), "member, no number": warc.packed(HEAD % b"1e3" + BIG),
    "stream, cut in the payload": gzip.compress(WHOLE)[:9000], "stream, shorter than declared": gzip.compress(WHOLE[:15_000]),
    "stream, no blank line": gzip.compress(b"WARC/1.0"), "stream, broken": gzip.compress(WHOLE)[:2000] + bytes(5000) + gzip.compress(WHOLE)[7000:],
    "second record cut": warc.packed(WHOLE) + warc.packed(WHOLE)[:500],
}


@pytest.mark.parametrize("case", sorted(DAMAGED))
def test_damage_is_an_error_and_every_read_ends(tmp_path, case):
    with pytest.raises(warc.DamagedArchive, match="record at byte"):
        all_records(tmp_path, DAMAGED[case])


def test_what_is_whole_is_read(tmp_path):
    for data in (WHOLE, warc.packed(WHOLE), gzip.compress(WHOLE), WHOLE[:-4], WHOLE + b"\r\n\r\n" * 3000):
        assert [block for _, block in all_records(tmp_path, data)] == [BIG]
    long = b"WARC/1.0\r\nX: " + b"x" * 50_000 + b"\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (long, warc.packed(long), gzip.compress(long)):
        assert [block for _, block in all_records(tmp_path, data)] == [b"abc"]
    assert all_records(tmp_path, b"") == all_records(tmp_path, b"\r\n\r\n") == []


def test_a_digest_that_does_not_fit_fails_the_read(spark, tmp_path):
    row = {"record_type": "response", "record_id": "r", "target_uri": None, "payload_digest": hashlib.sha256(b"abc").hexdigest(), "payload": b"abc"}
    (tmp_path / "x.warc.gz").write_bytes(warc.packed(warc.record_bytes(row)))
    assert warc.load(spark, f"file://{tmp_path}").first().payload == b"abc"
    (tmp_path / "x.warc.gz").write_bytes(warc.packed(warc.record_bytes(row | {"payload": b"abd"})))
    with pytest.raises(Exception, match="digest is not the declared one"):
        warc.load(spark, f"file://{tmp_path}").collect()


def test_empty(spark, tmp_path):
    folder = warc.archive(pages(spark, []), f"file://{tmp_path}/none")
    assert warc.page_summary(spark, folder).collect() == []
