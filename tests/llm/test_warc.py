"""Web archives against Python's gzip, and damaged files."""

import base64
import gzip
import hashlib
import io

import pytest

from rankloom.llm import warc
from rankloom.llm.queries.warc_query import ORACLE, op13_warc

SCHEMA = "page_id long, url string, html string, path string, top int, _key string, body string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "k", "b") for r in rows], SCHEMA)


def sha32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def read(files, **options):
    found = warc.read_warc(files, **options)
    return found.where("record_type <> 'warcinfo'").withColumn("page", warc.page_of(found.record_id)).withColumn("to", warc.page_of(found.refers_to)).collect()


ROWS = [
    (1, "http://a.example/", "<p>one</p>"),
    (5, "http://b.example/é x\r\nInjected: yes", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (4, "http://c.example/", None),
    (6, "http://d.example/", ""),
    (None, "http://e.example/", "<p>é漢</p>\r\n\r\n\x00"),
    (7, "http://f.example/", "long " * 200_000),
    (-8, "http://g.example/", "WARC/1.1\r\n\r\n"),
]


def test_round_trip(spark):
    files = warc.write_warc(pages(spark, ROWS))
    got = {r.page: r for r in read(files, payloads=True)}
    assert len(got) == len(ROWS)
    for page, url, html in ROWS:
        r = got[None if page is None else str(page)]
        assert (r.payload_bytes, r.payload_digest, r.problem) == (len((html or "").encode()), sha32(html), None)
        if r.record_type == "response":
            assert r.payload == (html or "").encode() and r.to is None
    assert {p: (r.record_type, r.to) for p, r in got.items() if r.record_type == "revisit"} == {"1": ("revisit", "5"), "3": ("revisit", "5"), "4": ("revisit", "6")}
    assert len({r.record_id for r in got.values()}) == len(ROWS)


def test_every_member_is_a_gzip_file_of_one_record(spark):
    row = warc.write_warc(pages(spark, ROWS).coalesce(1)).collect()[0]
    raw = open(row.path.removeprefix("file:"), "rb").read()
    whole = gzip.decompress(raw)
    assert whole.count(b"WARC/1.1\r\nWARC-Type:") == row.n_records == len(ROWS) + 1
    offsets = sorted(r.offset for r in warc.read_warc(spark.createDataFrame([row])).collect())
    for at, end in zip(offsets, [*offsets[1:], len(raw)]):
        one = gzip.decompress(raw[at:end])
        head, _, rest = one.partition(b"\r\n\r\n")
        length = int(next(line for line in head.split(b"\r\n") if line.startswith(b"Content-Length:")).split()[1])
        assert rest[length:] == b"\r\n\r\n" and b"\r\nInjected" not in head


def test_small_payloads_are_never_revisited(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (9, "u", "abcd")]
    got = {r.page: (r.record_type, r.to) for r in read(warc.write_warc(pages(spark, rows), min_bytes=4))}
    assert got == {"1": ("response", None), "2": ("response", None), "3": ("revisit", "9"), "9": ("response", None)}


def test_repeated_rows(spark):
    rows = [(2, "b", "same")] * 3 + [(2, "a", "same"), (2, None, "same"), (1, "a", "same"), (None, "n", "alone"), (None, "n", "alone")]
    got = read(warc.write_warc(pages(spark, rows).repartition(4)), payloads=True)
    assert len(got) == len(rows) and len({r.record_id for r in got}) == len(rows)
    kinds = sorted((r.page or "", r.record_type, r.to or "") for r in got)
    assert kinds == [("", "response", ""), ("", "revisit", ""), ("1", "revisit", "2"), ("2", "response", "")] + [("2", "revisit", "2")] * 4
    assert [r.target_uri for r in got if r.page == "2" and r.record_type == "response"] == [None]


def test_files_are_bounded_and_empty_tables_give_none(spark):
    rows = [(i, "u", hashlib.sha512(str(i).encode()).hexdigest() * 50) for i in range(200)]
    files = warc.write_warc(pages(spark, rows).coalesce(1), file_bytes=20_000)
    assert files.count() > 3 and files.agg({"n_bytes": "max"}).first()[0] < 40_000
    assert len(read(files)) == 200
    none = warc.write_warc(pages(spark, []))
    assert none.count() == 0 and warc.read_warc(none).count() == 0


def damaged(change):
    good = warc.record("response", "urn:x:1", b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc", Content_Type="application/http", WARC_Payload_Digest="sha1:" + sha32("abc"))
    return change(gzip.decompress(good)), good


@pytest.mark.parametrize(
    "change, says",
    [
        (lambda r: r.replace(b"abc\r\n", b"abd\r\n"), "warc-block-digest"),
        (lambda r: r.replace(b"sha1:" + sha32("abc").encode(), b"sha1:" + sha32("abd").encode()), "warc-payload-digest"),
        (lambda r: r.replace(b"\r\nContent-Length: 41", b"\r\nContent-Length: 40"), "line ends"),
        (lambda r: r.replace(b"abc\r\n\r\n", b"abc\r\n"), "line ends"),
        (lambda r: r[:-8], "shorter"),
        (lambda r: r.replace(b"WARC/1.1", b"XARC/1.1"), "begins"),
        (lambda r: r.replace(b"Content-Length: 4", b"Content-Length: -4", 1), "content length"),
        (lambda r: r + b"more", "line ends"),
        (lambda r: b"no head at all", "no end"),
    ],
)
def test_damage_is_found_and_reading_goes_on(change, says):
    bad, good = damaged(change)
    found = list(warc.records(io.BytesIO(gzip.compress(bad) + good), payloads=True))
    assert len(found) == 2 and says in found[0].problem
    assert found[1].problem is None and found[1].payload == b"abc"


def test_cut_off_and_corrupt_files():
    _, good = damaged(lambda r: r)
    assert "ends inside" in list(warc.records(io.BytesIO(good + good[:-5])))[-1].problem
    flipped = bytearray(good + good)
    flipped[len(good) + 30] ^= 255
    assert list(warc.records(io.BytesIO(bytes(flipped))))[-1].problem


def test_strict_reading_raises(spark, tmp_path):
    _, good = damaged(lambda r: r)
    (tmp_path / "x.warc.gz").write_bytes(good[:-4])
    files = spark.createDataFrame([(f"file:{tmp_path}/x.warc.gz",)], "path string")
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_warc(files).collect()
    assert "ends inside" in warc.read_warc(files, strict=False).first().problem


def test_query_equals_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = con.execute(ORACLE["op13_warc"]).fetchall()
    assert sorted(map(tuple, op13_warc(spark, sf_dir).collect())) == sorted(want)
