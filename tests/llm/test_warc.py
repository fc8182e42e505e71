import base64
import gzip
import hashlib
import io
import time

import pytest

from sievework.llm import warc

from .helpers import saved

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>y</p>"), (4, "http://a/4", None), (5, "http://a/5", ""),
    (9, "u", "<p>x</p>"), (9, "u", "<p>x</p>"), (9, "u", "other"), (None, "n", "<p>x</p>"), (None, "n", "alone"), (None, "n", "alone"),
    (12, "http://é", "é\r\n\r\nWARC/1.1\r\n" * 200), (13, "b\r\nad", "long " * 50_000), (14, "b", "long " * 50_000),
]


def expected(rows, least=0):
    def digest(h):
        return base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()

    groups, out = {}, []
    for i, (p, _, h) in enumerate(rows):
        groups.setdefault(h or "", []).append((p, i))
    for h, held in groups.items():
        n = len(h.encode())
        known = [p for p, _ in held if p is not None]
        top = max(known) if known else None
        first = next(i for p, i in held if p == top)
        for p, i in held:
            revisits = i != first and n >= least
            out.append((str(p), n, digest(h), "revisit" if revisits else "response", str(top if revisits else None)))
    return sorted(out)


def got(df):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect())


def test_round_trip(spark, tmp_path):
    folder = saved(spark, tmp_path, pages=spark.createDataFrame(ROWS, PAGES).repartition(5))
    assert got(warc.op9_warc(spark, folder)) == expected(ROWS)


@pytest.mark.parametrize("least", [0, 9])
def test_rolled_files_manifest_and_reruns(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, PAGES)
    names = []
    for k in range(2):
        folder = f"file://{tmp_path}/out{k}"
        manifest = warc.write(pages.repartition(3 + k), folder, roll=200, least=least)
        assert got(warc.read(spark, folder)) == expected(ROWS, least)
        held = {p.name: p.read_bytes() for p in (tmp_path / f"out{k}").glob("*.warc.gz")}
        assert {r["name"]: r["sha256"] for r in manifest.collect()} == {n: hashlib.sha256(b).hexdigest() for n, b in held.items()}
        assert not (tmp_path / f"out{k}" / "_temporary").exists()
        for b in held.values():
            assert gzip.decompress(b).startswith(b"WARC/1.1\r\n")
        names.append({n: hashlib.sha256(b).hexdigest() for n, b in held.items()})
    assert names[0] == names[1] and len(names[0]) > 2
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, f"file://{tmp_path}/out0").collect() if r.payload is not None}
    assert payloads[12] == ROWS[11][2] and payloads[14] == ROWS[13][2]


def test_empty(spark, tmp_path):
    folder = saved(spark, tmp_path, pages=spark.createDataFrame([], PAGES))
    assert warc.op9_warc(spark, folder).count() == 0


def test_damage_is_found(spark, tmp_path):
    bad = warc.record(1, 5, 0, "u", b"payload", None).replace(b"payload", b"paylord")
    (tmp_path / "x.warc.gz").write_bytes(warc.gzip_member(bad))
    with pytest.raises(Exception, match="does not have the bytes"):
        warc.read(spark, f"file://{tmp_path}").collect()


def test_urls_come_back_as_they_were(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    warc.write(spark.createDataFrame(ROWS + [(20, " x ", "h"), (21, "", "h2"), (22, "a\x7f\u2028b", "h3")], PAGES), folder)
    urls = {(r.page_id, r.url) for r in warc.read(spark, folder).collect()}
    assert urls == {(p, u) for p, u, _ in ROWS} | {(20, " x "), (21, ""), (22, "a\x7f\u2028b")}


def test_reading_takes_time_in_proportion_to_the_records():
    def seconds(n):
        archive = b"".join(warc.gzip_member(warc.record(i, i, 0, "u", hashlib.sha256(b"%d" % i).hexdigest().encode() * 80, None), 1) for i in range(n))
        began = time.process_time()
        assert sum(1 for _ in warc.records(io.BytesIO(archive))) == n
        return time.process_time() - began

    seconds(100)
    assert seconds(4000) < 12 * max(seconds(500), 0.01)


def test_an_archive_that_ends_early_is_found():
    member = warc.gzip_member(warc.record(1, 1, 0, "u", b"payload" * 99, None))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(member + member[:-20])))


@pytest.mark.parametrize("page_id", [7, None])
def test_one_id_with_many_pages_is_split(spark, tmp_path, page_id):
    rows = [(page_id, f"u{i}", f"text {i % 50} " * 20) for i in range(600)]
    folder = f"file://{tmp_path}/out"
    manifest = warc.write(spark.createDataFrame(rows, PAGES), folder, shard_bytes=5_000)
    found = warc.read(spark, folder)
    assert manifest.select("shard").distinct().count() > 10
    assert found.where("record_type = 'response'").count() == 50
    assert sorted(r.url for r in found.collect()) == sorted(u for _, u, _ in rows)


def test_bounds_do_not_depend_on_the_sample(spark):
    slim = spark.range(5000).selectExpr("id as page_id", "xxhash64(id) as key", "100L as n")
    few, many = (warc.bounds(slim, 10_000, sample=s, coarse=8) for s in (40, 5000))
    assert abs(len(few) - 49) <= 8 and abs(len(many) - 49) <= 8 and warc.bounds(slim, 10**9).ids.tolist() == []


def test_other_columns_and_a_long_payload(spark, tmp_path):
    rows = [(1, "u", "é" * 4_000_000, 5, "x"), (2, "u", "short", 6, None)]
    pages = spark.createDataFrame(rows, PAGES + ", shard int, digest string")
    folder = saved(spark, tmp_path, pages=pages)
    assert {(r.page_id, r.payload_bytes) for r in warc.op9_warc(spark, folder).collect()} == {(1, 8_000_000), (2, 5)}
