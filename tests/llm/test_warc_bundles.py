"""WARC bundles: exact round trip, plain readers, single records."""

import glob
import hashlib

import pytest
import zstandard

from cohortspark.llm import warc_bundles as W

ROWS = [(1, "http://a.example/x", "<p>é</p>" * 300), (2, "http://a.example/y", "<p>é</p>" * 300), (3, None, "<p>é</p>" * 300), (4, "u\r\nX: y", None),
        (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "x" * 1000), (9, "u", "x" * 999), (10, "u", "x" * 1000), (10, "u", "x" * 1000),
        (None, "u", "x" * 1000), (None, "v", "only here " * 200), (11, "u", "\r\n\r\nWARC/1.1\r\n" * 90), (12, "u", "y" * 3_000_000)]


def want():
    out = []
    for page, _, html in ROWS:
        body = (html or "").encode()
        top = max((p for p, _, h in ROWS if h == html and p is not None), default=None)
        again = len(body) >= 1000 and top is not None and page != top
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc"))
    df = spark.createDataFrame([(*r, "d", 0) for r in ROWS], "page_id long, url string, html string, digest string, frame int").repartition(2)
    return folder, W.write_bundles(df, folder, frame_bytes=3000, bundle_bytes=100)


def test_round_trip(stored):
    folder, index = stored
    got = W.read_bundles(index, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == want()
    bodies = {h or "" for _, _, h in ROWS}
    assert all(r.payload.decode() in bodies for r in got if r.record_type == "response")
    assert index.select("bundle").distinct().count() > 2 and index.count() == len(ROWS)
    assert {r.url for r in got if r.page_id == 4} == {"u%0D%0AX: y"}


def test_a_bundle_is_one_plain_stream_of_records(stored):
    folder, index = stored
    n = 0
    for path in glob.glob(f"{folder}/*.warc.zst"):
        data = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True).read()
        at = 0
        while at < len(data):
            _, at = W.parse(data, at)
            n += 1
    assert n == len(ROWS)


def test_fetch_single_records(stored):
    _, index = stored
    for page in (3, 4, 12):
        row, = W.fetch(index.where(f"page_id = {page}")).collect()
        assert row.page_id == page and row.payload.decode() == (next(h for p, _, h in ROWS if p == page) or "")
    ids = {r.record_id for r in index.where("page_id = 3").collect()}
    heads = W.fetch(index.where("page_id = 1")).collect()
    assert heads[0].record_type == "revisit" and heads[0].payload is None and ids == {W.record_id(3, heads[0].payload_digest)}


def test_damage_is_found():
    data = W.record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, "2000-01-01T00:00:00Z")
    assert W.parse(data, 0)[1] == len(data)
    for bad in (data.replace(b"abc", b"abd"), data[:-3], b"x" + data):
        with pytest.raises(ValueError):
            W.parse(bad, 0)


def test_empty_table(spark):
    index = W.write_bundles(spark.createDataFrame([], "page_id long, url string, html string"))
    assert W.read_bundles(index).count() == 0
