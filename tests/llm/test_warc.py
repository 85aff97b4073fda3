import base64
import gzip
import hashlib
import os

from conftest_llm import SF, with_clashes
from pulse.llm import warc
from pulse.llm.queries import QUERIES

DDL = "page_id long, url string, html string"


def brute(pages, least=0):
    by = {}
    for i, _, h in pages:
        by.setdefault(h or "", []).append(i)
    out, done = [], set()
    for i, _, h in pages:
        payload = (h or "").encode()
        top = max((x for x in by[h or ""] if x is not None), default=None)
        first = (h or "") not in done and i == top or len(payload) < least
        if i == top:
            done.add(h or "")
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if first else "revisit", None if first else top))
    return out


def rows_of(df):
    return [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()]


PAGES = [(1, "http://a/ b\r\n", "<p>x"), (2, "http://b", "<p>x"), (3, None, None), (4, "", ""), (5, "http://é", "é" * 70000), (5, "http://é", "é" * 70000),
         (-7, "u", "neg"), ((1 << 63) - 1, "u", "big"), (-(1 << 63), "u", "small"), (None, "u", "<p>x"), (None, "u", "only null"), (None, None, None), (2, "other", "\r\n\r\nWARC/1.1\r\n\r\n")]


def test_ids():
    for page in [0, 1, -1, (1 << 63) - 1, -(1 << 63), None, 123456789]:
        assert warc.page_of(warc.record_id(page, "ab" * 20, 5)) == page
    assert len({warc.record_id(p, d * 40, c) for p in (1, None) for d in "ab" for c in (0, 1)}) == 8


def test_round_trip(spark, frame, same_rows):
    root = warc.write(with_clashes(frame(PAGES, DDL)), shard_bytes=200_000)
    same_rows(rows_of(warc.read(spark, root)), brute(PAGES))
    payloads = [(r["page_id"], bytes(r["payload"])) for r in warc.read(spark, root, payloads=True).collect() if r["record_type"] == "response"]
    want = [(i, (h or "").encode()) for (i, _, h), b in zip(PAGES, brute(PAGES)) if b[3] == "response"]
    assert sorted(map(str, payloads)) == sorted(map(str, want))
    urls = {r["page_id"]: r["url"] for r in warc.read(spark, root).collect()}
    assert urls[1] == "http://a/%20b%0D%0A" and urls[4] == "about:blank"


def files(root):
    base = root.removeprefix("file://")
    return {n: open(f"{base}/{n}", "rb").read() for n in sorted(os.listdir(base)) if n.endswith(".warc.gz")}


def test_same_pages_same_files(spark, frame):
    pages = [(i, f"http://x/{i}", f"<p>page {i % 50} " + "word " * (i % 97)) for i in range(400)]
    how = {"shard_bytes": 20_000, "roll_bytes": 2_000}
    a = files(warc.write(frame(pages, DDL), **how))
    b = files(warc.write(frame(pages[::-1], DDL).repartition(7), **how))
    assert a == b and len(a) > 10
    assert not any(n == "_temporary" for n in os.listdir(warc.write(frame(pages, DDL), **how).removeprefix("file://")))
    last = None
    for name, data in a.items():  # ranges follow each other, and so do the records in a file
        ids = [warc.page_of(h["WARC-Record-ID"]) for h, _ in warc.records(iter([data])) if h["WARC-Type"] != "warcinfo"]
        assert ids == sorted(ids) and (last is None or ids[0] > last)
        last = ids[-1]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert name in gzip.decompress(data)[:2000].decode()


def test_manifest(spark, frame):
    pages = [(i, "u", f"page {i}") for i in range(50)]
    root = warc.write(frame(pages, DDL), shard_bytes=8_000)
    listed = {r["name"]: r for r in warc.manifest(spark, root).collect()}
    found = files(root)
    assert set(listed) == set(found) and sum(r["records"] for r in listed.values()) == 50
    assert all(hashlib.sha256(d).hexdigest() == listed[n]["sha256"] and len(d) == listed[n]["bytes"] for n, d in found.items())


def test_small_payloads_and_hot_ids(spark, frame, same_rows):
    pages = [(i, "u", "tiny") for i in range(10)] + [(20 + i, "u", "a larger payload") for i in range(10)]
    got = rows_of(warc.read(spark, warc.write(frame(pages, DDL), revisit_bytes=10)))
    same_rows(got, brute(pages, 10))
    hot = [(7, "u", f"payload {i % 30}") for i in range(300)] + [(None, "u", f"payload {i % 30}") for i in range(300)]
    got = rows_of(warc.read(spark, warc.write(frame(hot, DDL), shard_bytes=2_000)))  # one id fills many shards
    assert len(got) == 600 and sum(g[3] == "response" for g in got) == 30 and {g[4] for g in got if g[3] == "revisit"} == {7}


def test_no_pages(spark, frame):
    root = warc.write(frame([], DDL))
    assert warc.read(spark, root).collect() == [] and files(root) == {}


def test_query(spark, same_rows):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    same_rows(rows_of(QUERIES["op8_warc_shards"](spark, SF)), brute(pages))
