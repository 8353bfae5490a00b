import gzip
import hashlib

from tickloom.llm import warc
from tickloom.session import shared_dir


def test_round_trip(spark, tmp_path):
    big = "<p>" + "äöü" * 100_000 + "\r\n\r\nWARC/1.1\r\n" + "x" * 70_000
    rows = [(1, "http://a/1", "short"), (2, "http://a/2", "short"), (3, None, None), (4, "http://a/ 4\r\n", ""), (9, "u", big), (7, "u", big), (8, "u", big + "!"),
            (None, "n", big), (10, "u", "y" * 100), (11, "u", "y" * 100), (12, "u", "z" * 99), (13, "u", "z" * 99), (14, "u", "e" * warc.CHUNK), (15, "u", "y" * 100), (15, "u", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages.write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    index = warc.write(pages, shared_dir(spark, "w"))
    assert index.count() == len(rows)
    back = warc.read_chunks(index).collect()
    whole = {}
    for r in sorted(back, key=lambda r: (r.record_id, r.chunk)):
        have = whole.setdefault(r.record_id, [r, b""])
        assert len(r.data) <= warc.CHUNK
        have[0], have[1] = r, have[1] + r.data
        if r.record_type == "response":
            assert (r.payload_bytes, r.payload_digest) == (len(have[1]), hashlib.sha256(have[1]).hexdigest())
    said = {}
    for r, data in whole.values():
        assert r.last
        said.setdefault(r.page_id, []).append((r.record_type, r.refers_to, r.payload_bytes, r.payload_digest))
        if r.record_type == "response":
            assert data == (next(h for i, _, h in rows if i == r.page_id) or "").encode()
    for i, _, html in rows:
        raw = (html or "").encode()
        same = sorted(k for k, _, h in rows if k is not None and (h or "") == (html or ""))
        for kind, refers, size, digest in said[i]:
            assert (size, digest) == (len(raw), hashlib.sha256(raw).hexdigest())
            if len(raw) < 100 or i == same[0]:
                assert kind == "response" and refers is None
            else:
                assert kind == "revisit" and refers == same[0]
    r = index.where("record_type = 'response'").first()
    with open(r.file.removeprefix("file://"), "rb") as f:
        f.seek(r.offset)
        member = gzip.decompress(f.read(r.length))
    assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n") and r.record_id.encode() in member


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    index = warc.write(pages, shared_dir(spark, "w"))
    assert index.count() == 0 and warc.read_chunks(index).count() == 0
