import gzip
import hashlib
import io
import random

import pytest

from qaprep.llm import warc


def expected(pages):
    first = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, url, html in pages:
        raw = (html or "").encode()
        to = first.get(raw)
        revisit = to is not None and to != i
        out.append((i, url, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                    to if revisit else None))
    return sorted(out, key=str)


COLS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("split", [16 << 20, 700])
def test_round_trip(spark, frame, tmp_path, split):
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    rnd = random.Random(3)
    same = "<p>copy</p>" * 40
    pages += [(5000 + i, f"http://x/{i}", same) for i in range(30)] + [(40, "u", same), (40, "u", same)]
    pages += [(6000, None, None), (6001, "a%0Ab\r\nc", ""), (None, "n", same), (None, "n", "<i>alone</i>" * 20),
              (6002, "s", "x" * 99), (6003, "s", "x" * 99), (6004, "b", "é" * 300_000),
              (6005, "z", "\x1f\x8b\x08" + "".join(chr(rnd.randrange(32, 3000)) for _ in range(5000)))]
    docs = frame(pages, "page_id long, url string, html string")
    got = warc.round_trip(spark, docs, f"file://{tmp_path}/warc", split_bytes=split)
    assert sorted((tuple(r) for r in got.select(COLS).collect()), key=str) == expected(pages)
    texts = {(r.page_id, bytes(r.payload)) for r in got.where("record_type = 'response'").collect()}
    assert texts <= {(i, (h or "").encode()) for i, _, h in pages}


def test_archives_are_plain_gzip(spark, frame, tmp_path):
    docs = frame([(i, "u", f"<p>{i}</p>" * 30) for i in range(9)], "page_id long, url string, html string")
    warc.round_trip(spark, docs, f"file://{tmp_path}/w").count()
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").iterdir()))
    assert raw.count(b"WARC/1.1\r\n") == 9


def test_ranges_own_each_record_once():
    rnd = random.Random(1)
    data = b""
    for i in range(40):
        # stored (not compressed) members full of the magic
        raw = warc.encode_record(i, "u", bytes(rnd.randrange(256) for _ in range(rnd.randrange(3000)))
                                 + b"\x1f\x8b\x08\x00" * 20, "d", None, False)
        data += raw if i % 2 else _stored(gzip.decompress(raw))
    for size in (1, 7, 64, 1000, len(data)):
        found = []
        for s in range(0, len(data), size):
            found += [p for p, _ in warc.records_in_range(io.BytesIO(data), len(data), s, min(s + size, len(data)))]
            if size < 7 and s > 400:
                break
        assert sorted(set(found)) == found
        if size >= 7:
            assert len(found) == 40


def _stored(raw):
    import zlib
    c = zlib.compressobj(0, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def test_empty_table(spark, frame, tmp_path):
    docs = frame([], "page_id long, url string, html string")
    assert warc.round_trip(spark, docs, f"file://{tmp_path}/w").count() == 0
