import gzip
import hashlib
import io
import random

import pytest

from trendlake.llm import warc as w
from trendlake.session import scratch_path


def pages():
    r = random.Random(1)
    long = "".join(r.choices("abcdé\r\n0 ", k=200_000))
    same = "x" * 1500
    found = [(1, "http://a/1", "short"), (2, None, None), (3, "http://a/3\r\nX: y", ""), (4, "u", same), (5, "u", same), (6, "u", same),
             (7, "u", "WARC/1.1\r\n\r\n" * 50 + "\r\n\r\n0\r\n\r\n"), (8, "u", long), (9, "u", long), (9, "u", long),
             (10, "u", "y" * 999), (11, "u", "y" * 999), (None, "u", same), (None, "u", "alone" * 500), (12, "u", "z" * 1000), (13, "u", "z" * 1000)]
    return found


def want(rows, least=1000):
    out = []
    last = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            last[data] = max(last.get(data, page), page)
    count = {}
    for _, _, html in rows:
        count[(html or "").encode()] = count.get((html or "").encode(), 0) + 1
    for page, _, html in rows:
        data = (html or "").encode()
        first = last.get(data) if len(data) >= least and count[data] > 1 else None
        refers = first if first is not None and first != page else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers, True))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as payload", "3 as first")


@pytest.mark.parametrize("segment", [200, 5000, w.SEGMENT])
def test_round_trip(spark, segment):
    assert order(w.round_trip(frame(spark, pages()), segment=segment).collect()) == order(want(pages()))


def test_empty_table(spark):
    assert w.round_trip(frame(spark, [])).count() == 0


def test_chunked_framing():
    r = random.Random(2)
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        data = r.randbytes(n)
        assert w.dechunked(w.chunked(data)) == data
        assert w.http_payload(w.HTTP_HEAD + w.chunked(data)) == data
    for broken in (w.chunked(b"abc") + b"x", w.chunked(b"abc")[:-4], b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            w.dechunked(broken)


def test_records_parse_by_length():
    blocks = [b"", b"WARC/1.1\r\nWARC-Type: fake\r\n\r\n", b"\r\n\r\n" * 3]
    data = b"".join(w.record("response", f"urn:x:{i}", b) + b"\r\n\r\n" for i, b in enumerate(blocks))
    found = list(w.parse_records(io.BytesIO(data)))
    assert [b for _, b in found] == blocks and found[1][0]["warc-record-id"] == "<urn:x:1>"
    with pytest.raises(ValueError):
        list(w.parse_records(io.BytesIO(data[:-1])))


def segments(spark, rows):
    return w.reassemble(spark.createDataFrame(rows, w.RECORDS)).collect()


def test_segments_are_ordered_and_verified(spark):
    data = b"payload " * 300
    block = w.HTTP_HEAD + w.chunked(data)
    digest = hashlib.sha1(data).hexdigest()
    cut = [block[:700], block[700:1400], block[1400:]]

    def parts(origin, total, keep=(0, 1, 2)):
        return [(origin, "5" if k == 0 else None, "response" if k == 0 else "continuation", None, digest if k == 0 else None,
                 k + 1, total if k == 2 else None, None, None, cut[k]) for k in reversed(keep)]
    rows = parts("a", len(block)) + parts("b", len(block) + 1) + parts("c", len(block), (0, 2)) + parts("d", len(block), (0, 1))
    got = segments(spark, rows)
    assert sorted((r["bytes"] is not None, r["found"] or "") for r in got) == [(False, ""), (False, ""), (False, ""), (True, digest)]
    assert all(r["record_type"] == "response" and r["page"] == "5" for r in got)


def test_archives_are_plain_gzip_files(spark, tmp_path):
    path = scratch_path(spark, "warc_test")
    w.write_archives(frame(spark, pages()), path, segment=1000, file_records=7)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    assert len(files) > 10
    kinds = [h["warc-type"] for f in files for h, _ in w.parse_records(gzip.GzipFile(fileobj=io.BytesIO(f["content"])))]
    assert {"response", "revisit", "continuation"} == set(kinds)
