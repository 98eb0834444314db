import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from fraudlake.llm import warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None),
        (4, "http://c/\r\nX: y", ""), (5, "http://d/", "é" * 100_000), (None, "http://e/", "<p>x</p>"),
        (None, "http://f/", "only"), (7, "http://g/", "tie"), (7, "http://g/", "tie"),
        (8, "http://h/", "a\r\n\r\nb\r\n")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn(
        "sha", F.lit("clash"))


@pytest.fixture(scope="module")
def root(spark, pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc"))
    warc.write_archives(warc.page_records(pages), path, max_file_bytes=200)
    return path


def test_round_trip(spark, root):
    last = {}
    for p, _, h in ROWS:
        b = (h or "").encode()
        if p is not None:
            last[b] = max(last.get(b, p), p)
    got = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes,
                   None if r.payload is None else bytes(r.payload))
                  for r in warc.read_archives(spark, root).collect()), key=str)
    want = []
    for p, _, h in ROWS:
        b = (h or "").encode()
        again = b in last and last[b] != p
        want.append((f"urn:x-page:{'' if p is None else p}", "revisit" if again else "response",
                     f"urn:x-page:{last[b]}" if again else None, digest(b), len(b),
                     None if again else b))
    assert got == sorted(want, key=str)


def test_line_breaks_stay_out_of_headers(spark, root):
    uris = {r.target_uri for r in warc.read_archives(spark, root).collect()}
    assert "http://c/%0D%0AX: y" in uris


def test_filters_are_pushed_and_payload_is_skipped(spark, root):
    df = warc.read_archives(spark, root, "skip").filter("record_type = 'revisit'")
    assert {r.record_id for r in df.collect()} == {"urn:x-page:1", "urn:x-page:", "urn:x-page:3"}
    reader = warc.WarcReader(root)
    from pyspark.sql.datasource import EqualTo, IsNull

    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), IsNull(("payload",))]))
    assert left == [IsNull(("payload",))]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert {r[0] for r in rows} == {"revisit"}


def test_files_of_lost_tasks_are_not_read(spark, root):
    n = warc.read_archives(spark, root).count()
    some = next(f for f in os.listdir(root) if f.endswith(".warc.gz"))
    with open(os.path.join(root, some), "rb") as a, open(
            os.path.join(root, "part-lost.warc.gz"), "wb") as b:
        b.write(a.read())
    assert warc.read_archives(spark, root).count() == n


def test_torn_record_raises(root):
    import io

    name = next(f for f in os.listdir(root) if f.endswith(".warc.gz"))
    with open(os.path.join(root, name), "rb") as f:
        raw = f.read()
    with pytest.raises(EOFError):
        list(warc.read_members(io.BytesIO(raw[:-30]), {}))


def test_digest_is_that_of_the_archived_bytes(tmp_path):
    """One changed payload byte under unchanged headers changes the row."""
    import gzip
    import io

    body = "é".encode() * 300_000
    whole = warc.encode_record("response", "urn:x-page:1", "u", "d", digest(body), None,
                               len(body), body)
    at = len(whole) - 1000
    bad = whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1:]
    short = whole.replace(b"Content-Length: 600000\r\n\r\n", b"Content-Length: 600001\r\n\r\n")
    changed = body[:at - len(whole) + 4] + bytes([whole[at] ^ 1]) + body[at - len(whole) + 5:]
    for payload, want in (("digest", [digest(body), digest(changed), digest(body)]),
                          ("skip", [digest(body)] * 3)):
        got = [next(warc.read_members(io.BytesIO(gzip.compress(r)), {}, payload))
               for r in (whole, bad, short)]
        assert [r[4] for r in got] == want
        assert [r[6] for r in got] == [600_000, 600_000, 600_000 + (payload == "skip")]
        assert all(r[7] is None for r in got)
    assert next(warc.read_members(io.BytesIO(gzip.compress(bad)), {}))[7] == changed
    cut = whole.replace(b"Content-Length: 6000", b"Content-Length: 7000")
    with pytest.raises(EOFError):
        list(warc.read_members(io.BytesIO(gzip.compress(cut)), {}))


def test_skipped_payloads_are_not_kept(root):
    """With ``skip`` no byte behind the HTTP header is held."""
    block = warc._Block({"length": 1 << 40, "record_type": "response"}, "skip")
    block.add(b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r")
    for _ in range(10):
        block.add(b"\n" + b"x" * 1000)
    assert block.in_body and bytes(block.http).endswith(b"Content-Length: 5")
    assert block.body is None and block.sha is None and block.size == 10_009


def test_small_payloads_are_responses(pages):
    kinds = {r.record_type for r in warc.page_records(pages, min_bytes=1 << 20).collect()}
    assert kinds == {"response"}


def test_empty(spark, pages, tmp_path):
    got = warc.archive_pages(pages.limit(0), str(tmp_path / "none"))
    assert got.collect() == []
