import base64
import gzip
import hashlib
import random

from hirelens.llm.warc import captures, field, inflate, parse_records, read_archives, warc, write_archives
from hirelens.session import shared_dir

SCHEMA = "page_id long, url string, html string, payload string, row string, first string"


def pages(rows):
    return [(i, u, h, "p", "r", "f") for i, u, h in rows]


def test_round_trip(spark, on_file):
    pick = random.Random(2)
    bodies = ["", None, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc", "é" * 10, "<html>\r\n\r\n</html>", "same", "same"]
    rows = [(k, f"http://h{k}.example/p q\n?x", pick.choice(bodies)) for k in range(60)]
    rows += [(None, None, "same"), (7, "u", "same"), (7, "u", "same")]
    path = shared_dir(spark, "warc-test")
    write_archives(on_file(pages(rows), SCHEMA, files=2), path, records_per_file=20)
    found = captures(read_archives(spark, path)).collect()
    assert len(found) == len(rows)
    least = {}
    for i, _, h in rows:
        least[h or ""] = min(least.get(h or "", (True, 0)), (i is None, i or 0))
    for row in found:
        assert row.request is not None and row.metadata is not None
        if row.record_type == "response":
            content = bytes(row.answer.payload)
            digest = base64.b32encode(hashlib.sha1(content).digest()).decode()
            assert row.answer.headers["warc-payload-digest"] == f"sha1:{digest}"
            assert int(row.answer.headers["content-length"]) >= len(content)
            assert content.decode() in least
    assert sum(r.record_type == "response" for r in found) == len(least)


def test_small_payloads_are_never_revisits(spark, on_file):
    path = shared_dir(spark, "warc-test")
    write_archives(on_file(pages([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), SCHEMA), path, least_bytes=3)
    found = captures(read_archives(spark, path))
    kinds = {int(r.page): r.record_type for r in found.select(
        "record_type", field(found["metadata.payload"], "page-id").alias("page")).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark, on_file):
    path = shared_dir(spark, "warc-test")
    write_archives(on_file([], SCHEMA), path)
    assert captures(read_archives(spark, path)).count() == 0


def test_damaged_archives():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    assert [r["damaged"] for r in parse_records(good * 2)] == [False, False]
    assert [r["damaged"] for r in parse_records(b"junk" + good)] == [True, False]
    assert [r["damaged"] for r in parse_records(good + good[:-6])] == [False, True]
    cut = good.replace(b"Content-Length: 2", b"Content-Length: x")
    assert [r["damaged"] for r in parse_records(cut + good)] == [True, False]
    assert list(parse_records(b"")) == []
    members = gzip.compress(good) + gzip.compress(good)
    assert inflate(members) == good * 2 and inflate(members[:-9])[:len(good)] == good


def test_pages(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.page_id: tuple(r)[1:] for r in warc(spark, folder).collect()}
    rows = sorted(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect())
    first = {}
    for r in rows:
        first.setdefault(r.html or "", r.page_id)
    for r in rows:
        content = (r.html or "").encode()
        again = first[r.html or ""] != r.page_id
        assert got[r.page_id] == (len(content), base64.b32encode(hashlib.sha1(content).digest()).decode(),
                                  "revisit" if again else "response", first[r.html or ""] if again else None)


def test_many_gzip_members_in_linear_time():
    import time
    body = random.Random(1).randbytes(20_000)
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 20000\r\n\r\n" + body + b"\r\n\r\n"
    member, began = gzip.compress(record, 1), time.time()
    assert inflate(member * 3000) == record * 3000
    assert time.time() - began < 20
    assert inflate(member * 2 + member[:500])[:len(record) * 2] == record * 2
    assert inflate(b"") == b"" and inflate(b"plain") == b"plain"
