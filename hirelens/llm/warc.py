"""WARC archives: write a transaction per page, read archives back, join records into captures.

A transaction is a request, a response (or a revisit of an earlier response with the same payload)
and a metadata record. Request and metadata name the response in WARC-Concurrent-To. Records are
framed by Content-Length alone, so payloads may hold anything, blank lines included.

Writing needs no Python: a record ends with two line breaks, which is the line separator given to
Spark's text writer. Archives are compressed as a whole by the writer's codec. Reading takes whole
files (Spark's binaryFile source) and walks their records; the writer bounds records a file.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import stored
from hirelens.session import shared_dir
from hirelens.sources.tables import read_parquet

BREAK = "\r\n"
# A reader's view of a record.
RECORD = ("file string, record_id string, record_type string, concurrent_to string, target_uri string, "
          "warc_date string, headers map<string,string>, http_head string, payload binary, damaged boolean")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(content: Column) -> Column:
    """Upper-case base32 of the SHA-1: five bytes become eight letters, by base conversion."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexed = F.sha1(content)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), digits, letters)


def record_urn(kind: str, *names: Column) -> Column:
    """A stable urn:uuid from a kind and names, so that a repeated task writes the same records."""
    hexed = F.md5(F.concat_ws("|", F.lit(kind), *names))
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def roles(pages: DataFrame, id_col: str, least_bytes: int = 0) -> DataFrame:
    """Per page the page whose response it revisits, or null if it is a response itself.

    Of equal payloads with at least ``least_bytes`` bytes the smallest identifier (null last) is
    the response. Groups shrink to one row map-side before any shuffle; the join back is a plain
    equality join, whose hot keys adaptive execution splits.
    """
    first = pages.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.col("row"))).alias("first"))
    return pages.join(first, ["digest", "bytes"], "left")


def prepare(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """Pages with payload, digest and role. ``row`` tells rows with the same identifier apart."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    named = pages.select(
        F.col(id_col).alias("page_id"),
        # Spaces and control characters can't stand in a header; they are percent-encoded.
        F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"\s", "%20"), r"\p{Cntrl}", "").alias("uri"),
        payload.alias("payload"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("row"))
    measured = named.withColumns({"bytes": F.octet_length("payload").cast("long"),
                                  "digest": base32_sha1(F.col("payload").cast("binary"))})
    joined = roles(measured, "page_id", least_bytes)
    is_first = F.col("first").isNull() | (F.col("row") == F.col("first.row"))
    return joined.withColumn("first", F.when(~is_first, F.col("first")))


def _record(kind: str, urn: Column, uri: Column, date: Column, content_type: str, extra: list[Column], block: Column) -> Column:
    head = F.concat_ws(
        BREAK, F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), urn),
        F.concat(F.lit("WARC-Date: "), date), F.concat(F.lit("WARC-Target-URI: "), uri), *extra,
        F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(2 * BREAK), block)


def records(prepared: DataFrame, date: str) -> DataFrame:
    """Three records a page as text, without their closing line breaks."""
    # The page's own name in urns: identifier and row, as rows may share an identifier.
    here = [F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.to_json("row")]
    there = [F.coalesce(F.col("first.id").cast("string"), F.lit("null")), F.to_json("first.row")]
    response, uri, day = record_urn("response", *here), F.col("uri"), F.lit(date)
    answers_to = F.concat(F.lit("WARC-Concurrent-To: "), response)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    host = F.coalesce(F.nullif(F.regexp_extract("uri", r"://([^/?#]*)", 1), F.lit("")), F.lit("localhost"))
    path = F.coalesce(F.nullif(F.regexp_extract("uri", r"://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    asked = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{BREAK}Host: "), host, F.lit(2 * BREAK))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(2 * BREAK))
    page = F.coalesce(F.concat(F.lit(f"{BREAK}page-id: "), F.col("page_id").cast("string")), F.lit(""))
    told = F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string"), page)
    answer = F.when(F.col("first").isNull(), _record(
        "response", response, uri, day, "application/http; msgtype=response", [digest], F.concat(http, F.col("payload")))
    ).otherwise(_record(
        "revisit", response, uri, day, "application/http; msgtype=response",
        [digest, F.lit(f"WARC-Profile: {PROFILE}"),
         F.concat(F.lit("WARC-Refers-To: "), record_urn("response", *there))], http))
    request = _record("request", record_urn("request", *here), uri, day, "application/http; msgtype=request",
                      [answers_to], asked)
    metadata = _record("metadata", record_urn("metadata", *here), uri, day, "application/warc-fields",
                       [answers_to], told)
    return prepared.select(F.explode(F.array(request, answer, metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 3000,
                   compression: str = "gzip") -> None:
    """Write a folder of archives; a null payload is written as an empty one, an empty table as no record."""
    lines = records(prepare(pages, id_col, url_col, html_col, least_bytes), date)
    (lines.write.option("lineSep", 2 * BREAK).option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))


# Compressed bytes given to a gzip member at a time.
GZIP_PIECE = 1 << 14


def parse_records(content: bytes) -> Iterator[dict]:
    """Records of one archive (plain, or gzip of one or many members), framed by Content-Length.

    A record that is cut short, or bytes that begin no record, give one row marked damaged;
    reading goes on at the next record start.
    """
    content = inflate(content)
    at, end = 0, len(content)
    while at < end:
        if content[at:at + 5] != b"WARC/":
            following = content.find(b"WARC/1.", at + 1)
            if content[at:following if following >= 0 else end].strip():
                yield {"headers": [], "damaged": True}
            at = following if following >= 0 else end
            continue
        split = content.find(b"\r\n\r\n", at)
        lines = content[at:split if split >= 0 else end].decode("utf-8", "replace").split(BREAK)[1:]
        pairs = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines)]
        headers = {k.lower(): v for k, v in pairs}
        length = headers.get("content-length", "")
        whole = split >= 0 and length.isdigit() and split + 4 + int(length) <= end
        if not whole:
            yield {"headers": list(headers.items()), "damaged": True}
            following = content.find(b"\r\n\r\nWARC/1.", at + 4)
            at = following + 4 if following >= 0 else end
            continue
        block = content[split + 4:split + 4 + int(length)]
        at = split + 4 + int(length)
        while content[at:at + 2] == b"\r\n":
            at += 2
        http, payload = None, block
        if headers.get("content-type", "").startswith("application/http"):
            cut = re.search(rb"\r\n\r\n", block)
            http = block[:cut.start() if cut else len(block)].decode("utf-8", "replace")
            payload = block[cut.end():] if cut else b""
        yield {"record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"),
               "concurrent_to": headers.get("warc-concurrent-to"), "target_uri": headers.get("warc-target-uri"),
               "warc_date": headers.get("warc-date"), "headers": list(headers.items()), "http_head": http,
               "payload": payload, "damaged": False}


def inflate(content: bytes) -> bytes:
    """The bytes of a gzip file of any number of members; other bytes as they are. A cut member gives what it has."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts, at, whole = [], 0, memoryview(content)
    while content[at:at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        while at < len(content) and not member.eof:
            # Fed in pieces: what a member leaves over is at most one of them, however many members follow.
            parts.append(member.decompress(whole[at:at + GZIP_PIECE]))
            at = min(at + GZIP_PIECE, len(content))
        at -= len(member.unused_data)
        if not member.eof:
            break
    return b"".join(parts)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives in a folder."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = to_arrow_schema(_parse_datatype_string(RECORD))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, held, size = batch.column("path")[k].as_py(), [], 0
                for record in parse_records(batch.column("content")[k].as_py()):
                    held.append({"file": name, **record})
                    size += len(record.get("payload") or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(rows, RECORD)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: response (or revisit), request and metadata joined by concurrent-to.

    A response without companions stays with nulls in their place; companions whose response is
    missing and damaged records are left out here (they are rows of ``read_archives``). Records
    that occur twice under one identifier count once.
    """
    good = found.where(~F.col("damaged"))
    nested = F.struct("record_id", "target_uri", "warc_date", "headers", "http_head", "payload")
    answers = (good.where(F.col("record_type").isin("response", "revisit") & F.col("record_id").isNotNull())
               .select("record_id", "record_type", nested.alias("answer")).dropDuplicates(["record_id"]))
    beside = good.where(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    beside = beside.groupBy(F.col("concurrent_to").alias("record_id")).agg(
        F.min(F.when(F.col("record_type") == "request", F.struct("record_id", "http_head", "payload"))).alias("request"),
        F.min(F.when(F.col("record_type") == "metadata", F.struct("record_id", "payload"))).alias("metadata"))
    return answers.join(beside, "record_id", "left")


def field(block: Column, name: str) -> Column:
    """One value of an application/warc-fields block; null if it is not there."""
    return F.nullif(F.regexp_extract(block.cast("string"), rf"(?m)^{name}: *(.*?)\r?$", 1), F.lit(""))


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives, read them back, and describe each capture."""
    path = shared_dir(spark, "warc")
    write_archives(read_parquet(spark, f"{sf_dir}/pages.parquet"), path)
    found = captures(read_archives(spark, path))
    told = F.col("metadata.payload")
    is_response = F.col("record_type") == "response"
    narrow = stored(found.select(
        "record_id", "record_type", field(told, "page-id").cast("long").alias("page_id"),
        F.when(is_response, F.octet_length("answer.payload").cast("long"))
        .otherwise(field(told, "payload-bytes").cast("long")).alias("payload_bytes"),
        F.when(is_response, base32_sha1(F.col("answer.payload")))
        .otherwise(F.substring_index(F.col("answer.headers")["warc-payload-digest"], ":", -1)).alias("payload_digest"),
        F.col("answer.headers")["warc-refers-to"].alias("refers_urn")), "warc-captures")
    originals = narrow.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_urn"), F.col("page_id").alias("refers_to"))
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = narrow.where(F.col("refers_urn").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    revisits = narrow.where(F.col("refers_urn").isNotNull()).join(originals, "refers_urn", "left")
    return responses.select(shown).unionByName(revisits.select(shown))


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hexed FROM pages
), d AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(hexed, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT) + 1, 1)), '')
           AS payload_digest,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
