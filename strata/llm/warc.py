"""WARC archives: writing with segmented records, reading with reassembly.

Writing: every page becomes a ``response`` record (an HTTP message with chunked
transfer framing) or, if its payload is a copy, a ``revisit`` record that names
the response. A block longer than ``SEGMENT`` is cut: its first part stays in the
record, the rest goes into ``continuation`` records. Files are written by Spark's
text writer, one record per row, and hold at most ``RECORDS_PER_FILE`` records, so
a file has a bounded size.

Reading: each file is one row; its records are cut out by their Content-Length.
Whole records are decoded where they are read. Parts of segmented records are
grouped by origin identifier, ordered by segment number, checked against the
total length, joined and decoded; only those move, and a group is one page.
Revisits then take length and digest from the response they name.

Defined results: null html is an empty payload; a null page_id is written as an
empty field and read back as null, and never is the response of others; rows that
repeat a page_id are written and read as often as they occur (all rows with the
largest page_id of equal payloads are responses); an empty table gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored, table
from strata.session import scratch_path

SEGMENT = 32 * 1024          # most block bytes in one record
CHUNK = 8 * 1024             # bytes of an HTTP chunk
RECORDS_PER_FILE = 1000      # so a file holds at most about 32 MB
MIN_REVISIT = 1000           # payload bytes from which copies become revisits
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes) -> bytes:
    """The payload in HTTP chunked transfer framing."""
    parts = [payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        size = int(body[at:eol].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[eol + 2:eol + 2 + size])
        if len(out[-1]) != size or body[eol + 2 + size:eol + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at = eol + 4 + size


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its closing blank lines (the file's record separator)."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None
                 ) -> Iterator[bytes]:
    """The records of one page; ``response``: the page it repeats, None for a response."""
    name = "" if page_id is None else str(page_id)
    this = f"<urn:uuid:{uuid.uuid4()}>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    uri = " ".join((url or "").split())
    same = [("WARC-Record-ID", this), ("WARC-Target-URI", uri), ("Page-ID", name),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if response is not None:
        yield record([("WARC-Type", "revisit"), *same, ("WARC-Profile", REVISIT_PROFILE),
                      ("Refers-To-Page-ID", response)], http)
        return
    block = http + chunked(payload)
    if len(block) <= SEGMENT:
        yield record([("WARC-Type", "response"), *same], block)
        return
    parts = [block[i:i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    yield record([("WARC-Type", "response"), *same, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                      ("WARC-Segment-Origin-ID", this), ("WARC-Segment-Number", k), *last], part)


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an uncompressed archive."""
    at = 0
    while at < len(raw):
        end = raw.index(END, at)
        first, *lines = raw[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        start, size = end + 4, int(fields["Content-Length"])
        if len(raw) < start + size + len(END):
            raise ValueError(f"the record at byte {at} is cut short")
        yield fields, raw[start:start + size]
        at = start + size + len(END)


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(END)
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files under ``path``."""
    payload = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                           F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    # Short payloads get a key of their own, so they neither match nor meet in one task.
    keyed = payload.withColumn("equal", F.when(
        F.length("payload") >= MIN_REVISIT, F.sha2("payload", 256))
        .otherwise(F.concat(F.lit("#"), F.xxhash64("page_id", "url"))))
    first = (payload.filter(F.length("payload") >= MIN_REVISIT).groupBy(F.sha2("payload", 256).alias("equal"))
             .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    linked = (keyed.join(first, "equal", "left")
              .select("page_id", "url", "payload", F.sha1("payload").alias("digest"),
                      F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("response")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(b.num_columns)))
            made = [r for row in rows for r in page_records(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    (linked.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


PART = "origin string, number int, total long, page_id long, kind string, declared string, refers_to long, data binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``. ``data`` is the block of a segment;
    of other records it is empty, and ``total`` and ``origin`` are the payload's length and digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda s: int(s) if s else None
        for b in batches:
            for content in b.column(0):
                rows = []
                for f, block in records(gzip.decompress(content.as_py())):
                    page, kind = number(f.get("Page-ID")), f["WARC-Type"]
                    declared = f.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    refers = number(f.get("Refers-To-Page-ID"))
                    if "WARC-Segment-Number" in f:
                        rows.append((f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]),
                                     int(f["WARC-Segment-Number"]), number(f.get("WARC-Segment-Total-Length")),
                                     page, kind, declared, refers, block))
                    elif kind == "revisit":
                        rows.append((None, None, None, page, kind, declared, refers, None))
                    else:
                        p = http_payload(block)
                        rows.append((hashlib.sha1(p).hexdigest(), None, len(p), page, kind, declared, None, None))
                columns = list(zip(*rows)) or [()] * 8
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 [x.split()[0] for x in PART.split(", ")])

    return files.mapInArrow(run, PART)


def reassembled(parts: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, declared, segments) of the segmented records."""
    groups = parts.groupBy("origin").agg(F.array_sort(F.collect_list(F.struct(  # the parts of one page
        "number", "total", "page_id", "declared", "data"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for origin, found in zip(b.column(0).to_pylist(), b.column(1)):
                found = found.as_py()
                block = b"".join(p["data"] for p in found)
                if [p["number"] for p in found] != list(range(1, len(found) + 1)) or found[-1]["total"] != len(block):
                    raise ValueError(f"record {origin}: segments are missing or do not add up")
                p = http_payload(block)
                rows.append((found[0]["page_id"], len(p), hashlib.sha1(p).hexdigest(), found[0]["declared"], len(found)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["page_id", "payload_bytes", "payload_digest", "declared", "segments"])

    return groups.mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, declared string, segments int")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, segments, digest_ok: one row
    per page; a revisit has the length and digest of the response that it names."""
    read = stored(read_records(spark, path), "warc-records")
    whole = (read.filter("number IS NULL AND kind = 'response'")
             .select("page_id", F.col("total").alias("payload_bytes"), F.col("origin").alias("payload_digest"), "declared",
                     F.lit(1).alias("segments")))
    responses = whole.unionByName(reassembled(read.filter("number IS NOT NULL")))
    revisits = read.filter("kind = 'revisit'").select("page_id", "declared", "refers_to")
    named = responses.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy(F.col("page_id").alias("refers_to"),
                                                                            F.col("payload_digest").alias("declared")) \
        .agg(F.first("payload_bytes").alias("payload_bytes"))
    found = revisits.join(named, ["refers_to", "declared"], "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "digest_ok"]
    return (responses.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long"))
            .withColumn("digest_ok", F.col("declared") == F.col("payload_digest")).select(*out)
            .unionByName(found.withColumn("record_type", F.lit("revisit")).withColumn("segments", F.lit(1))
                         .withColumn("payload_digest", F.col("declared"))
                         .withColumn("digest_ok", F.col("payload_bytes").isNotNull()).select(*out)))


def verified(read: DataFrame) -> DataFrame:
    """The rows of :func:`read_archives`; the query fails at a payload that is not the one declared."""
    message = F.concat(F.lit("payload of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
                       F.lit(" does not have its declared digest"))
    return read.withColumn("payload_digest", F.when(F.col("digest_ok"), F.col("payload_digest")).otherwise(F.raise_error(message)))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return verified(read_archives(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
k AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest, payload FROM p),
w AS (SELECT payload, max(page_id) AS response FROM k WHERE n >= 1000 GROUP BY payload)
SELECT k.page_id, k.n AS payload_bytes, k.digest AS payload_digest,
       CASE WHEN k.n >= 1000 AND w.response IS NOT NULL AND w.response IS DISTINCT FROM k.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.n >= 1000 AND w.response IS NOT NULL AND w.response IS DISTINCT FROM k.page_id THEN w.response END AS refers_to
FROM k LEFT JOIN w ON k.payload = w.payload
"""
