"""WARC: round trips, reassembly, and equality with the SQL over awkward pages."""

import gzip
import random

import duckdb
import pytest

from strata.llm import warc

SCHEMA = "page_id long, url string, html string"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def through(spark, pages, path):
    warc.write_archives(pages, str(path))
    return warc.read_archives(spark, str(path))


def awkward():
    r = random.Random(5)
    long = "".join(r.choice("abcé漢\r\n <>") for _ in range(120_000))
    body = "x\r\n\r\nWARC/1.1\r\n" * 100
    return [(1, "http://a", None), (2, "http://b", ""), (3, None, long), (4, "u", long), (5, "u", long + "!"),
            (6, "u", body), (7, "u", body), (8, "u", body), (9, "u", "short"), (10, "u", "short"),
            (11, "u\r\nX: y", "é" * 500), (12, "u", "é" * 500), (13, "u", "e" * 999), (14, "u", "e" * 999)]


def test_rows_equal_sql(spark, tmp_path):
    pages = spark.createDataFrame(awkward(), SCHEMA)
    found = through(spark, pages, tmp_path / "w")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.execute(warc.ORACLE).fetchall()
    names = [d[0] for d in con.description]
    assert rows(found, *names) == sorted(want, key=repr)
    assert all(r.digest_ok for r in found.collect())
    assert max(r.segments for r in found.collect()) > 3


def test_null_and_repeated_rows(spark, tmp_path):
    body = "b" * 2000
    pages = spark.createDataFrame([(None, None, body), (7, "u", body), (7, "u", body), (3, "u", body)], SCHEMA)
    found = rows(through(spark, pages, tmp_path / "w"), "page_id", "record_type", "refers_to", "payload_bytes")
    assert found == sorted([(None, "revisit", 7, 2000), (7, "response", None, 2000), (7, "response", None, 2000),
                            (3, "revisit", 7, 2000)], key=repr)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert through(spark, empty, tmp_path / "e").count() == 0
    clash = spark.createDataFrame([(1, "u", "x", "p", 2)], SCHEMA + ", payload string, response int")
    assert rows(through(spark, clash, tmp_path / "c"), "page_id", "payload_bytes") == [(1, 1)]


def test_chunked_framing_round_trip():
    for n in (0, 1, warc.CHUNK, warc.CHUNK + 1, 3 * warc.CHUNK):
        assert warc.unchunked(warc.chunked(b"\r\n0" * n)) == b"\r\n0" * n
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab\r\n0\r\n\r\n")


def test_archive_is_plain_warc(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(awkward(), SCHEMA).coalesce(1), str(tmp_path / "w"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("*.gz")))
    kinds = [f["WARC-Type"] for f, _ in warc.records(raw)]
    assert kinds.count("response") + kinds.count("revisit") == len(awkward()) and "continuation" in kinds


def test_missing_segment_is_an_error(spark):
    parts = spark.createDataFrame([("o", 1, None, 1, "response", "", None, b"ab"), ("o", 3, 5, None, "continuation", "",
                                                                                    None, b"c")], warc.PART)
    with pytest.raises(Exception, match="do not add up"):
        warc.reassembled(parts).collect()
