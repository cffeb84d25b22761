import gzip
import time

import pandas as pd
import pytest

from cloudtally.llm import warc
from tests.conftest import plan


def test_query_matches_sql(query, oracle):
    got, expected = query("op3_warc_segments"), oracle("op3_warc_segments")
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)

    def rows(df):
        return sorted((tuple(None if pd.isna(v) else v for v in r) for r in df[columns].itertuples(index=False, name=None)),
                      key=str)
    assert rows(got) == rows(expected)
    assert len(got)


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "page_id long, url string, html string, row long, payload string")


ROWS = [(1, "http://a", "same"), (2, None, "same"), (3, "http://c\r\nX: 1", None), (4, "", ""), (None, "n", "same"),
        (5, "u", "é" * 1000), (6, "u", "WARC/1.1\r\n\r\n" * 300), (7, "u", "0\r\n\r\n"), (7, "u", "0\r\n\r\n"),
        (8, "u", "日本" * 7000), (None, "u", "alone")]


@pytest.mark.parametrize("segment", [61, 1000, 1 << 16])
def test_round_trip(spark, tmp_path, segment):
    path = str(tmp_path / "archives")
    warc.write_archives(pages(spark, ROWS), path, file_records=5, segment=segment, chunk=40)
    found = warc.read_records(spark, path)
    whole = {(r.page_id, bytes(r.payload)) for r in warc.payloads(found).collect() if r.problem is None}
    assert whole == {(2, b"same"), (4, b""), (5, ("é" * 1000).encode()), (6, b"WARC/1.1\r\n\r\n" * 300),
                     (7, b"0\r\n\r\n"), (8, ("日本" * 7000).encode()), (None, b"alone")}
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.problem)
           for r in warc.read_pages(spark, path).collect()}
    same, empty = warc.digest(b"same"), warc.digest(b"")
    assert {(1, 4, same, "revisit", 2, None), (2, 4, same, "response", None, None), (None, 4, same, "revisit", 2, None),
            (3, 0, empty, "revisit", 4, None)} <= got
    assert warc.read_pages(spark, path).count() == len(ROWS)


def test_faults_are_named(spark, tmp_path):
    path = tmp_path / "archives"
    warc.write_archives(pages(spark, [(1, "u", "x" * 500), (2, "u", "y" * 500), (3, "u", "z" * 500), (4, "u", "w" * 500)]).coalesce(1),
                        str(path), segment=200)
    file = next(path.glob("*.gz"))
    parts = gzip.decompress(file.read_bytes()).split(b"WARC/1.1\r\n")[1:]
    kept = [p for p in parts if not (b"continuation" in p and b":3>" in p and b"yyy" in p)]
    kept = [p.replace(b"Total-Length: ", b"Total-Length: 1") if b"zzz" in p else p for p in kept]
    kept = [p.replace(b"w" * 20, b"v" * 20, 1) if b"www" in p else p for p in kept]
    (path / "b.gz").write_bytes(gzip.compress(b"".join(b"WARC/1.1\r\n" + p for p in kept)))
    found = warc.read_records(spark, str(path / "b.gz"))
    assert {r.page_id: r.problem for r in warc.payloads(found).collect()} == {
        1: None, 2: "segments are missing or doubled" if len(parts) > 12 else "the last segment is missing",
        3: "the length differs from the total", 4: "the digest differs"}


@pytest.mark.parametrize("body", [b"", b"x\r\n", b"3\r\nab\r\n0\r\n\r\n", b"2\r\nab\r\n", b"2\r\nab\r\n0\r\n"])
def test_broken_framing(body):
    with pytest.raises(ValueError, match="chunk"):
        warc.unframed(body)


def test_framing_with_extensions():
    assert warc.unframed(b"2;a=b\r\nab\r\n0\r\nX: y\r\n\r\n") == b"ab"


def test_no_pages_and_small_payloads(spark, tmp_path):
    warc.write_archives(pages(spark, []), str(tmp_path / "none"))
    assert warc.read_pages(spark, str(tmp_path / "none")).count() == 0
    warc.write_archives(pages(spark, ROWS), str(tmp_path / "some"), smallest=5)
    kinds = {(r.page_id, r.record_type) for r in warc.read_pages(spark, str(tmp_path / "some")).collect()}
    assert {k for k in kinds if k[1] == "revisit"} == set()


def test_broken_and_foreign_archives(spark, tmp_path):
    path = tmp_path / "archives"
    warc.write_archives(pages(spark, [(i, "u", f"page {i} " * 50) for i in range(6)]).coalesce(1), str(path))
    good = next(path.glob("*.gz")).read_bytes()
    (path / "cut.gz").write_bytes(good[:len(good) // 2])
    (path / "noise.gz").write_bytes(b"not an archive at all")
    (path / "text.gz").write_bytes(gzip.compress(b"hello\r\n"))
    info = b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:uuid:7c1e>\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n"
    body = b"HTTP/1.1 200 OK\r\n\r\nplain body"
    (path / "foreign.gz").write_bytes(gzip.compress(info % (b"warcinfo", b"", 3, b"abc") + info % (b"response", b"", len(body), body)))
    (path / "empty.gz").write_bytes(gzip.compress(b""))
    found = warc.read_records(spark, str(path))
    kinds = {(r.type, (r.problem or "").split("/")[-1].split(":")[0]) for r in found.collect()}
    assert {k for k in kinds if k[0] == "broken"} == {("broken", f) for f in ("cut.gz", "noise.gz", "text.gz")}
    got = warc.read_pages(spark, str(path)).collect()
    assert {r.page_id for r in got if r.record_type == "response" and r.problem is None} == {None, *range(6)}
    assert [r.payload_bytes for r in got if r.page_id is None and r.record_type == "response"] == [10]
    assert sum(r.record_type == "broken" for r in got) == 3


def test_archives_are_read_in_two_passes(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages(spark, ROWS), path, segment=1000)
    assert plan(warc.read_pages(spark, path)).count("FileScan binaryFile") == 0
    assert plan(warc._contents(warc.read_records(spark, path), keep=False)).count("FileScan binaryFile") == 2


def test_a_page_of_one_hundred_megabytes_is_joined_in_line(spark, tmp_path):
    """1,600 segments; a join that copies what it has at each of them would move 80 GB."""
    frame = spark.range(1).selectExpr("id AS page_id", "'u' AS url", "repeat('0123456789abcdef', 6553600) AS html")
    start = time.perf_counter()
    warc.write_archives(frame, str(tmp_path / "large"))
    row = warc.read_pages(spark, str(tmp_path / "large")).collect()[0]
    assert (row.payload_bytes, row.problem) == (16 * 6_553_600, None)
    assert row.payload_digest == warc.digest(b"0123456789abcdef" * 6_553_600)
    assert time.perf_counter() - start < 60
