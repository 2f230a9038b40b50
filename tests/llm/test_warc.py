"""Archives: round trips, magic inside payloads, and blocks that cut records."""

import base64
import hashlib

from samesense.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"

PAGES = [
    (5, "http://a/1", "hello"),
    (3, "http://a/2", "hello"),
    (3, "http://a/2", "hello"),
    (9, "http://a/3\r\nInjected: yes", "hello"),
    (1, None, None),
    (2, "", ""),
    (None, "http://n/", "null id"),
    (None, "http://n/2", "hello"),
    (20, "http://m/1", f"before {FAKE} after"),
    (21, "http://m/2", FAKE),
    (22, "http://m/3", FAKE * 3 + "WARC/1.1\r\n"),
    (23, "http://m/4", f"before {FAKE} after"),
    (24, "http://m/5", "WARC/1.1\r\nContent-Length: 99999999999999999999999\r\n\r\nx"),
    (25, "http://m/6", "WARC/1.1\r\nContent-Length: 7\r\n\r\nWARC/1.1\r\n\r\n\r\n"),
    (30, "http://u/", "ünï\U0001f600\r\n\r\n" * 9),
    (31, "http://long/", "long line " * 40_000),
] + [(100 + i, f"http://r/{i}", f"page {i} " + ("again" if i % 7 else FAKE)) for i in range(300)]


def want(pages, least=0):
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    rows = []
    count = {}
    for _, _, html in pages:
        count[html or ""] = count.get(html or "", 0) + 1
    for page, _, html in pages:
        data = (html or "").encode()
        again = len(data) >= least and count[html or ""] > 1 and first.get(html or "") != page
        rows.append((
            str(page), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
            "revisit" if again else "response", str(first[html or ""]) if again else "None",
        ))
    return sorted(rows)


def got(records):
    return sorted(
        (str(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]))
        for r in records.collect()
    )


def pages(spark, rows=PAGES):
    return spark.createDataFrame(
        [(*row, "clash", 1) for row in rows], "page_id bigint, url string, html string, _digest string, start int"
    )


def test_round_trip(spark):
    assert got(warc.round_trip(pages(spark).repartition(3, "page_id"))) == want(PAGES)


def test_least_bytes(spark):
    assert got(warc.round_trip(pages(spark).coalesce(1), least_bytes=6)) == want(PAGES, 6)


def test_small_blocks_cut_records(spark):
    """Blocks far smaller than a record: chains cross many blocks."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert got(warc.round_trip(pages(spark).coalesce(1))) == want(PAGES)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_all_different_and_empty(spark):
    rows = [(i, "u", f"p{i}") for i in range(20)]
    assert got(warc.round_trip(pages(spark, rows))) == want(rows)
    assert warc.round_trip(pages(spark, []).limit(0)).count() == 0


def test_payload_text_is_in_the_archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages(spark), path)
    data = b"".join(f.read_bytes() for f in sorted((tmp_path / "archive").glob("part-*")))
    assert ("ünï\U0001f600\r\n\r\n" * 9).encode() in data
    assert b"\r\nInjected" not in data


def test_mandatory_headers(spark, tmp_path):
    """Every record states a date, every revisit a profile; the same pages give the same bytes."""
    found = []
    for run in ("one", "two"):
        path = str(tmp_path / run)
        warc.write_archive(pages(spark).coalesce(1), path, date="2024-05-06T07:08:09Z")
        found.append(b"".join(f.read_bytes() for f in sorted((tmp_path / run).glob("part-*"))))
    assert found[0] == found[1]
    heads = [r.split(b"\r\n\r\n")[0] for r in found[0].split(b"WARC/1.1\r\nWARC-Type: ") if b"<urn:page:999>" not in r and b"WARC-Date" in r]
    assert len(heads) > 250
    for head in heads:
        assert b"\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n" in head
        assert (b"\r\nWARC-Profile: http" in head) == head.startswith(b"revisit")
