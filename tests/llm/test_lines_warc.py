import hashlib
import random
from collections import Counter

import pytest
from brute import line_dedup
from conftest import pairs

from usageledger.llm import lines, warc


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("which", ["documents", "odd_docs"])
def test_line_dedup_equals_plain(which, request):
    frame = request.getfixturevalue(which)
    assert rows_of(lines.digests(frame)) == Counter(line_dedup(pairs(frame)))


def test_hot_lines_over_many_partitions(spark):
    rng = random.Random(2)
    hot = ["A line that very many of the documents hold, number one ", "another LINE that very many of the documents hold é", "x" * 39]
    rows = []
    for i in range(600):
        own = [f"line {rng.randrange(150)} that a handful of documents have in common" for _ in range(4)]
        body = own + [rng.choice(["", "\t"]) + h for h in hot if rng.random() < 0.7] * rng.choice([1, 1, 2])
        rng.shuffle(body)
        rows.append((i, "\n".join(body)))
    frame = spark.createDataFrame(rows + rows[:20], "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(lines.digests(frame))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == Counter(line_dedup(rows + rows[:20]))


def test_settling_is_the_same_for_any_batches(spark):
    rows = [(i, "\n".join(f"line {i % k} that a handful of documents have in common" for k in (2, 3, 50))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows_of(lines.digests(frame)) == Counter(line_dedup(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_texts_without_common_lines(odd_docs, documents):
    for frame in (odd_docs, documents):
        out = lines.without_common_lines(frame)
        assert out.columns == frame.columns
        want = Counter((i, s) for i, _, _, s in line_dedup(pairs(frame)))
        assert Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in pairs(out)) == want


def test_empty_line_tables(documents):
    assert lines.digests(documents.limit(0)).count() == 0


def plain_roles(rows):
    best = {}
    for i, html in rows:
        if len((html or "").encode()) >= 1000 and i is not None:
            best[html] = max(best.get(html, i), i)
    out = []
    for i, html in rows:
        body = (html or "").encode()
        other = best.get(html)
        revisit = other is not None and other != i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return Counter(out)


def trip(frame):
    return rows_of(warc.round_trip(frame).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def test_pages_come_back(pages):
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    assert trip(pages) == plain_roles(rows)


def test_odd_pages_come_back(spark):
    big, other = "<p>é" * 400, "x" * 1000
    rows = [(1, None), (2, ""), (3, big), (9, big), (9, big), (4, big), (None, big), (5, other), (None, "small"), (6, "a\r\n\r\nb"), (7, "y" * 2_000_000), (8, "x" * 999), (10, "x" * 999)]
    frame = spark.createDataFrame([(i, f"http://e/{i}\r\n%0A", h, "clash") for i, h in rows] + [(11, None, other, "c")], "page_id long, url string, html string, first string")
    back = warc.round_trip(frame)
    assert rows_of(back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == plain_roles(rows + [(11, other)])
    texts = {r["page_id"]: r["payload"] for r in back.where("record_type = 'response' and page_id is not null").collect()}
    assert texts[6] == b"a\r\n\r\nb" and texts[1] == b""
    urls = {r["page_id"]: r["url"] for r in back.collect()}
    assert urls[6] == "http://e/6\r\n%0A" and urls[11] is None
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_damaged_archives_are_errors():
    record = warc.record_bytes(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), "response", None)
    archive = warc.archive_bytes([record] * 3)
    assert [r["payload"] for r in warc.read_records(archive)] == [b"payload"] * 3
    for broken in (archive[8:], archive[:-1], archive[:40] + b"\xff" + archive[41:], b""):
        with pytest.raises(Exception):  # noqa: B017
            list(warc.read_records(broken))
    for wrong in (record.replace(b"payload", b"pAyload"), record[:-1], record.replace(b"WARC/1.1", b"WARC/9"), record.replace(b"Content-Length: ", b"Content-Length: 1")):
        with pytest.raises(ValueError):
            warc.parse_record(wrong)
