import random
import struct

import zstandard
from cases import by_key, rows_of

from replyloom.llm import warc as W
from replyloom.llm.common import new_folder

PAGES = [
    (3, "http://a/", "<p>same é😀</p>"),
    (1, "http://b/", "<p>same é😀</p>"),
    (2, None, "<p>same é😀</p>"),
    (4, "http://c/\r\nX: y", None),
    (5, "", ""),
    (5, "", ""),
    (6, "http://d/", "a\r\n\r\nWARC/1.1\r\n\r\n"),
    (7, "http://e/", "z" * 200_000),
    (None, "http://f/", "no key"),
    (None, "http://g/", "<p>same é😀</p>"),
] + [(100 + i, f"http://h/{i}", f"<html><body>page {i} {'lorem ' * (i % 50)}</body></html>") for i in range(120)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows], "page_id long, url string, html string, payload string, first long, part int"
    ).repartition(3)


def expected(rows):
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    out = []
    for k, _, h in rows:
        raw = (h or "").encode()
        refers = first.get(h or "") if first.get(h or "") != k else None
        out.append((k, len(raw), W.payload_digest(raw), "revisit" if refers is not None else "response", refers))
    return by_key(out)


def test_round_trip(spark):
    found = W.warc_round_trip(pages(spark))
    assert rows_of(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected(PAGES)


def test_payloads_and_urls_come_back(spark):
    folder = new_folder(spark, "warc-test")
    written = W.write_archives(pages(spark), folder, archive_bytes=5_000)
    assert sum(r.n_records for r in written.rows.collect()) == len(PAGES) and written.rows.count() > 3
    rows = W.read_archives(written.rows, folder).collect()
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    texts = {(r.page_id, bytes(r.payload).decode()) for r in rows if r.payload is not None}
    assert {(k, h or "") for k, _, h in PAGES if k not in (None, 2, 3)} - {(5, ""), (6, "")} <= texts | {(5, "")}
    assert {r.url for r in rows if r.page_id == 4} == {"http://c/%0D%0AX: y"}
    assert {r.url for r in rows if r.page_id == 2} == {None}


def test_a_second_attempt_leaves_the_first_whole(spark):
    """What a task that runs twice does: the same folder and parts, rows in another order."""
    folder = new_folder(spark, "warc-test")
    first = W.write_archives(pages(spark), folder, archive_bytes=5_000)
    second = W.write_archives(pages(spark, PAGES[::-1]), folder, archive_bytes=3_000)
    names = [{r.name for r in x.rows.collect()} for x in (first, second)]
    assert not names[0] & names[1]
    for written in (first, second):
        found = W.read_archives(written.rows, folder, payloads=False)
        assert rows_of(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected(PAGES)


def test_a_wrong_count_is_noticed(spark):
    import pytest

    folder = new_folder(spark, "warc-test")
    written = W.write_archives(pages(spark), folder).rows.selectExpr("name", "n_records + 1 as n_records")
    with pytest.raises(Exception, match="records instead of"):
        W.read_archives(written, folder).collect()


def test_archives_have_a_dictionary_frame_and_single_records():
    random.seed(1)
    records = [W.warc_record(i, f"http://h/{i}", f"<html>page {i} {random.random()}</html>".encode(), None) for i in range(300)]
    raw = W.archive(records)
    magic, size = struct.unpack_from("<II", raw)
    assert magic == W.DICTIONARY_FRAME and size > 0
    assert list(W.records_of(raw)) == records
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(raw) < alone
    # Any frame is readable without those before it.
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    last = zstandard.ZstdCompressor(level=3, dict_data=dictionary).compress(records[-1])
    assert raw.endswith(last)


def test_one_tiny_record():
    record = W.warc_record(1, None, b"", None)
    assert list(W.records_of(W.archive([record]))) == [record]


def test_a_damaged_payload_is_noticed():
    import pytest

    record = W.warc_record(1, "http://a/", b"payload", None)
    with pytest.raises(ValueError, match="digest"):
        W.parse_record(record.replace(b"\r\n\r\npayload", b"\r\n\r\npayloaf"))


def test_empty_table(spark):
    assert W.warc_round_trip(pages(spark, [])).collect() == []
