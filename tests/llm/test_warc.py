import base64
import hashlib
import os

import pytest
import zstandard

from featpipe.llm import warc

PAGES = "page_id long, url string, html string"


def expected(rows, min_bytes=0):
    out = []
    for page, _, html in rows:
        b = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == b and p is not None]
        first = min(same, default=None)
        n = sum((h or "").encode() == b for _, _, h in rows)
        revisit = len(b) >= min_bytes and n > 1 and first is not None and page != first
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture
def rows():
    body = "<html><body>%s</body></html>"
    made = [(k, f"http://h{k}.example/p", body % (f"text {k} " * 40)) for k in range(300)]
    made += [(1000 + k, None, body % ("copy " * 50)) for k in range(100)]
    made += [(None, "http://n.example", body % ("copy " * 50)), (None, None, None), (2000, "u", None), (2001, "u", ""),
             (2002, "a\r\nb: c", "é中\U0001f600\r\n\r\nWARC/1.1"), (2003, "u", "x" * 300_000), (1000, None, body % ("copy " * 50))]
    return made


def test_round_trip(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    back = warc.archive_pages(pages, str(tmp_path)).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=repr)
    assert got == expected(rows)
    html = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    for r in back:
        if r.record_type == "response" and r.page_id is not None:
            assert bytes(r.payload) == html[r.page_id]


def test_short_payloads_are_all_responses(spark, rows, tmp_path):
    back = warc.archive_pages(spark.createDataFrame(rows, PAGES), str(tmp_path), min_bytes=100).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=repr)
    assert got == expected(rows, 100)


def test_archive_layout(spark, rows, tmp_path):
    """A leading skippable frame holds the dictionary; every record is a frame that needs it and no other frame."""
    marked = warc.mark_revisits(spark.createDataFrame(rows, PAGES).coalesce(1))
    manifest = warc.write_archives(marked, str(tmp_path)).collect()
    assert sum(m.records for m in manifest) == len(rows)
    big = max(manifest, key=lambda m: m.records)
    raw = open(big.path, "rb").read()
    assert len(raw) == big.bytes == os.path.getsize(big.path)
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC
    size = int.from_bytes(raw[4:8], "little")
    assert size == big.dictionary_bytes > 0
    dictionary = zstandard.ZstdCompressionDict(raw[8:8 + size])
    positions = [p for _, _, p in warc.read_archive(big.path)]
    assert positions[0] == 8 + size and len(positions) == big.records
    some = positions[len(positions) // 2]
    record = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(raw[some:])
    assert record.startswith(b"WARC/1.1\r\n")
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(raw[some:])
    # other readers skip the frame
    assert b"WARC/1.1" in record and zstandard.frame_content_size(raw[some:]) > 0


def test_one_record_is_read_alone(spark, rows, tmp_path):
    """Every record comes back from the raw file by its position and the dictionary frame, and nothing else."""
    marked = warc.mark_revisits(spark.createDataFrame(rows, PAGES).coalesce(1))
    manifest = warc.write_archives(marked, str(tmp_path), archive_bytes=200_000)
    back = warc.read_archives(manifest).collect()
    sizes = {m.path: m.bytes for m in manifest.collect()}
    assert len(back) == len(rows)
    for r in back:
        assert r.position < sizes[r.archive] == os.path.getsize(r.archive)
        headers, payload = warc.read_record(r.archive, r.position)
        assert payload == bytes(r.payload) and headers["WARC-Type"] == r.record_type


def test_rollover_and_untrainable_archives(spark, rows, tmp_path):
    marked = warc.mark_revisits(spark.createDataFrame(rows, PAGES).coalesce(1))
    manifest = warc.write_archives(marked, str(tmp_path), archive_bytes=50_000)
    assert manifest.count() > 3
    back = warc.read_archives(manifest).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=repr)
    assert got == expected(rows)


def test_changed_payload_is_noticed(spark, rows, tmp_path):
    path, *_ = warc.write_archive(str(tmp_path), [warc._record("response", 1, "u", b"abc", None).replace(b"abc", b"abd")])
    manifest = spark.createDataFrame([(path,)], "path string")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(manifest).collect()


def test_empty_and_extra_columns(spark, tmp_path):
    none = spark.createDataFrame([], PAGES)
    assert warc.archive_pages(none, str(tmp_path)).count() == 0
    extra = spark.createDataFrame([(1, "u", "x", "p", 5)], PAGES + ", payload string, refers_to long")
    assert warc.archive_pages(extra, str(tmp_path / "b")).first().payload_bytes == 1
