"""WARC archives compressed with a Zstandard dictionary.

Each archive starts with a skippable frame that holds a dictionary trained on
the archive's own records; every record follows as a frame of its own,
compressed with that dictionary. A record can so be read alone, given the
frame at the archive's start.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featpipe.llm.common import batches_by_size, written
from featpipe.session import scratch_path

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: Bytes of records a dictionary is trained on at most: records evenly spaced over the archive.
TRAIN_BYTES = 100 * DICTIONARY_BYTES
#: Record bytes of an archive before the next one is begun.
ARCHIVE_BYTES = 24 << 20
#: Archive bytes a reading task is given, when there are more archives than cores.
READ_BYTES = 256 << 20
LEVEL = 3
#: Payloads shorter than this are never written as revisits.
MIN_REVISIT_BYTES = 0

MANIFEST = "path string, records long, bytes long, dictionary_bytes long"
READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary, archive string, position long")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of pages with equal payloads of
    ``min_bytes`` or more the one with the smallest id is the response, and the
    others refer to it.

    Ids and digests are aggregated without the payloads; only groups of two or
    more come back to the pages, so the join is on a digest that AQE may split.
    A null id is larger than any other and is never referred to while another
    id is there. Rows that repeat the response's id and payload are responses
    too."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    digest = F.concat(F.sha1(payload), F.lit("-"), F.xxhash64(payload).cast("string"))
    rows = pages.select("page_id", "url", payload.alias("payload"), digest.alias("_key"))
    groups = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("_key")
              .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1 and _first is not null").select("_key", "_first"))
    refers = F.when(F.coalesce(F.col("page_id") != F.col("_first"), F.col("_first").isNotNull()), F.col("_first"))
    return (rows.join(groups, "_key", "left")
            .select("page_id", "url", "payload", refers.cast("long").alias("refers_to")))


def _record(kind: str, page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit carries no payload but its digest and length."""
    digest = payload_digest(payload)
    name = lambda page: f"<urn:page:{'' if page is None else page}>"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c >= " "))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES):
    """Dictionary from evenly spaced records; None when they are too few or too alike to train on."""
    import zstandard
    total = sum(map(len, records))
    every = max(1, -(-total // TRAIN_BYTES))
    sample = [r[:TRAIN_BYTES // 8] for r in records[::every]]
    if len(sample) < 8:
        return None
    size = min(size, max(1024, sum(map(len, sample)) // 10))
    try:
        # fixed segment and context lengths: no search over parameters
        return zstandard.train_dictionary(size, sample, k=256, d=8, steps=1, level=LEVEL)
    except zstandard.ZstdError:
        return None


def _filesystem(folder: str):
    """(filesystem, path) of a folder named by a Hadoop-style URI or a plain path."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def write_archive(folder: str, records: list[bytes]) -> tuple[str, int, int, int]:
    """Write one archive under a name of its own; (path, records, bytes, dictionary bytes)."""
    import zstandard
    dictionary = train_dictionary(records)
    raw = dictionary.as_bytes() if dictionary else b""
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
    n = 0
    with store.open_output_stream(path, compression=None) as out:  # the name would make it wrap the frames in another
        if raw:
            n += out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
        for record in records:
            n += out.write(packer.compress(record))
    return f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}", len(records), n, len(raw)


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the marked pages as archives in ``folder``; the manifest, one row per archive.

    Every attempt of a task writes files of its own; only those of the attempts
    that succeeded are in the manifest, which is itself written as a table. A
    task holds the records of one archive at a time."""
    def run(batches):
        import pyarrow as pa
        records, size, done = [], 0, []
        for batch in batches:
            for part in batches_by_size(batch, 2, archive_bytes // 4):
                for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    kind = "response" if refers_to is None else "revisit"
                    records.append(_record(kind, page_id, url, payload, refers_to))
                    size += len(records[-1])
                    if size >= archive_bytes:
                        done.append(write_archive(folder, records))
                        records, size = [], 0
        if records:
            done.append(write_archive(folder, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)],
                                             [x.split()[0] for x in MANIFEST.split(", ")])

    return written(marked.select("page_id", "url", "payload", "refers_to").mapInArrow(run, MANIFEST), "warc-manifest")


def read_archive(path: str):
    """Records of an archive: (headers, payload, offset) one after another."""
    import zstandard
    store, at = _filesystem(path)
    with store.open_input_stream(at, compression=None) as f:
        held, position, dictionary = b"", 0, None
        head = f.read(8)
        if len(head) == 8 and int.from_bytes(head[:4], "little") == DICTIONARY_MAGIC:
            size = int.from_bytes(head[4:], "little")
            dictionary = zstandard.ZstdCompressionDict(f.read(size))
            position = 8 + size
        else:
            held = head
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
        while held or (held := f.read(1 << 16)):
            frame, record, used = unpacker.decompressobj(), [], 0
            while not frame.eof:
                record.append(frame.decompress(held))
                used += len(held) - len(frame.unused_data)
                held = frame.unused_data if frame.eof else f.read(1 << 16)
                if not held and not frame.eof:
                    raise ValueError(f"{path}: the archive ends inside a record")
            head, _, body = b"".join(record).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"{path}: no record at {position}")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            yield headers, body[:int(headers["Content-Length"])], position
            position += used


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives in a manifest. The digest of a response's
    payload is computed anew and held against its header."""
    def page(name: str):
        number = name[len("<urn:page:"):-1]
        return int(number) if number else None

    def run(batches):
        import pyarrow as pa
        names = [x.split()[0] for x in READ.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[x.split()[1]] for x in READ.split(", ")]
        rows, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                for headers, payload, position in read_archive(path):
                    kind = headers["WARC-Type"]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(headers["X-Payload-Length"])
                    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
                        raise ValueError(f"{path}: the payload at {position} does not match its digest")
                    refers = page(headers["WARC-Refers-To"]) if kind == "revisit" else None
                    rows.append((page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), length, digest, kind,
                                 refers, payload, path, position))
                    size += len(payload)
                    if size > 4 << 20 or len(rows) >= 10_000:
                        yield flush()
                        rows, size = [], 0
        if rows:
            yield flush()

    width = F.col("bytes") if "bytes" in manifest.columns else F.lit(READ_BYTES)  # of unknown size: one to a task
    n, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    tasks = max(1, min(n, manifest.sparkSession.sparkContext.defaultParallelism), -(-size // READ_BYTES))
    return manifest.select("path").repartition(tasks).mapInArrow(run, READ)


def read_record(path: str, position: int):
    """(headers, payload) of the record at ``position``: only the dictionary frame and that record are read."""
    import zstandard
    store, at = _filesystem(path)
    with store.open_input_file(at) as f:
        head = f.read(8)
        magic, size = int.from_bytes(head[:4], "little"), int.from_bytes(head[4:], "little")
        dictionary = zstandard.ZstdCompressionDict(f.read(size)) if magic == DICTIONARY_MAGIC else None
        f.seek(position)
        frame, record = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), []
        while not frame.eof:
            held = f.read(1 << 16)
            if not held:
                raise ValueError(f"{path}: the archive ends inside a record")
            record.append(frame.decompress(held))
    head, _, body = b"".join(record).partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return headers, body[:int(headers["Content-Length"])]


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write every page as a WARC record and read the archives back.

    A null html is an empty payload; null urls have no target header (control
    characters in a url are left out of its header); an empty table writes no
    archive and gives an empty result."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(mark_revisits(pages, min_bytes), folder))


ORACLE = r"""
with p as (select page_id, coalesce(encode(html), ''::blob) as payload from pages),
d as (select page_id, octet_length(payload) as payload_bytes, payload, unhex(sha1(payload))::bit::varchar as bits from p),
f as (select *, min(page_id) over (partition by payload) as first_id, count(*) over (partition by payload) as n from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + cast(list_sum(list_transform(range(5), lambda j: (1 << (4 - j)) * cast(substr(bits, cast(i * 5 + j + 1 as bigint), 1) as integer))) as bigint), 1)), '')
         as payload_digest,
       case when n > 1 and first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
       case when n > 1 and first_id is not null and page_id is distinct from first_id then first_id end as refers_to
from f
"""
