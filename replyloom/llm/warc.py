"""WARC archives whose records are compressed one by one with a shared dictionary.

An archive is a leading skippable frame that holds a Zstandard dictionary, built
from the archive's own records, then one Zstandard frame per record.  Any record
can be read alone, and small records still compress well.  Payloads that occur
again are written as revisit records, without the payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import Stored, new_folder, store

#: Frame id of the dictionary frame in compressed WARC files.
DICTIONARY_FRAME = 0x184D2A5D
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
#: Of an archive's records, so many bytes teach the dictionary, spread evenly over them.
TRAINING_BYTES = 4 << 20
LEVEL = 3
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None, salt: str) -> str:
    return f"<urn:page:{page}>" if page is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, salt)}>"


def _one_line(value: str) -> str:
    """A URL that cannot end its header line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def warc_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record if the payload is that of another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page, (url or '') + payload_digest(payload))}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to, '')}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + _END + block + _END


def parse_record(raw: bytes) -> dict:
    """What ``warc_record`` wrote; the digest of a response is computed from its payload."""
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != _END:
        raise ValueError("A record does not end where its length says.")
    http, _, payload = block.partition(_END)
    kind = fields["WARC-Type"]
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("A payload does not match its digest.")
    page = lambda name: int(x.removeprefix("<urn:page:")[:-1]) if (x := fields.get(name, "")).startswith("<urn:page:") else None
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A trained dictionary; plain content where there is too little to train on."""
    total = sum(map(len, records))
    step = max(1, -(-total // TRAINING_BYTES))
    samples = records[::step]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, total // 8)), samples, k=256, d=8)
    except zstandard.ZstdError:
        content = b"".join(x[:4096] for x in samples[-16:])
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None


def archive(records: list[bytes]) -> bytes:
    """The bytes of one archive: dictionary frame, then a frame per record."""
    trained = build_dictionary(records)
    packed = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes()) if trained else b""
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(packed)), packed, *map(writer.compress, records)])


def records_of(raw: bytes) -> Iterator[bytes]:
    """The records of an archive, one after the other."""
    magic, size = struct.unpack_from("<II", raw)
    if magic != DICTIONARY_FRAME:
        raise ValueError("An archive begins with its dictionary.")
    content = zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]) if size else b""
    # A trained dictionary says what it is; other content is used as it stands.
    trained = zstandard.ZstdCompressionDict(content) if content else None
    reader = zstandard.ZstdDecompressor(dict_data=trained)
    rest = memoryview(raw)[8 + size :]
    while len(rest):
        one = reader.decompressobj()
        yield one.decompress(rest)
        rest = rest[len(rest) - len(one.unused_data) :] if one.unused_data else rest[len(rest) :]


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _save(folder: str, name: str, raw: bytes) -> None:
    """Write under another name, then move: whatever bears an archive's name is whole."""
    files, root = _filesystem(folder)
    draft = f"{root}/.{name}.draft"
    with files.open_output_stream(draft, compression=None) as out:
        out.write(raw)
    files.move(draft, f"{root}/{name}")


def _load(folder: str, name: str) -> bytes:
    files, root = _filesystem(folder)
    with files.open_input_stream(f"{root}/{name}", compression=None) as f:
        return f.read()


def first_pages(pages: DataFrame, key: str, html: str, least: int = MIN_REVISIT_BYTES) -> Stored:
    """(payload_key, first) of the payloads that several rows share: one row per payload."""
    payload = F.coalesce(F.col(html), F.lit(""))
    found = (
        pages.filter(F.octet_length(payload) >= least)
        .groupBy(F.sha2(payload, 256).alias("payload_key"))
        .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return store(found.select("payload_key", "first"), "payloads")


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES
) -> Stored:
    """Write every row as a record and return the archives written: (name, n_records).

    Of rows with equal payloads the one with the smallest key is a response, the
    others revisit it; rows that share both key and payload are all alike.  A
    null payload is empty; a row with a null key revisits too, but is revisited
    only by none.  Names hold the task, a mark of its attempt and a running number: a
    second attempt, whose rows may come in another order, touches no archive of
    the first, and only the archives of the attempt that Spark accepts are
    returned.  Those of other attempts stay in ``folder`` and are never read;
    an empty table writes none.  ``folder`` must be
    reachable by every executor.  A task holds one archive, which closes at
    ``archive_bytes`` or with a single longer record.
    """
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    shared = first_pages(pages, key, html)
    rows = pages.select(
        F.col(key).cast("long").alias("page"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
        F.sha2(F.coalesce(F.col(html), F.lit("")), 256).alias("payload_key"),
    )
    marked = rows.join(shared.rows, "payload_key", "left").select(
        F.spark_partition_id().alias("part"),
        "page",
        "url",
        "payload",
        F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes, waiting, held, part = [], [], [], 0, None
        attempt = uuid.uuid4().hex

        def close() -> None:
            name = f"pages-{part:06d}-{attempt}-{len(names):05d}.warc.zst"
            _save(folder, name, archive(waiting))
            names.append(name)
            sizes.append(len(waiting))
            waiting.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                record = warc_record(*(batch.column(c)[i].as_py() for c in ("page", "url", "payload", "refers_to")))
                waiting.append(record)
                held += len(record)
                if held >= archive_bytes:
                    close()
                    held = 0
        if waiting:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["name", "n_records"])

    written = store(marked.mapInArrow(write, "name string, n_records long"), "archives")
    shared.drop()
    return written


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    ``archives`` is what ``write_archives`` returned; archives are dealt out
    evenly.  Every response is checked against its digest, and every archive
    against its ``n_records``: one that holds more or fewer ends the job.  ``payload`` is null for revisits,
    and for all if ``payloads`` is off.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n_records in zip(batch.column("name").to_pylist(), batch.column("n_records").to_pylist()):
                rows, held, n = [], 0, 0
                for raw in records_of(_load(folder, name)):
                    row = parse_record(raw)
                    rows.append(row if payloads else row | {"payload": None})
                    held += len(raw)
                    n += 1
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if n != n_records:
                    raise ValueError(f"{name} holds {n} records instead of {n_records}.")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    wide = archives.sparkSession.sparkContext.defaultParallelism
    names = archives.select("name", "n_records").repartition(4 * wide)
    return names.mapInArrow(
        load,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def warc_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back; see ``write_archives``."""
    folder = new_folder(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, key, url, html)
    return read_archives(archives.rows, folder, payloads=False).drop("payload")
