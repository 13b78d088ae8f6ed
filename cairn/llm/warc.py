"""WARC archives in Zstandard: one frame per record, dictionary in a leading skippable frame.

The writer gives each page one record. Pages with equal payloads of at least
``least_bytes`` are found by a grouped digest; the one with the largest page_id
is a response, the others revisit it. A task writes archives of bounded size
under names that follow from its partition and moves them into place when
complete, so a task that runs again replaces its own files and leaves no other.

The reader loads the dictionary from the first frame if that is skippable,
decodes one frame for each record and checks the version line, the required
fields, the block's length, the record's end, and a response's payload digest.
A record that fails has its ``error`` set, or ends the job if ``strict``.

Defined results: a null html counts as an empty payload, which is always a
response; a null url leaves its field out; a null page_id is written as a record
without that id and is never the record that others refer to unless all of a
group are null; pages repeated with the same id and payload are all responses or
all revisits; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import session_of, shared_dir

#: Of the skippable frame that holds a dictionary, and of a bare dictionary. Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
BARE_DICTIONARY = 0xEC30A437
#: Payload bytes after which an archive is closed.
ARCHIVE_BYTES = 8 << 20
#: A dictionary is trained on so many bytes from the start of its archive's records.
SAMPLE_BYTES = 512 << 10
LEVEL = 3
_END = b"\r\n\r\n"
_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, error string"


def plan_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload and its digest, record_type and refers_to of each page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumns(
        {"payload_digest": F.sha1("payload"), "same": F.sha2("payload", 256)})
    first = (
        own.where(F.octet_length("payload") >= least_bytes)
        .groupBy("same").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
        .hint("rebalance")  # so that the join's exchanges are its own and a hot payload can be split
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return own.join(first, "same", "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page-{page_id}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """A whole record: fields, block and end."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]|^{}<>\"`\\")))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
        block = head + b"\r\n"
    else:
        block = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + _END


def build_archive(records: list[bytes]) -> bytes:
    """Frames of the records after the dictionary's frame; no dictionary if there is too little to train on."""
    samples, size = [], 0
    for record in records:
        samples.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    parts, dictionary = [], None
    if len(samples) >= 16:
        try:
            dictionary = zstandard.train_dictionary(16 << 10, samples)
        except zstandard.ZstdError:
            dictionary = None
    if dictionary:
        body = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        parts.append(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    parts += [pack.compress(record) for record in records]
    return b"".join(parts)


def split_archive(data: bytes) -> Iterator[bytes]:
    """The decoded content of each frame."""
    at, dictionary = 0, None
    if len(data) >= 8 and (head := struct.unpack_from("<II", data))[0] == DICTIONARY_FRAME:
        at = 8 + head[1]
        if at > len(data):
            raise ValueError("the dictionary's frame is cut short")
        body = data[8:at]
        if struct.unpack_from("<I", body)[0] != BARE_DICTIONARY:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
    unpack, view, step = zstandard.ZstdDecompressor(dict_data=dictionary), memoryview(data), 16 << 10
    while at < len(data):
        frame, out = unpack.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut short")
            out.append(frame.decompress(view[at : at + step]))
            at = min(len(data), at + step) - len(frame.unused_data)
        yield b"".join(out)


def parse_record(raw: bytes) -> tuple:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) or ValueError."""
    head, gap, rest = raw.partition(_END)
    version, *lines = head.decode("utf-8").split("\r\n")
    if not gap or version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line or no end of the fields")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"not a field: {line[:80]}")
        if fields.setdefault(name.strip().lower(), value.strip()) != value.strip():
            raise ValueError(f"two values of {name}")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isascii() or not fields["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    length, kind = int(fields["content-length"]), fields["warc-type"]
    if len(rest) != length + len(_END) or rest[length:] != _END:
        raise ValueError(f"the block is not {length} bytes long")
    if kind not in ("response", "revisit"):
        raise ValueError(f"record of type {kind}")
    http, gap, payload = rest[:length].partition(_END)
    if not gap or not http.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP response")
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1" or len(digest) != 40:
        raise ValueError("no sha1 payload digest")
    size = int(fields.get("x-payload-length", len(payload)))
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload does not match its length and digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit with a payload or without the record it refers to")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("x-page-id"), fields.get("warc-target-uri"), payload if kind == "response" else None, size, digest, kind, number("x-refers-to-page-id")


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records of ``plan_records`` as ``*.warc.zst`` into a shared folder."""
    session_of(records)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _file_system(folder)
        store.create_dir(path, recursive=True)
        part, names, held, size = TaskContext.get(), [], [], 0

        def close() -> None:
            final = f"{path}/part-{part.partitionId():06d}-{len(names):06d}.warc.zst"
            with store.open_output_stream(draft := f"{final}.{part.taskAttemptId()}.draft") as out:
                out.write(build_archive(held))
            if store.get_file_info(final).is_file:
                store.delete_file(final)
            store.move(draft, final)
            names.append(final)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(build_record(*row))
                size += len(held[-1])
                if size >= archive_bytes:
                    close()
                    size = 0
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], names=["archives"])

    ordered = records.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to").sortWithinPartitions("page_id", "payload_digest")
    ordered.mapInArrow(write, "archives long").write.format("noop").mode("overwrite").save()


def read_archives(spark: SparkSession, folder: str, strict: bool = False, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in a folder; ``payloads=False`` leaves the payload column null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows: list[tuple] = []
                try:
                    for raw in split_archive(data.as_buffer().to_pybytes()):
                        try:
                            row = (*parse_record(raw), None)
                        except ValueError as why:
                            row = (*[None] * 7, str(why))
                        rows.append(row if payloads else (*row[:2], None, *row[3:]))
                except (ValueError, zstandard.ZstdError) as why:
                    rows.append((*[None] * 7, str(why)))
                if strict and (bad := [r[-1] for r in rows if r[-1]]):
                    raise ValueError(f"{path}: {bad[0]}")
                for begin in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows[begin : begin + 500], strict=True), kinds, strict=True)], schema=kinds)

    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("error", pa.string())])
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    session_of(files)
    return files.select("path", "content").mapInArrow(read, _SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record for each page, read the archives back; one row per record."""
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    _file_system(folder)[0].create_dir(_file_system(folder)[1], recursive=True)
    write_archives(plan_records(pages), folder)
    return read_archives(spark, folder, strict=True, payloads=False)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
     f AS (SELECT h, max(page_id) AS first_id FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h
"""

QUERIES = {"op2_warc": op2_warc}
ORACLES = {"op2_warc": OP2_SQL}
