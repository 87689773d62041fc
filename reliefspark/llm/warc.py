"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

A file begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary; each
record follows as a frame of its own, so any record can be read by its offset and any
reader that knows the dictionary frame can read the file.  The dictionary is trained on a
bounded sample of the records to be archived.  Equal payloads of a least length are stored
once: the others are revisit records that name it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, open_filesystem, read_tasks, store, workspace

DICTIONARY_MAGIC = 0x184D2A5D
#: Records, and bytes of one record, that the dictionary is trained on, at most; its size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 65_536
#: Uncompressed bytes of one file, about.
FILE_BYTES = 128 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decide(pages: DataFrame, least: int, at: str) -> DataFrame:
    """pages (page_id, url, html) with payload_bytes, payload_digest and refers_to; a revisit's html is null.

    Of equal payloads of `least` bytes or more, each row with the largest page_id is the response, repeated ones too,
    and rows of null page_id revisit it; with null ids alone all are responses. A null html is the empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    # Few rows, and as a written table they join by a plain exchange that Spark can split if one payload is everywhere.
    kept = rows.filter(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1 AND keeper IS NOT NULL").drop("n")
    joined = rows.join(store(kept, at, "kept"), ["payload_digest", "payload_bytes"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "payload_bytes", "payload_digest", refers.alias("refers_to"))


def _identifier(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _line(value: str | None) -> str:
    """A header value on one line, other characters percent-encoded."""
    return "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in value or "")


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_identifier(page_id, digest)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_identifier(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary, or the records' own content where there is too little to train on."""
    import zstandard as z

    if sum(map(len, records)) >= 20 * DICTIONARY_BYTES and len(records) >= 16:
        try:
            return z.train_dictionary(DICTIONARY_BYTES, records, k=256, d=8, level=LEVEL).as_bytes()
        except z.ZstdError:
            pass
    return b"".join(records)[-DICTIONARY_BYTES:]


def _sample(rows: DataFrame) -> list[bytes]:
    ids = rows.filter("refers_to IS NULL AND page_id IS NOT NULL").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_RECORDS)
    # At most SAMPLE_RECORDS ids are broadcast and as many payloads of at most SAMPLE_BYTES come to the driver.
    some = rows.filter(F.col("payload").isNotNull() & (F.col("payload_bytes") <= SAMPLE_BYTES)).join(F.broadcast(ids.distinct()), "page_id").orderBy("page_id", "payload_digest").limit(SAMPLE_RECORDS).collect()
    return [record(r["page_id"], r["url"], bytes(r["payload"]), r["payload_bytes"], r["payload_digest"], None) for r in some]


def write_archives(rows: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Archives of rows (as of decide()) below `folder`; returns (uri, records, bytes) of those of committed tasks."""
    shared = rows.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        d = z.ZstdCompressionDict(shared.value) if shared.value else None
        if d is not None:
            d.precompute_compress(level=LEVEL)
        tool = z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=True)
        context = TaskContext.get()
        stem = f"{folder}/archives/{context.partitionId():06d}-{context.taskAttemptId()}"
        made: list[dict] = []
        out, written, n, held = None, 0, 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    uri = f"{stem}-{len(made):04d}.warc.zst"
                    fs, path = open_filesystem(uri)
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                    first = struct.pack("<II", DICTIONARY_MAGIC, len(shared.value)) + shared.value if d is not None else b""
                    out.write(first)
                    written, n, held = len(first), 0, 0
                data = record(r["page_id"], r["url"], r["payload"], r["payload_bytes"], r["payload_digest"], r["refers_to"])
                frame = tool.compress(data)
                out.write(frame)
                written, n, held = written + len(frame), n + 1, held + len(data)
                if held >= FILE_BYTES:
                    out.close()
                    made.append({"uri": uri, "records": n, "bytes": written})
                    out = None
        if out is not None:
            out.close()
            made.append({"uri": uri, "records": n, "bytes": written})
        yield pa.RecordBatch.from_pylist(made, pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return store(rows.mapInArrow(frugal(run), "uri string, records long, bytes long"), folder, "archives-written")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open archive, frame by frame."""
    import zstandard as z

    start = stream.read(8)
    d = None
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == DICTIONARY_MAGIC:
        d = z.ZstdCompressionDict(stream.read(struct.unpack("<I", start[4:])[0]))
    else:
        stream.seek(0)
    with z.ZstdDecompressor(dict_data=d).stream_reader(stream, read_across_frames=True, read_size=1 << 20) as plain:
        held = b""

        def upto(n: int) -> None:
            nonlocal held
            parts, size = [held], len(held)
            while size < n and (more := plain.read(max(1 << 16, n - size))):
                parts.append(more)
                size += len(more)
            held = b"".join(parts)

        while True:
            upto(1 << 16)
            if not held:
                return
            end = held.find(b"\r\n\r\n")
            while end < 0:
                before = len(held)
                upto(2 * before)
                if len(held) == before:
                    raise ValueError("a record's header has no end")
                end = held.find(b"\r\n\r\n")
            lines = held[:end].decode("utf-8").split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError("not a WARC record")
            headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            size = int(headers["Content-Length"])
            upto(end + 8 + size)
            yield headers, held[end + 4 : end + 4 + size]
            held = held[end + 8 + size :]


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of all records.

    A response's size and digest are those of the payload that is there, and must equal its header's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        keep = 6 + with_payload
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                fs, path = open_filesystem(uri)
                rows, size = [], 0
                with fs.open_input_file(path) as stream:
                    for headers, block in read_records(stream):
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        n = int(http.rsplit(b"Content-Length: ", 1)[1])
                        response = headers["WARC-Type"] == "response"
                        if response and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"{uri}: a payload differs from its digest")
                        page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                        rows.append((page and int(page), headers["WARC-Target-URI"], n, digest, headers["WARC-Type"], refers and int(refers), payload if response else None)[:keep])
                        size += len(payload) * with_payload + 100
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names[:keep])
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names[:keep])

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    return files.select("uri").repartition(read_tasks(files), "uri").mapInArrow(frugal(run), schema)


def archive(pages: DataFrame, least: int = 1000) -> DataFrame:
    """pages (page_id, url, html, ...) written to archives in the shared folder; their (uri, records, bytes)."""
    at = workspace(pages.sparkSession, "warc")
    rows = decide(pages, least, at)
    return write_archives(rows, at, build_dictionary(_sample(rows)))
