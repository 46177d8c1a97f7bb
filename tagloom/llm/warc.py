"""WARC archives of pages: written as one gzip stream per file, normalised to one gzip member
per record with a sidecar offset index, and read back record by record.

Archive files are in the shared folder. Their names hold the attempt of the task that wrote
them, and only files named in a manifest, itself a written table, are ever read; what a lost
executor left behind is never looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SLICE_ROWS, arrow_schema, small_batches
from tagloom.session import materialise, scratch_path, small_side

# Payloads shorter than this are never stored as a reference to another record.
LEAST_SHARED = 100

# Digests of repeated payloads that are sent to every executor; with more they are joined.
MOST_SENT = 200_000

LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 20

MANIFEST = "path string, n_records long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def with_references(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which pages only refer to an equal payload.

    Of equal payloads of at least ``LEAST_SHARED`` bytes the one with the smallest page_id
    is stored; rows that repeat that page_id are stored as well, and so are all if none has
    a page_id. A null html is empty.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = rows.filter(F.octet_length("html") >= LEAST_SHARED).select("digest", "page_id")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = materialise(firsts.filter("n > 1 AND first IS NOT NULL").drop("n"), "firsts")
    joined = rows.join(small_side(firsts, MOST_SENT), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _value(text: str) -> str:
    """``text`` as a header value: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text)


def _unvalue(text: str) -> str:
    return re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), text)


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to) -> bytes:
    """One WARC record: the page, or a reference to the page with the same payload."""
    payload = html.encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if url is not None:
        head["WARC-Target-URI"] = _value(url)
    if refers_to is not None:
        head |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": record_id(refers_to, digest),
            "X-Refers-To-Page-ID": str(refers_to),
        }
    block = http + (payload if refers_to is None else b"")
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Page, payload and references of one record; checks the payload against its digest."""
    top, _, block = data.partition(b"\r\n\r\n")
    lines = top.decode().split("\r\n")[1:]
    head = dict(line.split(": ", 1) for line in lines)
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    url = head.get("WARC-Target-URI")
    out = {
        "page_id": int(head["X-Page-ID"]) if "X-Page-ID" in head else None,
        "url": None if url is None else _unvalue(url),
        "payload_bytes": int(head["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": int(head["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in head else None,
        "payload": None,
    }
    if out["record_type"] == "response":
        content = block[: int(head["Content-Length"])]
        out["payload"] = payload = content.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {head['WARC-Record-ID']} does not match its digest")
    return out


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _task_file(folder: str) -> str:
    context = TaskContext.get()
    return f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex}"


def _per_task(df: DataFrame, schema: str, run: Callable) -> DataFrame:
    small_batches(df.sparkSession)
    arrow = arrow_schema(schema)

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in run(batches):
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return df.mapInArrow(call, schema)


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives of one gzip stream, a file per task; the manifest."""
    folder = scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out, n = None, 0
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS).to_pydict()
                if out is None:
                    path = _task_file(folder) + ".warc.gz"
                    store, name = _open(path)
                    store.create_dir(name.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(name, compression=None)
                    packer = zlib.compressobj(LEVEL, wbits=31)
                for row in zip(*part.values()):
                    out.write(packer.compress(record(*row)))
                    n += 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield {"path": path, "n_records": n}

    rows = with_references(pages).select("page_id", "url", "html", "digest", "refers_to")
    return materialise(_per_task(rows, MANIFEST, run), "archives")


def records_of(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The records of a gzip stream of any number of members, inflated once and in order; at
    most one record and a block are held at a time."""
    inflater, waiting, raw = zlib.decompressobj(wbits=31), bytearray(), b""
    while True:
        raw = raw or read(READ)
        if not raw:
            break
        waiting += inflater.decompress(raw, READ)
        raw = inflater.unconsumed_tail
        if inflater.eof:
            raw, inflater = inflater.unused_data, zlib.decompressobj(wbits=31)
        while (size := _complete(waiting)) is not None:
            yield bytes(waiting[:size])
            del waiting[:size]
    if waiting.strip():
        raise ValueError("the archive ends within a record")


def _complete(data: bytearray) -> int | None:
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    length = re.search(rb"\r\nContent-Length: (\d+)", data[:end])
    size = end + 4 + int(length[1]) + 4
    return size if size <= len(data) else None


def normalise(manifest: DataFrame) -> DataFrame:
    """Rewrites archives of any members as one gzip member per record, each next to a file
    ``.idx`` of lines ``offset length``; the new manifest. One task handles a file, inflating
    it once as a stream."""
    folder = scratch_path(manifest.sparkSession, "normalised")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                path = _task_file(folder) + ".warc.gz"
                store, name = _open(path)
                store.create_dir(name.rpartition("/")[0], recursive=True)
                old, old_name = _open(source)
                offset, n = 0, 0
                with (
                    old.open_input_stream(old_name, compression=None) as archive,
                    store.open_output_stream(name, compression=None) as out,
                    store.open_output_stream(f"{name}.idx", compression=None) as index,
                ):
                    for data in records_of(archive.read):
                        packer = zlib.compressobj(LEVEL, wbits=31)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        index.write(b"%d %d\n" % (offset, len(member)))
                        offset += len(member)
                        n += 1
                yield {"path": path, "n_records": n}

    files = max(1, manifest.count())
    spread = manifest.select("path").repartition(files)
    return materialise(_per_task(spread, MANIFEST, run), "normalised")


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of normalised archives, each read by its place in the sidecar index."""
    small_batches(manifest.sparkSession)
    schema = arrow_schema(RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = _open(path)
                with store.open_input_stream(f"{name}.idx", compression=None) as lines:
                    index = [tuple(map(int, x.split())) for x in lines.read().splitlines()]
                with store.open_input_file(name) as archive:
                    for start in range(0, len(index), SLICE_ROWS):
                        members = []
                        for offset, length in index[start : start + SLICE_ROWS]:
                            archive.seek(offset)
                            members.append(parsed(zlib.decompress(archive.read(length), wbits=31)))
                        yield pa.RecordBatch.from_pylist(members, schema=schema)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes, normalises and reads back all pages: one row per page.

    Repeated rows are archived each; null URLs have no target header; an empty table gives
    an empty one. Other columns of ``pages`` are ignored.
    """
    return read_archives(normalise(write_archives(pages.select("page_id", "url", "html"))))
