"""WARC archives: one gzip member per record, written and read sequentially.

Writing: of pages with equal payloads (same SHA-1 and length) the one with the
largest id becomes a response record, the others revisit records that refer to
it.  Each task rolls its records over into files of about ``ROLL`` compressed
bytes in a folder that all executors share.  A file is complete when its task
reports it; files that a lost or repeated attempt left behind are in no
manifest and are never read.

Reading: a file is streamed in pieces through an incremental zlib decompressor.
Each member is one record: the header block up to the empty line, then exactly
Content-Length bytes, then two line ends, then the end of the member.  Block and
payload digests are verified; a broken frame or digest ends the job.

Nulls and edge cases: null html is an empty payload; a null page_id is written
as ``none`` and read back as null, such a page is never referred to unless all
equal pages lack an id; repeated rows with the largest id are all responses; a
null url is left out, line breaks in one are percent-encoded.  An empty table
writes no file.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut, ship, tidy
from kestrel.session import checkpoint_dir

ROLL = 32 << 20
PIECE = 1 << 16
MAX_HEADER = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    value = (name or "<urn:page:none>")[10:-1]
    return None if value == "none" else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member; a revisit has the HTTP header and no payload."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode("utf-8", "replace") + block + b"\r\n\r\n") + z.flush()


def members(pieces: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The decompressed pieces of each gzip member of a stream."""
    rest = b""

    def refill() -> bool:
        nonlocal rest
        while not rest:
            got = next(pieces, None)
            if got is None:
                return False
            rest = got
        return True

    def one() -> Iterator[bytes]:
        nonlocal rest
        z = zlib.decompressobj(31)
        while not z.eof:
            if not rest and not refill():
                raise ValueError("archive ends inside a gzip member")
            data = z.decompress(rest, PIECE)
            rest = z.unused_data if z.eof else z.unconsumed_tail
            if data:
                yield data

    while refill():
        yield one()


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block of one member."""
    buffer = bytearray()
    while (end := buffer.find(b"\r\n\r\n")) < 0:
        got = next(pieces, None)
        if got is None or len(buffer) > MAX_HEADER:
            raise ValueError("record without a complete header")
        buffer += got
    lines = bytes(buffer[:end]).decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC version line: {lines[0][:40]!r}")
    head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    size = int(head["content-length"])
    body = buffer[end + 4:]
    for got in pieces:
        body += got
        if len(body) > size + 4:
            break
    if bytes(body[size:]) != b"\r\n\r\n":
        raise ValueError("Content-Length does not frame the record")
    block = bytes(body[:size])
    if head.get("warc-block-digest") not in (None, "sha1:" + digest(block)):
        raise ValueError(f"block digest differs: {head.get('warc-record-id')}")
    return head, block


def parse(head: dict[str, str], block: bytes) -> dict:
    """A record as a row; the payload digest of a response is verified."""
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (
        x.partition(":") for x in http.decode("utf-8", "replace").split("\r\n")[1:])}
    kind, stated = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (digest(payload) != stated or len(payload) != int(fields["content-length"])):
        raise ValueError(f"payload digest or length differs: {head['warc-record-id']}")
    return {"page_id": _page(head["warc-record-id"]), "payload_bytes": int(fields["content-length"]),
            "payload_digest": stated, "record_type": kind,
            "refers_to": _page(head["warc-refers-to"]) if kind == "revisit" else None,
            "url": head.get("warc-target-uri"), "payload": payload if kind == "response" else None}


def plan_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): who is written in full; payloads under ``least`` bytes always are."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("_d", F.sha1(F.col("html").cast("binary"))).withColumn("_n", F.octet_length("html"))
    first = p.groupBy("_d", "_n").agg(F.max("page_id").alias("_first"))
    revisit = (F.col("_n") >= least) & (F.col("_first") != F.coalesce("page_id", F.col("_first") - 1))
    return p.join(first, ["_d", "_n"]).select("page_id", "url", "html", F.when(revisit, F.col("_first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Write records; returns the manifest (path, records, bytes), kept in the checkpoint folder."""
    ship(records.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        out, name, n, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                                              names=["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "refers_to"))):
                if out is None:
                    store.create_dir(path, recursive=True)
                    name = f"{path}/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = store.open_output_stream(name, compression=None), 0, 0
                data = record(page_id, url, html.encode("utf-8", "replace"), refers_to, date)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ROLL:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return cut(records.mapInArrow(run, "path string, records long, bytes long"))


def read_archives(manifest: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Records of all files of a manifest, verified."""
    ship(manifest.sparkSession)
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())] + (
        [("payload", pa.binary())] if payload else [])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_folder(folder)

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in fields],
                                              names=[k for k, _ in fields])

        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows, n, held = [], 0, 0
                with store.open_input_stream(path, compression=None) as f:
                    for member in members(iter(lambda: f.read(PIECE) or None, None)):
                        rows.append(parse(*read_record(member)))
                        n, held = n + 1, held + len(rows[-1]["payload"] or b"")
                        if len(rows) >= 2000 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if n != expected:
                    raise ValueError(f"{path} holds {n} records, the manifest says {expected}")
                yield batch_of(rows)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    files = manifest.select("path", "records").repartition(max(1, min(manifest.count(), 100_000)), "path")
    return files.mapInArrow(run, ", ".join(f"{k} {kinds[t]}" for k, t in fields))


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write all pages as archives and read the archives back."""
    folder = folder or f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(plan_records(pages, least), folder), folder)
