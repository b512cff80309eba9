"""WARC archives: one gzip member per record, written by the tasks that hold the pages and
read back sequentially, with incremental decompression, content-length framing and a check
of every digest.

Archives lie in the shared scratch folder, or in any store that pyarrow opens by its address.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

#: Payloads of fewer bytes are never written as revisits (fixed value).
REVISIT_LEAST = 1000
#: Bytes after which a task begins a new file, and which a reader takes at once.
FILE_BYTES, CHUNK = 64 << 20, 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "path string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def opened(path: str):
    """(file system, path in it) of a plain path or an address."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One record as a gzip member."""
    sha = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(sha.digest()).decode()
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {i} {digest}')}>"
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": date,
            "WARC-Target-URI": None if url is None else "".join(url.split()), "WARC-Payload-Digest": f"sha1:{digest}",
            "WARC-Block-Digest": f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
            "WARC-Profile": None if refers_to is None else PROFILE, "WARC-Refers-To": None if refers_to is None else name(refers_to),
            "Page-ID": page_id, "Refers-To-Page-ID": refers_to,
            "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _write(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0

        def listed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        # each attempt of a task has file names of its own, and only those of the attempt that Spark counts are listed
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = record(page_id, url, (html or "").encode(), refers_to, date)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()
    return run


def revisits(pages: DataFrame, least: int = REVISIT_LEAST) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page with a larger id has too.

    Ids and digests alone are shuffled, and the largest id of a digest is found on the map
    side first, so a payload that a third of the pages share is no hot spot."""
    html = F.coalesce("html", F.lit(""))
    small = pages.where(F.octet_length(html) >= least).select("page_id", F.sha1(html).alias("digest"))
    largest = small.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    return small.join(largest, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record for each of ``pages`` (page_id, url, html) and lists the files (path, records, bytes).

    A null html is an empty payload, a null url or page_id leaves its header out. Of equal
    payloads of ``REVISIT_LEAST`` bytes or more the row with the largest page_id is a response
    (each of them, if rows repeat that id), the others revisit it; a row without page_id
    revisits too. Other columns are left aside. An empty table gives no files.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit(""))).alias("digest")).alias("p")
    again = revisits(pages).alias("r")
    same = (F.col("p.digest") == F.col("r.digest")) & F.col("p.page_id").eqNullSafe(F.col("r.page_id"))
    rows = rows.join(again, same, "left").select("p.page_id", "p.url", "p.html", "r.refers_to")
    return stored(rows.mapInArrow(_write(folder, date, file_bytes), FILES), "warc-files")


def inflated(stream, chunk: int = CHUNK) -> Iterator[Iterator[bytes]]:
    """For each gzip member of ``stream`` what it holds, piece by piece. Each is to be read to its end."""
    rest = stream.read(chunk)
    while rest:
        inflate, left = zlib.decompressobj(31), [rest]

        def pieces(inflate=inflate, left=left):
            while not inflate.eof:
                if not left[0] and not inflate.unconsumed_tail:
                    left[0] = stream.read(chunk)
                    if not left[0]:
                        raise ValueError("an archive ends within a record")
                piece = inflate.decompress(inflate.unconsumed_tail or left[0], 16 * chunk)
                left[0] = inflate.unused_data
                if piece:
                    yield piece

        yield pieces()
        rest = left[0] or stream.read(chunk)


def _head(buffer: bytearray, pieces: Iterator[bytes]) -> dict[str, str]:
    """Takes a first line and headers off ``buffer``, which grows as needed."""
    while (end := buffer.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError("a record ends within its headers")
        buffer += piece
    lines = bytes(buffer[:end]).decode().split("\r\n")
    del buffer[:end + 4]
    return {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_record(pieces: Iterator[bytes], keep: bool) -> tuple:
    """A row of RECORDS. Raises where framing or a digest is wrong."""
    buffer = bytearray()
    head = _head(buffer, pieces)
    if not head[""].startswith("WARC/"):
        raise ValueError(f"no WARC record: {head['']!r}")
    length, block, payload, kept = int(head["content-length"]), hashlib.sha1(), hashlib.sha1(), []
    while len(buffer) < min(length, CHUNK) and (piece := next(pieces, None)) is not None:
        buffer += piece
    whole = bytes(buffer[:length])
    inner = bytearray(whole)
    http = _head(inner, iter(())) if head.get("content-type", "").startswith("application/http") else {"content-length": str(length)}
    block.update(whole)
    payload.update(inner)
    kept.append(bytes(inner)) if keep else None
    n, seen, tail = len(inner), len(whole), buffer[length:]
    for piece in pieces:
        own = piece[:length - seen]
        tail += piece[len(own):]
        block.update(own)
        payload.update(own)
        n, seen = n + len(own), seen + len(own)
        kept.append(own) if keep else None
    if seen != length or bytes(tail) != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    stated = {k: base64.b32decode(head[k].removeprefix("sha1:")).hex() for k in ("warc-block-digest", "warc-payload-digest") if k in head}
    if stated.get("warc-block-digest", block.hexdigest()) != block.hexdigest():
        raise ValueError("a block does not have its digest")
    revisit = head["warc-type"] == "revisit"
    if not revisit and (stated.get("warc-payload-digest", payload.hexdigest()) != payload.hexdigest() or n != int(http["content-length"])):
        raise ValueError("a payload does not have its digest or length")
    digest, number = stated.get("warc-payload-digest", payload.hexdigest()), lambda k: int(head[k]) if k in head else None
    return (number("page-id"), head.get("warc-target-uri"), int(http["content-length"]), digest, head["warc-type"],
            number("refers-to-page-id"), b"".join(kept) if keep and not revisit else None)


def _read(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        rows: list[tuple] = []
        batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            store, name = opened(path)
            with store.open_input_stream(name, compression=None) as stream:
                size = 0
                for pieces in inflated(stream):
                    rows.append(read_record(pieces, keep))
                    size += len(rows[-1][-1] or b"") + 200
                    if size > 4 << 20:
                        yield batch_of()
                        rows, size = [], 0
            if rows:
                yield batch_of()
                rows = []
    return run


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (RECORDS) of the files in ``files`` (path), one task to a file.

    A revisit has the size and digest of the payload that it names, and no payload. A cut
    or altered file raises. Without files there are no rows.
    """
    n = files.count()
    return files.select("path").repartition(max(1, n)).mapInArrow(_read(payloads), RECORDS)
