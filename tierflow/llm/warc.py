"""WARC archives: a writer and a splittable reader.

The reader cuts the archives into byte ranges and deals them to tasks. A task
scans its range for the gzip magic number, validates a candidate member by
decoding the WARC header that it must start with, and owns the records that start
inside its range; it reads on beyond the end as far as its last record goes.
No index is needed and a file of any size is read by many tasks.

Bytes are read and written through ``pyarrow.fs``, at the shared folder's path.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import heavy_keys, scratch, stage, width

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 << 20
FILE_BYTES = 256 << 20
CHUNK = 1 << 20
#: Payloads below this are always responses of their own.
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Owners of duplicates that may be broadcast: a checked bound of about 20 MB.
BROADCAST_ROWS = 200_000


def filesystem(path: str):
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _urn(ident) -> str:
    return f"<urn:x-page:{'' if ident is None else ident}>"


def record(ident, url: str | None, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One gzip member. ``refers_to`` (id) makes it a revisit, which has headers only."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(ident)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def write_archives(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write one record per row of ``pages``; returns the manifest (path, bytes, records).

    Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the
    largest id is the response and the others are revisits that refer to it.
    Null payloads are empty; a null url leaves its header out. A
    null id is written as an empty one and is never a response that others
    refer to unless all are null (then all are responses); rows that repeat
    the largest id are all responses. Other columns are not read. An empty
    table gives no files. Only files in the manifest count: what a lost task left is not in it.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body"), F.octet_length(body).cast("long").alias("size"), F.sha1(body).alias("digest"))
    groups = src.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.max("id").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = stage(groups, "warc-groups")
    if groups.count() <= BROADCAST_ROWS:
        rows = src.join(F.broadcast(groups.drop("n")), "digest", "left")
    else:  # digests of very many rows go by broadcast, at most a thousand of them; the rest by a shuffle
        hot = heavy_keys(groups, "digest", "n", src.count())
        hot_rows = F.broadcast(groups.join(F.broadcast(hot), "digest").select("digest", F.col("owner").alias("hot_owner")))
        rest = groups.join(F.broadcast(hot), "digest", "left_anti").drop("n")
        marked = src.join(hot_rows, "digest", "left")
        cold = marked.filter("hot_owner is null").drop("hot_owner").join(rest, "digest", "left")
        rows = cold.unionByName(marked.filter("hot_owner is not null").withColumnRenamed("hot_owner", "owner"))
    rows = rows.select("id", "url", "body", "size", "digest", F.when(F.col("owner") != F.col("id"), F.col("owner")).when(F.col("id").isNull(), F.col("owner")).alias("refers"))
    root = path or scratch(spark, "warc")
    fs, at = filesystem(root)
    fs.create_dir(at, recursive=True)

    def run(batches):
        fs, at = filesystem(root)
        task = TaskContext.get()
        out, made, name, size, records = None, [], None, 0, 0
        for batch in batches:
            for ident, url, payload, n, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(made)}.warc.gz"
                    out, size, records = fs.open_output_stream(f"{at}/{name}", compression=None), 0, 0
                member = record(ident, url, payload, n, digest, refers)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= FILE_BYTES:
                    out.close()
                    made.append((f"{root}/{name}", size, records))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{root}/{name}", size, records))
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])
    return stage(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


def _header(raw: bytes) -> tuple[dict[str, str], int] | None:
    """WARC header fields (names in lower case) and where the block begins; None if this is no record."""
    if not raw.startswith(b"WARC/1."):
        return None
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in raw[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if {"warc-type", "warc-record-id", "content-length"} <= fields.keys() and fields["content-length"].isdigit() else None


class _Window:
    """A part of a file that grows at its end when more is asked for."""

    def __init__(self, file, start: int, size: int):
        self.file, self.start, self.size, self.data = file, start, size, b""

    def upto(self, end: int) -> None:
        have = self.start + len(self.data)
        end = min(end, self.size)
        if end > have:
            self.data += self.file.read_at(end - have, have)

    def drop(self, before: int) -> None:
        if before - self.start >= 4 * CHUNK:
            self.data, self.start = self.data[before - self.start:], before


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """Decode the gzip member at ``at``: its bytes and where it ends. None unless it is a whole WARC record."""
    unpack, out, pos, checked = zlib.decompressobj(31), [], at, False
    try:
        while not unpack.eof:
            window.upto(pos + CHUNK)
            piece = window.data[pos - window.start:pos - window.start + CHUNK]
            if not piece:
                return None
            out.append(unpack.decompress(piece))
            pos += len(piece)
            if not checked and (len(raw := b"".join(out)) >= 8):
                if not raw.startswith(b"WARC/1."):
                    return None
                out, checked = [raw], True
    except zlib.error:
        return None
    return b"".join(out), pos - len(unpack.unused_data)


def records_in(file, size: int, start: int, end: int):
    """Records that start in [start, end): (offset, header fields, block)."""
    window, at = _Window(file, start, size), start
    while at < end:
        window.drop(at)
        window.upto(min(end, at + CHUNK) + len(MAGIC) - 1)
        found = window.data.find(MAGIC, at - window.start)
        if found < 0 or window.start + found >= end:
            reached = window.start + len(window.data) - (len(MAGIC) - 1)
            if reached >= end or window.start + len(window.data) >= size:
                return
            at = max(at, reached)
            continue
        at = window.start + found
        got = _member(window, at)
        head = _header(got[0]) if got else None
        if head is None:
            at += 1
            continue
        yield at, head[0], got[0][head[1]:head[1] + int(head[0]["content-length"])]
        at = got[1]


def _payload(block: bytes) -> tuple[int | None, bytes]:
    """(length named by the HTTP header, payload after it) of a record's block."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return None, block
    named = [line.partition(b":")[2].strip() for line in block[:end].split(b"\r\n") if line.lower().startswith(b"content-length:")]
    return (int(named[0]) if named and named[0].isdigit() else None), block[end + 4:]


SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, digest_ok boolean, path string, offset long, payload binary"


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the archives named in ``manifest`` (path, bytes): one row per
    record, see ``SCHEMA``; ``payload_digest`` is bare lower-case hex SHA-1 of the
    full payload (for a revisit, the digest and length its headers name), ``digest_ok`` tells whether a response's
    payload has the digest its header names. Bytes that are no valid WARC member
    are skipped. With ``payload=False`` that column is null."""
    ranges = (manifest.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
              .repartition(width(manifest.sparkSession), "path", "start"))

    def run(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, at = filesystem(path)
                rows = []
                with fs.open_input_file(at) as file:
                    for offset, head, block in records_in(file, size, start, min(size, start + split_bytes)):
                        length, body = _payload(block)
                        kind = head["warc-type"]
                        named = head.get("warc-payload-digest", "").partition(":")[2]
                        try:
                            named = base64.b32decode(named).hex() if len(named) == 32 else named.lower()
                        except ValueError:
                            named = ""
                        own = named if kind == "revisit" else hashlib.sha1(body).hexdigest()
                        rows.append((head["warc-record-id"], kind, head.get("warc-target-uri"), head.get("warc-refers-to"),
                                     length if kind == "revisit" else len(body), own, kind == "revisit" or not named or own == named, path, offset, body if payload else None))
                        if len(rows) >= 200:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in SCHEMA.split(", "))])
    names = arrow.names
    return ranges.mapInArrow(run, SCHEMA)


ORACLE = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
    g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS owner FROM d)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN owner <> page_id THEN owner END AS refers_to, true AS digest_ok FROM g"""
