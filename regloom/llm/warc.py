"""WARC archives: a writer of one gzip member per record and a sequential reader.

The writer's tasks each write archives of their own into the shared folder,
under a name that no other attempt uses, and return a manifest; only archives
named by a task that ended well are ever read, so a lost executor costs a
rewrite and leaves nothing half-read. The reader goes through an archive
member by member, decompresses in small steps, frames each block by its
Content-Length and verifies digest and framing; it holds one step of a
payload at a time.

Records with equal payloads are written once as ``response``; the others are
``revisit`` records that name it. Nulls: a null payload is empty; a null
page_id sorts before all others and is written as ``null``; a null url is
written as an empty target. Of rows that agree in id, url and payload the
first is the response, the others revisit it. An empty table writes no
archive and gives an empty table."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 256 << 20
STEP = 1 << 16
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and path of a folder of the shared checkpoint folder."""
    if re.match(r"file:/+", uri) or "://" not in uri:
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def digest32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(kind: str, record_id: str, url: str, payload: bytes, size: int, sha1_hex: str,
           refers_to: str | None) -> bytes:
    """One uncompressed record. A revisit carries the HTTP head only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http + payload
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {re.sub('[\r\n]', ' ', url)}",
            f"WARC-Payload-Digest: sha1:{digest32(sha1_hex)}",
            f"WARC-Block-Digest: sha1:{digest32(hashlib.sha1(block).hexdigest())}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _write(folder: str, limit: int):
    def run(stream):
        store, path = _place(folder)
        store.create_dir(path, recursive=True)
        out, made, name, held, count = None, [], "", 0, 0
        for part in stream:
            for row in part.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, held, count = store.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                data = member(record(row["kind"], row["record_id"], row["url"] or "",
                                     (row["payload"] or "").encode(), row["size"], row["sha1"],
                                     row["refers_to"]))
                out.write(data)
                held, count = held + len(data), count + 1
                if held >= limit:
                    out.close()
                    made.append((f"{folder}/{name}", count, held))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", count, held))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("path", "records", "bytes"), m)) for m in made],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))
    return run


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(kind, record_id, url, payload, size, sha1, refers_to), a row per page.

    The response of each payload is an aggregate over size and digest that
    carries the payload: copies meet on the map side, so each distinct payload
    moves once however often it occurs. Who revisits is settled on ids,
    digests and sizes alone."""
    body = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select("page_id", "url", body.alias("payload"),
                        F.octet_length(body).cast("long").alias("size"),
                        F.sha1(body.cast("binary")).alias("sha1"))
    thin = materialize(full.groupBy("page_id", "url", "size", "sha1")
                       .agg(F.count(F.lit(1)).alias("n")), "warc-plan")
    shared = F.col("size") >= least_bytes

    def name(page: str):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("null")))

    best = thin.where(shared).groupBy("size", "sha1").agg(F.max(F.struct("page_id", "url")).alias("best"))
    is_best = F.col("page_id").eqNullSafe(F.col("best.page_id")) & F.col("url").eqNullSafe(F.col("best.url"))
    again = thin.join(best, ["size", "sha1"]).withColumn("n", F.col("n") - is_best.cast("int")).where("n > 0")
    revisits = again.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(
        F.lit("revisit").alias("kind"),
        F.concat(name("page_id"), F.lit(":"), "copy").alias("record_id"),
        "url", F.lit(None).cast("string").alias("payload"), "size", "sha1",
        name("best.page_id").alias("refers_to"))

    def responses(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit("response").alias("kind"), name("page_id").alias("record_id"), "url", "payload",
                           "size", "sha1", F.lit(None).cast("string").alias("refers_to"))

    once = (full.where(shared).groupBy("size", "sha1")
            .agg(F.max(F.struct("page_id", "url", "payload")).alias("best"))
            .select("best.*", "size", "sha1"))
    plans = responses(once).unionByName(revisits)
    if least_bytes > 0:
        plans = plans.unionByName(responses(full.where(~shared)))
    return plans


def write_archives(records: DataFrame, folder: str | None = None,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all records; returns the manifest (path, records, bytes), stored."""
    folder = folder or f"{ensure_checkpoint_dir(records.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return materialize(records.mapInArrow(
        _write(folder, archive_bytes), "path string, records long, bytes long"), "warc-manifest")


class _Bytes:
    """Decompressed bytes of one gzip member, drawn from a compressed stream step by step."""

    def __init__(self, source, left: bytes):
        self.source, self.z, self.held, self.left = source, zlib.decompressobj(31), bytearray(), left

    def _more(self) -> bool:
        while not self.z.eof:
            if not self.left and not self.z.unconsumed_tail:
                self.left = self.source.read(STEP)
                if not self.left:
                    raise ValueError("archive ends inside a gzip member")
            out = self.z.decompress(self.z.unconsumed_tail or self.left, STEP)
            self.left = b""
            if out:
                self.held += out
                return True
        return False

    def line(self) -> bytes:
        start = 0
        while (at := self.held.find(b"\r\n", start)) < 0:
            start = max(0, len(self.held) - 1)
            if not self._more():
                raise ValueError("record head without end")
        out = bytes(self.held[:at])
        del self.held[:at + 2]
        return out

    def take(self, n: int):
        """The next ``n`` bytes, in steps."""
        while n:
            if not self.held and not self._more():
                raise ValueError("block is shorter than its Content-Length")
            out = bytes(self.held[:n])
            del self.held[:n]
            n -= len(out)
            yield out

    def rest(self) -> bytes:
        while self._more():
            if len(self.held) > STEP:
                raise ValueError("block is longer than its Content-Length")
        return bytes(self.held)


def _head(stream: _Bytes) -> dict[str, str]:
    out = {}
    while line := stream.line():
        name, _, value = line.decode().partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_records(source, with_payload: bool = True):
    """The records of an archive stream in order, one dict each; raises
    ValueError at a record whose framing or digests do not hold."""
    left = source.read(STEP)
    while left:
        stream = _Bytes(source, left)
        if stream.line().decode() != VERSION:
            raise ValueError("not a WARC record")
        head = _head(stream)
        length, block, payload, kept = int(head["content-length"]), hashlib.sha1(), hashlib.sha1(), []
        http, body, size = bytearray(), False, 0
        for step in stream.take(length):
            block.update(step)
            if not body:
                http += step
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                body, step, http = True, bytes(http[at + 4:]), http[:at + 2]
            payload.update(step)
            size += len(step)
            if with_payload:
                kept.append(step)
        if stream.rest() != b"\r\n\r\n":
            raise ValueError("record does not end where its Content-Length says")
        if head["warc-block-digest"] != "sha1:" + digest32(block.hexdigest()):
            raise ValueError("block digest differs")
        declared = int(re.search(rb"(?i)content-length:\s*(\d+)", bytes(http))[1])
        if head["warc-type"] == "response" and (
                declared != size or head["warc-payload-digest"] != "sha1:" + digest32(payload.hexdigest())):
            raise ValueError("payload digest differs")
        yield {"record_type": head["warc-type"], "record_id": head["warc-record-id"].strip("<>"),
               "url": head.get("warc-target-uri"), "payload_bytes": declared,
               "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"),
               "refers_to": (head.get("warc-refers-to") or "").strip("<>") or None,
               "payload": b"".join(kept) if with_payload else None}
        left = stream.z.unused_data or source.read(STEP)


_RECORD = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("refers_to", pa.string()), ("payload", pa.binary())])


def _read(with_payload: bool, batch_bytes: int = 8 << 20):
    def run(stream):
        for part in stream:
            for uri in part.column("path").to_pylist():
                store, path = _place(uri)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for row in read_records(source, with_payload):
                        rows.append(row)
                        held += 200 + len(row["payload"] or b"")
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)
    return run


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """(record_type, record_id, url, payload_bytes, payload_digest, refers_to,
    payload) of every record of the manifest's archives, one archive a task."""
    many = max(1, manifest.count())
    return manifest.select("path").repartition(many).mapInArrow(
        _read(with_payload), "record_type string, record_id string, url string, payload_bytes long, "
        "payload_digest string, refers_to string, payload binary")


def _page(record_id: str):
    text = F.split(F.col(record_id), ":")[2]
    return F.when(text != "null", text).cast("long")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), as read back."""
    back = read_archives(write_archives(plan_records(pages, least_bytes)), with_payload=False)
    return back.select(_page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", _page("refers_to").alias("refers_to"))
