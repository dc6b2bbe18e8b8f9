"""Web archives (WARC 1.1, one gzip member a record) as a Spark data source.

Writing: each task writes files of at most ``max_bytes`` under names of its own;
the commit on the driver lists the files of the successful tasks in a manifest,
so files of lost or repeated tasks are never read. A member's gzip header
holds its compressed length (the ``sl`` field of the standard), so a reader can
step over it.

Reading: files are planned into partitions by size. A record's headers are
inflated first and compared with the pushed filters (record type, target URI,
record id); only wanted records whose payload column is selected are inflated
to the end. Others are stepped over by the ``sl`` field, or, in files that lack
it, inflated without being kept. Files without a manifest are read too.

Deduplication: of pages with equal payloads that with the largest id is the
``response``, the others are ``revisit`` records (identical-payload-digest)
that keep the response's length in their HTTP headers.

Null payloads are empty. Null URLs write no target. Rows that share the largest
id of their payload are all responses; rows with a null id revisit if another
has an id. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from ..session import scratch_path
from .common import stored

MANIFEST = "_manifest"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITE_SCHEMA = "record_id string, type string, uri string, refers_to string, payload binary, payload_length bigint, payload_digest string"
#: Columns from headers alone, then those that need the payload.
SCHEMA = ("record_id string, type string, uri string, refers_to string, header_digest string, header_length bigint, "
          "payload binary, payload_bytes bigint, payload_digest string")
HEADERS_ONLY = {"record_id", "type", "uri", "refers_to", "header_digest", "header_length"}


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


#: Largest length that the header of a gzip member can tell.
LARGEST_LENGTH = 0xFFFFFFFF


def _line(value: str) -> str:
    """A header value on one line; other characters than printable ASCII are percent-encoded."""
    return "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def record(record_id: str, kind: str, uri: str | None, refers_to: str | None, payload: bytes, length: int, sha: str) -> bytes:
    body = b"" if kind == "revisit" else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{sha}", f"Content-Length: {len(http) + len(body)}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_line(uri)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    """One gzip member whose header tells its compressed and full length, where both fit its 32 bits; a reader inflates
    its way past a larger one."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    size = 12 + 12 + len(body) + 8
    tail = body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    if max(size, len(raw)) > LARGEST_LENGTH:
        return b"\x1f\x8b\x08\x00" + b"\0" * 4 + b"\0\xff" + tail
    return b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size, len(raw)) + tail


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, max_bytes: int):
        self.path, self.max_bytes = path, max_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        out, size, files = None, 0, []
        try:
            for batch in iterator:
                for r in batch.to_pylist():
                    m = member(record(r["record_id"], r["type"], r["uri"], r["refers_to"], r["payload"] or b"", r["payload_length"], r["payload_digest"]))
                    if out is not None and size + len(m) > self.max_bytes:
                        out.close()
                        files[-1] = (files[-1][0], size)
                        out = None
                    if out is None:
                        files.append((f"part-{uuid.uuid4().hex}.warc.gz", 0))
                        out, size = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                    out.write(m)
                    size += len(m)
        finally:
            if out is not None:
                out.close()
                files[-1] = (files[-1][0], size)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            for m in messages:
                for name, size in m.files if m else []:
                    out.write(f"{size} {name}\n".encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                store.delete_file(f"{root}/{name}")


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split_bytes: int):
        self.path, self.columns, self.split_bytes = path, columns, split_bytes
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if isinstance(f, (EqualTo, In)) and name in ("type", "uri", "record_id"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = filesystem(self.path)
        if store.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}", compression=None) as src:
                files = [(int(size), f"{root}/{name}") for size, name in (x.split(" ", 1) for x in src.read().decode().splitlines())]
        else:
            found = store.get_file_info(pafs.FileSelector(root)) if store.get_file_info(root).type == pafs.FileType.Directory else [store.get_file_info(root)]
            files = [(f.size, f.path) for f in found if f.path.endswith((".warc", ".warc.gz"))]
        out, held = [], self.split_bytes
        for size, name in sorted(files, key=lambda x: x[1]):
            if held + size > self.split_bytes:
                out.append(Files([]))
                held = 0
            out[-1].names.append(name)
            held += size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        payload = not set(self.columns) <= HEADERS_ONLY
        rows: list[dict] = []
        size = 0
        for name in partition.names:
            with store.open_input_stream(name, compression=None) as src:
                for head, body in (gzip_records if name.endswith(".gz") else plain_records)(src):
                    kept = self._row(head, body, payload)
                    if kept is None:
                        continue
                    rows.append(kept)
                    size += len(kept["payload"] or b"") + 500
                    if size > 8 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _row(self, head: dict[str, str], body, payload: bool) -> dict | None:
        row = {"record_id": _bare(head.get("warc-record-id")), "type": head.get("warc-type"), "uri": head.get("warc-target-uri"), "refers_to": _bare(head.get("warc-refers-to")),
               "header_digest": (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None, "header_length": None, "payload": None, "payload_bytes": None, "payload_digest": None}
        if any(row[c] not in v for c, v in self.wanted.items()):
            return None
        if "header_length" in self.columns or payload:
            http = head.get("content-type", "").startswith("application/http")
            first, _, data = body(payload and row["type"] != "revisit").partition(b"\r\n\r\n") if http else (b"", b"", body(payload))
            row["header_length"] = next((int(x.split(b":")[1]) for x in first.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
            if payload and row["type"] != "revisit":
                row["payload"] = data if "payload" in self.columns else None
                row["payload_bytes"], row["payload_digest"] = len(data), digest(data)
            elif payload:
                row["payload_bytes"], row["payload_digest"] = row["header_length"], row["header_digest"]
        return row

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"header_length": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in self.columns], names=self.columns)


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value is not None else None


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record but {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def gzip_records(src, step: int = 16 << 10):
    """(headers, body) of each member; ``body(whole)`` inflates the record's block, or
    only what was inflated with the headers. What is not asked for is stepped over."""
    held = b""

    def more(n: int) -> bool:
        nonlocal held
        while len(held) < n and (x := src.read(max(step, n - len(held)))):
            held += x
        return len(held) >= n

    while more(18):
        flags = held[3]
        total = 0
        if flags & 4:
            (xlen,) = struct.unpack("<H", held[10:12])
            more(12 + xlen)
            extra = held[12:12 + xlen]
            while len(extra) >= 4:
                (n,) = struct.unpack("<H", extra[2:4])
                if extra[:2] == b"sl" and n >= 4:
                    (total,) = struct.unpack("<I", extra[4:8])
                extra = extra[4 + n:]
        inflate = zlib.decompressobj(31)
        text, used = b"", 0
        while b"\r\n\r\n" not in text and not inflate.eof:       # headers first
            if used >= len(held) and not more(used + 1):
                break
            piece = held[used:used + 2048]
            used += len(piece)
            text += inflate.decompress(piece)
        head, _, text = text.partition(b"\r\n\r\n")
        fields = _headers(head)
        length = int(fields.get("content-length", "0"))

        def body(whole: bool, text=text, length=length):
            nonlocal used
            parts, have = [text], len(text)
            while (have < length if whole else b"\r\n\r\n" not in b"".join(parts[-2:]) and have < length) and not inflate.eof:
                if used >= len(held) and not more(used + 1):
                    break
                piece = held[used:used + (64 << 10)]
                used += len(piece)
                parts.append(inflate.decompress(piece))
                have += len(parts[-1])
            return b"".join(parts)[:length]

        yield fields, body
        if total:                                                # the member's own length
            if len(held) < total:
                left = total - len(held)
                held = b""
                while left > 0 and (x := src.read(min(left, 4 << 20))):
                    left -= len(x)
            else:
                held = held[total:]
        else:
            while not inflate.eof:
                if used >= len(held) and not more(used + 1):
                    return
                piece = held[used:used + (64 << 10)]
                used += len(piece)
                inflate.decompress(piece)
            held = held[used - len(inflate.unused_data):]


def plain_records(src, step: int = 64 << 10):
    """(headers, body) of each record of an uncompressed file; unwanted blocks are not kept."""
    held = b""
    while True:
        held = held.lstrip(b"\r\n")
        while b"\r\n\r\n" not in held and (x := src.read(step)):
            held = (held + x).lstrip(b"\r\n") if not held.strip(b"\r\n") else held + x
        if b"\r\n\r\n" not in held:
            return
        head, _, held = held.partition(b"\r\n\r\n")
        fields = _headers(head)
        length = int(fields.get("content-length", "0"))
        taken = False

        def body(whole: bool, length=length):
            nonlocal held, taken
            parts, have = [held[:length]], min(len(held), length)
            held, taken = held[length:], True
            while have < length and (x := src.read(max(step, 1))):
                parts.append(x[:length - have])
                held = x[length - have:]
                have += len(parts[-1])
            return b"".join(parts)

        yield fields, body
        if not taken:
            left = length - len(held)
            held = held[length:]
            while left > 0 and (x := src.read(step)):
                held = x[left:] if left < len(x) else b""
                left -= len(x)


class WarcSource(DataSource):
    """``warc``: options ``path``, ``max_bytes`` (of a written file) and ``split_bytes`` (of a read partition)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], [f.name for f in schema.fields], int(self.options.get("split_bytes", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("max_bytes", 128 << 20)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archives(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records of the archives under ``path``; the schema names the columns that are parsed."""
    register(spark)
    fields = {x.strip().split(" ")[0]: x.strip() for x in SCHEMA.split(",")}
    return spark.read.format("warc").schema(", ".join(fields[c] for c in columns or fields)).load(path)


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write one record a row, equal payloads as revisits; returns the archives' folder."""
    spark = pages.sparkSession
    register(spark)
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("uri"), body.alias("payload"), F.sha1(body).alias("sha"))
    groups = rows.select("id", "sha").groupBy("sha").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = stored(groups.select("sha", "first"), "warc-groups")                  # payloads that occur twice or more
    revisit = F.col("first").isNotNull() & F.coalesce(F.col("id") < F.col("first"), F.lit(True))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    raw = F.unhex("sha")
    records = rows.join(groups, "sha", "left").select(
        name(F.col("id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("type"), "uri",
        F.when(revisit, name(F.col("first"))).alias("refers_to"), F.when(~revisit, F.col("payload")).alias("payload"),
        F.length("payload").cast("long").alias("payload_length"), base32(raw).alias("payload_digest"))
    path = scratch_path(spark, "warc")
    records.write.format("warc").mode("append").save(path)
    return path


def base32(raw) -> F.Column:
    """Base 32 of 20 bytes: four times five bytes are eight digits of five bits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    part = lambda i: F.conv(F.hex(F.substring(raw, 5 * i + 1, 5)), 16, 10).cast("long")
    digit = lambda n, k: F.substring(F.lit(letters), F.shiftright(n, 5 * k).bitwiseAND(31).cast("int") + 1, F.lit(1))
    return F.concat(*[digit(part(i), k) for i in range(4) for k in range(7, -1, -1)])
