"""WARC archives with a two-level capture index.

`write_archives` writes one WARC record per page into gzip members: a response for the page that stands
for its payload (the largest page_id), a revisit for every other page with an equal payload. `write_index`
sorts the captures by reversed-host URL key into compressed blocks; each index file ends in a sparse
directory with the first key, offset and length of its blocks, and the manifest has one row per index
file. `lookup` binary-searches manifest, directory and block for every key and reads only the blocks that
can hold it; `fetch` reads the records by range, neighbouring ones at once.

Archives and index files are in the folder given, which all executors must share (`pyarrow.fs` opens it).
A task writes to a file with a name of its own, and only what a finished task reports is in the tables,
so a task that is lost or runs twice leaves at most a file that nobody refers to.

Nulls, blanks and ties: a null page is an empty payload; a null url has the empty key; a null page_id is
kept as null and never stands for others unless all of them are null. Rows that share the largest page_id
of their payload are all responses. Repeated rows have a record each. Empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import pin

ARCHIVE_BYTES = 1 << 30
READ_BYTES = 4 << 20
_DATE = "2000-01-01T00:00:00Z"  # pages carry no capture time; a fixed one keeps archives reproducible
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_DEFAULT_PORT = {"http": ":80", "https": ":443"}


def url_key(url: str | None) -> str:
    """Sort key with the host's labels reversed: `org,example,www)/path?query`."""
    clean = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", (url or "").strip())
    try:
        parts = urlsplit(clean)
    except ValueError:
        return clean
    if not parts.netloc:
        return clean
    host = parts.netloc.rpartition("@")[2].lower().removesuffix(_DEFAULT_PORT.get(parts.scheme.lower(), ":"))
    name, colon, port = host.partition(":") if not host.startswith("[") else (host, "", "")
    labels = ",".join(reversed(name.rstrip(".").split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{colon}{port}){parts.path or '/'}{query}"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; the digest is checked against the payload where there is one."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        found = fields.get(name, "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(found) if found else None

    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"), "payload": payload if response else None,
    }


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    system, path = pafs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of a stream of batches, a few hundred converted at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in batch.slice(first, 256).columns], strict=True)


_CAPTURE = "key string, page_id bigint, archive string, start bigint, length bigint"


def write_archives(pages: DataFrame, root: str, *, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives under `root`; returns captures (key, page_id, archive, start, length).

    Payloads of fewer than `least_bytes` are never revisits.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("html"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("html")))
    stands = rows.filter(F.octet_length("html") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("stands"), F.count(F.lit(1)).alias("n"))
    # Pinned, and only groups of two and more: the join can split a payload that many pages share.
    stands = pin(stands.filter("n > 1").drop("n"), "payloads")
    joined = rows.join(stands, "sha1", "left").select("page_id", "url", "html", "stands")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        system.create_dir(folder, recursive=True)
        stream, name, at, held = None, "", 0, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            held.clear()
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=["key", "page_id", "archive", "start", "length"])

        for ident, link, text, stands in _records(batches):
            if stream is None:
                name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                stream = system.open_output_stream(f"{folder}/{name}", compression=None)
            revisit = stands is not None and ident != stands
            raw = _member(_record(ident, link, text.encode(), stands, revisit))
            stream.write(raw)
            held.append((url_key(link), ident, name, at, len(raw)))
            at += len(raw)
            if at >= ARCHIVE_BYTES:
                stream.close()
                stream = None
            if len(held) >= 10_000:
                yield flush()
        if stream is not None:
            stream.close()
        if held:
            yield flush()

    return pin(joined.mapInArrow(run, _CAPTURE), "captures")


_FILE = "file string, first_key string, last_key string, directory bigint, size bigint"


def write_index(captures: DataFrame, root: str, *, block_lines: int = 3000, file_lines: int = 1_000_000) -> DataFrame:
    """Index files under `root`; returns the manifest, one row per file."""
    files = 1 + captures.count() // file_lines
    order = ["key", "archive", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        system.create_dir(folder, recursive=True)
        stream, name, at, first, lines, directory = None, f"{uuid.uuid4().hex}.cdx", 0, "", [], []

        def close_block() -> None:
            nonlocal at
            raw = zlib.compress("\n".join(lines).encode())
            stream.write(raw)
            directory.append(f"{lines[0].partition(' ')[0]} {at} {len(raw)}")
            at += len(raw)
            lines.clear()

        for key, page, archive, start, length in _records(batches):
            if stream is None:
                stream, first = system.open_output_stream(f"{folder}/{name}", compression=None), key
            lines.append(f"{key} {'' if page is None else page} {archive} {start} {length}")
            if len(lines) == block_lines:
                close_block()
        if stream is not None:
            if lines:
                close_block()
            raw = zlib.compress("\n".join(directory).encode())
            stream.write(raw)
            stream.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "first_key": first, "last_key": key, "directory": at, "size": len(raw)}])

    dealt = captures.repartitionByRange(files, *order).sortWithinPartitions(*order).select("key", "page_id", "archive", "start", "length")
    return pin(dealt.mapInArrow(run, _FILE), "manifest")


_BLOCK = "file string, at bigint, size bigint, key string"


def _around(first_keys: list[str], key: str) -> range:
    """Places in a sorted list of first keys whose stretch can hold the key."""
    return range(max(0, bisect_left(first_keys, key) - 1), bisect_right(first_keys, key))


def lookup(keys: DataFrame, manifest: DataFrame, root: str) -> DataFrame:
    """Captures of every distinct key of `keys` (key).

    The manifest (a row per million captures) is sent to the tasks; directories and blocks are read.
    """
    # Of files that begin with the same key only the last can go beyond it, so last keys give their order.
    files = sorted((r["first_key"], r["last_key"], r["file"], r["directory"], r["size"]) for r in manifest.collect())
    firsts = [f[0] for f in files]

    def find_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        held, name = [], None
        for batch in batches:
            out = []
            for (key,) in _records(iter([batch])):
                for k in _around(firsts, key):
                    _, _, file, at, size = files[k]
                    if name != file:
                        with system.open_input_file(f"{folder}/{file}") as source:
                            lines = zlib.decompress(source.read_at(size, at)).decode().split("\n")
                        held, name = [x.rsplit(" ", 2) for x in lines], file
                        starts = [x[0] for x in held]
                    out += [(file, int(held[b][1]), int(held[b][2]), key) for b in _around(starts, key)]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=["file", "at", "size", "key"])

    def find_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        held, block = [], None
        for batch in batches:
            out = []
            for file, at, size, key in _records(iter([batch])):
                if block != (file, at):
                    with system.open_input_file(f"{folder}/{file}") as source:
                        held = [x.rsplit(" ", 4) for x in zlib.decompress(source.read_at(size, at)).decode().split("\n")]
                    block, names = (file, at), [x[0] for x in held]
                for k in range(bisect_left(names, key), bisect_right(names, key)):
                    _, page, archive, start, length = held[k]
                    out.append((key, int(page) if page else None, archive, int(start), int(length)))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=["key", "page_id", "archive", "start", "length"])

    near = pin(keys.select("key").distinct(), "keys").repartitionByRange("key").sortWithinPartitions("key")
    blocks = near.mapInArrow(find_blocks, _BLOCK)
    dealt = blocks.repartition("file", "at").sortWithinPartitions("file", "at", "key")
    return dealt.mapInArrow(find_lines, _CAPTURE)


_PAGE = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def fetch(captures: DataFrame, root: str, *, payloads: bool = True) -> DataFrame:
    """Records of the captures, read by range; `payload` is null for revisits, or if not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        source, name, data, low = None, None, b"", 0
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            out = []
            for k, (archive, start, length) in enumerate(rows):
                if archive != name:
                    if source is not None:
                        source.close()
                    source, name, data, low = system.open_input_file(f"{folder}/{archive}"), archive, b"", 0
                if start < low or start + length > low + len(data):
                    until = start + length
                    for other, at, size in rows[k + 1 :]:  # what follows closely is read along
                        if other != archive or at > until + (64 << 10) or at + size - start > READ_BYTES:
                            break
                        until = at + size
                    data, low = source.read_at(until - start, start), start
                found = parse_record(zlib.decompress(data[start - low : start - low + length], 31))
                if not payloads:
                    found["payload"] = None
                out.append(found)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])
    stretch = F.floor(F.col("start") / (16 * READ_BYTES))
    dealt = captures.select("archive", "start", "length").repartition("archive", stretch).sortWithinPartitions("archive", "start")
    return dealt.mapInArrow(run, _PAGE)
