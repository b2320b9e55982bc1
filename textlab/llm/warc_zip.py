"""Operator 6: WARC records inside ZIP packages, read by byte ranges.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``,
WARC records each in a gzip member of its own, and ``indexes/index.idx``, one line a
record with its offset and length. The reader parses the end record, the ZIP64
locator and directory, and the central directory, finds a member's bytes behind its
local header, reads the index, and then reads each record by its range; nothing is
extracted and no package is read whole. Ranges are dealt to tasks by package and
``CHUNK`` of bytes, so a huge package is read by many tasks.

The writer fills packages of about ``PACKAGE_BYTES`` in the folder it is given, under
names that no other task attempt uses. Only packages that a finished task reports
are listed in the manifest, so what lost executors leave behind is never read.

Payloads that are equal and at least ``min_bytes`` long are stored once: the record
of the largest page_id is the response, the others are revisit records that name it.

Defined cases: a NULL html is an empty payload, a NULL url gives a record without a
target, control characters of urls are percent-encoded. Repeated rows with the
largest page_id are all responses; NULL page_ids come last. Very long payloads make a package of their own. An
empty table makes no package. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import materialise

PACKAGE_BYTES = 16 << 20
CHUNK = 8 << 20
#: Bytes of packed records that a task reads.
TASK_BYTES = 2 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.idx"
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "package string, records long, bytes long"
RANGES = "package string, at long, length long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def _open(uri: str):
    """File system and path of a folder or file, local or remote."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


# --- writing ---------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _target(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)


def record(page_id, url, payload: bytes | None, size: int, sha: str, refers_to) -> bytes:
    """A WARC record; ``payload`` is None for a revisit."""
    revisit = payload is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {_target(url)}"]),
        f"WARC-Payload-Digest: sha1:{sha}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
           f"WARC-Refers-To: {_id(refers_to)}"] if revisit else []),
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(body: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(body) + z.flush()


def package(members: list[bytes], force_zip64: bool = False) -> bytes:
    """The ZIP file of gzipped records with their index."""
    out, index, at = io.BytesIO(), [], 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=force_zip64) as f:
            for m in members:
                f.write(m)
                index.append(f"{at} {len(m)}\n")
                at += len(m)
        z.writestr(zipfile.ZipInfo(INDEX), "".join(index))
    return out.getvalue()


def _write(folder: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        members: list[bytes] = []
        held = 0

        def flush():
            name = f"{uuid.uuid4().hex}.zip"
            body = package(members)
            with files.open_output_stream(f"{root}/{name}") as f:
                f.write(body)
            return pa.RecordBatch.from_pydict(
                {"package": [f"{folder}/{name}"], "records": [len(members)], "bytes": [len(body)]}
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "size", "sha", "refers_to")]
            for page_id, url, html, size, sha, refers_to in zip(*columns, strict=True):
                html = html.as_py()
                members.append(
                    gzip_member(record(
                        page_id.as_py(), url.as_py(), None if html is None else html.encode("utf-8"),
                        size.as_py(), sha.as_py(), refers_to.as_py(),
                    ))
                )
                held += len(members[-1])
                if held >= PACKAGE_BYTES:
                    yield flush()
                    members, held = [], 0
        if members:
            yield flush()

    return run


#: base-32 SHA-1 from the hex digits: five of them are four characters.
def _base32(hex_digits):
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.conv(F.substring(hex_digits, i * 5 + 1, F.lit(5)), 16, 10).cast("int"),
    )
    letter = lambda v, s: F.substring(
        F.lit(alphabet), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)
    )
    return F.array_join(F.transform(parts, lambda v: F.concat(*[letter(v, s) for s in (15, 10, 5, 0)])), "")


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)``; the manifest of what was written.

    Equal payloads meet by digest: the largest page_id of each is pre-aggregated, and
    a digest that a third of the pages share is one row of that table; AQE splits its
    partition of the join.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("size"),
        F.sha1(html).alias("_hex"),
    )
    last = rows.groupBy("_hex").agg(F.max("page_id").alias("_last")).withColumnRenamed("_hex", "_h")
    revisit = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_last"))
    typed = rows.join(last.hint("shuffle_hash"), F.col("_hex") == F.col("_h"), "left").select(
        "page_id", "url",
        F.when(~revisit, F.col("html")).alias("html"),
        "size", _base32(F.col("_hex")).alias("sha"),
        F.when(revisit, F.col("_last")).alias("refers_to"),
    )
    return materialise(typed.mapInArrow(_write(folder), MANIFEST), "warc-manifest")


# --- reading ---------------------------------------------------------------------


def central_directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """Members by name: method, offset of the local header, stored length.

    ``f`` reads and seeks. The end record is looked for in the last 64 KB; fields
    at their maximum are taken from the ZIP64 record or the entry's extra field.
    """
    tail_at = max(0, size - 65_557)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        (where,) = struct.unpack_from("<Q", tail, at - 12)
        f.seek(where)
        entries, length, start = struct.unpack_from("<QQQ", f.read(56), 32)
    f.seek(start)
    body, at, found = f.read(length), 0, {}
    for _ in range(entries):
        if body[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", body, at + 10)[0]
        stored, plain, n, extra, comment = struct.unpack_from("<IIHHH", body, at + 20)
        header = struct.unpack_from("<I", body, at + 42)[0]
        name = body[at + 46 : at + 46 + n].decode("utf-8", "replace")
        x, end = at + 46 + n, at + 46 + n + extra
        while x + 4 <= end:
            kind, width = struct.unpack_from("<HH", body, x)
            if kind == 1:
                wide, p = [], x + 4
                for value in (plain, stored, header):
                    if value == 0xFFFFFFFF:
                        value = struct.unpack_from("<Q", body, p)[0]
                        p += 8
                    wide.append(value)
                plain, stored, header = wide
            x += 4 + width
        found[name] = (method, header, stored)
        at = end + comment
    return found


def member_range(f, entry: tuple[int, int, int]) -> tuple[int, int]:
    """Where a stored member's bytes begin, and how many there are."""
    method, header, stored = entry
    if method != 0:
        raise ValueError("the member is compressed; only stored members can be read by range")
    f.seek(header)
    local = f.read(30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("damaged local header")
    name, extra = struct.unpack_from("<HH", local, 26)
    return header + 30 + name + extra, stored


def _list(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for uri in batch.column("package").to_pylist():
            files, path = _open(uri)
            with files.open_input_file(path) as f:
                members = central_directory(f, f.size())
                data, _ = member_range(f, members[DATA])
                start, length = member_range(f, members[INDEX])
                f.seek(start)
                lines = [line.split() for line in f.read(length).splitlines()]
            yield pa.RecordBatch.from_pydict(
                {
                    "package": [uri] * len(lines),
                    "at": [data + int(a) for a, _ in lines],
                    "length": [int(n) for _, n in lines],
                }
            )


def parse_record(raw: bytes) -> dict:
    """Fields of one gzipped WARC record."""
    body = zlib.decompress(raw, 31)
    head, _, rest = body.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    number = lambda key: int(v) if (v := fields.get(key, "")[len("<urn:page:") : -1]) else None
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and len(payload) != size:
        raise ValueError("the payload is cut short")
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else digest(payload),
        "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To") if revisit else None,
        "payload": None if revisit else payload,
    }


def _read(columns: list[str]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(c, kinds.get(c, pa.string())) for c in columns])
        held, opened = None, None
        for batch in batches:
            rows, size = [], 0
            for uri, at, length in zip(*(batch.column(c).to_pylist() for c in ("package", "at", "length")), strict=True):
                if uri != held:
                    if opened:
                        opened.close()
                    files, path = _open(uri)
                    held, opened = uri, files.open_input_file(path)
                opened.seek(at)
                r = parse_record(opened.read(length))
                rows.append({c: r[c] for c in columns})
                size += r["payload_bytes"] if "payload" in columns else 0
                if size > CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if opened:
            opened.close()

    return run


def read_packages(packages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The records of ``packages(package)``, with the wanted ``columns`` of ``RECORDS``."""
    kinds = dict(c.strip().split(" ") for c in RECORDS.split(","))
    columns = columns or list(kinds)
    ranges = materialise(packages.select("package").mapInArrow(_list, RANGES), "record-ranges", "zstd")
    # as many tasks as there are bytes to read, not as the few bytes of the ranges suggest
    size = ranges.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    part = F.floor(F.col("at") / TASK_BYTES)
    dealt = (
        ranges.withColumn("_part", part).repartition(size // TASK_BYTES + 1, "package", "_part")
        .sortWithinPartitions("package", "at")
    )
    return dealt.drop("_part").mapInArrow(_read(columns), ", ".join(f"{c} {kinds[c]}" for c in columns))
