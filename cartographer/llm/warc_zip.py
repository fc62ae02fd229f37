"""WARC records in ZIP packages: written, then range-read without extraction.

A package is a ZIP file with stored (uncompressed) members, as web archive
collections use: ``archive/data.warc.gz`` holds one gzip member per WARC
record, ``indexes/index.cdx`` a line per record with its offset and length in
the archive. ZIP64 records are written and read where sizes or counts need
them.

The reader knows a package's path and size only. It reads the end of the file,
follows the (ZIP64) end record to the central directory, takes stored members
and their data offsets, reads the index member, and then range-reads each
record; nothing is extracted to disk and no package is read whole.

Packages live in the session's shared folder and are reached through
``pyarrow.fs``. Each task writes packages of about ``PACKAGE_BYTES`` under
names of its own, so a task that runs again never meets a half-written file.

Equal payloads of ``REVISIT_BYTES`` or more are stored once: the row with the
largest page_id is the response, the others are revisit records that refer to
it. Rows that share that largest id are all responses, and so is a group
whose ids are all null. A null html is an empty payload; a null url is left
out; a null page_id is written as an empty one. Repeated rows are written as
often as they occur.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import cut, map_arrow

REVISIT_BYTES = 1000
PACKAGE_BYTES = 64 << 20
#: Index lines that one task reads and range-reads at once; bytes of a merged read.
READ_ROWS = 200
GAP_BYTES = 64 << 10
MOST_READ = 8 << 20
#: Bytes of packages that one task reads, about, and tasks that list packages at most.
TASK_BYTES = 16 << 20
MOST_LISTERS = 4096

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
LIMIT32, LIMIT16 = 0xFFFFFFFF, 0xFFFF
#: Signatures and layouts of the ZIP format (fixed values).
LOCAL, LOCAL_SIG = struct.Struct("<4s5H3I2H"), b"PK\x03\x04"
CENTRAL, CENTRAL_SIG = struct.Struct("<4s6H3I5H2I"), b"PK\x01\x02"
END, END_SIG = struct.Struct("<4s4H2IH"), b"PK\x05\x06"
END64, END64_SIG = struct.Struct("<4sQ2H2I4Q"), b"PK\x06\x06"
PLACE64, PLACE64_SIG = struct.Struct("<4sIQI"), b"PK\x06\x07"
#: 1980-01-01 as a ZIP date.
DAY = 33


class PackageWriter:
    """Streams stored members into a ZIP file; sizes follow in the central directory.

    Members start with a ZIP64 header, since their size is not known
    beforehand; the header is completed by writing members from ``add``.
    """

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.members, self.zip64 = out, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        """A member whose sizes come after its data (flag bit 3, with a ZIP64 field for large data)."""
        raw = name.encode()
        self.name, self.header, self.crc, self.size = raw, self.at, 0, 0
        extra = struct.pack("<2H2Q", 1, 16, 0, 0)
        self._put(LOCAL.pack(LOCAL_SIG, 45, 8, 0, 0, DAY, 0, LIMIT32, LIMIT32, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """Returns the data's offset in the member."""
        at = self.size
        self.crc, self.size = zlib.crc32(data, self.crc), at + len(data)
        self._put(data)
        return at

    def end(self) -> None:
        self._put(struct.pack("<4sI2Q", b"PK\x07\x08", self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.header))

    def close(self) -> int:
        start = self.at
        for name, crc, size, header in self.members:
            wide = [x for x in (size, size, header) if x >= LIMIT32 or self.zip64]
            extra = struct.pack(f"<2H{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            narrow = lambda x: LIMIT32 if x >= LIMIT32 or self.zip64 else x
            self._put(CENTRAL.pack(CENTRAL_SIG, 45, 45, 8, 0, 0, DAY, crc, narrow(size), narrow(size),
                                   len(name), len(extra), 0, 0, 0, 0, narrow(header)) + name + extra)
        size, n = self.at - start, len(self.members)
        if self.zip64 or start >= LIMIT32 or size >= LIMIT32 or n >= LIMIT16:
            place = self.at
            self._put(END64.pack(END64_SIG, END64.size - 12, 45, 45, 0, 0, n, n, size, start))
            self._put(PLACE64.pack(PLACE64_SIG, 0, place, 1))
            self._put(END.pack(END_SIG, 0, 0, LIMIT16, LIMIT16, LIMIT32, LIMIT32, 0))
        else:
            self._put(END.pack(END_SIG, 0, 0, n, n, size, start, 0))
        return self.at


def read_range(f, start: int, size: int) -> bytes:
    f.seek(start)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"{size} bytes expected at {start}, {len(data)} found")
    return data


def central_directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """Stored members of a ZIP file: name to (offset of the data, size, checksum)."""
    tail_size = min(size, END.size + LIMIT16 + PLACE64.size)
    tail = read_range(f, size - tail_size, tail_size)
    at = tail.rfind(END_SIG, 0, len(tail) - END.size + 4)
    while at >= 0 and at + END.size + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END_SIG, 0, at + 3)  # the signature may stand in the comment
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, length, start, _ = END.unpack_from(tail, at)
    if LIMIT16 == n or LIMIT32 in (length, start):
        place = size - tail_size + at - PLACE64.size
        sig, _, where, _ = PLACE64.unpack(read_range(f, place, PLACE64.size))
        if sig == PLACE64_SIG:
            sig, *_, n, length, start = END64.unpack(read_range(f, where, END64.size))
            if sig != END64_SIG:
                raise ValueError("no ZIP64 end record")
    data, out, at = read_range(f, start, length), {}, 0
    for _ in range(n):
        sig, _, _, _, method, _, _, crc, packed, plain, name_size, extra_size, comment, _, _, _, header = CENTRAL.unpack_from(data, at)
        if sig != CENTRAL_SIG:
            raise ValueError("broken central directory")
        at += CENTRAL.size
        name, extra = data[at:at + name_size].decode(), data[at + name_size:at + name_size + extra_size]
        at += name_size + extra_size + comment
        field = 0
        while field + 4 <= len(extra):
            kind, held = struct.unpack_from("<2H", extra, field)
            if kind == 1:  # 64-bit values of the fields that hold the limit, in order
                wide = iter(struct.unpack_from(f"<{held // 8}Q", extra, field + 4))
                plain, packed, header = (next(wide) if x == LIMIT32 else x for x in (plain, packed, header))
            field += 4 + held
        if method == 0 and packed == plain:
            local = LOCAL.unpack(read_range(f, header, LOCAL.size))
            if local[0] != LOCAL_SIG:
                raise ValueError("broken local header")
            out[name] = (header + LOCAL.size + local[9] + local[10], plain, crc)
    return out


def page_uri(page_id: object) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(page_id: object, url: str | None, payload: bytes, refers_to: object) -> bytes:
    """One WARC record: an HTTP response, or a revisit that has its headers alone."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block += b"" if revisit else payload
    uri = re.sub(r"\s", lambda m: "%%%02X" % ord(m[0]), url) if url else None  # a header is one line
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{page_uri(page_id)}>",
             "WARC-Date: 1980-01-01T00:00:00Z", *([f"WARC-Target-URI: {uri}"] if uri else []), f"WARC-Payload-Digest: {digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: <{page_uri(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[:int(headers["content-length"])]


def mark_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html and refers_to (null for responses).

    Only payloads that occur more than once are joined back; both sides of
    that join are shuffled by digest and can be split where one is hot.
    """
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.octet_length(body).alias("size"), F.sha1(body.cast("binary")).alias("digest"))
    first = (rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.count("*").alias("n"), F.max("page_id").alias("latest"))
             .where("n > 1").select(F.col("digest").alias("of"), "latest"))
    return (rows.join(cut(first), F.col("digest") == F.col("of"), "left")
            .select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("latest")), F.col("latest")).alias("refers_to")))


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html, refers_to); returns path and size of each package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        writer, name, index = None, "", []

        def finish() -> list:
            writer.end()
            writer.begin(INDEX)
            writer.write("".join(index).encode())
            writer.end()
            size = writer.close()
            writer.out.close()
            return [[name], [size]]

        for b in batches:
            for at in range(0, b.num_rows, 500):
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.slice(at, 500).columns), strict=True):
                    if writer is None:
                        name, index = f"{root}/{uuid.uuid4().hex}.wacz", []
                        writer = PackageWriter(store.open_output_stream(name))
                        writer.begin(ARCHIVE)
                    data = gzip.compress(record(page_id, url, html.encode(), refers_to), 1, mtime=0)
                    index.append(f"{page_uri(page_id)} {writer.write(data)} {len(data)}\n")
                    if writer.size >= package_bytes:
                        yield finish()
                        writer = None
        if writer is not None:
            yield finish()

    return map_arrow(pages, run, "path string, size long")


def list_records(packages: DataFrame, folder: str) -> DataFrame:
    """path, offset (in the package) and length of every record, from the packages' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with store.open_input_file(path) as f:
                    members = central_directory(f, size)
                    data, held, crc = members[INDEX]
                    lines = read_range(f, data, held)
                if zlib.crc32(lines) != crc:
                    raise ValueError(f"{path}: broken index")
                begin = members[ARCHIVE][0]
                fields = [x.rsplit(" ", 2) for x in lines.decode().splitlines()]
                yield [[path] * len(fields), [begin + int(x[1]) for x in fields], [int(x[2]) for x in fields]]

    return map_arrow(packages, run, "path string, offset long, length long")


RECORD = "record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def read_records(records: DataFrame, folder: str, tasks: int, payloads: bool = True) -> DataFrame:
    """Range-reads records; a payload is checked against its digest and null for revisits.

    Records are dealt out anew over ``tasks`` tasks (their rows are small, so their number
    can't be told from them), so a large package is read by many; neighbours in a package are
    read together.
    """
    dealt = records.repartition(tasks, "path", F.floor(F.col("offset") / MOST_READ)).sortWithinPartitions("path", "offset")

    def parsed(data: bytes) -> tuple:
        headers, block = parse_record(gzip.decompress(data))
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)[1])
        digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
        revisit = headers["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{headers['warc-record-id']}: broken payload")
        return (headers["warc-record-id"].strip("<>"), headers["warc-type"], headers.get("warc-target-uri"), size, digest,
                headers["warc-refers-to"].strip("<>") if revisit else None, payload if payloads and not revisit else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        store, _ = fs.FileSystem.from_uri(folder)
        path, f = None, None
        for b in batches:
            for at in range(0, b.num_rows, READ_ROWS):
                out, start, data = [], 0, b""
                rows = list(zip(*(c.to_pylist() for c in b.slice(at, READ_ROWS).columns), strict=True))
                for i, (where, offset, length) in enumerate(rows):
                    if where != path:
                        if f is not None:
                            f.close()
                        path, f, data = where, store.open_input_file(where), b""
                    if not start <= offset or offset + length > start + len(data):
                        stop = offset + length
                        for nxt, o, n in rows[i + 1:]:
                            if nxt != path or o > stop + GAP_BYTES or o + n - offset > MOST_READ:
                                break
                            stop = o + n
                        start, data = offset, read_range(f, offset, stop - offset)
                    out.append(parsed(data[offset - start:offset - start + length]))
                yield [list(x) for x in zip(*out, strict=True)]
        if f is not None:
            f.close()

    return map_arrow(dealt, run, RECORD)


def new_folder(spark: SparkSession) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root if '://' in root or root.startswith('file:') else 'file://' + root}/packages-{uuid.uuid4().hex}"


def archive_and_read(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as packages and reads all records back."""
    folder = new_folder(pages.sparkSession)
    folder = folder.replace("file:/", "file:///", 1) if re.match(r"file:/[^/]", folder) else folder
    packages = cut(write_packages(mark_revisits(pages), folder))
    number, size = packages.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    listed = list_records(packages.repartition(max(1, min(number, MOST_LISTERS)), "path"), folder)
    return read_records(listed, folder, 1 + size // TASK_BYTES, payloads)


def digest(records: DataFrame, kind: str) -> DataFrame:
    """The columns of the query; ids come back from the records' URIs."""
    number = lambda c: F.nullif(F.regexp_replace(c, "^urn:page:", ""), F.lit("")).cast(kind)
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number("refers_to").alias("refers_to"))
