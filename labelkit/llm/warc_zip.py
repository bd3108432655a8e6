"""WARC records in ZIP packages: written by Spark's writer, read by ranges without extraction.

An archive is a ZIP file of stored members: WARC files (a gzip member for each record, or
plain records), indexes with a line for each record, and others that are not read.  The
writer makes ``archive/data.warc.gz``, ``indexes/index.cdx`` (JSON lines) and
``datapackage.json``; the reader takes the members from the directory, and any number of them.

Reading: Spark lists the archives by path and length, without content.  The end of a
file gives the central directory (or, by its locator, the ZIP64 one), that the members.
Indexes (JSON lines with offset, length and filename after any key, such as CDXJ, or CDX
with a header of field letters; gzipped or not) give record ranges, each matched with the
member whose name ends with the filename.  WARC members that no index names are walked from
record to record.  The ranges are a table, dealt by ranges of (path, offset), and each task
reads neighbouring ranges together, up to ``READ_BYTES``.  So tasks hold pieces of archives,
however long these are.  Files are opened by pyarrow's file systems (local and mounted files,
S3, GCS, Azure, HDFS where libhdfs is installed).  In a store that pyarrow does not
know, Spark's binaryFile source delivers whole archives, which then must be under 2 GiB.

Archives close at ``archive_bytes`` of compressed records, so a writing task holds one of bounded size.

Writing: of records with equal payloads of ``least`` bytes or more, the one with
the largest id is a response, the others are revisits that refer to it (by its page id
and address).  Digests alone are grouped (a maximum, combined before the shuffle); a payload
that very many pages share is looked up by broadcast.  Pages then get their rows' answers by
id (only pages that a bit table of ids does not prove to be responses are shuffled),
are packed within their tasks and written a file each by Spark's text writer,
which commits through the job's protocol: a lost task leaves no file.  The line end
that it adds is the ZIP's comment.  Every record has an id of its own.

Defined results: a null payload is empty.  Rows with a null id are always
responses, as are rows that share the response's id.  Dates are the epoch: the
tables have none.  An archive without records is not written.  Other columns are
not archived.  Records of foreign archives without a page id have a null one.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from itertools import count, islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm.common import chunks, lookup, parted, released, written

LEAST, ARCHIVE_BYTES = 1000, 8_000_000
#: Neighbouring ranges read at once, the step in which members without an index are walked, and records read by one task.
READ_BYTES, STEP_BYTES, TASK_BYTES = 4_000_000, 1_000_000, 32_000_000
WARC, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdx", "datapackage.json"
_DATE = "1970-01-01T00:00:00Z"

# ------------------------------------------------------------------ ZIP reading


class Archive:
    """Members of a ZIP file that is read by ranges."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        self.members = self._directory()
        self._data: dict[str, int] = {}

    @classmethod
    def of_file(cls, file: io.BufferedIOBase) -> Archive:
        def read(offset: int, n: int) -> bytes:
            file.seek(offset)
            return file.read(n)

        return cls(read, file.seek(0, io.SEEK_END))

    @classmethod
    def of_bytes(cls, data: bytes | memoryview) -> Archive:
        view = memoryview(data)
        return cls(lambda offset, n: bytes(view[offset : offset + n]), len(view))

    def _directory(self) -> dict[str, tuple[int, int, int, int]]:
        """name -> (method, stored size, size, offset of the local header)."""
        tail_at = max(0, self.size - 65_557)  # the record and its longest comment
        tail = self.read(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] > len(tail)):
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        count, length, offset = struct.unpack_from("<HII", tail, end + 10)
        if count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
            locator = self.read(tail_at + end - 20, 20) if tail_at + end >= 20 else b""
            if locator[:4] == b"PK\x06\x07":
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != b"PK\x06\x06":
                    raise ValueError("broken ZIP64 end of central directory")
                count, length, offset = struct.unpack_from("<QQQ", record, 32)
        data, at, out = self.read(offset, length), 0, {}
        for _ in range(count):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            stored, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
            (local,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<HH", extra)
                if kind == 1:  # ZIP64: of these three, those that do not fit in 32 bits, in this order
                    wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                    size = next(wide) if size == 0xFFFFFFFF else size
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    local = next(wide) if local == 0xFFFFFFFF else local
                extra = extra[4 + n :]
            out[name] = (method, stored, size, local)
            at += 46 + n_name + n_extra + n_comment
        return out

    def member(self, name: str, offset: int = 0, n: int | None = None) -> bytes:
        """A range of a stored member; a deflated one is refused, since it has no ranges."""
        method, stored, _, local = self.members[name]
        if method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} is compressed in the ZIP: it can't be read by ranges")
        if name not in self._data:
            head = self.read(local, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header of {name}")
            n_name, n_extra = struct.unpack_from("<HH", head, 26)
            self._data[name] = local + 30 + n_name + n_extra
        n = stored - offset if n is None else n
        if offset < 0 or offset + n > stored:
            raise ValueError(f"range outside {name}")
        return self.read(self._data[name] + offset, n)

    def at(self, name: str) -> tuple[int, int]:
        """Where a stored member's data begins in the file, and its size."""
        self.member(name, 0, 0)
        return self._data[name], self.members[name][1]

    def ranges(self) -> Iterator[tuple[int, int]]:
        """Offset in the file and length of every record: those that indexes name, then those of members that none names."""
        warcs = [m for m in self.members if re.search(r"\.warc(\.gz)?$", m)]
        named = set()
        for index in (m for m in self.members if re.search(r"\.cdxj?(\.gz)?$", m)):
            for filename, offset, length in index_lines(self._lines(index)):
                fits = [m for m in warcs if filename is None or m == filename or m.endswith(f"/{filename}")]
                if len(fits) != 1:
                    raise ValueError(f"{index}: {len(fits)} members fit {filename}")
                begin, size = self.at(fits[0])
                if offset < 0 or offset + length > size:
                    raise ValueError(f"{index}: a range outside {fits[0]}")
                named.add(fits[0])
                yield begin + offset, length
        for name in warcs:
            if name not in named:
                yield from self._walk(name)

    def _lines(self, name: str) -> Iterator[str]:
        _, size = self.at(name)
        unzip = zlib.decompressobj(31) if name.endswith(".gz") else None
        rest = b""
        for k in range(0, size, STEP_BYTES):
            data = self.member(name, k, min(STEP_BYTES, size - k))
            while unzip and data:
                rest += unzip.decompress(data)
                data = unzip.unused_data
                unzip = zlib.decompressobj(31) if unzip.eof else unzip
            *lines, rest = (rest + data).split(b"\n")
            yield from (x.decode() for x in lines)
        yield rest.decode()

    def _walk(self, name: str) -> Iterator[tuple[int, int]]:
        """Ranges of a member's records: gzip members, or plain records by their Content-Length."""
        begin, size = self.at(name)
        zipped = self.member(name, 0, min(2, size)) == b"\x1f\x8b"
        at = 0
        while at < size:
            if zipped:
                unzip, end = zlib.decompressobj(31), at
                while not unzip.eof and end < size:
                    data = self.member(name, end, min(STEP_BYTES if end > at else 64_000, size - end))
                    unzip.decompress(data)
                    end += len(data) - len(unzip.unused_data)
                n = end - at
            else:
                head = self.member(name, at, min(64_000, size - at))
                if b"\r\n\r\n" not in head:
                    raise ValueError(f"{name}: no record at {at}")
                length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)
                n = head.index(b"\r\n\r\n") + 4 + int(length[1]) + 4
            yield begin + at, min(n, size - at)
            at += n

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Header fields and payload of every record."""
        for at, n in self.ranges():
            yield unpack_record(self.read(at, n))


def index_lines(lines: Iterator[str]) -> Iterator[tuple[str | None, int, int]]:
    """Filename (or None), offset and length of each record that an index's lines name."""
    letters: list[str] | None = None
    for line in lines:
        line = line.strip()
        if not line or line.startswith("!"):
            continue
        if line.startswith("CDX "):
            letters = line.split()[1:]
        elif "{" in line:
            entry = json.loads(line[line.index("{") :])
            yield entry.get("filename"), int(entry["offset"]), int(entry["length"])
        elif letters:
            entry = dict(zip(letters, line.split(), strict=True))
            yield entry.get("g"), int(entry["V"]), int(entry["S"])
        else:
            raise ValueError("an index line has no JSON, and no header names its fields")


def unpack_record(data: bytes) -> tuple[dict[str, str], bytes]:
    return parse_record(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)


# ----------------------------------------------------------------- WARC records


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None = None, name: str = "") -> bytes:
    """A response record, or a revisit record (without payload) if ``refers_to`` is given; ``name`` makes its id unique."""
    digest = hashlib.sha1(payload).digest()
    uri = lambda x: "".join(c if 0x20 < ord(c) < 0x7F else "".join(f"%{b:02X}" for b in c.encode()) for c in x or "")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}|{page_id}|{url}|{digest.hex()}')}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": uri(url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        fields["X-Page-ID"] = str(page_id)
    if refers_to is not None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To-Target-URI"] = uri(refers_url)
        fields["WARC-Refers-To-Date"] = _DATE
        fields["X-Refers-To-Page-ID"] = str(refers_to)
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """WARC fields (and Content-Length of the HTTP head as ``http-length``), and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    for line in http.decode("latin-1").split("\r\n")[1:]:
        if line.lower().startswith("content-length:"):
            fields["http-length"] = line.partition(":")[2].strip()
    return fields, payload


class _Package:
    """An archive that is being filled; ``name`` is no other one's."""

    def __init__(self, name: str):
        self.name, self.data, self.index = name, io.BytesIO(), []

    def add(self, page_id, url, payload: bytes, refers_to, refers_url) -> None:
        at = self.data.tell()
        body = gzip.compress(make_record(page_id, url, payload, refers_to, refers_url, f"{self.name}/{at}"), 1, mtime=0)
        self.data.write(body)
        entry = {"offset": at, "length": len(body), "filename": WARC, "type": "response" if refers_to is None else "revisit", "page": page_id}
        self.index.append(f"{'' if page_id is None else page_id} {json.dumps(entry)}")

    def close(self) -> bytes:
        out, members = io.BytesIO(), {WARC: self.data.getvalue(), INDEX: "".join(f"{x}\n" for x in sorted(self.index)).encode()}
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            listed = [{"path": k, "bytes": len(v), "crc32": zlib.crc32(v)} for k, v in members.items()]
            for name, data in (*members.items(), (PACKAGE, json.dumps({"resources": listed}).encode())):
                z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data)
            z.comment = b"\n"
        return out.getvalue()


# ------------------------------------------------------------------- Spark jobs


def revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """(id, digest, refers_to, refers_url) of the pages whose payload a page with a larger id holds too."""
    payload = F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8")
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).filter((F.col("n") >= least) & F.col("id").isNotNull())
    own = written(own.select("id", "url", "digest"), "page-digests")
    best = own.groupBy("digest").agg(F.max("id").alias("refers_to"), F.max(F.struct("id", "url")).getField("url").alias("refers_url"), F.count("*").alias("times")).filter("times > 1")
    return lookup(own, written(best, "page-copies"), "digest", "times", own.count()).filter("id <> refers_to").select("id", "digest", "refers_to", "refers_url").distinct()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a WARC record for every row of ``pages`` to archives in the new folder ``path``."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("text"))
    known = written(revisits(pages, id_col, url_col, payload_col, least), "page-revisits")
    again, single = parted(rows, "id", known.select("id"))
    again = again.withColumn("digest", F.sha1(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    again = again.join(known, ["id", "digest"], "left").select("id", "url", "text", "refers_to", "refers_url")
    answered = again.unionByName(single.withColumns({c: F.lit(None).cast(known.schema[c].dataType) for c in ("refers_to", "refers_url")}))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(package: _Package) -> pa.RecordBatch:
            # The text writer ends the file with a line end: the comment's only byte.
            return pa.RecordBatch.from_pydict({"zip": pa.array([package.close()[:-1]], pa.binary())})

        names = (f"{TaskContext.get().partitionId()}.{k}" for k in count())
        package = _Package(next(names))
        for batch in batches:
            for part in chunks(batch):
                for id_, url, text, refers_to, refers_url in zip(*(part.column(c).to_pylist() for c in ("id", "url", "text", "refers_to", "refers_url")), strict=True):
                    package.add(id_, url, (text or "").encode(), refers_to, refers_url)
                    if package.data.tell() >= archive_bytes:
                        yield done(package)
                        package = _Package(next(names))
        if package.index:
            yield done(package)

    packed = answered.mapInArrow(released(pack), "zip binary").select(F.col("zip").cast("string").alias("value"))
    packed.write.option("maxRecordsPerFile", 1).text(path)


def opened(path: str) -> pafs.FileSystem | None:
    """pyarrow's file system for a path, or None if it knows none."""
    try:
        return pafs.FileSystem.from_uri(path)[0]
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return None


def _reader(path: str) -> tuple[Callable[[int, int], bytes], Callable[[], None]]:
    """A ranged reader of a file, and what closes it."""
    store, name = pafs.FileSystem.from_uri(path)
    file = store.open_input_file(name)
    return (lambda at, n: file.read_at(n, at)), file.close


_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
_SCHEMA = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def _row(fields: dict[str, str], payload: bytes, payloads: bool) -> tuple:
    digest = fields.get("warc-payload-digest", "")
    digest = base64.b32decode(digest.removeprefix("sha1:")) if digest.startswith("sha1:") and len(digest) == 37 else None
    response = fields["warc-type"] == "response"
    if response and digest is not None and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    page, refers = (int(fields[k]) if k in fields else None for k in ("x-page-id", "x-refers-to-page-id"))
    size = len(payload) if response or "http-length" not in fields else int(fields["http-length"])
    return page, fields.get("warc-target-uri"), fields["warc-type"], digest.hex() if digest else None, size, refers, payload if payloads and response else None


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if len(held) >= 1000 or size > READ_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _FIELDS.values(), strict=True)], names=[*_FIELDS])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _FIELDS.values(), strict=True)], names=[*_FIELDS])


def record_ranges(files: DataFrame) -> DataFrame:
    """(path, at, n) of all records of the archives in ``files`` (path, length): directories and indexes are read, no records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                read, close = _reader(path)
                ranges = Archive(read, length).ranges()
                while held := list(islice(ranges, 50_000)):
                    yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(held)), "at": pa.array([a for a, _ in held], pa.int64()), "n": pa.array([n for _, n in held], pa.int64())})
                close()

    return files.select("path", "length").mapInArrow(released(run), "path string, at long, n long")


def _neighbours(ranges: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Ranges of one file that follow each other without a gap, up to READ_BYTES (a longer one is alone)."""
    path, held = None, []
    for p, at, n in ranges:
        if held and (p != path or at != sum(held[-1]) or at + n - held[0][0] > READ_BYTES):
            yield path, held
            held = []
        path = p
        held.append((at, n))
    if held:
        yield path, held


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_digest (hex), payload_bytes (of the full payload), refers_to, payload."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    some = files.select("path").first()
    if some is not None and opened(some.path) is None:

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for content in batch.column("content"):
                    yield from _batches(_row(*x, payloads) for x in Archive.of_bytes(content.as_buffer()).records())

        return files.select("content").mapInArrow(released(whole), _SCHEMA)
    ranges = written(record_ranges(files), "record-ranges")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now = read = close = None
            listed = (x for batch in batches for x in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "n")), strict=True))
            for file, some in _neighbours(listed):
                if file != now:
                    if close:
                        close()
                    now, (read, close) = file, _reader(file)
                begin = some[0][0]
                data = read(begin, sum(some[-1]) - begin)
                for at, n in some:
                    yield _row(*unpack_record(data[at - begin : at - begin + n]), payloads)
            if close:
                close()

        yield from _batches(rows())

    # A fixed number of parts: Spark would join them by the size of the ranges' rows, not of what they name.
    parts = 1 + (ranges.agg(F.sum("n")).first()[0] or 0) // TASK_BYTES
    return ranges.repartitionByRange(parts, "path", "at").sortWithinPartitions("path", "at").mapInArrow(released(fetch), _SCHEMA)
