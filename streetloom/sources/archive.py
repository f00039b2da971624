"""Web archives (WARC and ARC, plain or gzip) as DataFrames.

Archives are read as streams and handed over in Arrow batches bounded by size, so neither the
file nor its pages are ever held as a whole.  There are three ways in:

* ``scan_archives(manifest)`` reads the files named by the rows of a DataFrame, a large file
  per task and small ones together.  It works on batch and streaming manifests alike and never
  lists files on the driver.
* ``archive_ranges(manifest)`` finds places where a file can be cut: records that begin a gzip
  member.  ``scan_ranges`` reads these parts, so many tasks share one large file.  The table of
  parts can be kept; finding them inflates a file once.
* ``spark.read.format("webarchive").load(path)`` reads a folder or a file, small files together;
  a filter on ``rec_type`` is pushed into the reader.

A file that cannot be read to its end adds one row with ``error`` set; other files go on.
"""

from __future__ import annotations

import gzip
import io
import re
import uuid
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from streetloom.operators import tables
from streetloom.schemas import ARCHIVE_SCHEMA
from streetloom.session import qualified_path

_ARROW = pa.schema(
    [
        ("file_id", pa.string()),
        ("ordinal", pa.int64()),
        ("rec_type", pa.string()),
        ("target_uri", pa.string()),
        ("warc_rec_id", pa.string()),
        ("warc_date", pa.string()),
        ("http_content_type", pa.string()),
        ("body", pa.binary()),
        ("error", pa.string()),
    ]
)
_BATCH_ROWS = 1000
_BATCH_BYTES = 16 << 20


#: Files or parts of so many bytes have a task of their own, smaller ones share tasks of about that.
TASK_BYTES = 64 << 20
#: What opening a file costs in a folder that is read as a source, in bytes read, and the tasks that
#: a folder of as many small files has at least; nothing there knows the cores of the cluster.
OPEN_BYTES = 1 << 20
LEAST_TASKS = 64
#: How a part of a file is given: bytes from ``start`` up to ``stop`` (null: the end), and the
#: number of its first record.
RANGE = "file_id string, start long, stop long, first long"


def _filesystem(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _join(base: str, file_id: str) -> str:
    """The place of a file below a qualified folder; absolute names stay on its file system."""
    if "://" in file_id:
        return file_id
    if file_id.startswith("/"):
        return re.match(r"(?:[a-z0-9+.-]+://[^/]*)?", base)[0] + file_id
    return f"{base.rstrip('/')}/{file_id}"


def _size(path: str) -> int:
    system, name = _filesystem(path)
    return system.get_file_info(name).size or 0


class _Part(io.RawIOBase):
    """The bytes of a file from ``start`` up to ``stop``."""

    def __init__(self, path: str, start: int = 0, stop: int | None = None):
        self.file = None
        system, name = _filesystem(path)
        if start or stop is not None:
            self.file = system.open_input_file(name)
            self.file.seek(start)
        else:
            self.file = system.open_input_stream(name, compression=None, buffer_size=1 << 20)
        self.left = None if stop is None else stop - start

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        size = len(buffer) if self.left is None else min(len(buffer), self.left)
        data = self.file.read(size) if size else b""
        buffer[: len(data)] = data
        if self.left is not None:
            self.left -= len(data)
        return len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        super().close()


def _open(path: str, start: int = 0, stop: int | None = None) -> io.BufferedReader:
    stream = io.BufferedReader(_Part(path, start, stop), 1 << 20)
    return io.BufferedReader(gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else stream, 1 << 20)


class _Members(io.RawIOBase):
    """Inflates a gzip file and notes where its members begin."""

    def __init__(self, stream):
        self.stream, self.inflate, self.pending = stream, None, b""
        self.read_to = self.made = 0
        self.edges: deque[tuple[int, int]] = deque()  # places in the text and in the file

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if not self.pending:
                self.pending = self.stream.read(1 << 16)
                if not self.pending:
                    if self.inflate is not None:
                        raise EOFError("a member ends early")
                    return 0
            if self.inflate is None:
                filled = self.pending.lstrip(b"\0")  # padding between members
                self.read_to += len(self.pending) - len(filled)
                self.pending = filled
                if not filled:
                    continue
                self.edges.append((self.made, self.read_to))
                self.inflate = zlib.decompressobj(31)
            before = len(self.pending)
            data = self.inflate.decompress(self.pending, len(buffer))
            over = self.inflate.eof
            self.pending = self.inflate.unused_data if over else self.inflate.unconsumed_tail
            self.read_to += before - len(self.pending)
            if over:
                self.inflate = None
            if data:
                buffer[: len(data)] = data
                self.made += len(data)
                return len(data)

    def edge(self, place: int) -> int | None:
        """Where in the file the member begins whose text begins at ``place``."""
        while self.edges and self.edges[0][0] < place:
            self.edges.popleft()
        return self.edges[0][1] if self.edges and self.edges[0][0] == place else None


class _Counted:
    """Counts what is read from a stream."""

    def __init__(self, stream):
        self.stream, self.place = stream, 0

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.place += len(data)
        return data

    def readline(self) -> bytes:
        line = self.stream.readline()
        self.place += len(line)
        return line


def _headers(stream) -> dict[str, str]:
    found: dict[str, str] = {}
    name = None
    for raw in iter(stream.readline, b""):
        line = raw.decode("utf-8", "replace").rstrip("\r\n")
        if not line:
            break
        if line[0] in " \t" and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            found.setdefault(name, value.strip())
    return found


def _skip(stream, size: int) -> None:
    while size > 0:
        got = len(stream.read(min(size, 1 << 20)))
        if not got:
            raise EOFError("record ends early")
        size -= got


def _take(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) < size:
        raise EOFError("record ends early")
    return data


def _dechunk(data: bytes) -> bytes:
    stream, out = io.BytesIO(data), []
    while match := re.match(rb"\s*([0-9a-fA-F]+)[^\n]*\n$", stream.readline()):
        size = int(match[1], 16)
        if not size:
            return b"".join(out)
        out.append(stream.read(size))
        stream.readline()
    return b"".join(out) or data


def _http_body(payload: bytes) -> tuple[str | None, bytes]:
    """Content type and decoded body of a stored HTTP response."""
    stream = io.BytesIO(payload)
    if not payload.startswith(b"HTTP/"):
        return None, payload
    stream.readline()
    headers = _headers(stream)
    body = stream.read()
    if "chunked" in headers.get("transfer-encoding", "").lower():
        body = _dechunk(body)
    coding = headers.get("content-encoding", "").lower()
    try:
        if coding in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif coding == "deflate":
            body = zlib.decompress(body, 15 if body[:1] == b"\x78" else -15)
    except (OSError, EOFError, zlib.error):
        pass  # stored already decoded: keep the bytes as they are
    return headers.get("content-type"), body


def _arc_record(line: bytes, file_id: str, ordinal: int):
    """Header line of the older format: URL, address, date, type, …, length."""
    parts = line.decode("utf-8", "replace").split()
    url, date, size = parts[0], parts[2], int(parts[-1])
    kind = "warcinfo" if url.startswith("filedesc://") else "response"
    iso = re.sub(r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", r"\1-\2-\3T\4:\5:\6Z", date)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{file_id}#{ordinal}")
    return kind, {"warc-target-uri": url, "warc-date": iso, "warc-record-id": f"<urn:uuid:{name}>"}, size


def _starts(stream, ordinal: int) -> Iterator[tuple[int, bytes]]:
    """Number and first line of each record; the rest of it must be read before the next."""
    for line in iter(stream.readline, b""):
        if line.strip():
            yield ordinal, line
            ordinal += 1


def _head(stream, line: bytes, file_id: str, ordinal: int):
    """Type, headers and length of a record."""
    if line.startswith(b"WARC/"):
        headers = _headers(stream)
        return headers.get("warc-type"), headers, int(headers["content-length"])
    return _arc_record(line, file_id, ordinal)


def _records(stream, file_id: str, only: str | None, first: int = 0) -> Iterator[tuple]:
    ordinal = first - 1
    try:
        for ordinal, line in _starts(stream, first):
            kind, headers, size = _head(stream, line, file_id, ordinal)
            if only is not None and kind != only:
                _skip(stream, size)
                continue
            content_type = body = None
            if kind == "response":
                content_type, body = _http_body(_take(stream, size))
            else:
                _skip(stream, size)
            yield (
                file_id,
                ordinal,
                kind,
                headers.get("warc-target-uri"),
                headers.get("warc-record-id"),
                headers.get("warc-date"),
                content_type,
                body,
                None,
            )
    except Exception as ex:  # noqa: BLE001 - one bad file must not end the job
        yield (file_id, ordinal, None, None, None, None, None, None, f"{type(ex).__name__}: {ex}")


def _file_records(
    file_id: str, path: str, only: str | None, start: int = 0, stop: int | None = None, first: int = 0
) -> Iterator[tuple]:
    try:
        stream = _open(path, start, stop)
    except Exception as ex:  # noqa: BLE001
        yield (file_id, first - 1, None, None, None, None, None, None, f"{type(ex).__name__}: {ex}")
        return
    with stream:
        yield from _records(stream, file_id, only, first)


def _file_ranges(file_id: str, path: str, every: int) -> Iterator[tuple]:
    """Parts of at least ``every`` bytes; a file that cannot be read on has a last part to its end."""
    start = first = 0
    try:
        with io.BufferedReader(_Part(path), 1 << 20) as raw:
            members = _Members(raw) if path.endswith(".gz") else None
            stream = _Counted(io.BufferedReader(members, 1 << 20) if members else raw)
            for ordinal, line in _starts(stream, 0):
                here = stream.place - len(line)
                at = members.edge(here) if members else here
                if at is not None and at - start >= every:
                    yield file_id, start, at, first
                    start, first = at, ordinal
                _skip(stream, _head(stream, line, file_id, ordinal)[2])
    except Exception:  # noqa: BLE001 - whoever reads the last part meets and reports it
        pass
    yield file_id, start, None, first


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[7] or b"")
        if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _dealt(parts: DataFrame, base: str, tasks: int | None) -> DataFrame:
    """Parts of files, shared out so that tasks read about the same number of bytes."""
    spark = parts.sparkSession
    if parts.isStreaming:
        return parts.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if tasks:
        return parts.repartitionById(tasks, F.pmod(F.xxhash64("file_id", "start"), F.lit(tasks)).cast("int"))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [
                (_size(_join(base, r["file_id"])) if r["stop"] is None else r["stop"]) - r["start"]
                for r in batch.to_pylist()
            ]
            yield batch.append_column("size", pa.array(sizes, pa.int64()))

    cores = spark.sparkContext.defaultParallelism
    sized = parts.repartition(cores).mapInArrow(measure, f"{RANGE}, size long")
    big = F.col("size") >= TASK_BYTES
    large, rows, bytes_ = sized.agg(
        F.count_if(big), F.count_if(~big), F.coalesce(F.sum(F.when(~big, F.col("size"))), F.lit(0))
    ).first()
    groups = min(rows, max(cores, -(-bytes_ // TASK_BYTES))) or 1
    small = sized.where(~big)
    if not large:
        return small.repartitionById(groups, F.pmod(F.xxhash64("file_id", "start"), F.lit(groups)).cast("int"))
    own = tables.with_row_id(sized.where(big), ["file_id", "start"])
    slots = own.select("*", F.col("row_id").alias("slot")).drop("row_id").unionByName(
        small.withColumn("slot", F.pmod(F.xxhash64("file_id", "start"), F.lit(groups)) + large)
    )
    return slots.repartitionById(large + groups, F.col("slot").cast("int"))


def scan_ranges(
    parts: DataFrame, root: str = "", tasks: int | None = None, only: str | None = None
) -> DataFrame:
    """Records of parts of archives (file_id, start, stop, first), as `archive_ranges` gives them."""
    base = qualified_path(parts.sparkSession, root)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                path = _join(base, r["file_id"])
                yield from _batches(
                    _file_records(r["file_id"], path, only, r["start"], r["stop"], r["first"])
                )

    parts = parts.select("file_id", "start", "stop", "first")
    return _dealt(parts, base, tasks).select(*parts.columns).mapInArrow(read, ARCHIVE_SCHEMA)


def scan_archives(
    manifest: DataFrame, root: str = "", tasks: int | None = None, only: str | None = None
) -> DataFrame:
    """Records of the archives named by ``manifest.file_id``, relative to ``root``.

    Large files get a task of their own, small ones share tasks by their bytes; another number
    of ``tasks`` can be asked for.  On a stream, whose files cannot be measured beforehand,
    they are shared out among the shuffle partitions of the session.  A path without a scheme
    is on the file system that Spark uses by default.  ``only`` keeps one record type and
    skips the bytes of others.
    """
    none = F.lit(None).cast("long")
    whole = manifest.select(
        "file_id", F.lit(0).cast("long").alias("start"), none.alias("stop"), F.lit(0).cast("long").alias("first")
    )
    return scan_ranges(whole, root, tasks, only)


def archive_ranges(
    manifest: DataFrame, root: str = "", every: int = TASK_BYTES, tasks: int | None = None
) -> DataFrame:
    """Where archives can be cut: parts of at least ``every`` bytes that begin with a record.

    Each archive is inflated once, by one task, and nothing of it is kept.  Files that are one
    gzip member have one part.
    """
    base = qualified_path(manifest.sparkSession, root)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_id in batch.column(0).to_pylist():
                found = list(zip(*_file_ranges(file_id, _join(base, file_id), every), strict=True))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(found, kinds, strict=True)],
                    names=["file_id", "start", "stop", "first"],
                )

    none = F.lit(None).cast("long")
    whole = manifest.select("file_id", F.lit(0).cast("long").alias("start"), none.alias("stop"), none.alias("first"))
    return _dealt(whole, base, tasks).select("file_id").mapInArrow(find, RANGE)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _grouped(sizes: dict[str, int]) -> list[list[str]]:
    """Files by the task that reads them: each large one alone, small ones by their bytes."""
    large = sorted(path for path, size in sizes.items() if size >= TASK_BYTES)
    costs = {path: sizes[path] + OPEN_BYTES for path in sorted(sizes.keys() - set(large))}
    share = min(TASK_BYTES, -(-sum(costs.values()) // LEAST_TASKS))
    groups: dict[int, list[str]] = {}
    before = 0
    for path, cost in costs.items():
        groups.setdefault(before // share, []).append(path)
        before += cost
    return [[path] for path in large] + list(groups.values())


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.only = path, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("rec_type",) and self.only is None:
                self.only = f.value
            else:
                yield f

    def partitions(self):
        system, name = _filesystem(self.path)
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        if system.get_file_info(name).type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(name, recursive=True))
            sizes = {scheme + f.path: f.size or 0 for f in found if re.search(r"\.w?arc(\.gz)?$", f.path)}
        else:
            sizes = {scheme + name: 0}
        return [_Files(paths) for paths in _grouped(sizes)]

    def read(self, partition: _Files):
        for path in partition.paths:
            yield from _batches(_file_records(path, path, self.only))


class WebArchiveSource(DataSource):
    """``spark.read.format("webarchive").load(folder_or_file)``."""

    @classmethod
    def name(cls):
        return "webarchive"

    def schema(self):
        return ARCHIVE_SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WebArchiveSource)


def good_records(scan: DataFrame) -> DataFrame:
    return scan.where(F.col("error").isNull())


def scan_errors(scan: DataFrame) -> DataFrame:
    """Files that could not be read to the end: file, last record reached, message."""
    return scan.where(F.col("error").isNotNull()).select("file_id", "ordinal", "error")
