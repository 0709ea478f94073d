"""WARC records in ZIP-packaged archives.

Writing: each task streams its records into archives of bounded size. An archive is a ZIP file with
two stored (uncompressed) members: the WARC data, in which every record is its own gzip member, and
an index with the place of every record. The task's rows name the archives it finished; the table of
these rows, written by Spark, is the list of valid archives, so an archive left by a lost or repeated
task is never read.

Reading parses the end of the file, the ZIP64 and central directories and the local header to find
the stored members, reads the index, and then reads records by byte range. Nothing is extracted.
Ranges of neighbouring records are spread over tasks, so an archive is not one task.

Payloads of at least ``least`` bytes that occur more than once are stored once: the row with the
smallest page id is a response, the others are revisits that name it.

Defined results: a null html is an empty payload and a null url an empty one; rows with a null page
id are responses unless their payload is also on a page with an id; repeated rows give one record each,
all responses if they share the smallest page id. An empty table gives no archives and no records.
Other columns are ignored.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import utf8_slices
from ledgerloom.operators.materialize import materialize

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "path string, records long"
RECORDS = ("archive string, offset long, record_type string, page_id long, url string,"
           " payload_digest string, payload_length long, refers_to long, payload binary")


def _open(path: str):
    """The file system of ``path`` (file, hdfs, viewfs, s3, gs, ...) and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


# Records


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _number(name: str) -> int | None:
    tail = name.strip("<>").rpartition(":")[2]
    return int(tail) if tail else None


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def build_record(page_id: int | None, url: str, payload: bytes, digest: str,
                 refers_to: int | None) -> bytes:
    block = HTTP % len(payload)
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE),
               ("WARC-Target-URI", _line(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("WARC-Payload-Length", str(len(payload)))]
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]
    headers += [("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", str(len(block)))]
    written = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return b"WARC/1.1\r\n" + written + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The WARC headers and the payload (empty for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


# Archives


class _Archive:
    """One archive being written, front to back."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        system, inside = _open(self.path)
        system.create_dir(inside.rpartition("/")[0], recursive=True)
        self._stream = system.open_output_stream(inside)
        self._zip = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(DATA, "w", force_zip64=True)
        self._index: list[str] = []
        self.size = 0

    @property
    def records(self) -> int:
        return len(self._index)

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self._data.write(packed)
        self._index.append(json.dumps([page_id, self.size, len(packed)]))
        self.size += len(packed)

    def close(self) -> None:
        self._data.close()
        self._zip.writestr(INDEX, "\n".join(self._index))
        self._zip.close()
        self._stream.close()


def members(read, size: int) -> dict[str, tuple[int, int]]:
    """Offset and length of the stored members of a ZIP file.

    ``read(offset, length)`` gives bytes of the file.
    """
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    length, start = struct.unpack_from("<II", tail, end + 12)
    locator = end - 20
    if locator >= 0 and tail[locator:locator + 4] == b"PK\x06\x07":
        at, = struct.unpack_from("<Q", tail, locator + 8)
        zip64 = read(at, 56)
        if zip64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        length, start = struct.unpack_from("<QQ", zip64, 40)
    directory, at, found = read(start, length), 0, {}
    while at < len(directory):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", directory, at + 20)
        header, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + names].decode()
        extra = directory[at + 46 + names:at + 46 + names + extras]
        # The ZIP64 field holds, in this order, those of the values that did not fit.
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                if plain == 0xFFFFFFFF:
                    plain = wide.pop(0)
                if packed == 0xFFFFFFFF:
                    packed = wide.pop(0)
                if header == 0xFFFFFFFF:
                    header = wide.pop(0)
            extra = extra[4 + n:]
        at += 46 + names + extras + comments
        if method != 0:
            continue
        local = read(header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("damaged local header")
        local_names, local_extras = struct.unpack_from("<HH", local, 26)
        found[name] = (header + 30 + local_names + local_extras, packed)
    return found


# Spark


def find_revisits(pages: DataFrame, least: int) -> DataFrame:
    """``page_id``, ``digest`` and ``refers_to`` of the rows to store as revisits; no payloads."""
    slim = pages.where(F.col("length") >= least).select("page_id", "digest")
    first = slim.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where(
            "n > 1 AND refers_to IS NOT NULL").drop("n")
    return slim.join(first, "digest").where(
        "page_id IS NULL OR page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, *, least: int = 100,
                   archive_bytes: int = 64 << 20, archive_records: int = 100_000) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``.

    Returns the table of archives. The row's payload is not shuffled where the revisits are few
    enough for the planner to broadcast; else rows are joined on (page_id, digest).
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        payload.alias("payload"), F.octet_length(payload).alias("length"),
                        F.sha2(payload, 256).alias("digest"))
    revisits = materialize(find_revisits(base, least), "warc_revisits")
    same = base["page_id"].eqNullSafe(revisits["page_id"]) & (base["digest"] == revisits["digest"])
    rows = base.join(revisits, same, "left").select(
        base["page_id"], "url", "payload", base["digest"], "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in utf8_slices(batches, 64):
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                archive = archive or _Archive(folder)
                archive.add(row[0], build_record(*row))
                if archive.size >= archive_bytes or archive.records >= archive_records:
                    archive.close()
                    yield pa.RecordBatch.from_pydict(
                        {"path": [archive.path], "records": [archive.records]})
                    archive = None
        if archive:
            archive.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [archive.path], "records": [archive.records]})

    listed = f"{folder}-archives"
    rows.mapInArrow(run, FILES).write.parquet(listed)
    return pages.sparkSession.read.schema(FILES).parquet(listed)


# Reading: up to so many tasks, whatever they read, and from there on a task for so many bytes.
LEAST_PARTS = 200
PART_BYTES = 64 << 20


def locate(archives: DataFrame, range_bytes: int = 4 << 20) -> DataFrame:
    """Byte ranges of whole records: ``path``, ``start`` and the record ``sizes`` in the range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in utf8_slices(batches, 1):
            path = batch.column(0)[0].as_py()
            system, inside = _open(path)
            with system.open_input_file(inside) as file:
                def read(at: int, n: int, file=file) -> bytes:
                    return file.read_at(n, at)

                found = members(read, file.size())
                data_at, _ = found[DATA]
                lines = read(*found[INDEX]).decode().split("\n")
            start, sizes, held = data_at, [], 0
            for line in lines:
                _, at, n = json.loads(line)
                if sizes and held + n > range_bytes:
                    yield pa.RecordBatch.from_pydict(
                        {"path": [path], "start": [start], "sizes": [sizes]})
                    start, sizes, held = data_at + at, [], 0
                sizes.append(n)
                held += n
            yield pa.RecordBatch.from_pydict({"path": [path], "start": [start], "sizes": [sizes]})

    return archives.select("path").repartition("path").mapInArrow(
        run, "path string, start long, sizes array<long>")


def read_records(archives: DataFrame, range_bytes: int = 4 << 20) -> DataFrame:
    """Every record of the archives, its payload included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in utf8_slices(batches, 1):
            path, start, sizes = (c[0].as_py() for c in batch.columns)
            system, inside = _open(path)
            with system.open_input_file(inside) as file:
                raw = file.read_at(sum(sizes), start)
            rows, at = [], 0
            for n in sizes:
                headers, payload = parse_record(gzip.decompress(raw[at:at + n]))
                refers = headers.get("WARC-Refers-To")
                rows.append((
                    path, start + at, headers["WARC-Type"], _number(headers["WARC-Record-ID"]),
                    headers["WARC-Target-URI"],
                    headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                    int(headers["WARC-Payload-Length"]), refers and _number(refers), payload))
                at += n
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(),
                     pa.int64(), pa.int64(), pa.binary()]
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 64]), kinds)],
                    [f.split()[0] for f in RECORDS.split(", ")])

    ranges = materialize(locate(archives, range_bytes), "warc_ranges")
    # A range is a short row that stands for megabytes, so its partitions are numbered: Spark would
    # fold rows of so few bytes into one task.
    parts = max(1, min(ranges.count(), max(LEAST_PARTS, _bytes(ranges) // PART_BYTES)))
    return ranges.repartition(parts, "path", "start").mapInArrow(run, RECORDS)


def _bytes(ranges: DataFrame) -> int:
    return ranges.agg(F.sum(F.expr("aggregate(sizes, 0L, (n, s) -> n + s)"))).first()[0] or 0
