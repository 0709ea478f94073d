"""Source files landed as they arrive.

A file-source stream finds new files. Each file is checked against its table's contract; a file that
breaks it goes to the quarantine and lands nothing, whatever else its batch holds and whatever comes
later. The others join the list of accepted files, which is a version of its own
(``sinks/manifest.py``), and the business days they touch are landed again from the accepted files.
A file counts once, so a repeated batch does nothing; one that died half-way lands whole days anew. After all
files the lake is that of a batch run over them. A mended file needs a new name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from fnmatch import fnmatch

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans import daily_run
from ledgerloom.plans.daily_run import Job, Window
from ledgerloom.sinks import manifest
from ledgerloom.sinks.tables import hadoop_path
from ledgerloom.sources import contracts, files, lake

# Noted for files that broke their contract or belong to no table.
SET_ASIDE = "none"
# The columns of the file source; the content is never read.
NAMES = "path string, modificationTime timestamp, length bigint, content binary"


def accepted_path(job: Job) -> str:
    return f"{job.root}/meta/accepted_files"


def table_of(job: Job, path: str) -> str | None:
    """The source table whose pattern the file's place below the source directory matches."""
    root = job.source_dir.rstrip("/")
    below = path[path.index(root) + len(root) + 1:] if root in path else path.rpartition("/")[2]
    return next((t for t, pattern in job.source_files.items() if fnmatch(below, pattern)), None)


def _empty(job: Job, table: str) -> DataFrame:
    fields = [T.StructField(c, T.StringType()) for c in contracts.CONTRACTS[table].columns]
    return job.spark.createDataFrame([], T.StructType(fields))


def _read(job: Job, table: str, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return _empty(job, table)
    return files.read_files(job.spark, files.headers_of(job.spark, paths), job.multi_line)


def _set_aside(job: Job, path: str, table: str, found: Sequence[object], run_id: str) -> None:
    now = job.clock()
    lake.quarantine(_read(job, table, [path]), job.root, table, now.date(), found, now, run_id)


def accept(job: Job, paths: Sequence[str], run_id: str) -> dict[str, list[str]]:
    """The files by table that keep their contracts; the others are set aside."""
    kept: dict[str, list[str]] = {}
    for path in sorted(paths):
        table = table_of(job, path)
        if table is None:
            continue
        found = contracts.drift(table, files.headers_of(job.spark, [path]).values())
        if found:
            _set_aside(job, path, table, found, run_id)
        else:
            kept.setdefault(table, []).append(path)
    return kept


def _days_of_lines(job: Job, lines: DataFrame) -> dt.date | None:
    """The first business day of the landed orders that some lines belong to."""
    orders = lake.read_raw(job.spark, job.root, "orders").select("order_id", files.EVENT_TIME)
    found = orders.join(lines.select("order_id").distinct(), "order_id", "left_semi")
    return found.agg(F.min(files.event_date())).first()[0]


def _qualified(job: Job, path: str) -> str:
    """One way to write a file's place, so that a known file is known however it is named."""
    target, fs = hadoop_path(job.spark, path)
    return fs.makeQualified(target).toString()


def land_files(job: Job, paths: Sequence[str], number: int) -> Window | None:
    """Accept a batch of files and land the days they touch; return these, if any."""
    spark = job.spark
    with manifest.writing(spark, accepted_path(job), f"batch {number}") as draft:
        known = dict(draft.base.facts)  # file: table and days
        run_id = f"stream-{number:08d}"
        names = {_qualified(job, p) for p in paths} - known.keys()
        if not names:
            return None  # a batch that is repeated
        fresh = accept(job, sorted(names), run_id)
        starts: list[dt.date] = []
        for path in fresh.get("orders", ()):
            orders = _read(job, "orders", [path])
            first, last, unreadable = files.event_profile(orders).first()
            if unreadable:
                daily_run.set_aside_unreadable(job, orders, first or job.clock().date(), run_id)
            known[path] = f"orders {first or ''} {last or ''}"
            starts += [first] if first else []
        for table, found in fresh.items():
            if table != "orders":
                known |= {path: f"{table}  " for path in found}
        window = _window(job, known, fresh, starts)
        if window is not None:
            daily_run.land_window(job, _sources(job, known, window), window)
        draft.publish({}, {path: f"{SET_ASIDE}  " for path in names} | known)
        return window


def _spans(known: Mapping[str, str]) -> dict[str, tuple[dt.date, dt.date]]:
    """First and last business day of the accepted files of orders."""
    found = {}
    for path, note in known.items():
        table, first, last = note.split(" ")
        if table == "orders" and first:
            found[path] = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    return found


def _window(job: Job, known: Mapping[str, str], fresh: Mapping[str, Sequence[str]],
            starts: list[dt.date]) -> Window | None:
    """From the first day that the new files touch to the newest business day known."""
    spans = _spans(known)
    if not spans or not fresh:
        return None
    newest = max(last for _, last in spans.values())
    if "order_items" in fresh:
        first = _days_of_lines(job, _read(job, "order_items", fresh["order_items"]))
        starts = starts + ([first] if first else [])
    if fresh.keys() - {"orders", "order_items"}:
        starts = [*starts, newest]  # snapshots of days past stay as they were
    return Window(min(starts), newest) if starts else None


def _sources(job: Job, known: Mapping[str, str], window: Window) -> dict[str, DataFrame]:
    """The accepted files that can have rows of the window."""
    first = window.start - dt.timedelta(days=job.params.lookback_days)
    spans = _spans(known)
    wanted = {t: [] for t in contracts.CONTRACTS}
    for path, note in known.items():
        table = note.split(" ")[0]
        if table in wanted and (table != "orders" or path in spans and spans[path][1] >= first):
            wanted[table].append(path)
    return {table: _read(job, table, paths) for table, paths in wanted.items()}


def stream_files(job: Job, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Land the files below the source directory, and those that come until the query stops.

    Only names travel through the stream; at most ``files_per_batch`` of them reach the driver at a time.
    """
    names = (
        job.spark.readStream.format("binaryFile").schema(NAMES).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch)
        .load(job.source_dir).select("path"))

    def land(batch: DataFrame, number: int) -> None:
        land_files(job, [r["path"] for r in batch.collect()], number)

    return (names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
