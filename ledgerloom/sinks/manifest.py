"""Numbered versions of a table or of a set of tables, published as a whole.

A version is a manifest: a small file that names the folders the table consists of, and what the writer
wants to know about them again. Data is written to new folders first and the manifest last, so readers
see the old version or the new one, and a writer that dies in between leaves the old one whole.

A writer claims the next number by creating a file that must not exist yet. A second writer that
starts from the same version finds the claim and stops; a claim older than STALE is of a writer that died
and is taken over.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.sinks.tables import hadoop_path

STALE = dt.timedelta(hours=12)


class ConcurrentWrite(Exception):
    """Another run is writing the next version of the same table."""


@dataclass(frozen=True)
class Manifest:
    """``parts``: name to folder below the table. ``facts``: name to what its writer noted."""

    number: int = 0
    parts: Mapping[str, str] = field(default_factory=dict)
    facts: Mapping[str, str] = field(default_factory=dict)


def _file(path: str, number: int, kind: str) -> str:
    return f"{path}/_versions/{number:010d}.{kind}"


def _read(spark: SparkSession, name: str) -> str:
    target, fs = hadoop_path(spark, name)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, name: str, text: str) -> None:
    """Write a file that must not exist."""
    target, fs = hadoop_path(spark, name)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the published versions, ascending."""
    target, fs = hadoop_path(spark, f"{path}/_versions")
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def newest(spark: SparkSession, path: str) -> Manifest:
    """The current version; number 0 without parts before the first."""
    known = numbers(spark, path)
    if not known:
        return Manifest()
    found = json.loads(_read(spark, _file(path, known[-1], "json")))
    return Manifest(known[-1], found["parts"], found["facts"])


def read_parts(spark: SparkSession, path: str, parts: Mapping[str, str],
               schema: T.StructType | str) -> DataFrame:
    """The rows of some parts of a version."""
    if not parts:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{folder}" for folder in sorted(set(parts.values()))]
    return spark.read.schema(schema).parquet(*folders)


class Draft:
    """The next version, while its writer holds the claim."""

    def __init__(self, spark: SparkSession, path: str, base: Manifest):
        self.spark, self.path, self.base = spark, path, base
        self.number = base.number + 1
        self.folder = f"data/{self.number:010d}"

    def publish(self, parts: Mapping[str, str], facts: Mapping[str, str] | None = None) -> Manifest:
        """Make the version current and delete data that neither it nor the one before needs."""
        made = Manifest(self.number, dict(parts), dict(facts or {}))
        text = json.dumps({"parts": made.parts, "facts": made.facts}, sort_keys=True)
        # A reader looks for finished names only, so a half-written manifest is never met.
        draft, final = (_file(self.path, self.number, kind) for kind in ("draft", "json"))
        source, fs = hadoop_path(self.spark, draft)
        fs.delete(source, False)
        _create(self.spark, draft, text)
        if not fs.rename(source, hadoop_path(self.spark, final)[0]):
            raise ConcurrentWrite(f"{self.path}: version {self.number} exists")
        self._clean(made)
        return made

    def _clean(self, made: Manifest) -> None:
        needed = {folder.split("/")[1] for m in (self.base, made) for folder in m.parts.values()}
        target, fs = hadoop_path(self.spark, f"{self.path}/data")
        if fs.exists(target):
            for status in fs.listStatus(target):
                if status.getPath().getName() not in needed:
                    fs.delete(status.getPath(), True)
        for number in numbers(self.spark, self.path)[:-2]:
            fs.delete(hadoop_path(self.spark, _file(self.path, number, "json"))[0], False)


def _holder(spark: SparkSession, name: str) -> tuple[str, dt.datetime]:
    owner, _, since = _read(spark, name).rpartition(" ")
    return owner, dt.datetime.fromisoformat(since)


@contextlib.contextmanager
def writing(spark: SparkSession, path: str, owner: str = "",
            now: dt.datetime | None = None) -> Iterator[Draft]:
    """Claim the version after the current one; raise ``ConcurrentWrite`` if it is claimed."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    base = newest(spark, path)
    claim = _file(path, base.number + 1, "claim")
    target, fs = hadoop_path(spark, claim)
    if fs.exists(target):
        holder, since = _holder(spark, claim)
        if now - since < STALE:
            raise ConcurrentWrite(
                f"{path}: {holder or 'another run'} has been writing version {base.number + 1} "
                f"since {since:%Y-%m-%d %H:%M:%S}")
        fs.delete(target, False)
    try:
        _create(spark, claim, f"{owner} {now.isoformat()}")
    except Exception as error:
        if "AlreadyExists" in str(error) or "already exists" in str(error):
            raise ConcurrentWrite(f"{path}: version {base.number + 1} was claimed just now") from error
        raise
    try:
        # The version may have been published, and its claim removed, since ``base`` was read.
        if newest(spark, path).number != base.number:
            raise ConcurrentWrite(f"{path}: version {base.number + 1} was published meanwhile")
        yield Draft(spark, path, base)
    finally:
        fs.delete(target, False)
