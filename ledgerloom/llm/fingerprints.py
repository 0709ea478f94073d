"""Document fingerprints as invertible Bloom lookup sketches.

A text is a set of units: stretches up to and with clause or sentence marks, ASCII or wide, or line
ends (the paragraphs of this sketch; line breaks alone would leave most documents with one or two).
Marks and line ends with nothing before them are a unit too, so units cover every character, and a
unit's digest is that of its characters and of how often it stood before, so repeats count. Stretches
without a mark are cut each 240 characters. Every unit's 64-bit digest is added to three cells of a sketch: a cell holds a count, the XOR of its digests and the XOR
of their check hashes. The sketches of two versions are subtracted cell by cell, which cancels what
they share. Cells left with one digest give it away; taking it out of its other cells uncovers more,
until all cells are empty. Where that stops early, both sketches are made again with twice the
cells. The differing digests give the likeness: shared units over all units of the two.

The fingerprint is the sketch at its first size with the number of units. Sketches of many documents
are built and peeled together as arrays.

Defined results: a null text is empty; two texts without units are alike (1); only empty texts have none. Null ids come first in the order of documents, equal ids are ordered by a
hash of their text, and the document after the last is the first, which may be the document itself.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty, utf8_slices

CELLS = 24
HASHES = 3
# The most cells that are peeled together; larger sets of pairs are taken in parts.
TOGETHER = 1 << 19
# Clause and sentence marks with their full-width, ideographic and half-width forms, and the line end.
MARKS = r".,;!?\n\uff0e\uff0c\uff1b\uff01\uff1f\u3002\u3001\uff61\uff64"
UNIT = re.compile(rf"[^{MARKS}]{{1,240}}[{MARKS}]*|[{MARKS}]+")
# Odd constants of a 64-bit mixing function.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    v = values + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    v = (v ^ (v >> np.uint64(30))) * MIX[0]
    v = (v ^ (v >> np.uint64(27))) * MIX[1]
    return v ^ (v >> np.uint64(31))


def units(text: str) -> np.ndarray:
    """The distinct digests of a text's units, ascending."""
    from xxhash import xxh3_64_intdigest

    found = {xxh3_64_intdigest(u, seed=k)
             for u, times in Counter(UNIT.findall(text)).items() for k in range(times)}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


class Sketches:
    """The sketches of several sets, one after the other, ``cells`` cells each."""

    def __init__(self, sets: Sequence[np.ndarray], cells: int):
        self.cells, self.number = cells, len(sets)
        self.count = np.zeros(cells * len(sets), np.int32)
        self.keys = np.zeros(cells * len(sets), np.uint64)
        self.checks = np.zeros(cells * len(sets), np.uint32)
        if len(sets):
            digests = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            self.change(owner, digests, np.ones(len(digests), np.int32))

    def change(self, owner: np.ndarray, digests: np.ndarray, sign: np.ndarray) -> None:
        """Add (1) digests to or take (-1) them from the sketches of their owners."""
        part = self.cells // HASHES
        check = check_of(digests)
        for s in range(HASHES):
            inside = (mix(digests, s + 1) % np.uint64(part)).astype(np.int64)
            at = owner * self.cells + s * part + inside
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, digests)
            np.bitwise_xor.at(self.checks, at, check)

    def written(self, sizes: Sequence[int]) -> list[str]:
        cell = np.zeros(len(self.count), np.dtype([("n", "<i4"), ("k", "<u8"), ("c", "<u4")]))
        cell["n"], cell["k"], cell["c"] = self.count, self.keys, self.checks
        raw, width = cell.tobytes(), self.cells * cell.itemsize
        return [f"{n}:{base64.b64encode(raw[i * width:(i + 1) * width]).decode()}"
                for i, n in enumerate(sizes)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empty subtracted sketches: (owner, digest, sign) found, and which sketches emptied."""
        found = []
        look = np.flatnonzero(self.count)
        while len(look):
            single = look[np.abs(self.count[look]) == 1]
            single = single[self.checks[single] == check_of(self.keys[single])]
            if not len(single):
                break
            owner, digests, sign = single // self.cells, self.keys[single], self.count[single]
            order = np.lexsort((digests, owner))
            owner, digests, sign = owner[order], digests[order], sign[order]
            first = np.ones(len(order), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (digests[1:] != digests[:-1])
            owner, digests, sign = owner[first], digests[first], sign[first]
            self.change(owner, digests, -sign)
            found.append((owner, digests, sign))
            look = np.flatnonzero(self.count)
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        empty = ~left.reshape(self.number, self.cells).any(axis=1)
        if not found:
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none, empty
        return *(np.concatenate(c) for c in zip(*found)), empty


def check_of(digests: np.ndarray) -> np.ndarray:
    return mix(digests, 101).astype(np.uint32)


def differences(pairs: Sequence[tuple[np.ndarray, np.ndarray]],
                cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair of sets, the digests only the first and only the second has."""
    out: list = [None] * len(pairs)
    todo = list(range(len(pairs)))
    while todo:
        failed = []
        step = max(1, TOGETHER // cells)
        for part in (todo[i:i + step] for i in range(0, len(todo), step)):
            one = Sketches([pairs[i][0] for i in part], cells)
            two = Sketches([pairs[i][1] for i in part], cells)
            one.count -= two.count
            one.keys ^= two.keys
            one.checks ^= two.checks
            owner, digests, sign, empty = one.peel()
            order = np.lexsort((digests, sign, owner))
            owner, digests, sign = owner[order], digests[order], sign[order]
            edges = np.searchsorted(owner, np.arange(len(part) + 1))
            for n, i in enumerate(part):
                if not empty[n]:
                    failed.append(i)
                    continue
                mine, side = digests[edges[n]:edges[n + 1]], sign[edges[n]:edges[n + 1]]
                out[i] = mine[side > 0], mine[side < 0]
        todo, cells = failed, 2 * cells
    return out


def likeness(one: int, two: int, differing: int) -> float:
    """Shared over all units of two sets of the sizes ``one`` and ``two``."""
    every = one + two + differing
    return (one + two - differing) / every if every else 1.0


def compare(rows: DataFrame, base: str, others: Sequence[str], digests: bool = True,
            carry: Mapping[str, str] | None = None) -> DataFrame:
    """Fingerprints of the versions in the columns ``base`` and ``others``, compared with ``base``.

    Columns: doc_id, those of ``carry`` (name to type), {version}_fingerprint, and per other version
    {version}_likeness and, with ``digests``, {version}_removed and {version}_added, the recovered
    digests as signed longs.
    """
    versions, carried = [base, *others], dict(carry or {})
    schema = ["doc_id long", *(f"{c} {kind}" for c, kind in carried.items()),
              *(f"{v}_fingerprint string" for v in versions)]
    kept = 1 + len(carried)
    for v in others:
        schema.append(f"{v}_likeness double")
        if digests:
            schema += [f"{v}_removed array<long>", f"{v}_added array<long>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in utf8_slices(batches, 128):
            seen: dict[str, np.ndarray] = {}

            def of(text: str, seen=seen) -> np.ndarray:
                if text not in seen:
                    seen[text] = units(text)
                return seen[text]

            sets = [[of(t) for t in batch.column(i + kept).to_pylist()]
                    for i in range(len(versions))]
            sizes = [[len(s) for s in column] for column in sets]
            columns = batch.columns[:kept]
            columns += [pa.array(Sketches(c, CELLS).written(n)) for c, n in zip(sets, sizes)]
            rows = batch.num_rows
            found = differences([(a, b) for other in sets[1:] for a, b in zip(sets[0], other)])
            for k in range(len(others)):
                mine = found[k * rows:(k + 1) * rows]
                columns.append(pa.array([
                    likeness(a, b, len(x) + len(y))
                    for a, b, (x, y) in zip(sizes[0], sizes[k + 1], mine)], pa.float64()))
                if digests:
                    columns += [pa.array([d[side].astype(np.int64) for d in mine],
                                         pa.list_(pa.int64())) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema])

    return rows.select("doc_id", *carried, *versions).mapInArrow(run, ", ".join(schema))


def with_next(docs: DataFrame, range_rows: int = 1_000, most_ranges: int = 10_000) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, the text of the next document by id.

    Ids are cut into ranges at approximate quantiles, so that texts are shuffled once and each range
    is read in order as a stream. The first document of a range is also sent to the range before it.
    There are at most ``most_ranges`` ranges, so what the driver and the broadcast hold is bounded.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn(
        "tie", F.xxhash64("text"))
    ids = docs.select("doc_id")
    total = ids.count()
    ranges = min(max(1, total // range_rows), most_ranges)
    known = ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("double").alias("d"))
    probabilities = [i / ranges for i in range(1, ranges)]
    splits = np.unique(np.array(
        known.approxQuantile("d", probabilities, 0.2 / ranges) if ranges > 1 else [], float))

    @F.pandas_udf("int")
    def range_of(column: pd.Series) -> pd.Series:
        at = np.searchsorted(splits, column.astype("float64").fillna(-np.inf), side="right")
        return pd.Series(at.astype("int32"))

    placed = rows.withColumn("range", range_of("doc_id"))
    heads = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("tie")).withColumn(
        "range", range_of("doc_id")).groupBy("range").agg(
            F.min(F.struct("doc_id", "tie")).alias("head")).orderBy("range").collect()
    if not heads:
        return rows.selectExpr("doc_id", "text", "text AS next_text")
    before = [(heads[i - 1]["range"], h["head"]["doc_id"], h["head"]["tie"])
              for i, h in enumerate(heads)]
    sent = docs.sparkSession.createDataFrame(
        before, "range int, head_id long, head_tie long")
    tails = rows.join(
        F.broadcast(sent), rows["doc_id"].eqNullSafe(sent["head_id"])
        & (rows["tie"] == sent["head_tie"])).select("doc_id", "text", "tie", "range")
    tails = tails.dropDuplicates(["range"])
    streams = placed.withColumn("tail", F.lit(0)).unionByName(
        tails.withColumn("tail", F.lit(1))).repartition("range").sortWithinPartitions(
            "range", "tail", F.asc_nulls_first("doc_id"), "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in utf8_slices(batches, 128):
            done = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                part, tail, doc_id, text = row
                if last is not None:
                    if last[0] != part:
                        raise ValueError("a range lacks the head of the next")
                    done.append((last[1], last[2], text))
                last = None if tail else (part, doc_id, text)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*done), (pa.int64(), pa.string(), pa.string()))],
                    ["doc_id", "text", "next_text"])
        if last is not None:
            raise ValueError("a range lacks the head of the next")

    return streams.select("range", "tail", "doc_id", "text").mapInArrow(
        run, "doc_id long, text string, next_text string")


def edited() -> F.Column:
    """``text`` with its last quarter replaced by as much of the start of ``next_text``."""
    changed = F.expr("int(length(text) div 4)")
    return F.concat(F.substr("text", F.lit(1), (F.length("text") - changed).cast("int")),
                    F.substr("next_text", F.lit(1), changed))
