"""Benchmark decontamination by a positional inverted index of the training texts.

1. ``build_index`` stores postings: a row is the index of a block of whole documents, with the
   distinct words of the block and, word by word, the ascending positions at which they stand.
   Blocks hold about BLOCK_BYTES of text, so the index is spread by documents: no word's list spans
   tasks, however frequent the word is, and nothing is shuffled. Numbers and words are kept as bytes
   and each block is a row group, so a task writes and reads few at a time, however many it has.
2. Test items become windows of ``words`` consecutive words (items of fewer are one window). Equal
   windows are looked up once. The items are a stated query set, run against all blocks in parts of
   at most about PART_BYTES of text, so what is broadcast does not grow with the benchmark.
3. In a block, a window's words are taken from the rarest. The rarest word's list, moved by the word's
   offset in the window, gives the places where the window may start; the lists of the others, moved
   alike, are intersected with it one after the other. The lists of a block are disjoint, so a
   place is looked up in the one array that tells whose list holds it.
4. ``phrases`` returns the places where every word stands at its offset. With ``slack`` above 0 it
   returns proximity matches: places around which every word stands at most ``slack`` words from its
   offset, in any order. A match covers its window, and with ``slack`` as many words on either side.

Words are compared as strings. A match never crosses documents.

Defined results: a null text has no words, in documents and items alike; such documents have a row
without matches. Rows with a null id or with one id are rows of their own. Items are told apart by
their id as a string, a null id is the empty string; rows of one id are one item, and items of equal
words all count. No documents give no rows; no items give rows without matches. Texts of any length
are indexed whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty
from ledgerloom.llm.tokens import blocks, byte_class, split
from ledgerloom.operators.materialize import materialize

# Words are runs of ASCII letters, digits and all characters beyond ASCII.
GAPS = byte_class("".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                                    *range(0x7B, 0x80)])))
BLOCK_BYTES = 1 << 22
PART_BYTES = 1 << 21
# Places that are compared at a time.
PLACES = 1 << 20

# A row is a block: Spark reads a row group at once, and Parquet's writer would first look at the size
# of its own after 100 rows. Statistics would keep the least and largest value of each until the file ends.
ROW_GROUPS = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false",
              "parquet.column.statistics.enabled": "false"}

# The binary columns are 32-bit numbers, except ``terms``: words of these ``lengths``, one after the
# other. ``positions`` has the words' lists in this order, of these ``counts``.
_INDEX = ("doc_ids array<long>, bounds binary, terms binary, lengths binary, counts binary,"
          " positions binary")


def _stored(numbers: np.ndarray) -> bytes:
    return numbers.astype("<i4").tobytes()


def _read(stored: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(stored.as_buffer(), "<i4")


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index: per block its number, documents, words and postings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 1, BLOCK_BYTES):
            words, bounds, *_ = split(block.column(1).combine_chunks(), GAPS)
            coded = words.dictionary_encode()
            codes = np.asarray(coded.indices)
            terms = coded.dictionary
            lengths = np.asarray(pc.binary_length(terms))
            held = [_stored(bounds), terms.buffers()[2][:int(lengths.sum())].to_pybytes(),
                    _stored(lengths), _stored(np.bincount(codes, minlength=len(terms))),
                    _stored(np.argsort(codes, kind="stable"))]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, block.num_rows], block.column(0).combine_chunks()),
                 *(pa.array([part], pa.binary()) for part in held)],
                [f.split()[0] for f in _INDEX.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    # The number is stored with the block, so every later read sees the same one.
    return materialize(texts.mapInArrow(run, _INDEX).withColumn(
        "block", F.monotonically_increasing_id()), "postings", **ROW_GROUPS)


class _Windows:
    """The distinct windows of some items, by their number of words."""

    def __init__(self, ids: list[str], texts: pa.Array, words: int):
        found = split(texts, GAPS)
        coded = found.words.dictionary_encode()
        codes = np.asarray(coded.indices)
        self.terms = coded.dictionary.cast(pa.string())
        self.ids = ids
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        lengths = np.diff(found.bounds)
        for size in range(1, words + 1):
            of = np.flatnonzero(lengths == size if size < words else lengths >= words)
            counts = lengths[of] - size + 1
            if not counts.sum():
                continue
            item = np.repeat(of, counts)
            at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at += found.bounds[item]
            distinct, which = np.unique(codes[at[:, None] + np.arange(size)], axis=0,
                                        return_inverse=True)
            # The items of each distinct window, one after the other.
            pairs = np.unique(np.stack([which.ravel(), item], axis=1), axis=0)
            first = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
            self.sizes[size] = distinct, first, pairs[:, 1]


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (counts[0] of them), first[1], ..."""
    return np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)


def _places(windows: np.ndarray, counts: np.ndarray, lists: np.ndarray, positions: np.ndarray,
            holder: np.ndarray, bounds: np.ndarray, slack: int) -> Iterator[tuple]:
    """(window, place, document) of all matches in a block.

    ``windows`` has its words as numbers of the block's terms; ``holder`` has the term at each position.
    """
    size = windows.shape[1]
    order = np.argsort(counts[windows], axis=1, kind="stable")
    rarest = np.take_along_axis(windows, order[:, :1], axis=1)[:, 0]
    reached = np.cumsum(counts[rarest])
    shifts = np.arange(-slack, slack + 1)
    at = 0
    while at < len(windows):
        before = reached[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(reached, before + PLACES, "right")))
        todo, left = lists[rarest[at:end]], counts[rarest[at:end]].copy()
        # A list longer than PLACES is cut as well, so that one word cannot make a large working set.
        while left.any():
            now = np.minimum(left, PLACES)
            window = np.repeat(np.arange(at, end), now)
            stands = positions[_spread(todo, now)]
            doc = np.searchsorted(bounds, stands, "right") - 1
            # The rarest word may itself stand up to ``slack`` from its offset.
            window, doc = np.repeat(window, len(shifts)), np.repeat(doc, len(shifts))
            place = (stands[:, None] + shifts).ravel() - order[window, 0]
            for k in range(1, size):
                if not len(place):
                    break
                wanted = windows[window, order[window, k]]
                low, high = bounds[doc], bounds[doc + 1]
                found = np.zeros(len(place), bool)
                for shift in shifts:
                    moved = place + order[window, k] + shift
                    there = (moved >= low) & (moved < high)
                    found |= there & (holder[np.where(there, moved, 0)] == wanted)
                window, place, doc = window[found], place[found], doc[found]
            if len(place):
                yield window, place, doc
            todo, left = todo + now, left - now
        at = end


_FOUND = ("block long, place int, doc_id long, n_words long,"
          " spans array<struct<start:int, end:int>>, items array<string>")


def _look_up(index: DataFrame, query: _Windows, slack: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(query)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                yield of_block(query, *(batch.column(c)[row] for c in range(7)))

    def of_block(query, docs, bounds, terms, lengths, counts, positions, block) -> pa.RecordBatch:
        docs, bounds, counts, positions = docs.values, _read(bounds), _read(counts), _read(positions)
        lists = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(_read(lengths))]).astype(np.int32)
        terms = pa.StringArray.from_buffers(len(counts), pa.py_buffer(ends), terms.as_buffer())
        holder = np.empty(len(positions), np.int32)
        holder[positions] = np.repeat(np.arange(len(terms), dtype=np.int32), counts)
        known = np.asarray(pc.index_in(query.terms, value_set=terms).fill_null(-1))
        marks = np.zeros(len(positions) + 1, np.int64)
        held = []  # document and item of matches
        for size, (windows, first, items) in query.sizes.items():
            here = known[windows]
            there = np.flatnonzero((here >= 0).all(axis=1))
            for window, place, doc in _places(
                    here[there], counts, lists, positions, holder, bounds, slack):
                window = there[window]
                np.add.at(marks, np.maximum(place - slack, bounds[doc]), 1)
                np.add.at(marks, np.minimum(place + size + slack, bounds[doc + 1]), -1)
                pairs = np.unique(np.stack([doc, window], axis=1), axis=0)
                many = first[pairs[:, 1] + 1] - first[pairs[:, 1]]
                of = items[_spread(first[pairs[:, 1]], many)]
                held.append(np.unique(np.stack([np.repeat(pairs[:, 0], many), of], axis=1), axis=0))
        covered = np.cumsum(marks)[:-1] > 0
        # Runs of covered words, cut where documents begin.
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        edges = bounds[:-1][bounds[:-1] < len(covered)]
        begins[edges] = covered[edges]
        ends = np.append(covered[1:] & ~begins[1:], False)
        starts, stops = np.flatnonzero(begins), np.flatnonzero(covered & ~ends) + 1
        per = np.searchsorted(starts, bounds)
        base = np.repeat(bounds[:-1], np.diff(per))
        spans = pa.StructArray.from_arrays(
            [pa.array(starts - base, pa.int32()), pa.array(stops - base, pa.int32())],
            ["start", "end"])
        pairs = (np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 2), np.int64))
        of = np.searchsorted(pairs[:, 0], np.arange(len(docs) + 1))
        named = pa.array([query.ids[i] for i in pairs[:, 1]], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(docs), block.as_py())),
             pa.array(np.arange(len(docs)), pa.int32()), docs,
             pa.array(np.diff(bounds), pa.int64()),
             pa.ListArray.from_arrays(pa.array(per, pa.int32()), spans),
             pa.ListArray.from_arrays(pa.array(of, pa.int32()), named)],
            ["block", "place", "doc_id", "n_words", "spans", "items"])

    return index.select(*(f.split()[0] for f in _INDEX.split(", ")), "block").mapInArrow(
        run, _FOUND)


# Sorted spans joined where they meet.
_JOINED = """aggregate(array_sort(spans), array_repeat(named_struct('start', 0, 'end', 0), 0),
    (done, s) -> if(size(done) > 0 AND s.start <= element_at(done, -1).end,
        concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start,
            'end', greatest(element_at(done, -1).end, s.end)))),
        concat(done, array(s))))"""


def phrases(index: DataFrame, benchmark: DataFrame, words: int = 10, slack: int = 0,
            part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: block, place (in the block), doc_id, n_words, spans (of words) and item ids.

    ``spans`` are the words that matches cover, in ascending order and apart; ``items`` is sorted.
    """
    items = materialize(benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        text_or_empty().alias("text")), "decontamination_items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    found = None
    for part in range(parts):
        # Equal texts are in one part, so that their windows are looked up once.
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).toArrow()
        query = _Windows(rows.column(0).to_pylist(), rows.column(1).combine_chunks(), words)
        here = _look_up(index, query, slack)
        found = here if found is None else found.unionByName(here)
    if parts > 1:
        found = found.groupBy("block", "place").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items")).withColumn("spans", F.expr(_JOINED))
    return found.withColumn("items", F.array_sort(F.array_distinct("items")))
