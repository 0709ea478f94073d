"""Cost-balanced packing of tokenised documents into fixed-length sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n`` (attention). Each task tokenises its
documents and packs them window by window: whole sequences are cut off the front of long documents,
and the remainders of a window, in descending cost, each go to the sequence with the lowest cost so
far among those with room. A window opens as few sequences as its tokens need, so at the end the few
remainders that fit nowhere whole are cut over the room that is left; a window wastes less than one
sequence. A window is bounded by its number of remainders and tokens, so memory does not depend on
the size of a partition, and there is no shuffle at all: a hot source or group of copies is just
more windows.

Tokens are looked up per blank-separated string; only strings not met before reach the tokenizer,
many at a time. The first ones met are remembered, up to a number, a length and a total of bytes, so
that strings as long as documents, where blanks are rare, do not fill a worker. No match of the
tokenizer's word pattern crosses a blank, so the ids are the same as for the whole text; so do words
and the marks after them, which are looked up apart. The vocabulary's added tokens, such as
``<|endoftext|>``, are one id wherever a text spells them out, as in the library's plain call; strings
that hold one are encoded alone and as they are.

Defined results: a null text is empty and has the closing id alone. Null ids and repeated rows are
packed row by row. An empty table gives no rows. Columns other than those named are ignored.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerloom.llm.common import text_or_empty, utf8_slices

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long,"
          " input_ids binary")
# A character that is one token wherever blanks stand around it; it parts strings in a batch.
PART = "\x00"
MARKS = ".,;:!?%&*$#"
# Longer strings hardly come back; they are encoded each time.
LONGEST_KNOWN = 64
KNOWN_BYTES = 256 << 20
# About what an entry of a dictionary takes besides its key and value.
ENTRY_BYTES = 100


class Lookup:
    """Token ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str, remember: int, remember_bytes: int = KNOWN_BYTES):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = tuple(token.content for token in added)
        self._remember = remember
        self._bytes_left = remember_bytes
        self._known: dict[str, bytes] = {"": b""}
        self._part = self._encode(PART)
        assert len(self._part) == 1

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _holds_added(self, string: str) -> bool:
        return any(token in string for token in self._added)

    def _learn(self, strings: list[str]) -> dict[str, bytes]:
        found = {s: self._encode(s).tobytes() for s in strings
                 if PART in s or self._holds_added(s)}
        plain = [s for s in strings if s not in found]
        if plain:
            ids = self._encode(f" {PART} ".join(plain))
            parts = np.flatnonzero(ids == self._part[0]).tolist()
            raw, at = ids.tobytes(), 0
            for s, end in zip(plain, [*parts, len(ids)], strict=True):
                found[s] = raw[4 * at:4 * end]
                at = end + 1
        return found

    def _parts(self, string: str) -> tuple[str, str]:
        """A string as a word in lower case and the marks after it, where that changes no token.

        Marks after a letter or digit and before a blank are always one match of the word pattern.
        """
        word = string.rstrip(MARKS)
        if not word or not word[-1].isalnum() or max(word) > "\xff":
            return string, ""
        lower = word.lower()
        # An added token is matched in lower case only, before the text is put in lower case.
        if self._holds_added(lower):
            return string, ""
        return lower, string[len(word):]

    def _resolve(self, strings: set[str]) -> dict[str, bytes]:
        known = self._known
        parts = {s: self._parts(s) for s in strings}
        missing = {p for both in parts.values() for p in both if p not in known}
        new = self._learn(sorted(missing)) if missing else {}
        found = {s: (known.get(w) or new.get(w, b"")) + (known.get(m) or new.get(m, b""))
                 for s, (w, m) in parts.items()}
        # The first strings met are the frequent ones; later ones are encoded whenever they occur.
        if len(known) < self._remember and self._bytes_left > 0:
            self._keep(new)
            self._keep(found)
        return found

    def _keep(self, found: dict[str, bytes]) -> None:
        for s, ids in found.items():
            if len(s) > LONGEST_KNOWN or s in self._known:
                continue
            self._bytes_left -= sys.getsizeof(s) + sys.getsizeof(ids) + ENTRY_BYTES
            if self._bytes_left < 0:
                return
            self._known[s] = ids

    def ids(self, texts: list[str]) -> list[bytes]:
        # One character at a time is the fastest way to map them; other blanks stay inside strings.
        split = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")
                 for t in texts]
        hits = [list(map(self._known.get, strings)) for strings in split]
        missing = {s for strings, got in zip(split, hits) if None in got
                   for s, g in zip(strings, got) if g is None}
        new = self._resolve(missing) if missing else {}
        return [b"".join([new[s] if g is None else g for s, g in zip(strings, got)]
                         if None in got else got)
                for strings, got in zip(split, hits)]


def assign(lengths: np.ndarray, capacity: int, linear: float,
           quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Place pieces shorter than ``capacity``: (piece, its first token, tokens, sequence, offset)."""
    total = int(lengths.sum())
    count = -(-total // capacity)
    if not count:
        return []
    cost = linear * lengths + quadratic * lengths.astype(float) ** 2
    spent, used = np.zeros(count), np.zeros(count, dtype=np.int64)
    placed, left = [], []
    for piece in np.lexsort((np.arange(len(lengths)), -cost)).tolist():
        n = int(lengths[piece])
        open_cost = np.where(used + n <= capacity, spent, np.inf)
        best = int(open_cost.argmin())
        if open_cost[best] == np.inf:
            left.append((piece, 0, n))
            continue
        placed.append((piece, 0, n, best, int(used[best])))
        used[best] += n
        spent[best] += cost[piece]
    # The room left is enough for the rest, though not in one place.
    room = [(spent[s], s) for s in range(count) if used[s] < capacity]
    heapq.heapify(room)
    for piece, start, n in left:
        while n:
            at_cost, s = heapq.heappop(room)
            take = min(n, capacity - int(used[s]))
            placed.append((piece, start, take, s, int(used[s])))
            used[s] += take
            if used[s] < capacity:
                heapq.heappush(room, (at_cost + linear * take + quadratic * take * take, s))
            start, n = start + take, n - take
    return placed


_lookups: dict[tuple[str, int], Lookup] = {}


def _lookup(vocabulary: str, remember: int) -> Lookup:
    if (vocabulary, remember) not in _lookups:
        _lookups[vocabulary, remember] = Lookup(vocabulary, remember)
    return _lookups[vocabulary, remember]


def pack(docs: DataFrame, vocabulary: str, *, capacity: int = 2048, closing_id: int = 1,
         linear: float = 1.0, quadratic: float = 1.0 / 2048, window_pieces: int = 4096,
         remember: int = 1_000_000) -> DataFrame:
    """One row per piece: ``length`` tokens of the document from ``start``, at ``offset`` of a sequence.

    ``input_ids`` are the piece's ids, little-endian unsigned 32-bit. ``sequence_id`` is unique in the
    result and names the task and the sequence's number in it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(vocabulary, remember)
        task = TaskContext.get().partitionId() << 32
        closing = np.array([closing_id], "<u4").tobytes()
        whole = 4 * capacity
        sequences = 0
        window: list[tuple[int | None, int, int, bytes]] = []

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:6]],
                 pa.array(columns[6], pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "input_ids"])

        def close() -> list[tuple]:
            nonlocal sequences, window
            lengths = np.array([len(ids) // 4 for *_, ids in window], dtype=np.int64)
            rows = []
            for piece, first, n, sequence, offset in assign(lengths, capacity, linear, quadratic):
                doc, start, tokens, ids = window[piece]
                rows.append((doc, start + first, n, tokens, task + sequences + sequence, offset,
                             ids[4 * first:4 * (first + n)]))
            sequences += -(-int(lengths.sum()) // capacity) if len(lengths) else 0
            window = []
            return rows

        for batch in utf8_slices(batches, 128):
            rows = []
            ids_of = batch.column(0).to_pylist()
            for doc, ids in zip(ids_of, lookup.ids(batch.column(1).to_pylist())):
                ids += closing
                tokens = len(ids) // 4
                for at in range(0, len(ids) - whole + 1, whole):
                    rows.append((doc, at // 4, capacity, tokens, task + sequences, 0,
                                 ids[at:at + whole]))
                    sequences += 1
                rest = len(ids) // whole * whole
                if rest < len(ids):
                    window.append((doc, rest // 4, tokens, ids[rest:]))
                if len(window) >= window_pieces:
                    rows += close()
            if rows:
                yield emit(rows)
        if window:
            yield emit(close())

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
