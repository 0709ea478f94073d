"""Removal of byte strings that occur earlier in the corpus, with suffix arrays.

A byte goes if a ``length``-byte window that covers it also starts earlier: in a smaller document id,
or in the same document before. Sorting all suffixes of the corpus is neither needed nor affordable;
suffix arrays are built for the windows that need them:

1. Every window is assigned the smallest-hashed ``gram`` in it. Equal windows have equal grams
   at equal places, so windows can only repeat within the group of their gram, and neighbouring
   windows with the same gram form one segment of at most 2 * length - gram bytes. There is
   about one segment per (length - gram) / 2 bytes.
2. Segments travel as hashes (gram, content, place). A segment whose whole content was seen earlier
   repeats as a whole; a gram with one content only needs no more work. Within a task's block equal
   segments are reduced to the first before the shuffle, so a passage that a third of the documents
   share is a row per block.
3. What is left, the first segments of grams with several contents, goes by gram to shards of bounded
   size. A shard builds the suffix array of its segments (Larsson-Sadakane refinement) and
   their common prefixes (Kasai); neighbours that share ``length`` bytes are equal windows.
4. A gram with more segments than a shard holds is split over shards by a hash of the place. These
   shards also give the first place of each distinct window, and those are merged across shards by
   binary search in hash ranges of the windows.
5. The places found are joined to the documents, whose texts are shuffled compressed.

Grams that many segments of one block have are known to be heavy there: their rows are dealt by
content too, and one marker row tells the rest of the gram's rows that there are other contents.

Defined results: a null text is empty. Null ids come first. Rows with one id are ordered by a
64-bit hash of their text; equal rows (id and text) are one document and get the same result. An empty table
gives no rows. Other columns are ignored by ``find_repeats`` and passed through by ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import text_or_empty, utf8_slices
from ledgerloom.llm.fingerprints import mix
from ledgerloom.llm.suffix_arrays import window_classes
from ledgerloom.operators.materialize import materialize


@dataclass(frozen=True)
class Settings:
    length: int = 100
    gram: int = 32  # a power of two; a segment must be covered by six grams
    stretch_bytes: int = 1 << 20  # bytes hashed at a time
    block_segments: int = 400_000  # segments reduced to first ones at a time
    heavy_in_block: int = 64  # contents of one gram in a block that make it heavy
    heavy_segments: int = 2_048  # segments of one gram that are split over shards
    shard_bytes: int = 1 << 20
    salts: int = 64

    def __post_init__(self):
        if self.gram & (self.gram - 1) or not self.gram < self.length <= 7 * self.gram // 2:
            raise ValueError("the gram must be a power of two, and 2 * length - gram at most 6 grams")


NO_ID = -(2**63)  # stands for a null id inside the stages; null ids come first

_BYTE = mix(np.arange(256, dtype=np.uint64), 31)
_ODD = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of all ``gram``-byte strings, by doubling."""
    found, width, factor = _BYTE[data], 1, _ODD
    while width < gram:
        found = found[:-width] * np.uint64(factor) + found[width:]
        factor = factor * factor % 2**64
        width *= 2
    return mix(found, 5)


def segments(data: np.ndarray, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """Segments of concatenated texts: start, windows in it, gram hash and content hash.

    ``ends`` are the ends of the texts in ``data``. No window crosses an end.
    """
    none = np.zeros(0, np.int64)
    if len(data) < settings.length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = gram_hashes(data, settings.gram)
    place_bits = int(len(hashes)).bit_length()
    low = np.uint64((1 << place_bits) - 1)
    # The leftmost smallest hash of each window, its place in the low bits.
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    want, width = settings.length - settings.gram + 1, 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[:width - want], least[want - width:])
    at = (least & low).astype(np.int64)
    valid = np.ones(len(at) + settings.length, bool)
    for end in ends.tolist():
        valid[max(0, end - settings.length + 1):end] = False
    valid = valid[:len(at)]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    start = np.flatnonzero(begins)
    # A segment ends where the next one begins or where windows stop being valid.
    stops = np.flatnonzero(begins[1:] | ~valid[1:]) + 1
    stops = np.append(stops, len(at))
    windows = stops[np.searchsorted(stops, start, side="right")] - start
    last = start + windows - 1 + settings.length - settings.gram
    content = mix(windows.astype(np.uint64), 9)
    for i in range(5):
        content = mix(content ^ hashes[np.minimum(start + i * settings.gram, last)], 10 + i)
    content = mix(content ^ hashes[last], 15)
    return start, windows, hashes[at[start]], content


ROWS = "gram long, tag int, content long, doc long, tie long, at long"


def _segment_rows(docs: DataFrame, settings: Settings) -> DataFrame:
    """Segments of all texts, reduced per block.

    ``at`` is start * 256 + windows. ``tag`` is -1 for segments that repeat within their block,
    0 for others, and above 0 for those of grams that are heavy in their block.
    """
    marker = np.int64(-1)

    def reduced(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, tie, start, windows, gram, content = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((start, tie, doc, content, gram))
        doc, tie, start, windows, gram, content = (
            c[order] for c in (doc, tie, start, windows, gram, content))
        new_gram = np.ones(len(gram), bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        new = new_gram.copy()
        new[1:] |= content[1:] != content[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        # Rows of one and the same place come from equal document rows and are no repeats.
        same = (doc == doc[first]) & (tie == tie[first]) & (start == start[first])
        tag = np.where(new, 0, -1)
        group = np.cumsum(new_gram) - 1
        heavy = np.bincount(group[new]) > settings.heavy_in_block
        salt = 1 + (content % np.uint64(settings.salts)).astype(np.int64)
        tag = np.where(new & heavy[group], salt, tag)
        keep = new | ~same
        marked = gram[new_gram][heavy].view(np.int64)
        # Repeats are dealt by document, since nothing is looked up for them.
        key = np.where(tag < 0, mix(doc.view(np.uint64), 3).view(np.int64), gram.view(np.int64))
        zeros = np.zeros(len(marked), np.int64)
        columns = [
            np.concatenate([key[keep], marked]),
            np.concatenate([tag[keep], zeros]).astype(np.int32),
            np.concatenate([content.view(np.int64)[keep], zeros + marker]),
            np.concatenate([doc[keep], zeros + NO_ID]),
            np.concatenate([tie[keep], zeros]),
            np.concatenate([(start << 8 | windows)[keep], zeros])]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], [c.split()[0] for c in ROWS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        stretch: list[tuple[int, int, int, bytes]] = []  # doc, tie, offset in the text, bytes
        held = pending = 0

        def hashed() -> int:
            """Turn the stretches at hand into segments; the number of these."""
            data = np.frombuffer(b"".join(s[3] for s in stretch), np.uint8)
            ends = np.cumsum([len(s[3]) for s in stretch])
            start, windows, gram, content = segments(data, ends, settings)
            owner = np.searchsorted(ends, start, side="right")
            begin = np.concatenate([[0], ends[:-1]])
            doc, tie, offset = (np.array([s[i] for s in stretch], np.int64) for i in range(3))
            parts.append((doc[owner], tie[owner], start - begin[owner] + offset[owner],
                          windows, gram, content))
            stretch.clear()
            return len(start)

        step = settings.stretch_bytes
        for batch in utf8_slices(batches, 128):
            for doc, tie, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8", "surrogatepass")
                # A long text is hashed in stretches that share all but one byte of a window.
                for at in range(0, len(raw) - settings.length + 1, step):
                    part = raw[at:at + step + settings.length - 1]
                    stretch.append((doc, tie, at, part))
                    pending += len(part)
                    if pending >= step:
                        held += hashed()
                        pending = 0
                    if held >= settings.block_segments:
                        yield from _sliced(reduced(parts))
                        parts, held = [], 0
        if stretch:
            hashed()
        if parts:
            yield from _sliced(reduced(parts))

    return docs.mapInArrow(run, ROWS)


def _sliced(batch: pa.RecordBatch, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text_or_empty()).alias("tie"), text_or_empty().alias("text"))


def _judged(rows: DataFrame) -> DataFrame:
    """Segments that repeat as a whole (``again``) and those that suffix arrays must judge."""
    keys = ["gram", "tag"]
    same = Window.partitionBy(*keys, "content").orderBy("doc", "tie", "at")
    group = Window.partitionBy(*keys)
    first = F.first(F.struct("doc", "tie", "at")).over(same)
    # One shuffle serves both windows.
    dealt = rows.repartition(*keys)
    seen = dealt.withColumn("first", first).withColumn("least", F.min("content").over(group)) \
        .withColumn("most", F.max("content").over(group))
    later = F.expr("(struct(doc, tie, at) > first)")
    return seen.where((F.col("tag") < 0) | later | (F.col("tag") > 0)
                      | (F.col("least") < F.col("most"))).where("at & 255 > 0").select(
        "gram", "doc", "tie", F.expr("shiftright(at, 8)").alias("start"),
        F.expr("int(at & 255)").alias("windows"), ((F.col("tag") < 0) | later).alias("again"))


def compressed(docs: DataFrame, carry: list[T.StructField]) -> DataFrame:
    """``doc``, ``tie``, ``packed`` (the compressed UTF-8 text) and the carried columns."""
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("tie", T.LongType()),
                           T.StructField("packed", T.BinaryType()), *carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in utf8_slices(batches, 128):
            packed = pa.array([pack(t.encode("utf-8", "surrogatepass"))
                               for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], packed, *batch.columns[3:]], schema.names)

    return docs.mapInArrow(run, schema)


PLACES = "doc long, tie long, start long, stop long"


def _with_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The segments of ``wanted`` (gram, doc, tie, start, windows, stop) with their bytes."""
    schema = "gram long, doc long, tie long, start long, windows int, bytes binary"
    lists = wanted.groupBy("doc", "tie").agg(
        F.collect_list(F.struct("gram", "start", "windows", "stop")).alias("list"))
    texts = compressed(_source(docs), [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in utf8_slices(batches, 32):
            rows = []
            for doc, tie, packed, cuts in zip(*(c.to_pylist() for c in batch.columns)):
                raw = unpack(packed)
                rows += [(c["gram"], doc, tie, c["start"], c["windows"],
                          raw[c["start"]:c["stop"]]) for c in cuts]
            for at in range(0, len(rows), 10_000):
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[at:at + 10_000]), kinds)],
                    [c.split()[0] for c in schema.split(", ")])

    return texts.join(lists, ["doc", "tie"]).select("doc", "tie", "packed", "list").mapInArrow(
        run, schema)


def _covered(owner: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Windows by (owner, start) as runs: owner, start and stop of the bytes they cover."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    begins = np.ones(len(owner), bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + length)
    at = np.flatnonzero(begins)
    ends = np.append(at[1:], len(owner)) - 1
    return owner[at], start[at], (start[ends] + length if len(at) else start[at])


def _shard_places(parts: DataFrame, settings: Settings) -> DataFrame:
    """Repeats within each shard, and the first places of windows of split grams.

    Columns: places, and ``one``, ``two``: the window's 128-bit hash, null for a repeat.
    """
    schema = f"{PLACES}, one long, two long"

    def run(table: pa.Table) -> pa.Table:
        from xxhash import xxh3_128_intdigest

        split = table.column("piece")[0].as_py() >= 0
        strings = table.column("bytes").to_pylist()
        doc, tie, start = (table.column(c).to_numpy() for c in ("doc", "tie", "start"))
        owner, inside, classes = window_classes(strings, settings.length)
        place = start[owner] + inside
        order = np.lexsort((place, tie[owner], doc[owner], classes))
        owner, place, classes = owner[order], place[order], classes[order]
        inside = place - start[owner]
        new = np.ones(len(classes), bool)
        new[1:] = classes[1:] != classes[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again = (doc[owner] != doc[owner[first]]) | (tie[owner] != tie[owner[first]]) \
            | (place != place[first])
        who, begin, stop = _covered(owner[again], place[again], settings.length)
        out = [doc[who], tie[who], begin, stop]
        one = two = np.zeros(0, np.int64)
        if split:
            heads = np.flatnonzero(new)
            hashed = [xxh3_128_intdigest(strings[o][i:i + settings.length])
                      for o, i in zip(owner[heads].tolist(), inside[heads].tolist())]
            one = np.array([h >> 64 for h in hashed], np.uint64).view(np.int64)
            two = np.array([h & (2**64 - 1) for h in hashed], np.uint64).view(np.int64)
            more = (doc[owner[heads]], tie[owner[heads]], place[heads],
                    place[heads] + settings.length)
            out = [np.concatenate(c) for c in zip(out, more)]
        nothing = pa.nulls(len(who), pa.int64())
        kinds = (pa.int64(),) * 4
        return pa.Table.from_arrays(
            [*[pa.array(c, t) for c, t in zip(out, kinds)],
             pa.concat_arrays([nothing, pa.array(one, pa.int64())]),
             pa.concat_arrays([nothing, pa.array(two, pa.int64())])],
            [c.split()[0] for c in schema.split(", ")])

    return parts.groupBy("shard", "piece").applyInArrow(run, schema)


def _merged(firsts: DataFrame, per_range: int = 100_000) -> DataFrame:
    """Of first places in several shards, those that are not the first of all."""
    total = firsts.count()
    ranges = max(1, total // per_range)

    def run(table: pa.Table) -> pa.Table:
        doc, tie, start, stop, one, two = (
            table.column(c).to_numpy() for c in ("doc", "tie", "start", "stop", "one", "two"))
        order = np.lexsort((start, tie, doc, two, one))
        key = np.zeros(len(order), np.dtype([("one", "<i8"), ("two", "<i8")]))
        key["one"], key["two"] = one[order], two[order]
        first = order[np.searchsorted(key, key, side="left")]
        later = (doc[order] != doc[first]) | (tie[order] != tie[first]) \
            | (start[order] != start[first])
        rows = order[later]
        return pa.Table.from_arrays([pa.array(c[rows]) for c in (doc, tie, start, stop)],
                                    [c.split()[0] for c in PLACES.split(", ")])

    return firsts.withColumn("range", F.expr(f"pmod(one, {ranges})")).groupBy(
        "range").applyInArrow(run, PLACES)


def find_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Places (doc, tie, start, stop) of the bytes to remove; they may overlap."""
    judged = materialize(_judged(_segment_rows(_source(docs), settings)), "repeat_segments")
    whole = judged.where("again").select(
        "doc", "tie", "start",
        (F.col("start") + F.col("windows") - 1 + settings.length).alias("stop"))
    wanted = judged.where("NOT again").withColumn(
        "stop", F.col("start") + F.col("windows") - 1 + settings.length)
    held = materialize(_with_bytes(docs, wanted.select(
        "gram", "doc", "tie", "start", "windows", "stop")), "repeat_bytes")
    size = held.agg(F.sum(F.octet_length("bytes") + 1)).first()[0] or 0
    shards = max(1, -(-size // settings.shard_bytes))
    heavy = held.groupBy("gram").count().where(F.col("count") > settings.heavy_segments)
    pieces = f"int(ceil(count / {settings.heavy_segments}))"
    parts = held.join(heavy, "gram", "left").select(
        "doc", "tie", "start", "bytes",
        F.expr(f"IF(count IS NULL, pmod(xxhash64(gram), {shards}), gram)").alias("shard"),
        F.expr(f"IF(count IS NULL, -1, int(pmod(xxhash64(doc, tie, start), {pieces})))")
        .alias("piece"))
    found = materialize(_shard_places(parts, settings), "repeat_places")
    within = found.where("one IS NULL").select("doc", "tie", "start", "stop")
    firsts = found.where("one IS NOT NULL")
    places = whole.unionByName(within)
    return places if firsts.isEmpty() else places.unionByName(_merged(firsts))


def spans_of(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the places."""
    runs: list[tuple[int, int]] = []
    for start, stop in sorted(places):
        if runs and start <= runs[-1][1]:
            if stop > runs[-1][1]:
                runs[-1] = (runs[-1][0], stop)
        else:
            runs.append((start, stop))
    return runs


def remove_repeats(docs: DataFrame, settings: Settings = Settings(),
                   as_text: bool = False) -> DataFrame:
    """Every row with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes left over.

    The row's own columns are in the struct ``row``, but for ``text``. With ``as_text``, ``kept`` is
    a string, without the characters that lost a byte.
    """
    others = [f for f in docs.schema.fields if f.name != "text"]
    row = T.StructField("row", T.StructType(others))
    texts = compressed(docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text_or_empty()).alias("tie"), text_or_empty().alias("text"),
        F.struct(*[F.col(f"`{f.name}`") for f in others]).alias("row")), [row])
    places = materialize(find_repeats(docs, settings).groupBy("doc", "tie").agg(
        F.collect_set(F.struct("start", "stop")).alias("places")), "repeat_lists")
    counted = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    kind, arrow = (T.StringType(), pa.string()) if as_text else (T.BinaryType(), pa.binary())
    schema = T.StructType([row, *counted, T.StructField("kept", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in utf8_slices(batches, 64):
            sizes, removed, spans, kept = [], [], [], []
            for packed, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = unpack(packed)
                runs = spans_of([(p["start"], p["stop"]) for p in found or []])
                edges = [0, *(e for r in runs for e in r), len(raw)]
                left = [raw[a:z] for a, z in zip(edges[::2], edges[1::2])]
                sizes.append(len(raw))
                removed.append(len(raw) - sum(map(len, left)))
                spans.append(len(runs))
                kept.append("".join(part.decode("utf-8", "ignore") for part in left) if as_text
                            else b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in (sizes, removed, spans)],
                 pa.array(kept, arrow)], schema.names)

    return texts.join(places, ["doc", "tie"], "left").select(
        "row", "packed", "places").mapInArrow(run, schema)


def deduplicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the texts that are left; ``n_chars``, where there is one, is their length."""
    left = remove_repeats(docs, settings, as_text=True)

    def column(name: str):
        if name == "text":
            return F.col("kept").alias("text")
        if name == "n_chars":
            return F.length("kept").cast(docs.schema[name].dataType).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return left.select(*[column(c) for c in docs.columns])
