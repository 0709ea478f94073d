"""Phrase collocations from stripes.

A stripe belongs to a prefix of one to three words in a language and counts the words that follow it,
with an entry for "nothing follows in this piece". Tasks build stripes over blocks of text; stripes of
one prefix merge by adding their entries. From merged stripes come the extensions (an entry is the
frequency of prefix plus word), the prefix totals (the sum of a stripe is the frequency of its
prefix) and the subsumption maxima (the largest entry of a stripe is the most frequent phrase
that continues its prefix; the largest over all prefixes with one tail is the most frequent phrase that
precedes it).

* Stripes are built level by level. From two words on, only phrases whose head and tail are frequent
  can be frequent, so a task leaves out all others. It knows the frequent phrases by a bitmap of
  2**BITS bits, so what is broadcast has one size at any scale; a phrase whose bit another one set
  only costs work.
* A stripe is dealt in SLICES parts by its next words, so that the stripe of a very frequent word is
  no single task's. Parts of one slice meet in one task, which merges them in a stream, sorted, and
  holds the entries of one part at a time.
* Phrases are compared as strings everywhere; products are decimals of 38 digits.

``collocations`` gives a ranked list per language. Defined results: a null text has no words; a null
language is ``und``, and so are documents with that very value; ids are not read, so repeated rows and
rows without id count like others. Texts of any length are read whole. Equal scores are ordered by
frequency and then by the bytes of the phrase, so ranks have no ties. No rows, or none frequent
enough, give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty
from ledgerloom.llm.fingerprints import mix
from ledgerloom.llm.tokens import blocks, byte_class, split
from ledgerloom.operators.materialize import materialize

MARKS = byte_class(".,;:!?\n\x0b\x0c\r")
GAPS = MARKS | byte_class(" \t")
# Text that a task counts before it sends stripes on.
BLOCK_BYTES = 1 << 24
SLICES = 16
# Size of the bitmap of frequent phrases: 8 MB.
BITS = 26
# The entry of a stripe for the end of a piece; words are never empty.
END = ""


@dataclass(frozen=True)
class Settings:
    words: int = 4  # longest phrase
    least: int = 30  # occurrences of a candidate
    covered: int = 80  # percent of them within one longer candidate that drop it
    top: int = 2000


_STRIPE = "lang string, prefix string, slice int, words array<string>, counts array<long>"
_NAMES = [f.split()[0] for f in _STRIPE.split(", ")]


def _hashes(terms: pa.Array) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, terms.to_pylist()), np.uint64, len(terms))


def _phrase_hash(parts: list[np.ndarray], lang: int) -> np.ndarray:
    """Of the hashes of a phrase's words, for the bitmap."""
    total = np.full(len(parts[0]), lang, np.uint64)
    for k, part in enumerate(parts):
        total = mix(total ^ part, k + 1)
    return total & np.uint64((1 << BITS) - 1)


def _block_stripes(lang: str, texts: pa.Array, length: int,
                   frequent: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The stripes of prefixes of ``length`` words in some texts of a language."""
    from xxhash import xxh3_64_intdigest

    words, bounds, starts, data = split(texts, GAPS)
    if not len(words):
        return
    coded = words.dictionary_encode()
    terms, codes = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
    n, base = len(codes), len(terms) + 1
    hashed = _hashes(terms)
    # A word goes on if the next is in the same piece: the same text, no mark between.
    marks = np.cumsum(MARKS[data], dtype=np.int32)[starts]
    goes_on = np.append(marks[1:] == marks[:-1], False)
    ends = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    goes_on[ends] = False
    at = np.arange(n)
    if length == 1:
        following = np.where(goes_on, np.append(codes[1:], 0), base - 1)
        prefix = codes
    else:
        begins = np.flatnonzero(np.logical_and.reduce(
            [goes_on[k:n - length + 1 + k] for k in range(length - 1)])) if n >= length else at[:0]
        seed = xxh3_64_intdigest(lang.encode())
        marked = _phrase_hash([hashed[codes[begins + k]] for k in range(length)], seed)
        common = np.zeros(n + 1, bool)
        common[begins] = frequent[marked]
        # Both the head and the tail of head + next word are frequent.
        at = np.flatnonzero(common[:-1] & common[1:] & goes_on)
        prefix = codes[at]
        for k in range(1, length):
            _, prefix = np.unique(prefix * base + codes[at + k], return_inverse=True)
        following = codes[at + length]
    if not len(at):
        return
    keys, first, counts = np.unique(prefix * base + following, return_index=True,
                                    return_counts=True)
    next_code = keys % base
    slices = (np.append(hashed, 0)[next_code] % np.uint64(SLICES)).astype(np.int32)
    order = np.lexsort((slices, keys // base))
    owner, slices, next_code = (keys // base)[order], slices[order], next_code[order]
    counts, first = counts[order], at[first[order]]
    heads = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (slices[1:] != slices[:-1])))
    parts = [terms.take(pa.array(codes[first[heads] + k])) for k in range(length)]
    prefixes = parts[0] if length == 1 else pc.binary_join_element_wise(
        *parts, pa.scalar(" ", terms.type))
    offsets = pa.array(np.append(heads, len(counts)), pa.int32())
    following = pa.concat_arrays([terms, pa.array([END], terms.type)]).take(pa.array(next_code))
    yield pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(heads), np.int32))),
         prefixes.cast(pa.string()), pa.array(slices[heads], pa.int32()),
         pa.ListArray.from_arrays(offsets, following.cast(pa.string())),
         pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], _NAMES)


def stripes(texts: DataFrame, length: int, frequent: np.ndarray | None = None) -> DataFrame:
    """Unmerged stripes of prefixes of ``length`` words; ``texts`` has lang and text."""
    shared = None if frequent is None else texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.unpackbits(shared.value, bitorder="little").view(bool)
        for block in blocks(batches, 1, BLOCK_BYTES):
            langs = block.column(0).combine_chunks().dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = block.column(1).filter(pc.equal(langs.indices, k)).combine_chunks()
                for made in _block_stripes(lang, mine, length, bits):
                    for part in range(0, made.num_rows, 10_000):
                        yield made.slice(part, 10_000)

    return texts.select("lang", "text").mapInArrow(run, _STRIPE)


def _added(rows: pa.RecordBatch, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The entries of stripes added elementwise: group, word and count, by group."""
    words = rows.column(3).flatten().dictionary_encode()
    codes = np.asarray(words.indices).astype(np.int64)
    lengths = np.asarray(pc.list_value_length(rows.column(3)))
    key = np.repeat(group, lengths) * max(1, len(words.dictionary)) + codes
    distinct, which = np.unique(key, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, which, np.asarray(rows.column(4).flatten()))
    owner, code = np.divmod(distinct, max(1, len(words.dictionary)))
    return owner, words.dictionary.take(pa.array(code)), sums


def merge(parts: DataFrame, least: int) -> DataFrame:
    """Per prefix and slice: the total of its entries, and those of ``least`` and more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            if not rows.num_rows:
                continue
            same = [pc.equal(rows.column(c).slice(1), rows.column(c).slice(0, rows.num_rows - 1))
                    for c in range(3)]
            group = np.append(0, np.cumsum(~np.logical_and.reduce(
                [s.to_numpy(zero_copy_only=False) for s in same])))
            owner, words, counts = _added(rows, group)
            # The last stripe may go on in the next batch.
            done = int(group[-1])
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            cut = np.searchsorted(owner, done)
            yield from finished(rows, first[:-1], owner[:cut], words.slice(0, cut), counts[:cut])
            held = pa.RecordBatch.from_arrays(
                [rows.column(c).slice(int(first[-1]), 1) for c in range(3)]
                + [pa.ListArray.from_arrays([0, len(words) - cut], words.slice(cut)),
                   pa.ListArray.from_arrays([0, len(words) - cut], pa.array(counts[cut:]))],
                schema=rows.schema)
        if held is not None:
            owner, words, counts = _added(held, np.zeros(1, np.int64))
            yield from finished(held, np.zeros(1, np.int64), owner, words, counts)

    def finished(rows, first, owner, words, counts) -> Iterator[pa.RecordBatch]:
        if not len(first):
            return
        kept = (counts >= least) & np.asarray(pc.not_equal(words, END))
        offsets = pa.array(np.searchsorted(owner[kept], np.arange(len(first) + 1)), pa.int32())
        edges = np.searchsorted(owner, np.arange(len(first)))
        take = pa.array(first)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).take(take), rows.column(1).take(take),
             pa.array(np.add.reduceat(counts, edges)),
             pa.ListArray.from_arrays(offsets, words.filter(pa.array(kept))),
             pa.ListArray.from_arrays(offsets, pa.array(counts[kept]))],
            ["lang", "prefix", "total", "words", "counts"])

    return parts.repartition("lang", "prefix", "slice").sortWithinPartitions(
        "lang", "prefix", "slice").mapInArrow(
            run, "lang string, prefix string, total long, words array<string>, counts array<long>")


def bitmap(phrases: DataFrame) -> np.ndarray:
    """The bits of ``lang`` and ``phrase``, packed; built by Spark in buckets of 4 KB."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            bits = [_phrase_hash([np.array([xxh3_64_intdigest(w)], np.uint64) for w in p.split(" ")],
                                 xxh3_64_intdigest(lang))[0]
                    for lang, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(bits, np.uint64).astype(np.int64))],
                                             ["bit"])

    # Spark's buckets count from 1.
    place = F.col("bit") + 1
    made = phrases.select("lang", "phrase").mapInArrow(run, "bit long").groupBy(
        F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    packed = np.zeros((1 << BITS) // 8, np.uint8)
    for row in made.toLocalIterator():
        part = np.frombuffer(bytes(row.bits), np.uint8)
        packed[(row.bucket - 1) * 4096:(row.bucket - 1) * 4096 + len(part)] = part
    return packed


def frequencies(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``words`` (their number), ``f`` of frequent phrases, and ``lang``, ``n``."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        text_or_empty().alias("text"))
    merged = materialize(merge(stripes(texts, 1), settings.least), "stripes")
    totals = merged.groupBy("lang").agg(F.sum("total").alias("n"))
    found = materialize(merged.groupBy("lang", "prefix").agg(F.sum("total").alias("f")).where(
        F.col("f") >= settings.least).select(
            "lang", F.col("prefix").alias("phrase"), F.lit(1).alias("words"), "f"), "phrases")
    for length in range(1, settings.words):
        if length > 1:
            frequent = bitmap(longest)
            merged = merge(stripes(texts, length, frequent), settings.least)
        longest = materialize(merged.select(
            "lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e")).select(
                "lang", F.concat_ws(" ", "prefix", "e.words").alias("phrase"),
                F.lit(length + 1).alias("words"), F.col("e.counts").alias("f")), "phrases")
        found = found.unionByName(longest)
    return found, totals


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per language the best phrases: lang, rank, phrase, a, l, r, n and score."""
    found, totals = frequencies(docs, settings)
    candidates = found.where("words > 1")
    # The most frequent phrase that is one word longer, at either end. A phrase longer by more words
    # is no more frequent than one of these, which it contains.
    longer = candidates.where("words > 2").select(
        "lang", "f", F.explode(F.array(
            F.expr("substring_index(phrase, ' ', words - 1)"),
            F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
    widest = longer.groupBy("lang", "phrase").agg(F.max("f").alias("widest"))
    wide = "cast({} AS decimal(38, 0))"
    kept = candidates.join(widest, ["lang", "phrase"], "left").where(
        f"widest IS NULL OR 100BD * {wide.format('widest')} < {settings.covered}BD * {wide.format('f')}")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(
        F.expr("sequence(1, words - 1)")).alias("k"), "words").select(
            "lang", "phrase", "a", "k",
            F.expr("substring_index(phrase, ' ', k)").alias("head"),
            F.expr("substring_index(phrase, ' ', k - words)").alias("tail"))
    known = found.select("lang", "phrase", "f")
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn(
        "score", F.expr(f"bigint((2000000BD * {wide.format('a')}) div "
                        f"({wide.format('l')} + {wide.format('r')}))"))
    least = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = least.withColumn("rank", F.row_number().over(best).cast("long")).where(
        F.col("rank") <= settings.top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
