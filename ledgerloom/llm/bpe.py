"""Byte-level BPE encoding and decoding of whole documents.

A text up to ``chunk_chars`` is encoded at once. A longer one is cut into overlapping chunks that
are pre-tokenised in parallel. Two neighbours, started at different places, find the same pre-token
boundaries after a few characters; a boundary both have in their overlap is a true one
(chunk 0 starts at a true boundary, and a pre-token depends on what follows its start only). The text
is cut at the first of them that has no white space before it, because white space at the end of a
piece is split otherwise than before more text. The cuts give pieces that are encoded in parallel, and a document's
ids are the ids of its pieces in order. Where two chunks have no such boundary in common,
because a pre-token or a run of white space is longer than the overlap, there is no cut and the piece just spans both. Copies of a long
text are encoded once.

Decoding concatenates the bytes of the ids.

Defined results: a null text is empty and has no ids. Null ids and repeated rows are encoded row by
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty, utf8_slices
from ledgerloom.operators.materialize import materialize

# A boundary this close to the end of a chunk may look different with the text that follows.
LOOKAHEAD = 8

_encodings: dict[tuple[str, str], object] = {}


def encoding(vocabulary: str, pattern: str):
    """The encoding of a rank file, made once per worker."""
    key = (vocabulary, pattern)
    if key not in _encodings:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[key] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


# Runs of white space from this length on are encoded apart: the library gives up on very long ones.
LONG_RUN = 4_096


def encode_text(encoder, text: str) -> list[int]:
    """The ids of a text as ``encode_ordinary`` gives them, also where that fails on its blanks.

    Of a run of white space, the pattern takes all but the last character as one match if something
    follows, and all of it at the end; what follows starts with the last character.
    """
    import regex

    ids, at = [], 0
    for run in regex.finditer(rf"\p{{White_Space}}{{{LONG_RUN},}}", text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder.encode_ordinary(text[at:run.start()])
        ids += encoder._encode_single_piece(text[run.start():stop])
        at = stop
    return ids + encoder.encode_ordinary(text[at:]) if at else encoder.encode_ordinary(text)


def boundaries(text: str, pattern: str) -> list[int]:
    """Starts of the pre-tokens of ``text``."""
    import regex

    return [m.start() for m in regex.finditer(pattern, text)]


def _encode_texts(rows: DataFrame, keys: str, vocabulary: str, pattern: str) -> DataFrame:
    """``rows`` of key columns and a text, with the ids in place of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary, pattern)
        for batch in utf8_slices(batches, 64):
            ids = pa.array([encode_text(encoder, t) for t in batch.column(batch.num_columns - 1).to_pylist()],
                           pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])

    return rows.mapInArrow(run, f"{keys}, ids array<int>")


def _chunks(texts: DataFrame, size: int, overlap: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in utf8_slices(batches, 1):
            digest, text = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            for k, at in enumerate(range(0, max(len(text) - overlap, 1), size - overlap)):
                yield pa.RecordBatch.from_pydict(
                    {"digest": [digest], "chunk": [k], "start": [at], "body": [text[at:at + size]]})

    return texts.mapInArrow(run, "digest string, chunk long, start long, body string")


def _cuts(texts: DataFrame, pattern: str, size: int, overlap: int) -> DataFrame:
    """Per long text, the true boundaries at which it is cut, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in utf8_slices(batches, 16):
            heads, tails = [], []
            for at, body in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found = boundaries(body, pattern)
                sure = len(body) - LOOKAHEAD
                heads.append([at + b for b in found if b < overlap])
                tails.append([at + b for b in found if size - overlap <= b <= sure
                              and not body[b - 1].isspace()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))], ["digest", "chunk", "head", "tail"])

    found = materialize(
        _chunks(texts, size, overlap).repartition("digest", "chunk").mapInArrow(
            run, "digest string, chunk long, head array<long>, tail array<long>"), "bpe_boundaries")
    left = found.select("digest", (F.col("chunk") + 1).alias("chunk"), "tail")
    return (
        left.join(found.select("digest", "chunk", "head"), ["digest", "chunk"])
        .select("digest", F.array_min(F.array_intersect("tail", "head")).alias("cut"))
        .where("cut IS NOT NULL").groupBy("digest")
        .agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    )


def _pieces(texts: DataFrame, cuts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in utf8_slices(batches, 1):
            digest, text, at = (batch.column(i)[0].as_py() for i in range(3))
            edges = [0, *(at or []), len(text)]
            for k, (a, z) in enumerate(zip(edges, edges[1:])):
                yield pa.RecordBatch.from_pydict(
                    {"digest": [digest], "piece": [k], "body": [text[a:z]]})

    return texts.join(cuts, "digest", "left").select("digest", "text", "cuts").mapInArrow(
        run, "digest string, piece long, body string").repartition("digest", "piece")


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, chunk_chars: int = 65_536,
           overlap: int = 2_048) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row."""
    if not 2 * overlap < chunk_chars or overlap <= LOOKAHEAD:
        raise ValueError("the overlap must be under half a chunk and longer than the look-ahead")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    is_long = F.length("text") > chunk_chars
    short = _encode_texts(rows.where(~is_long), "doc_id long", vocabulary, pattern)
    long_rows = rows.where(is_long).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    texts = materialize(long_rows.select("digest", "text").dropDuplicates(["digest"]), "bpe_long")
    pieces = _pieces(texts, _cuts(texts, pattern, chunk_chars, overlap))
    # One document's ids at a time: no more than the document itself.
    whole = _encode_texts(pieces, "digest string, piece long", vocabulary, pattern).groupBy(
        "digest").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts")).select(
            "digest", F.expr("flatten(transform(parts, p -> p.ids))").alias("ids"))
    return short.unionByName(
        long_rows.select("doc_id", "digest").join(whole, "digest").select("doc_id", "ids"))


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``decoded``, the raw bytes of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_bytes = encoding(vocabulary, pattern).decode_bytes
        for batch in utf8_slices(batches, 64):
            raw = pa.array([decode_bytes(ids) for ids in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary")
