"""Near-duplicate documents by tensored MinHash banding.

A document is the set of its distinct word shingles. Two groups of ``tables`` collections, each of
``rows`` MinHash values, give ``tables * tables`` table keys: key (i, j) pairs collection i of one
group with collection j of the other. So 2 * tables * rows MinHash values serve as many tables as
would otherwise take tables**2 * 2 * rows. With 12 and 3 a pair at similarity 0.85 shares no table
with probability 2 * (1 - 0.85**3)**12 = 2e-5, and fewer above.

1. Equal sets are one node, so groups of copies cost one row.
2. Documents that share a table are candidates. Those of tables with up to ``near`` + 1 nodes are
   paired; candidates that sizes or a 128-bit sketch of the MinHash values rule out are dropped. The
   sketch's threshold is six deviations below what the least similar link would show.
3. Links are confirmed on the full sets, first the likeliest candidate of each node, then those
   candidates whose nodes are not connected yet.
4. Nodes of larger tables are crowded. Pairs among them are never made as rows: crowded nodes that share
   a collection of the first group are dealt to blocks of bounded size, each pair of blocks is a
   task's, and the task walks the pairs that share a table, in the first collection they share, that
   are not connected and that the sketch lets pass. It confirms them on the full sets, keeps
   count of what it connects, and returns links that connect two components: fewer than nodes. Nodes of
   the largest component of a collection are not compared with each other. So no pair is lost,
   and near copies that are connected already cost nothing more.

Defined results: a null text has no words; documents without words are linked with nothing. Rows
with a null id belong to their component but do not name it; repeated rows get equal results. Of a
component ``keep_one`` keeps one row, that of the smallest id (null ids last) and then the smallest
hash of its text; of documents without words, one row per id and text. An empty table gives no rows. Other columns are ignored by ``near_duplicates`` and passed through by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, text_or_empty, utf8_slices
from ledgerloom.llm.components import components
from ledgerloom.llm.fingerprints import mix
from ledgerloom.operators.materialize import materialize


@dataclass(frozen=True)
class Settings:
    words: int = 3
    percent: int = 85  # links have 100 * intersection >= percent * union
    tables: int = 12
    rows: int = 3
    near: int = 16
    seed: int = 1

    @property
    def values(self) -> int:
        return 2 * self.tables * self.rows


SKETCHED = 64  # MinHash values in the sketch, two bits each
EVEN_BITS = 0x5555555555555555
# Weight of a block: shingles, and so many more for each node.
BLOCK = 1 << 20
PER_NODE = 256


def shingles(text: str, words: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, ascending.

    ASCII letters are lower-cased; ``bytes.split`` cuts at the same characters as the word pattern.
    """
    from xxhash import xxh3_64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total ^ hashed[i:len(found) - width + 1 + i], i + 1)
    return np.unique(total)


class _Hashes:
    def __init__(self, n: int, seed: int):
        random = np.random.default_rng(seed)
        self.flip = random.integers(0, 2**64, (1, n), dtype=np.uint64)
        self.times = random.integers(0, 2**63, (1, n), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, values: np.ndarray) -> np.ndarray:
        least = None
        for at in range(0, len(values), 512):
            part = ((values[at:at + 512, None] ^ self.flip) * self.times).min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return least


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row: doc_id, text_hash, n (set size), node (hash of the set), sketch, the collections."""
    rows, tables = settings.rows, settings.tables
    schema = ("doc_id long, text_hash long, n long, node long, sketch1 long, sketch2 long,"
              " one array<long>, two array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(settings.values, settings.seed)
        for batch in utf8_slices(batches, 256):
            n, node, sketch, parts = [], [], [], []
            for text in batch.column(2).to_pylist():
                values = shingles(text, settings.words)
                n.append(len(values))
                node.append(mix(mix(values, 7).sum(keepdims=True, dtype=np.uint64), len(values))[0])
                least = (hashes.minima(values) if len(values)
                         else np.zeros(settings.values, np.uint64))
                bits = mix(least[:SKETCHED], 11) & np.uint64(3)
                places = np.uint64(2) * np.arange(32, dtype=np.uint64)
                sketch.append([np.bitwise_or.reduce(bits[k:k + 32] << places[:len(bits[k:k + 32])])
                               for k in (0, 32)])
                grouped = least.reshape(2 * tables, rows)
                key = np.zeros(2 * tables, np.uint64)
                for i in range(rows):
                    key = mix(key ^ grouped[:, i], i + 21)
                parts.append(key.view(np.int64))
            longs = [pa.array(np.array(c, np.uint64).view(np.int64))
                     for c in (node, [s[0] for s in sketch], [s[1] for s in sketch])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *longs,
                 pa.array([p[:tables] for p in parts], pa.list_(pa.int64())),
                 pa.array([p[tables:] for p in parts], pa.list_(pa.int64()))],
                [f.split()[0] for f in schema.split(", ")])

    return docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"),
                       text_or_empty().alias("text")).mapInArrow(run, schema)


def _most_differing(settings: Settings) -> float:
    """Places in which the sketches of a link differ at most, six deviations allowed."""
    share = settings.percent / 100
    agreeing = share + (1 - share) / 4
    compared = min(SKETCHED, settings.values)
    return compared * (1 - agreeing) + 6 * (compared * agreeing * (1 - agreeing)) ** 0.5


def _differing(x: str, y: str) -> str:
    """SQL for the number of places in which two sketches differ."""
    def places(column: str) -> str:
        differ = f"({x}.{column} ^ {y}.{column})"
        # A two-bit place differs where either of its bits does.
        return f"bit_count(({differ} | shiftrightunsigned({differ}, 1)) & {EVEN_BITS}L)"

    return f"{places('sketch1')} + {places('sketch2')}"


def _alike(settings: Settings, x: str, y: str) -> str:
    """SQL that no link fails: sizes close enough, and sketches too."""
    return (f"100 * least({x}.n, {y}.n) >= {settings.percent} * greatest({x}.n, {y}.n) AND "
            f"{_differing(x, y)} <= {_most_differing(settings):.6f}D")


def _verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in last:
                if len(last) >= 32:
                    last.pop(next(iter(last)))
                last[node] = shingles(text, settings.words)
            return last[node]

        for batch in utf8_slices(batches, 128):
            found = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = of(a, x), of(b, y)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= settings.percent * (len(x) + len(y) - shared):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components so far."""
    of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return pairs.join(of_a, "a", "left").join(of_b, "b", "left").where(
        "NOT coalesce(root_a, a) <=> coalesce(root_b, b)").select("a", "b")


_CELL = ["key", "i", "j", "block", "slot", "node", "n", "root", "sketch1", "sketch2", "one", "two"]
_CELL_TYPES = ("key long, i int, j int, block int, slot int, node long, n long, root long,"
               " sketch1 long, sketch2 long, one array<long>, two array<long>")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after the other, from batches sorted by cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(c)) for c in range(3)]) if batch.num_rows else None
        at = 0
        while at < batch.num_rows:
            if held and any(held[-1].column(c)[0].as_py() != keys[c, at] for c in range(3)):
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            other = np.flatnonzero((keys[:, at:] != keys[:, at:at + 1]).any(axis=0))
            end = at + int(other[0]) if len(other) else batch.num_rows
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class _Cell:
    """Two blocks of crowded nodes that share a collection, and which of their pairs are open."""

    def __init__(self, rows: pa.Table, settings: Settings):
        def column(name):
            return np.asarray(rows.column(name).combine_chunks())

        def lists(name):
            return np.asarray(rows.column(name).combine_chunks().flatten()).reshape(rows.num_rows, -1)

        self.settings, self.most = settings, _most_differing(settings)
        self.node, self.n, self.root = column("node"), column("n"), column("root")
        self.one, self.two = lists("one"), lists("two")
        self.sketches = [column("sketch1").view(np.uint64), column("sketch2").view(np.uint64)]
        self.slot = rows.column("slot")[0].as_py()
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        self.same = i == j
        self.left = np.flatnonzero(column("block") == i)
        self.right = self.left if self.same else np.flatnonzero(column("block") == j)

    def open(self, x: np.ndarray) -> np.ndarray:
        """Per node of ``x`` and of the right block: is this a pair to confirm here?"""
        y = self.right
        small, large = np.minimum(self.n[x, None], self.n[y]), np.maximum(self.n[x, None], self.n[y])
        ok = (self.root[x, None] != self.root[y]) & (
            100 * small >= self.settings.percent * large) & (
            self.one[x, None, self.slot] == self.one[y, self.slot])
        if self.same:
            ok &= x[:, None] < y
        if not ok.any():
            return ok
        for k in range(self.slot):  # the pair belongs to the first collection it shares
            ok &= self.one[x, None, k] != self.one[y, k]
        differing = np.zeros(ok.shape, np.uint8)
        for sketch in self.sketches:
            differ = sketch[x, None] ^ sketch[y]
            differing += np.bitwise_count((differ | differ >> np.uint64(1)) & np.uint64(EVEN_BITS))
        ok &= differing <= self.most
        if ok.any():
            shared = np.zeros(ok.shape, bool)
            for k in range(self.two.shape[1]):
                shared |= self.two[x, None, k] == self.two[y, k]
            ok &= shared
        return ok

    def parts(self) -> Iterator[np.ndarray]:
        step = max(1, (1 << 18) // max(1, len(self.right)))
        for at in range(0, len(self.left), step):
            yield self.left[at:at + step]

    def links(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """Links between components, each connecting two that nothing before it did."""
        sets = {k: shingles(texts[k], self.settings.words) for k in {*self.left, *self.right}}
        values = np.concatenate([sets[k] for k in self.right])
        owner = np.repeat(np.arange(len(self.right)), [len(sets[k]) for k in self.right])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        merged: dict[int, int] = {}

        def find(root: int) -> int:
            while root in merged:
                root = merged[root]
            return root

        sizes = self.n[self.right]
        for part in self.parts():
            found = self.open(part)
            for row in np.flatnonzero(found.any(axis=1)):
                x = part[row]
                first = np.searchsorted(values, sets[x])
                many = np.searchsorted(values, sets[x], "right") - first
                at = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
                shared = np.bincount(owner[at], minlength=len(self.right))
                linked = found[row] & (100 * shared >= self.settings.percent
                                       * (self.n[x] + sizes - shared))
                for y in self.right[linked]:
                    a, b = find(int(self.root[x])), find(int(self.root[y]))
                    if a != b:
                        merged[a] = b
                        yield int(self.node[x]), int(self.node[y])


def _crowded_links(nodes: DataFrame, labels: DataFrame, texts: DataFrame,
                   settings: Settings) -> DataFrame:
    """Links (a, b) that connect the components of crowded nodes, from their blocks."""
    rooted = nodes.join(labels, "node", "left").select(
        "node", "n", F.coalesce("root", "node").alias("root"), "sketch1", "sketch2", "one", "two",
        F.posexplode("one").alias("slot", "value")).withColumn(
            "key", F.xxhash64("slot", "value")).drop("value")
    rooted = materialize(rooted, "minhash_crowded")
    weight = F.sum(F.col("n") + PER_NODE)
    sides = rooted.groupBy("key", "root").agg(weight.alias("weight")).groupBy("key").agg(
        F.max(F.struct("weight", "root")).alias("main"), F.sum("weight").alias("total"),
        F.count(F.lit(1)).alias("roots")).where("roots > 1")
    split = F.col("total") > BLOCK
    sides = sides.select(
        "key", F.col("main.root").alias("main"),
        F.when(split, F.ceil((F.col("total") - F.col("main.weight")) / BLOCK)).otherwise(1)
        .cast("int").alias("others"),
        F.when(split, F.ceil(F.col("main.weight") / BLOCK)).otherwise(0).cast("int").alias("mains"))
    # Blocks below ``others`` hold the other components, those from there on the main one.
    members = rooted.join(sides, "key").withColumn("block", F.expr(
        "int(if(root = main AND mains > 0, others + pmod(xxhash64(node), mains),"
        " pmod(xxhash64(node), others)))"))
    met = F.expr("explode(sequence(0, if(block < others, others + mains, others) - 1))")
    cells = members.withColumn("met", met).withColumns({
        "i": F.least("block", "met"), "j": F.greatest("block", "met")}).select(*_CELL)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches):
            cell = _Cell(rows, settings)
            marked = np.zeros(rows.num_rows, bool)
            for part in cell.parts():
                ok = cell.open(part)
                marked[part] |= ok.any(axis=1)
                marked[cell.right] |= ok.any(axis=0)
            yield from rows.filter(pa.array(marked)).to_batches()

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches):
            found = list(_Cell(rows, settings).links(rows.column("text").to_pylist()))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    marked = materialize(dealt(cells).mapInArrow(candidates, _CELL_TYPES), "minhash_open")
    return dealt(marked.join(texts, "node").select(*_CELL, "text")).mapInArrow(
        confirmed, "a long, b long")


def node_roots(docs: DataFrame, rated: DataFrame, settings: Settings) -> DataFrame:
    """``node`` and the ``root`` of its component, for nodes that have a link."""
    nodes = materialize(
        rated.where("n > 0").groupBy("node").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("of"),
            F.first("n").alias("n"), F.first("sketch1").alias("sketch1"),
            F.first("sketch2").alias("sketch2"), F.first("one").alias("one"),
            F.first("two").alias("two")).select("*", "of.doc_id", "of.text_hash").drop("of"),
        "minhash_nodes")
    keys = nodes.select("node", F.explode(F.expr(
        f"flatten(transform(sequence(0, {settings.tables - 1}), i -> transform("
        f"sequence(0, {settings.tables - 1}), j -> xxhash64(one[i], two[j], i, j))))")).alias(
            "key"))
    # Tables with one node, nearly all of them, are dropped before anything is stored.
    bucket = Window.partitionBy("key").orderBy("node")
    ahead = F.count(F.lit(1)).over(bucket.rowsBetween(0, settings.near + 1))
    seen = materialize(keys.select(
        "key", "node", F.row_number().over(bucket).alias("place"), ahead.alias("ahead")).where(
            "place + ahead > 2"), "minhash_tables")
    # A table has more than ``near`` + 1 nodes if there are so many up to here or from here on.
    large = F.col("place") + F.col("ahead") - 1 > settings.near + 1
    crowded = materialize(seen.where(large).select("node").distinct(), "minhash_beyond")
    # Pairs of crowded nodes are left to their blocks, but for some from which to start.
    close = seen.select(
        "node", "place", large.alias("large"), F.lag("node").over(bucket).alias("previous"),
        F.collect_list("node").over(bucket.rowsBetween(-settings.near, -1)).alias("before")).where(
            "place > 1").select("node", F.explode(
                F.when(F.col("large"), F.array("previous")).otherwise(F.col("before"))).alias("a"))
    pairs = close.select("a", F.col("node").alias("b")).distinct()
    attributes = nodes.select("node", "n", "sketch1", "sketch2").join(
        crowded.withColumn("crowded", F.lit(True)), "node", "left")
    alike = pairs.join(attributes.alias("x"), F.expr("a = x.node")).join(
        attributes.alias("y"), F.expr(f"b = y.node AND {_alike(settings, 'x', 'y')}"))
    alike = materialize(alike.select(
        "a", "b", F.expr(_differing("x", "y")).alias("differing"),
        F.expr("x.crowded AND y.crowded <=> true").alias("both")), "minhash_pairs")

    wanted = alike.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowded).distinct()
    reps = nodes.select("node", "doc_id", "text_hash").join(wanted, "node", "left_semi")
    source = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"),
                         text_or_empty().alias("text"))
    same = (source["doc_id"].eqNullSafe(reps["doc_id"])
            & (source["text_hash"] == reps["text_hash"]))
    texts = materialize(source.join(reps, same).select("node", "text").dropDuplicates(["node"]),
                        "minhash_texts")

    first = materialize(alike.groupBy("b").agg(F.min(F.struct("differing", "a")).alias("at")).select(
        F.col("at.a").alias("a"), "b"), "minhash_first")
    labels = materialize(components(
        materialize(_verified(first, texts, settings), "minhash_links")), "minhash_labels")
    tried = first.withColumnRenamed("a", "tried")
    rest = alike.where("NOT coalesce(both, false)").join(tried, "b").where("a <> tried")
    more = _verified(_apart(rest.select("a", "b"), labels), texts, settings)
    if not crowded.isEmpty():
        more = more.unionByName(_crowded_links(
            nodes.join(crowded, "node", "left_semi"), labels, texts, settings))
    return _merged(labels, materialize(more, "minhash_links"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``node`` and ``root`` after more links between the components of ``labels``."""
    def rooted(column: str) -> DataFrame:
        return labels.select(F.col("node").alias(column), F.col("root").alias(f"root_{column}"))

    above = links.join(rooted("a"), "a", "left").join(rooted("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    merged = materialize(components(above), "minhash_merged").select(
        F.col("node").alias("_node"), F.col("root").alias("_root"))
    # A merged component has the smallest root of its parts, so the smallest node.
    known = labels.join(merged, F.col("root") == F.col("_node"), "left").select(
        "node", F.coalesce("_root", "root").alias("root"))
    alone = merged.join(labels, F.col("_node") == F.col("node"), "left_anti").select(
        F.col("_node").alias("node"), F.col("_root").alias("root"))
    return known.unionByName(alone)


def _rooted(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Per row: doc_id, text_hash and n, with the root of its component; and rows without words."""
    rated = materialize(signatures(docs, settings), "minhash_signatures")
    labels = node_roots(docs, rated, settings)
    slim = rated.select("doc_id", "text_hash", "n", "node")
    rooted = materialize(slim.where("n > 0").join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node")), "minhash_roots")
    return rooted, slim.where("n = 0")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id and kept."""
    rooted, wordless = _rooted(docs, settings)
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(names, "root").select("doc_id", "text_hash", "n", "component_id")
    alone = wordless.select("doc_id", "text_hash", "n", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are kept, one per component, with their columns."""
    rooted, wordless = _rooted(docs, settings)
    chosen = rooted.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("of"))
    kept = chosen.select(F.col("of.doc_id").alias("_id"), "of.text_hash").unionByName(
        wordless.select(F.col("doc_id").alias("_id"), "text_hash").distinct())
    hashed, row = fresh(docs, "_hash"), fresh(docs, "_row")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                       F.col("doc_id").alias("doc_id"), F.xxhash64(text_or_empty()).alias(hashed))
    same = rows["doc_id"].eqNullSafe(kept["_id"]) & (rows[hashed] == kept["text_hash"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", hashed]).select(f"{row}.*")
