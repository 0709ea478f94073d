"""Secret scans over a ledger of content-addressed blobs.

Every version of a document is addressed by the SHA-256 of its text. A ledger table stores, per blob
and rule version, the spans found; a scan reads only (blob, rule version) pairs the ledger has not
seen, and findings are joined back to every path that has the blob. A blob is scanned once however
many documents share it: texts are reduced to one per blob before they are shuffled.

Only SQL functions are used. Positions come from cutting the text at the matches: the pieces between
matches and the matches alternate, so running sums of their lengths are the offsets (code points).

Defined results: a null text is the empty text; null paths and repeated rows get the findings of
their blob, row by row; an empty table gives no rows. Other columns are ignored by ``scan`` and
passed through by ``redact``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import fresh, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


# Runs of a class are matched from their least length on, which finds the same spans as matching
# any run and dropping the short ones.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                      r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
EXTRA = (
    Rule("bearer", 1, r"[Bb]earer\x20+([A-Za-z0-9._~+/-]{20,}=*)"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + EXTRA

LEDGER = T.StructType([
    T.StructField("blob", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
])


def address(column: str = "text") -> F.Column:
    """The content address of a text."""
    return F.sha2(text_or_empty(column).cast("binary"), 256)


def _cuts(rule: Rule) -> str:
    """Pieces, matches and the decisive groups of one rule, or null where nothing matches."""
    pattern = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"IF(_text RLIKE '{pattern}', struct('{rule.kind}' AS kind, {rule.version} AS version,"
        f" {rule.least} AS least, split(_text, '{pattern}', -1) AS pieces,"
        f" regexp_extract_all(_text, '{pattern}', 0) AS matches,"
        f" regexp_extract_all(_text, '{pattern}', {rule.group}) AS groups), NULL)")


def _pairs(rules: Sequence[Rule]) -> str:
    pairs = ", ".join(f"struct('{r.kind}' AS kind, {r.version} AS version)" for r in rules)
    return f"array({pairs})"


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows for every (blob, rule) pair, also where nothing is found.

    Where ``blobs`` has ``missing``, an array of (kind, version), only those rules are run on the blob.
    """
    def wanted(rule: Rule) -> str:
        if "missing" not in blobs.columns:
            return _cuts(rule)
        lacks = f"exists(missing, m -> m.kind = '{rule.kind}' AND m.version = {rule.version})"
        return f"IF({lacks}, {_cuts(rule)}, NULL)"

    cut = blobs.withColumnRenamed("text", "_text").selectExpr(
        "blob", f"array({', '.join(wanted(r) for r in rules)}) AS _cuts")
    # A row per match: the lengths of the piece before it, of the match and of its group.
    found = cut.selectExpr("blob", "inline(filter(_cuts, c -> c IS NOT NULL))").selectExpr(
        "blob", "kind", "version", "least",
        """posexplode(transform(matches, (m, i) -> struct(
               bigint(length(pieces[i])) AS gap, bigint(length(m)) AS span,
               length(groups[i]) AS decisive))) AS (at, cut)""")
    before = Window.partitionBy("blob", "kind", "version").orderBy("at")
    spans = found.withColumn("_end", F.sum(F.expr("cut.gap + cut.span")).over(before)).where(
        "cut.decisive >= least")
    listed = spans.groupBy("blob", "kind", "version").agg(
        F.sort_array(F.collect_list(F.expr("struct(_end - cut.span AS s, _end AS e)"))).alias("l"))
    pairs = blobs.selectExpr(
        "blob", f"inline({'missing' if 'missing' in blobs.columns else _pairs(rules)})")
    return pairs.join(listed, ["blob", "kind", "version"], "left").selectExpr(
        "blob", "kind", "version",
        "coalesce(transform(l, x -> x.s), CAST(array() AS array<bigint>)) AS starts",
        "coalesce(transform(l, x -> x.e), CAST(array() AS array<bigint>)) AS ends")


class Ledger:
    """The stored findings: a Parquet folder that only ever grows by whole writes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def rows(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def update(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Scan what ``versions`` (a ``text`` column) holds and the ledger lacks, per rule.

        A blob is scanned once, with all rules it lacks.
        """
        texts = versions.select(address().alias("blob"), text_or_empty().alias("text"))
        if not self.exists():
            scan_blobs(texts.dropDuplicates(["blob"]), rules).write.parquet(self.path)
            return
        seen = self.rows().groupBy("blob").agg(
            F.collect_set(F.struct("kind", "version")).alias("seen"))
        unseen = texts.join(seen, "blob", "left").selectExpr(
            "blob", "text", f"array_except({_pairs(rules)}, coalesce(seen, CAST(array() AS"
            " array<struct<kind: string, version: int>>))) AS missing").where(
                "size(missing) > 0").dropDuplicates(["blob"])
        scan_blobs(unseen, rules).write.mode("append").parquet(self.path)

    def findings(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """Per blob with any finding: ``spans``, an array of (start, end, kind, order of kind)."""
        known = ", ".join(
            f"struct('{r.kind}' AS kind, {r.version} AS version, {i} AS rank)"
            for i, r in enumerate(rules))
        wanted = self.rows().where(F.size("starts") > 0).selectExpr(
            "*", f"filter(array({known}), r -> r.kind = kind AND r.version = version) AS _rule"
        ).where(F.size("_rule") > 0)
        # A blob met in two overlapping runs may be stored twice; equal spans are one span.
        return wanted.selectExpr(
            "blob", "inline(arrays_zip(starts, ends))", "kind", "_rule[0].rank AS rank"
        ).groupBy("blob").agg(F.sort_array(F.collect_set(
            F.expr("struct(starts AS start, rank, ends AS end, kind)"))).alias("spans"))


def scan(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, ``blob`` and ``spans`` of every row, after bringing the ledger up to date."""
    ledger.update(docs, rules)
    paths = docs.select("doc_id", address().alias("blob"))
    return paths.join(ledger.findings(rules), "blob", "left").select(
        "doc_id", "blob", F.expr(
            "coalesce(spans, CAST(array() AS"
            " array<struct<start: bigint, rank: int, end: bigint, kind: string>>)) AS spans"))


def redact(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES,
           mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; overlapping spans are one."""
    ledger.update(docs, rules)
    blob, spans = fresh(docs, "_blob"), fresh(docs, "_spans")
    cut = fresh(docs, "_cut")
    found = ledger.findings(rules).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    joined = docs.withColumn(blob, address()).join(found, blob, "left")
    # Uncovered stretches lie between the furthest end so far and the next start.
    stretches = f"""aggregate(`{spans}`,
        struct(CAST(array() AS array<struct<a: bigint, z: bigint>>) AS kept, 0L AS reach),
        (s, x) -> struct(
            IF(x.start >= s.reach OR size(s.kept) = 0,
               concat(s.kept, array(struct(s.reach AS a, x.start AS z))), s.kept) AS kept,
            greatest(s.reach, x.end) AS reach))"""
    redacted = f"""CASE WHEN `{spans}` IS NULL THEN text ELSE concat(
        array_join(transform(`{cut}`.kept,
                             k -> concat(substring(text, int(k.a + 1), int(k.z - k.a)),
                                         '{mask}')), ''),
        substring(text, int(`{cut}`.reach + 1))) END"""
    return joined.withColumn(cut, F.expr(stretches)).withColumn(
        "text", F.expr(redacted)).select(
            *[F.col("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
