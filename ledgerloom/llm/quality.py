"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps one bit per failed rule and the
measurements behind the bits; policies are masks over those bits, so a new policy or an ablation
never touches the texts again. Everything is SQL expressions over one row: no shuffle is needed.

Defined results: a null text has no words. Null ids and repeated rows are rated row by row. An empty
table gives an empty ledger. Other columns of the input are ignored by ``ledger`` and passed through
by ``keep_documents``, whatever their names are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_GAP, fresh, text_or_empty

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Rule -> SQL over the measurements that is true where the rule fails. The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 25 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules a document must not fail."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Mapping[str, str] = RULES) -> int:
        return sum(1 << list(rules).index(rule) for rule in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
DEFAULT = Policy("default", 2, tuple(RULES))


def _measured(df: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and the measurements. The steps are projections that Spark pipelines.

    The 3-word windows of a text are 64-bit values of hash bits above the window's position, as
    many low bits as the position needs. After sorting, windows with equal hash bits are neighbours
    and are compared by their words. Where neighbours differ, windows of other words may stand between
    equal ones; all windows with those hash bits are then sorted by their words. So the counts are exact
    however few bits are left.
    """

    def same(p: str, q: str) -> str:
        return " AND ".join(f"_words[{p} + {k}] = _words[{q} + {k}]" for k in range(3))

    steps = df.select(*keep, text.alias("_text"))
    carried = steps.columns[:-1]
    steps = steps.selectExpr(
        *_quoted(carried),
        f"array_remove(split(_text, '{_sql(WORD_GAP)}', -1), '') AS _words",
        r"filter(split(_text, '\n', -1), x -> x RLIKE '[^\\x20\\x09-\\x0D]') AS _lines",
        r"length(regexp_replace(_text, '[^#*$%&|<>]+', '')) AS _symbols")
    steps = steps.selectExpr(
        *_quoted(carried), "_words", "_lines", "_symbols", "length(bin(size(_words))) AS _bits")
    steps = steps.selectExpr(
        *_quoted(carried), "_words", "_lines", "_symbols", "_bits",
        """CASE WHEN size(_words) < 3 THEN CAST(array() AS array<bigint>) ELSE sort_array(transform(
               sequence(0, size(_words) - 3),
               i -> shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), _bits) | bigint(i)
           )) END AS _windows""")
    steps = steps.selectExpr(
        *_quoted(carried), "_words", "_lines", "_symbols", "_bits", "_windows",
        """CASE WHEN size(_windows) < 2 THEN CAST(array() AS array<struct<p: int, q: int>>)
           ELSE transform(
               filter(sequence(0, size(_windows) - 2),
                      j -> shiftrightunsigned(_windows[j], _bits)
                           = shiftrightunsigned(_windows[j + 1], _bits)),
               j -> struct(int(_windows[j] & (shiftleft(1L, _bits) - 1)) AS p,
                           int(_windows[j + 1] & (shiftleft(1L, _bits) - 1)) AS q)
           ) END AS _pairs""")
    steps = steps.selectExpr(
        *_quoted(carried), "_words", "_lines", "_symbols", "_bits", "_windows", "_pairs",
        f"""array_distinct(transform(
                filter(_pairs, x -> NOT ({same('x.p', 'x.q')})),
                x -> shiftleft(xxhash64(_words[x.p], _words[x.p + 1], _words[x.p + 2]), _bits)
            )) AS _mixed""")
    steps = steps.selectExpr(
        *_quoted(carried), "_words", "_lines", "_symbols", "_pairs",
        """CASE WHEN size(_mixed) = 0
           THEN CAST(array() AS array<struct<a: string, b: string, c: string, p: int>>)
           ELSE sort_array(transform(
               transform(
                   filter(_windows, v -> array_contains(_mixed, v - (v & (shiftleft(1L, _bits) - 1)))),
                   v -> int(v & (shiftleft(1L, _bits) - 1))),
               p -> struct(_words[p] AS a, _words[p + 1] AS b, _words[p + 2] AS c, p AS p)
           )) END AS _sorted""")
    steps = steps.selectExpr(
        *_quoted(carried), "_words", "_lines", "_symbols",
        f"""concat(filter(_pairs, x -> {same('x.p', 'x.q')}),
                   CASE WHEN size(_sorted) < 2 THEN CAST(array() AS array<struct<p: int, q: int>>)
                   ELSE transform(
                       filter(sequence(0, size(_sorted) - 2), j ->
                              _sorted[j].a = _sorted[j + 1].a AND _sorted[j].b = _sorted[j + 1].b
                              AND _sorted[j].c = _sorted[j + 1].c),
                       j -> struct(_sorted[j].p AS p, _sorted[j + 1].p AS q)) END) AS _equal""")
    return steps.selectExpr(
        *_quoted(carried),
        "bigint(size(_words)) AS n_words",
        "bigint(length(array_join(_words, ''))) AS word_chars",
        "bigint(_symbols) AS n_symbols",
        "bigint(size(_lines) - size(array_distinct(_lines))) AS n_dup_lines",
        """bigint(size(array_distinct(flatten(transform(
               _equal,
               x -> array(x.p, x.p + 1, x.p + 2, x.q, x.q + 1, x.q + 2)))))) AS n_repeat_words""",
        "bigint(size(_lines)) AS n_lines")


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def _bits(rules: Mapping[str, str]) -> Column:
    terms = [f"IF({fails}, {1 << i}L, 0L)" for i, fails in enumerate(rules.values())]
    return F.expr(" | ".join(terms))


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``doc_id``, every measurement and ``failed_bits``, one row per document row."""
    measured = _measured(docs, text_or_empty(), [F.col("doc_id")])
    return measured.withColumn("failed_bits", _bits(rules))


def apply_policy(ledger_rows: DataFrame, policy: Policy,
                 rules: Mapping[str, str] = RULES) -> DataFrame:
    """The ledger with ``kept`` under ``policy``; reads bits only."""
    return ledger_rows.withColumn(
        "kept", F.col("failed_bits").bitwiseAND(F.lit(policy.mask(rules))) == 0)


def ablations(ledger_rows: DataFrame, policies: list[Policy],
              rules: Mapping[str, str] = RULES) -> DataFrame:
    """Per policy and rule: documents kept now, and kept if the rule were left out.

    The ledger is first reduced to a count per bit pattern, of which there are at most
    ``2 ** len(rules)`` whatever the number of documents.
    """
    patterns = ledger_rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = ", ".join(
        f"struct('{p.name}' AS policy, {p.version} AS version, '{r}' AS rule, "
        f"{p.mask(rules)}L AS mask, {1 << list(rules).index(r)}L AS bit)"
        for p in policies for r in p.rules)
    return (
        patterns.selectExpr("failed_bits", "n", f"inline(array({cases}))")
        .groupBy("policy", "version", "rule")
        .agg(F.expr("sum(IF(failed_bits & mask = 0, n, 0))").alias("kept"),
             F.expr("sum(IF(failed_bits & mask & ~bit = 0, n, 0))").alias("kept_without"),
             F.expr("sum(IF(failed_bits & bit <> 0, n, 0))").alias("failing"))
    )


def keep_documents(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with their columns."""
    row = fresh(docs, "_row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                         text_or_empty().alias("_rated"))
    measured = _measured(packed, F.col("_rated"), [F.col(row)])
    kept = apply_policy(measured.withColumn("failed_bits", _bits(RULES)), policy)
    # A filter would be moved below the measurements and repeat their expressions many times over.
    return kept.select(F.explode(F.expr(f"IF(kept, array(`{row}`), array())")).alias(row)).select(
        f"{row}.*")
