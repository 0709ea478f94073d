"""Repair of conversation structure by depth-first branch-and-bound.

A sound conversation has the role initials ``(s?(ua)+)?`` and no faulty row. The first fault of a row
counts: blank (no character outside white space), duplicate (role and text seen earlier in the
conversation), truncated (the last such character is not ``.``, ``!`` or ``?``). Edits, with the
letters of the audit and the costs: Keep 0, Rerole to user or assistant 3, Delete 4 (all a
blank or duplicate row can have), Insert an empty user or assistant row 3; a truncated row that is not
deleted adds 3. ``plan`` finds the cheapest edits, of those the ASCII-least audit.

``search`` is the branch-and-bound: an explicit stack, the most promising edit first; lower bounds of each
suffix after each role; the incumbent (cost, audit), against which prefixes are cut; and a table of the
best prefix at each node (rows done, role that stands last), which eliminates prefixes that reach a
node worse. The search ends when the stack is empty, so the incumbent is proved. Of two equally
cheap prefixes at one node neither begins with the other, because what they differ by would be inserts,
which cost; so their order is that of their completions, and the table loses nothing. Bounds that
leave out what stands last (each row at its cheapest) were tried first: they cut so little that
conversations of some hundred mixed rows did not end.

Conversations of any length: rows are sorted into ranges of (conversation, turn), and a segment is at
most SEGMENT neighbouring rows of one conversation in a range. A conversation in one segment is searched
as it is. Of longer ones, each segment is searched for every pair of roles before and after it, and the
best chain of segments is found by two passes over rows of some hundred bytes a segment, streamed in
order. Inserts stand before a row of their segment, or at the very end, so that a cut leaves one
way to write an audit.

Defined results: rows are taken by turn, nulls first, rows of one turn by the md5 of role and text; null
roles and texts are one space; rows without conversation id are one conversation. A role whose initial
is not s, u or a (an empty one, too) cannot be kept. Equal rows of a conversation are duplicates of its
first. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.materialize import materialize

# Rows of a segment: 2**SEGMENT_BITS at most.
SEGMENT_BITS = 10
BLANKS = " \t\n\x0b\f\r"

# What stands last: nothing, a system, a user or an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
REROLE = INSERT = TRUNCATED = 3
DELETE = 4
# A cost that no conversation has.
NEVER = 1 << 60
# What a sequence that ends so still lacks.
CLOSING = ("", "II", "I", "")


def _next(last: int) -> int:
    """The role that a rerole or an insert gives after ``last``."""
    return ASSISTANT if last == USER else USER


def _keeps(code: str, last: int) -> int | None:
    """What stands last when a row is kept after ``last``; None if it cannot be."""
    kept = KEPT.get(code.lower())
    if kept == SYSTEM:
        return SYSTEM if last == START else None
    return kept if kept == _next(last) else None


def _ways(codes: str, done: int, last: int, goal: int | None) -> list[tuple[int, str, int, int]]:
    """The edits at a node: cost, letter, rows done, role that stands last."""
    ways = []
    if done < len(codes) or goal is None:
        ways.append((INSERT, "I", done, _next(last)))
    if done < len(codes):
        code = codes[done]
        rest = TRUNCATED * code.isupper()
        ways.append((DELETE, "D", done + 1, last))
        if code != "x":
            ways.append((REROLE + rest, "R", done + 1, _next(last)))
            kept = _keeps(code, last)
            if kept is not None:
                ways.append((rest, "K", done + 1, kept))
    return ways


def lower_bounds(codes: str, goal: int | None = None) -> list[list[int]]:
    """Per number of rows done and role that stands last, the least that the rest can cost.

    Costs only, so a search still has to tell audits of equal cost apart.
    """
    sound = [START, ASSISTANT] if goal is None else [goal]
    bounds = [[0 if last in sound else NEVER for last in range(4)]]
    for done in range(len(codes), -1, -1):
        here = bounds[-1] if done == len(codes) else [NEVER] * 4
        for _ in range(3):  # two inserts at most change what stands last for the better
            for last in range(4):
                for more, letter, place, role in _ways(codes, done, last, goal):
                    ahead = here if letter == "I" else bounds[-1]
                    here[last] = min(here[last], more + ahead[role])
        if done < len(codes):
            bounds.append(here)
    return bounds[::-1]


def search(codes: str, start: int = START, goal: int | None = None,
           bounds: list[list[int]] | None = None) -> tuple[int, str]:
    """The least (cost, audit) of the rows in ``codes`` after a row of the role ``start``.

    A letter per row: s, u, a or o by the role, upper case if truncated, x if blank or duplicate. With a
    ``goal`` that role stands last; else the conversation ends there and is sound. ``bounds`` are
    those of ``codes`` and ``goal``.
    """
    bounds = lower_bounds(codes, goal) if bounds is None else bounds
    incumbent = (NEVER, "")
    best = {(0, start): (0, "")}
    stack = [(0, start, 0, "")]
    while stack:
        done, last, cost, audit = stack.pop()
        least = cost + bounds[done][last]
        if least > incumbent[0] or least == incumbent[0] and audit > incumbent[1][:len(audit)]:
            continue
        if best[done, last] != (cost, audit):
            continue  # a better prefix came here since
        if done == len(codes) and (last == goal if goal is not None else not CLOSING[last]):
            incumbent = min(incumbent, (cost, audit))
            continue
        children = []
        for more, letter, place, role in _ways(codes, done, last, goal):
            reached = (cost + more, audit + letter)
            if (place, role) not in best or reached < best[place, role]:
                best[place, role] = reached
                children.append((more + bounds[place][role], letter, place, role, *reached))
        # The most promising is pushed last and searched first.
        stack += [child[2:] for child in sorted(children, reverse=True)]
    return incumbent


def edits(codes: str, audit: str, last: int = START) -> Iterator[tuple[int, str, int]]:
    """(row, letter, role) of each edit; an insert has the number of the row it stands before."""
    row = 0
    for letter in audit:
        if letter != "D":
            last = _keeps(codes[row], last) if letter == "K" else _next(last)
        yield row, letter, last
        row += letter != "I"


def key() -> Column:
    """A conversation as a string; rows without id have a key of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def ordered(turns: DataFrame) -> DataFrame:
    """The stored rows with ``conv`` (key), ``order_id``, ``segment``, ``initial``, ``fault`` and ``code``.

    ``order_id`` ascends by conversation and turn, without gaps inside a segment.
    """
    rows = turns.select(
        key().alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")).withColumn(
            "tie", F.expr("md5(concat(role, '\\n', text))"))
    rows = materialize(
        rows.repartitionByRange("conv", "turn", "tie").sortWithinPartitions("conv", "turn", "tie")
        .withColumn("order_id", F.monotonically_increasing_id()), "repair_rows")
    first = rows.groupBy("conv", "tie").agg(F.min("order_id").alias("first_id"))
    said = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(said == "", "blank").when(F.col("order_id") > F.col("first_id"), "duplicate")
             .when(~F.substring(said, -1, 1).isin(".", "!", "?"), "truncated"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin(*KEPT), initial).otherwise("o")
    return rows.join(first, ["conv", "tie"]).select(
        "conv", "conv_id", "turn", "role", "text", "order_id",
        F.shiftright("order_id", SEGMENT_BITS).alias("segment"), letter.alias("initial"),
        fault.alias("fault")).withColumn(
            "code", F.expr("CASE WHEN fault IN ('blank', 'duplicate') THEN 'x'"
                           " WHEN fault = 'truncated' THEN upper(initial) ELSE initial END"))


_SOLVED = "conv string, segment long, costs array<long>, audits array<string>, ranks array<int>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, segment, codes, alone in zip(*(c.to_pylist() for c in batch.columns)):
            if alone:
                found, ranks = [search(codes)], [0]
            else:
                bounds = [lower_bounds(codes, b) for b in range(4)]
                found = [search(codes, a, b, bounds[b]) for a in range(4) for b in range(4)]
                # The place of an audit among those that start alike; none begins with another.
                ranks = [sorted(found[k - k % 4:k - k % 4 + 4], key=lambda x: x[1]).index(found[k])
                         for k in range(16)]
            rows.append((conv, segment, [c for c, _ in found], [a for _, a in found], ranks))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()),
                    pa.list_(pa.int32())))], [f.split()[0] for f in _SOLVED.split(", ")])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment, in order: whence each role that may stand last is best reached."""
    held = None
    for batch in batches:
        whence = []
        for conv, _, costs, ranks in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != held:
                held, reached, order = conv, [0, NEVER, NEVER, NEVER], [0, 1, 2, 3]
            best = [min(range(4), key=lambda m, k=k: (reached[m] + costs[4 * m + k], order[m]))
                    for k in range(4)]
            reached = [min(NEVER, reached[m] + costs[4 * m + k]) for k, m in enumerate(best)]
            by_audit = sorted(range(4), key=lambda k: (order[best[k]], ranks[4 * best[k] + k]))
            order = [by_audit.index(k) for k in range(4)]
            # Where the conversation may end: the closing inserts come last.
            ends = min(range(4), key=lambda k: (reached[k] + INSERT * len(CLOSING[k]), order[k]))
            whence.append(best + [ends])
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(whence, pa.list_(pa.int32()))],
                ["conv", "segment", "whence"])


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment, from the last: the roles before and after it, and what closes the conversation."""
    held = None
    for batch in batches:
        before, after, closing = [], [], []
        for conv, _, whence in zip(*(c.to_pylist() for c in batch.columns)):
            last = conv != held
            if last:
                held, role = conv, whence[4]
            after.append(role)
            closing.append(CLOSING[role] if last else "")
            role = whence[role]
            before.append(role)
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(before, pa.int32()),
                 pa.array(after, pa.int32()), pa.array(closing, pa.string())],
                ["conv", "segment", "before", "after", "closing"])


def plan(rows: DataFrame) -> DataFrame:
    """Per segment of ``ordered`` rows: conv, segment, first_id, codes, before, cost and audit."""
    by_place = "array_join(transform(array_sort(collect_list(struct(order_id, {0}))), x -> x.{0}), '')"
    segments = rows.groupBy("conv", "segment").agg(
        F.min("order_id").alias("first_id"), F.expr(by_place.format("code")).alias("codes"))
    only = (F.lag("segment").over(Window.partitionBy("conv").orderBy("segment")).isNull()
            & F.lead("segment").over(Window.partitionBy("conv").orderBy("segment")).isNull())
    segments = materialize(segments.withColumn("alone", only), "repair_segments")
    solved = materialize(
        segments.select("conv", "segment", "codes", "alone").mapInArrow(_solve, _SOLVED),
        "repair_solved")
    parts = solved.where(F.size("costs") > 1)
    whence = parts.select("conv", "segment", "costs", "ranks").repartition("conv") \
        .sortWithinPartitions("conv", "segment") \
        .mapInArrow(_forward, "conv string, segment long, whence array<int>")
    chain = whence.repartition("conv").sortWithinPartitions("conv", F.desc("segment")).mapInArrow(
        _backward, "conv string, segment long, before int, after int, closing string")
    place = F.expr("before * 4 + after + 1")
    long = parts.join(chain, ["conv", "segment"]).select(
        "conv", "segment", "before",
        (F.element_at("costs", place) + INSERT * F.length("closing")).alias("cost"),
        F.concat(F.element_at("audits", place), "closing").alias("audit"))
    short = solved.where(F.size("costs") == 1).select(
        "conv", "segment", F.lit(START).alias("before"), F.col("costs")[0].alias("cost"),
        F.col("audits")[0].alias("audit"))
    return materialize(
        segments.select("conv", "segment", "first_id", "codes").join(
            short.unionByName(long), ["conv", "segment"]), "repair_plan")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roles = [None, None, "user", "assistant"]
    for batch in batches:
        for conv, first, codes, before, audit in zip(*(c.to_pylist() for c in batch.columns)):
            found = list(edits(codes, audit, before))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(found), pa.string()),
                 # A closing insert belongs to the last row.
                 pa.array([first + min(row, len(codes) - 1) for row, *_ in found], pa.int64()),
                 pa.array(range(len(found)), pa.int32()),
                 pa.array([letter for _, letter, _ in found], pa.string()),
                 pa.array([roles[role] if letter in "RI" else None for _, letter, role in found],
                          pa.string())],
                ["conv", "order_id", "edit_no", "edit", "new_role"])


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Every row of the repaired conversations: conv, order_id, edit_no, edit, role and text.

    In the order of order_id and edit_no; deleted rows are left out.
    """
    made = plans.select("conv", "first_id", "codes", "before", "audit").mapInArrow(
        _edits, "conv string, order_id long, edit_no int, edit string, new_role string").where(
            "edit <> 'D'")
    said = rows.select("order_id", F.col("role").alias("old_role"), F.col("text").alias("old_text"))
    return made.join(said, "order_id").select(
        "conv", "order_id", "edit_no", "edit",
        F.coalesce("new_role", "old_role").alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("old_text")).alias("text"))


def digests(rows: DataFrame) -> DataFrame:
    """``conv`` and ``digest``: the SHA-256 of ``role:text``, newline-joined, of repaired rows.

    The hash runs along a conversation, so its rows are streamed in order, not gathered.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, done = None, None, []
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != held:
                    if digest is not None:
                        done.append((held, digest.hexdigest()))
                    held, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in zip(*done)], ["conv", "digest"])
                done = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([held]), pa.array([digest.hexdigest()])], ["conv", "digest"])

    return rows.repartition("conv").sortWithinPartitions("conv", "order_id", "edit_no").select(
        "conv", "role", "text").mapInArrow(run, "conv string, digest string")


def report(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Per conversation: gaps, the faults by kind, illegal neighbours, cost and audit."""
    faults = rows.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"),
        *[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")],
        F.coalesce(F.expr("max(turn) - min(turn) + 1 - count(DISTINCT turn)"), F.lit(0).cast("long"))
        .alias("gaps"))
    # Neighbours inside a segment come from its initials, those across from its first and last.
    by_place = "transform(array_sort(collect_list(struct(order_id, initial))), x -> x.initial)"
    segments = rows.groupBy("conv", "segment").agg(F.expr(by_place).alias("initials"))
    last = F.lag(F.element_at("initials", -1)).over(Window.partitionBy("conv").orderBy("segment"))
    pairs = "filter({0}, (x, i) -> i > 0 AND NOT concat({0}[i - 1], x) IN ('su', 'ua', 'au'))"
    illegal = segments.withColumn("initials", F.when(last.isNull(), F.col("initials")).otherwise(
        F.concat(F.array(last), "initials"))).groupBy("conv").agg(
            F.sum(F.expr(f"bigint(size({pairs.format('initials')}))")).alias("illegal"))
    planned = plans.groupBy("conv").agg(
        F.sum("cost").alias("cost"),
        F.expr("array_join(transform(array_sort(collect_list(struct(segment, audit))), x -> x.audit),"
               " '')").alias("audit"))
    return faults.join(illegal, "conv").join(planned, "conv")
