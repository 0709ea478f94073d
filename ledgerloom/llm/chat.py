"""Chat formatting of reply trees.

Messages name their parent. Paths from a root to each leaf are found by self-joins that double the
distance each time: after round i every message knows its ancestor 2**i steps up and the summed
score of the steps, so a tree of depth d takes log2(d) rounds on slim rows (no texts). Leaves are
ranked by path score; the ancestors of the chosen leaves are read off the stored rounds, and each
path is formatted as one conversation.

The template is ``### role: text</turn>`` and a line break per turn. Inside roles and texts the
characters ``\\ # < :`` are written ``\\e \\h \\l \\c`` (the colon in roles only), so no control
string can occur there and unescaping gives the text back. The loss mask is a list of spans (code
points) over the formatted string: the texts of assistant turns.

Defined results: null roles and texts are empty; a message whose parent is null or missing is a root;
of repeated message ids in a tree the smallest row counts; messages without a tree or message id,
and those that reach no root because their parents form a circle, are on no path; equal scores rank
by leaf id; null scores count as 0. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.materialize import materialize

TURN, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\e"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
LEARNED_ROLE = "assistant"


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes=ROLE_ESCAPES) -> Column:
    """Every backslash starts an escape, and the backslash itself is put back last."""
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _rounds(links: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored doubling rounds, and the links after the last one.

    A round has (tree, id, up, score): the ancestor 2**i steps up, null past the root, and the sum
    of scores of the messages before it.
    """
    rounds = [links]
    for i in range(max(most, 1).bit_length() + 1):
        here = rounds[-1]
        going = here.where("up IS NOT NULL")
        if going.isEmpty():
            break
        above = here.select("tree", F.col("id").alias("up"), F.col("up").alias("up2"),
                            F.col("score").alias("score2"))
        # Messages that have reached their root are carried over, not joined again.
        further = going.join(above, ["tree", "up"]).select(
            "tree", "id", F.col("up2").alias("up"),
            (F.col("score") + F.col("score2")).alias("score"))
        rounds.append(materialize(
            further.unionByName(here.where("up IS NULL")), f"reply_round_{i}"))
    return rounds[:-1], rounds[-1]


def paths(messages: DataFrame, top: int | None = None) -> DataFrame:
    """The turns on the paths to the ``top`` leaves of every tree (all leaves if None).

    Columns: tree_id, leaf_id, rank (1 is the best), score, distance (0 at the leaf), role, text.
    """
    unique = materialize(
        messages.where("tree_id IS NOT NULL AND message_id IS NOT NULL")
        .groupBy("tree_id", "message_id")
        .agg(F.min(F.struct(
            "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
        .select(F.col("tree_id").alias("tree"), F.col("message_id").alias("id"), "m.*"),
        "reply_messages")
    ids = unique.select("tree", F.col("id").alias("parent_id"), F.lit(True).alias("there"))
    links = materialize(
        unique.join(ids, ["tree", "parent_id"], "left").select(
            "tree", "id", F.when(F.col("there"), F.col("parent_id")).alias("up"), "score"),
        "reply_links")
    most = unique.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    rounds, done = _rounds(links, most)
    parents = links.select("tree", F.col("up").alias("id")).where("id IS NOT NULL")
    leaves = done.where("up IS NULL").join(parents, ["tree", "id"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "id")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    on_path = ranked.select("tree", F.col("id").alias("leaf"), "rank", "score", "id",
                            F.lit(0).cast("long").alias("distance"))
    for i in reversed(range(len(rounds))):
        up = rounds[i].select("tree", "id", "up").where("up IS NOT NULL")
        on_path = on_path.join(up, ["tree", "id"], "left").select(
            "tree", "leaf", "rank", "score", F.explode(F.expr(
                f"filter(array(struct(id AS id, distance AS distance),"
                f" struct(up AS id, distance + {1 << i} AS distance)), x -> x.id IS NOT NULL)"
            )).alias("step")).select("tree", "leaf", "rank", "score", "step.*")
    return on_path.join(unique.select("tree", "id", "role", "text"), ["tree", "id"]).select(
        F.col("tree").alias("tree_id"), F.col("leaf").alias("leaf_id"), "rank", "score",
        "distance", "role", "text")


def format_paths(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One row per path: ``formatted``, ``loss_spans`` (start, end; code points) and ``n_turns``."""
    by = ["tree_id", "leaf_id"]
    head = F.concat(F.lit(TURN), escape(F.col("role"), ROLE_ESCAPES), F.lit(ROLE_END))
    parts = turns.select(*by, "rank", "score", "distance", head.alias("head"),
                         escape(F.col("text")).alias("body"),
                         (F.col("role") == learned_role).alias("learned"))
    before = Window.partitionBy(*by).orderBy(F.desc("distance"))
    tail = len(TURN_END)
    placed = parts.withColumn(
        "end", F.sum(F.length("head") + F.length("body") + tail).over(before) - tail)
    placed = placed.withColumn("start", F.col("end") - F.length("body"))
    span = F.struct(F.col("start").cast("long").alias("start"),
                    F.col("end").cast("long").alias("end"))
    turn = F.struct((-F.col("distance")).alias("at"), F.concat("head", "body").alias("written"))
    return placed.groupBy(*by, "rank", "score").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("learned"), span))).alias("loss_spans"),
    ).select(*by, "rank", "score", "n_turns", F.expr(
        "concat(array_join(transform(turns, t -> t.written), '</turn>\\n'), '</turn>\\n')"
    ).alias("formatted"), "loss_spans")


def read_turns(formatted: str = "formatted") -> Column:
    """The turns of a formatted conversation: an array of (role, text), unescaped."""
    parts = F.split(F.col(formatted), TURN_END)
    pieces = F.slice(parts, 1, F.size(parts) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(F.substr(piece, F.lit(len(TURN) + 1)), ROLE_END, 2)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.col(spans), lambda s: unescape(F.substr(
        F.col(formatted), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
