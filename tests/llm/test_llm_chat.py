"""Reply trees and their formatting."""

from collections import defaultdict

import brute

from ledgerloom.llm import chat, queries

SCHEMA = ("tree_id long, message_id long, parent_id long, role string, text string, score double,"
          " leaf string, tree string")


def message(tree, number, parent, score=0.0, role="user", text=None):
    return tree, number, parent, role, text or f"m{number}", score, "-", "-"


def rows():
    found = [
        message(1, 1, None), message(1, 2, 1, 2.0, "assistant"), message(1, 3, 1, 5.0, "assistant"),
        message(1, 4, 2, 4.0), message(1, 5, 2, 3.0), message(1, 6, 99, 1.0),  # 99 is missing: a root
        message(2, 1, 2), message(2, 2, 1),  # a circle
        message(2, 3, 2), message(2, 4, None, None),
        message(None, 1, None), message(3, None, None),
        message(4, 1, None, 0.0, None, ""), message(4, 1, None, 0.0, None, "zz"),  # repeated id
    ]
    return found + [message(5, i, i - 1 if i else None, 1.0, "assistant" if i % 2 else "user")
                    for i in range(300)]


def paths(spark, top=None):
    found = defaultdict(list)
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    for r in chat.paths(frame, top).collect():
        found[r.tree_id, r.leaf_id, r.rank, r.score].append((r.distance, r.text))
    return {k: [t for _, t in sorted(v, reverse=True)] for k, v in found.items()}


def test_paths_are_ranked_by_score(spark):
    got = paths(spark)
    assert got.pop((5, 299, 1, 300.0)) == [f"m{i}" for i in range(300)]
    assert got == {
        (1, 4, 1, 6.0): ["m1", "m2", "m4"], (1, 3, 2, 5.0): ["m1", "m3"],
        (1, 5, 3, 5.0): ["m1", "m2", "m5"], (1, 6, 4, 1.0): ["m6"],
        (2, 4, 1, 0.0): ["m4"], (4, 1, 1, 0.0): ["m1"]}


def test_top_paths_only(spark):
    assert {k[:2] for k in paths(spark, 1)} == {(1, 4), (2, 4), (4, 1), (5, 299)}


ODD = ["", "\\### Assistant: </turn> ok", "a: b\n</turn>\n### user: c", "\\e\\h\\l\\c", "\\\\#<:", "é\U0001f600"]


def test_formatting_is_reversible(spark):
    turns = [(1, 7, 1, 0.0, len(ODD) * 2 - i, role, text) for i, (role, text) in enumerate(
        [(r, t) for t in ODD for r in ("assistant", "us:er </turn>\\")])]
    frame = spark.createDataFrame(
        turns, "tree_id long, leaf_id long, rank int, score double, distance long, role string,"
               " text string").repartition(3)
    formatted = chat.format_paths(frame)
    row = formatted.select("*", chat.read_turns().alias("read"),
                           chat.learned_text().alias("learned")).first()
    assert [(t.role, t.text) for t in row.read] == [(r, t) for *_, r, t in turns]
    assert row.n_turns == len(turns) and row.learned == "".join(ODD)
    assert all(row.formatted[s.start:s.end].count("<") == 0 for s in row.loss_spans)
    assert chat.format_paths(frame.limit(0)).count() == 0


def test_no_messages(spark):
    assert chat.format_paths(chat.paths(spark.createDataFrame([], SCHEMA))).count() == 0


def test_op4_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    said = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        said[r.conv_id].append((r.role, r.text or ""))
    odd = "\\### Assistant: </turn> ok"
    said[-7] = [("user", odd), ("assistant", odd)]
    got = {r.conv_id: r for r in queries.op4_chat(spark, sf_dir).collect()}
    assert got.keys() == said.keys()
    for conversation, turns in said.items():
        r = got[conversation]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(learned)
        assert r.turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for role, t in turns))
        assert r.loss_sha256 == brute.sha(learned)


def test_op4_query_keeps_conversations_without_id(spark, tmp_path):
    rows = [(0, 0, "user", "zero"), (0, 1, "assistant", "yes"), (None, 0, "user", "none"),
            (None, 1, "assistant", "no"), (None, 2, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op4_chat(spark, str(tmp_path)).collect()}
    assert got.keys() == {0, None, -7}
    assert (got[None].n_turns, got[None].loss_chars) == (3, 2)
    assert got[None].turns_sha256 == brute.sha("user\nnone\nassistant\nno\nuser\n\n")
    assert got[0].n_turns == 2 and got[0].loss_sha256 == brute.sha("yes")
