"""Conversation repair against exhaustive search and a plain version of the contract."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from ledgerloom.llm import common, queries, repair

COLUMNS = "conv_id long, turn long, role string, text string, code string"
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
NEVER = (10**9, "")


def cheapest(codes):
    """The least (cost, audit) by trying all edits, two inserts in a row at most."""
    sys.setrecursionlimit(20_000)
    role_after = {0: 2, 1: 2, 2: 3, 3: 2}

    @lru_cache(None)
    def of(i, last, inserts):
        ways = [(0, "")] if i == len(codes) and last in (0, 3) else []
        nexts = []
        if inserts < 2:
            nexts.append((3, "I", i, role_after[last], inserts + 1))
        if i < len(codes):
            code, more = codes[i], 3 * codes[i].isupper()
            nexts.append((4, "D", i + 1, last, 0))
            if code != "x":
                nexts.append((3 + more, "R", i + 1, role_after[last], 0))
                role = {"s": 1, "u": 2, "a": 3}.get(code.lower())
                if role == 1 and last == 0 or role is not None and role == role_after[last]:
                    nexts.append((more, "K", i + 1, role, 0))
        for cost, letter, *node in nexts:
            rest = of(*node)
            if rest != NEVER:
                ways.append((cost + rest[0], letter + rest[1]))
        return min(ways, default=NEVER)

    return of(0, 0, 0)


@pytest.mark.parametrize("letters", ["suaoSUAOx", "ua", "uux", "sa", "oO", "AU"])
def test_search(letters):
    rnd = random.Random(letters)
    for n in [0, 1, 2, 3, *range(4, 40, 3)] * 4:
        codes = "".join(rnd.choices(letters, k=n))
        assert repair.search(codes) == cheapest(codes), codes


def test_search_of_all_short_conversations():
    from itertools import product

    for n in range(4):
        for codes in product("suaoUx", repeat=n):
            assert repair.search("".join(codes)) == cheapest("".join(codes))


def said(conv, k):
    """A text of conversation ``conv``: sound, blank, truncated, said before."""
    return ["Yes.", " \t", "and then", f"Line {k}!", f"é {conv} {k}?  \n", "Done. ", "", "No"][k % 8]


def rows():
    rnd = random.Random(3)
    found = []
    for conv in [*range(1, 30), None]:
        for turn in range(rnd.randint(1, 9)):
            found.append((conv, None if rnd.random() < .1 else turn + 2 * (turn > 4),
                          rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
                          None if rnd.random() < .05 else said(conv, rnd.randint(0, 40)), "x"))
    found += [(50, k, ["user", "assistant"][k % 2], f"Turn {k}.", "x") for k in range(400) if k % 37]
    found += [(51, 7, "user", "Same.", "x")] * 30 + [(52, None, "system", "Only.", "x")]
    return [*found, *found[:4]]


def order(row):
    text = hashlib.md5(f"{row[2]}\n{row[3]}".encode()).hexdigest()
    return (row[1] is not None, row[1] or 0, text)


def contract(turns):
    """The columns of a conversation, from its damaged rows."""
    turns, seen, codes, faults = sorted(turns, key=order), set(), "", []
    for _, _, role, text in turns:
        fault = ("blank" if BLANK.match(text) else "duplicate" if (role, text) in seen
                 else "truncated" if text.rstrip(" \t\n\v\f\r")[-1] not in ".!?" else "")
        seen.add((role, text))
        faults.append(fault)
        letter = role[0] if role[:1] in tuple("sua") else "o"
        codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = cheapest(codes)
    out, i, last = [], 0, None
    for letter in audit:
        made = "assistant" if last == "user" else "user"
        if letter == "I":
            out.append((made, ""))
        elif letter == "R":
            out.append((made, turns[i][3]))
        elif letter == "K":
            out.append(turns[i][2:])
            made = {"u": "user", "a": "assistant", "s": "system"}[turns[i][2][0]]
        last = last if letter == "D" else made
        i += letter != "I"
    known = [t[1] for t in turns if t[1] is not None]
    initials = [t[2][:1] for t in turns]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damaged():
    """conv_id to its rows after damage, for all conversations."""
    found = {}
    for conv, turn, role, text, _ in rows():
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        made = (conv, turn, "user" if kind == 4 else role, text)
        found.setdefault(conv, []).extend([made] * {0: 0, 3: 2}.get(kind, 1))
    return found


@pytest.mark.parametrize("bits", [10, 2, 0])
def test_repair(spark, tmp_path, monkeypatch, bits):
    """The query's columns, with conversations in one segment, in many, and a row a segment."""
    common.ship(spark)
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    spark.createDataFrame(rows(), COLUMNS).repartition(3).write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = queries.op11_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {k: contract(v) for k, v in damaged().items()}
    assert len(got) == len(damaged()) and any(not v for v in damaged().values()) is False


def test_repair_of_nothing(spark, tmp_path):
    """No rows; and a conversation whose only row is dropped."""
    common.ship(spark)
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    for name, kept in (("none", []), ("gone", [(gone, 0, "user", "Hello.", "x")])):
        spark.createDataFrame(kept, COLUMNS).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = [tuple(r) for r in queries.op11_repair(spark, f"{tmp_path}/{name}").collect()]
        assert got == [(k[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for k in kept]


def test_repaired_conversations_are_sound(spark):
    common.ship(spark)
    ordered = repair.ordered(spark.createDataFrame(rows(), COLUMNS))
    made = repair.repaired(ordered, repair.plan(ordered)).collect()
    said_by = {}
    for r in sorted(made, key=lambda r: (r.order_id, r.edit_no)):
        said_by.setdefault(r.conv, []).append(r.role[0])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in said_by.values())
