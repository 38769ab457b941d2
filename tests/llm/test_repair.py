"""Conversation repair against a plain walk over all edits, and ranks of least paths against strings."""

import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from foliant.llm import repair

SF = "/root/testdata/sf0.001"


def plain(rows):
    """Results of op12 by recursion over (row, pattern state), one conversation after the other."""
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, own in by.items():
        s = lambda v: " " if v is None else str(v)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, s(r[1]), hashlib.md5(s(r[2]).encode()).hexdigest()))
        after = []
        for turn, role, text in own:
            k = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
            role, text = s(role), s(text)
            if k == 0:
                continue
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            after += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
        turns = [t for t, _, _ in after if t is not None]
        seen, faults = set(), []
        for _, role, text in after:
            last = re.findall("[^\x20\x09-\x0d]", text)
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = "".join(r[:1] or "-" for _, r, _ in after)

        @cache
        def best(i, state):
            """(cost, audit, lines) of the rest; states: nothing, s, u, a."""
            return min(ways_without_insert(i, state) + inserted(i, state))

        def inserted(i, state, runs=2):
            """Insertions one after the other, at most ``runs``; more are never cheaper."""
            role = "assistant" if state == "u" else "user"
            out = []
            for c, a, x in ways_without_insert(i, role[0]) + (inserted(i, role[0], runs - 1) if runs > 1 else []):
                out.append((c + 3, "I" + a, (f"{role}:", *x)))
            return out

        @cache
        def ways_without_insert(i, state):
            role = "assistant" if state == "u" else "user"
            ways = [(0, "", ())] if i == len(after) and state in ("", "a") else []
            if i < len(after):
                c, a, x = best(i + 1, state)
                ways.append((c + 4, "D" + a, x))
                if faults[i] not in ("blank", "duplicate"):
                    more, text = 3 * (faults[i] == "truncated"), after[i][2]
                    c, a, x = best(i + 1, role[0])
                    ways.append((c + 3 + more, "R" + a, (f"{role}:{text}", *x)))
                    to = {"s": "s" if state == "" else None, "u": "u" if state != "u" else None, "a": "a" if state == "u" else None}.get(initials[i])
                    if to:
                        c, a, x = best(i + 1, to)
                        ways.append((c + more, "K" + a, (f"{after[i][1]}:{text}", *x)))
            return ways

        cost, audit, lines = best(0, "")
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }
    return out


def held(df):
    return {r.conv_id: {c: r[c] for c in df.columns if c != "conv_id"} for r in df.collect()}


def test_whole_table_by_plain_recursion(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    want = plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert held(repair.op12(spark, table)) == want
    assert len({w["audit"] for w in want.values()}) > 3


def random_rows(seed, convs=40, most=14):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "half", "", " \t", "Ä ü?", "a. ", "x", "Done. ok", None]
    roles = ["user", "assistant", "system", "tool", "User", "sage", "", None]
    rows = []
    for c in [*range(convs), None]:
        for _ in range(rnd.randrange(1, most)):
            rows.append((c, rnd.choice([None, *range(8)]), rnd.choice(roles[:3] * 3 + roles), rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("block", [2, 5, 256])
def test_blocks_ties_nulls_and_repeated_rows(spark, block, monkeypatch):
    """The same results whatever the size of a block, so whether a conversation is in one or in many."""
    monkeypatch.setattr(repair.repair, "__defaults__", (block,))
    rows = random_rows(block)
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    assert held(repair.op12(spark, df)) == plain(rows)


def test_long_conversation_and_empty_table(spark):
    """A conversation of many blocks with faults all along; and no rows."""
    rows = random_rows(3, convs=1, most=2) + [(7, i, ("user", "assistant")[i % 2] if i % 11 else "assistant", f"t {i}." if i % 7 else "cut") for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = held(repair.op12(spark, df))
    import sys

    sys.setrecursionlimit(20_000)
    assert got == plain(rows)
    assert repair.op12(spark, df.limit(0)).count() == 0
    dropped = [(c, 0, "user", "a.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    only = held(repair.op12(spark, spark.createDataFrame(dropped, "conv_id long, turn long, role string, text string")))
    assert len(only) == len(dropped) > 0
    assert all(v == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()} for v in only.values())


def test_ranks_are_the_order_of_least_strings():
    rnd = random.Random(1)
    codes = [bytes(rnd.randrange(16) for _ in range(n)) for n in (1, 7, 12, 12)]
    costs = repair.block_costs(codes, np.tile(np.array(repair.END)[None, :, None], (len(codes), 1, 1)))
    paths = repair.LeastPaths(codes, costs, [True] * len(codes))
    strings = []
    for v in range(len(paths.letter)):
        nodes, _ = paths.walk(np.array([v]))
        strings.append("".join(repair.SIGNS[i] for i in paths.letter[nodes]))
    order = sorted(set(strings))
    for a in range(len(strings)):
        for b in (a + 1, a + 7):
            if b < len(strings):
                x, y = order.index(strings[a]), order.index(strings[b])
                assert (x < y) == (paths.rank[a] < paths.rank[b]) and (x == y) == (paths.rank[a] == paths.rank[b])
