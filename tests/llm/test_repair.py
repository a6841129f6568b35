"""Repairs of conversations against enumeration of all edit sequences and against full paths per state."""

import hashlib
import random
import re
import zlib

import pytest

from vigil.llm import repair

TOWARDS = {"E": "U", "S": "U", "A": "U", "U": "A"}
ROLE = {"U": "user", "A": "assistant"}


def steps(state, role, must_go, truncated):
    """(next state, edit, price, role that stays) of a row."""
    yield state, "D", 4, None
    if must_go:
        return
    extra, to = (3 if truncated else 0), TOWARDS[state]
    if role[:1] == "s" and state == "E":
        yield "S", "K", extra, role
    if role[:1] == to.lower():
        yield to, "K", extra, role
    yield to, "R", extra + 3, ROLE[to]


def exhaustive(rows):
    """(cost, audit) over every edit sequence with at most two insertions in a row."""
    best = None

    def go(i, state, cost, audit, inserted):
        nonlocal best
        if i == len(rows) and state in "EA":
            best = (cost, audit) if best is None else min(best, (cost, audit))
        if inserted < 2:
            go(i, TOWARDS[state], cost + 3, audit + "I", inserted + 1)
        if i < len(rows):
            role, _, must_go, truncated = rows[i]
            for to, edit, price, _ in steps(state, role, must_go, truncated):
                go(i + 1, to, cost + price, audit + edit, 0)

    go(0, "E", 0, "", 0)
    return best


def full_paths(rows):
    """(cost, audit, repaired turns): whole strings per state, no tree."""

    def closed(paths):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, turns) in list(paths.items()):
                to = TOWARDS[state]
                new = (cost + 3, audit + "I", (*turns, (ROLE[to], "")))
                if to not in paths or new[:2] < paths[to][:2]:
                    paths[to], changed = new, True
        return paths

    paths = closed({"E": (0, "", ())})
    for role, text, must_go, truncated in rows:
        after = {}
        for state, (cost, audit, turns) in paths.items():
            for to, edit, price, stays in steps(state, role, must_go, truncated):
                new = (cost + price, audit + edit, turns if edit == "D" else (*turns, (stays, text)))
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        paths = closed(after)
    return min((paths[s] for s in "EA" if s in paths), key=lambda p: p[:2])


def repaired(rows):
    survivors, edits = repair.Survivors(), []
    for row in rows:
        survivors.row(*row)
        edits += survivors.final
        survivors.final = []
    cost = survivors.end()
    edits += survivors.final
    return cost, "".join(e for e, _ in edits), tuple(t for e, t in edits if e != "D")


ROLES = [["system", "user", "assistant"], ["user"], ["assistant"], ["system"], ["user", "assistant", "tool", " "], ["", "x", "system"]]


def some_rows(rng, n):
    roles, blank, cut = rng.choice(ROLES), rng.choice([0, 0.1, 0.5, 0.9]), rng.choice([0, 0.1, 0.5, 0.9])
    return [(rng.choice(roles), str(i), rng.random() < blank, rng.random() < cut) for i in range(n)]


def test_edits_equal_full_paths_and_enumeration():
    rng = random.Random(3)
    for k in range(4000):
        rows = some_rows(rng, rng.choice([0, 1, 2, 3, 4, 5, 8, 40]))
        got = repaired(rows)
        assert got == full_paths(rows)
        if len(rows) <= 4 and k % 4 == 0:
            assert got[:2] == exhaustive(rows)


def nodes(root):
    n, todo = 0, [root]
    while todo:
        node = todo.pop()
        n += 1
        todo += node.kids
    return n


@pytest.mark.parametrize("row", [
    lambda i: (["user", "assistant"][i % 2], "t", False, False),
    lambda i: ("user", "t", i > 0, False),  # never resolved, but only deletions
    lambda i: (["user", "system", "assistant"][i * 7 % 3], "t", i % 5 == 0, i % 3 == 0),
    lambda i: ("user", "t", False, True),
    lambda i: ("system", "t", False, True),
])
def test_the_tree_stays_small(row):
    survivors, most = repair.Survivors(), 0
    for i in range(3000):
        survivors.row(*row(i))
        survivors.final = []
        most = max(most, nodes(survivors.root)) if i % 50 == 0 else most
    assert most < 60


def test_a_long_undecided_conversation():
    # every row needs a role; only the end tells the first one's
    for n in (4000, 4001):
        rows = [("system", "t", False, False)] * n
        assert repaired(rows) == full_paths(rows[:n])


def brute_report(conv_id, rows):
    """The query's row by its definition. ``rows``: (turn, role, text) as stored."""
    after = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        after += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, told, counts, pairs = set(), [], [0, 0, 0], 0
    for i, (_, role, text) in enumerate(after):
        trimmed = text.strip(" \t\n\v\f\r")
        fault = 0 if not trimmed else 1 if (role, text) in seen else 2 if trimmed[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        told.append((role, text, fault in (0, 1), fault == 2))
        pairs += i > 0 and after[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    cost, audit, turns = full_paths(told)
    numbered = [t for t, _, _ in after if t is not None]
    gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    return (conv_id, gaps, *counts, pairs, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rng = random.Random(4)
    convs = {}
    for conv in [*range(120), None]:
        turns = [t for t in range(rng.randint(0, 9)) if rng.random() < 0.9]
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["tool", None, "user"]])
        rows = [(t if rng.random() < 0.95 else None, roles[i % len(roles)], rng.choice(["Yes.", "No! ", "why", "", None, " \n", "long text.\n" * 3, f"t{i}.", "é?\t"])) for i, t in enumerate(turns)]
        convs[conv] = rows + (rows[:1] if rng.random() < 0.2 else [])
    # one conversation with a third of all rows, longer than a few Arrow batches
    convs[500] = [(t, ["user", "assistant"][t % 2], f"text {t}.") for t in range(300)] + [(t, "user", "once more.") for t in range(300, 400)]
    rows = [(c, *r, 1) for c, rs in convs.items() for r in rs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, dropped int").drop("dropped").selectExpr("*", "1 AS position", "2 AS cost")
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((tuple(r) for r in repair.digest(repair.repair(repair.damaged(df))).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    want = sorted((brute_report(c, rs) for c, rs in convs.items() if rs), key=repr)
    assert got == want


def test_repaired_turns_alternate(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "There."), (2, 0, "assistant", "cut"), (3, 0, "system", "Rules.")]
    out = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    turns = {c: [(r.role, r.text) for r in sorted((r for r in out if r.conv_id == c and r.position is not None), key=lambda r: r.position) if r.edit != "D"] for c in (1, 2, 3)}
    assert turns == {1: [("user", "Hi."), ("assistant", "There.")], 2: [], 3: []}


def test_empty_table_and_dropped_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.digest(repair.repair(repair.damaged(df))).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(9, gone, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in repair.digest(repair.repair(repair.damaged(df))).collect()] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
