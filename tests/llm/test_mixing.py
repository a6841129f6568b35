"""The mix against targets by repeated resharing and systematic sampling by a loop."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from vigil.llm import mixing


def reshared(sizes, share=1.5, most=2):
    """Targets as the contract tells it: shares by weight, the excess over the limits given to the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, full, free = dict.fromkeys(names, 0.0), set(), sum(sizes.values()) * share
    while free > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        for s in open_:
            target[s] += free * weight[s] / sum(weight[x] for x in open_)
        free = 0.0
        for s in open_:
            if target[s] >= most * sizes[s]:
                free += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                full.add(s)
    return target


def brute(rows):
    words = [(d, s, len((t or "").encode().split())) for d, t, s in rows]
    by = defaultdict(list)
    for w in words:
        by[w[1]].append(w)
    sizes = {s: sum(w[2] for w in ws) for s, ws in by.items()}
    targets = reshared(sizes)
    out = []
    for s, ws in by.items():
        ws.sort(key=lambda w: (w[2], hashlib.md5(f"0:{'' if w[0] is None else w[0]}".encode()).hexdigest()))
        shift = int(hashlib.md5(f"0:{s or ''}".encode()).hexdigest()[:5], 16) / 16**5
        rate = targets[s] / sizes[s] if sizes[s] else 0.0
        for k, (d, _, n) in enumerate(ws):
            out.append((d, n, sizes[s], targets[s], (math.floor((k + 1) * rate + shift) - math.floor(k * rate + shift)) * n))
    return out


def some_rows(rng, n=400):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "Z", "é", "\U0001f600", "￿", None, "", "tiny"] if i > 20 else ["tiny", "nothing"])
        text = None if rng.random() < 0.02 else "" if source == "nothing" else " ".join(["w"] * int(rng.paretovariate(1) * 5))
        rows.append((i, text, source))
    return rows + [rows[5], rows[5], (None, "x y", "a"), (7, "z " * 20000, "b"), (8, "u v\x0bw", "b")]


def test_plan_equals_brute_force(spark):
    rows = some_rows(random.Random(1))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS `key`", "3 AS one")
    got = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.plan(df).collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[1], r[4])), sorted(want, key=lambda r: (str(r[0]), r[1], r[4]))):
        assert g[:3] == w[:3] and g[4] == w[4] and g[3] == pytest.approx(w[3])
    assert all(g[4] <= 2 * g[1] for g in got)


def test_taken_words_come_near_their_targets(spark):
    rows = some_rows(random.Random(2), 3000)
    got = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = defaultdict(list)
    for r in got:
        by[(r.source_size, r.target)].append(r)
    for (_, target), rs in by.items():
        assert abs(sum(r.taken for r in rs) - target) <= 2 * max(r.size for r in rs)
    assert sum({k: k[1] for k in by}.values()) == pytest.approx(1.5 * sum(r.size for r in got))


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 0, "b": 0}, {"a": 1, "b": 1000, "c": 1}, {"a": 100, "b": 1, "c": 1, None: 50}, {str(i): (i * 37) % 101 for i in range(40)}])
def test_targets_are_those_of_resharing(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    assert got == pytest.approx(reshared(sizes))


def test_mix_emits_what_the_plan_takes(spark):
    rows = some_rows(random.Random(3), 200)
    df = spark.createDataFrame([(s, t, d, i) for i, (d, t, s) in enumerate(rows)], "source string, text string, doc_id long, doc long")
    planned = Counter({(r.doc_id, r.size): 0 for r in mixing.plan(df).collect()})
    for r in mixing.plan(df).collect():
        planned[(r.doc_id, r.size)] += r.taken
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    emitted = Counter()
    for r in mixed.collect():
        size = len((r.text or "").encode().split())
        emitted[(r.doc_id, size)] += size
    assert {k: v for k, v in planned.items() if v} == {k: v for k, v in emitted.items() if v}
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mix(df).collect()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.plan(df).collect() == [] and mixing.mix(df).collect() == []
