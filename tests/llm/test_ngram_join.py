"""The chosen-path join and connected components against brute force."""

import math
import random

import pytest

from vigil.llm import ngram_join as nj
from vigil.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """class members, links per row (other distinct sets), copies per row; quadratic."""
    sets = [shingles(t) for _, t in rows]
    distinct = list(dict.fromkeys(sets))
    up = list(range(len(distinct)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(distinct)
    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    at = {s: i for i, s in enumerate(distinct)}
    classes: dict = {}
    for (i, _), s in zip(rows, sets):
        classes.setdefault(top(at[s]), []).append(i)
    return {i: (min(classes[top(at[s])]), links[at[s]], sets.count(s), len(classes[top(at[s])])) for (i, _), s in zip(rows, sets)}


def made(seed=4):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows = []
    for _ in range(60):
        base = [r.choice(vocabulary) for _ in range(r.choice([8, 40, 120, 300]))]
        rows.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 3, 8])):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append(" ".join(copy).upper() if r.random() < 0.2 else "  ".join(copy))
    notice = " all rights reserved by the very same owner of these pages "
    rows += [notice + " ".join(r.choice(vocabulary) for _ in range(30)) for _ in range(40)]
    rows += ["", None, " \n", "one", "one two three four", "One two\tthree four", "one two three four five", "x y"] + [rows[0]] * 7
    r.shuffle(rows)
    return list(enumerate(rows))


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'?' AS class_id", "0 AS sid").repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies, r.class_size) for r in nj.join(df).collect()}
    assert got == brute(rows)
    kept = sorted(r.doc_id for r in nj.keep_one(df).collect())
    assert kept == sorted({c for c, *_ in got.values()})


def test_join_equals_brute_force(spark):
    check(spark, made())


def test_large_alike_and_large_unlike_buckets(spark, monkeypatch):
    # small buckets, so that near copies are cut into cells and documents with one common passage are split
    monkeypatch.setattr(nj, "BUCKET", 10)
    r = random.Random(9)
    vocabulary = [f"v{k}" for k in range(2000)]
    base = [r.choice(vocabulary) for _ in range(100)]
    rows = []
    for _ in range(60):
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(100)] = r.choice(vocabulary)
        rows.append(" ".join(copy))
    passage = " ".join(r.choice(vocabulary) for _ in range(25))
    rows += [passage + " " + " ".join(r.choice(vocabulary) for _ in range(20)) for _ in range(60)]
    check(spark, list(enumerate(rows)))


@pytest.mark.parametrize("dense", [1, 16])
def test_sets_that_consist_of_a_common_passage_mostly(spark, monkeypatch, dense):
    # two thirds of every text is one passage; pairs at and over the threshold among 120 of them, met in dense buckets or by walking
    monkeypatch.setattr(nj, "BUCKET", 8)
    monkeypatch.setattr(nj, "DENSE", dense)
    r = random.Random(6)
    passage = " ".join(f"h{i}" for i in range(80))
    rows = []
    for k in range(60):
        words = [f"a{k}x{i}" for i in range(40)]
        other = list(words)
        for at in r.sample(range(2, 38), r.choice([1, 2])):
            other[at] = f"b{k}x{at}"
        rows += [f"{passage} " + " ".join(words), f"{passage} " + " ".join(other)]
    check(spark, list(enumerate(rows)))


def test_recall_at_the_threshold(spark):
    # pairs of similarity just over 0.8: the shares of common shingles are what they are by construction
    r = random.Random(2)
    rows = []
    for k in range(150):
        words = [f"p{k}x{i}" for i in range(64)]
        other = words[:53] + [f"q{k}x{i}" for i in range(1)] + words[53:]
        rows += [" ".join(words), " ".join(other)]
    got = nj.join(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    want = brute(list(enumerate(rows)))
    pairs = sum(w[1] for w in want.values())
    assert pairs == 300 and sum(g.n_links for g in got) >= 0.99 * pairs


def test_one_stated_miss_for_the_cut_off_and_every_depth():
    cut = sum(math.comb(nj.SKETCH, i) * 0.8**i * 0.2 ** (nj.SKETCH - i) for i in range(nj.AGREE))
    assert cut < 3.1e-10
    assert all((1 - nj.meeting(k)) ** nj.RUNS_AT[k] <= nj.MISS for k in range(1, nj.LEVELS + 1))


def test_pairs_at_the_threshold_whose_sketches_agree_little(spark, monkeypatch):
    # similarity 40 / 50; found by search: 82 of 128 sketch bytes agree. Small buckets and a passage shared by others split paths
    monkeypatch.setattr(nj, "BUCKET", 8)
    rows = []
    for k in (36372, 43388):
        words = [f"p{k}x{i}" for i in range(49)]
        rows += [" ".join(words), " ".join(words[:24] + [f"q{k}"] + words[25:])]
    passage = " ".join(f"h{i}" for i in range(40))
    for k in range(30):  # 30 pairs of similarity 80 / 100 that share the passage with all others
        words = [f"a{k}x{i}" for i in range(54)]
        rows += [f"{passage} " + " ".join(words), f"{passage} " + " ".join(words[:10] + [f"b{k}"] + words[11:30] + [f"c{k}"] + words[31:])]
    check(spark, list(enumerate(rows)))


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(None, None)], "doc_id long, text string")
    assert nj.join(df.where("doc_id < 0")).count() == 0
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_copies, r.kept) for r in nj.join(df).collect())
    assert got == [(0, 0, 1, True), (1, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True)]
    assert nj.keep_one(df).count() == 4


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(40)] + [(500, k) for k in range(501, 530)]
    up = {n: n for e in edges for n in e}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: top(n) for e in edges if e[0] != e[1] for n in e}
