"""Runs of words against a scan over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from vigil.llm import periodic


def brute(words, min_length=6, min_exponent=4):
    """Every maximal stretch by its definition, smallest period first."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_length, min_exponent * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]


def some_texts(rng):
    for _ in range(rng.randint(1, 8)):
        words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([0, 1, 3, 10, 60, 200]))]
        if len(words) > 10 and rng.random() < 0.5:
            p, a = rng.randint(1, 6), rng.randrange(len(words))
            words = [words[a + (i - a) % p] if i >= a and a + p <= len(words) else w for i, w in enumerate(words)]
        yield words


@pytest.mark.parametrize("bits,chunk", [(21, 1 << 21), (1, 64)])
@pytest.mark.parametrize("min_length,min_exponent", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_brute_force(monkeypatch, bits, chunk, min_length, min_exponent):
    monkeypatch.setattr(periodic, "PACKED_BITS", bits)
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    rng = random.Random(bits + min_length)
    for _ in range(80):
        texts = list(some_texts(rng))
        offsets = np.cumsum([0] + [len(t) for t in texts])
        got = periodic.find_runs(np.array(sum(texts, []), np.int64), offsets, min_length, min_exponent)
        assert got == [(j, *r) for j, t in enumerate(texts) for r in brute(t, min_length, min_exponent)]


@pytest.mark.parametrize("code,runs", [
    (np.zeros(200_000, np.int64), [(0, 0, 200_000, 1)]),
    (np.arange(300_000) % 1000, [(0, 0, 300_000, 1000)]),
    (np.arange(200_000), []),
])
def test_very_long_texts(code, runs):
    assert periodic.find_runs(code, np.array([0, len(code)])) == runs


def test_lcp_and_suffix_order():
    rng = random.Random(5)
    texts = [[rng.randrange(3) for _ in range(40)] for _ in range(4)] + [[0] * 30]
    code, offsets = np.array(sum(texts, [])), np.cumsum([0] + [len(t) for t in texts])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    sa, isa, lcp = periodic.suffix_arrays(code, ends)
    suffixes = sorted((int(ends[i]), code[i:ends[i]].tolist(), i) for i in range(len(code)))
    assert [s[2] for s in suffixes] == sa.tolist() and (isa[sa] == np.arange(len(code))).all()
    for k in range(1, len(code)):
        (end_a, a, _), (end_b, b, _) = suffixes[k - 1], suffixes[k]
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) if end_a == end_b else 0
        assert lcp[k] == shared


def test_query_columns_equal_brute_force(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{w}" for w in t) for _ in range(30) for t in some_texts(rng)]
    texts += ["", None, " \t\n", "a a a a a a", "a\x0ba\x0ca\ra a\ta", "x b b b b b b b y", "été " * 9, "a b " * 4000, "A a " * 5]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "q r " * 5, 0), (3, texts[3], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    got = periodic.digest(periodic.detect(df, order=periodic.planted, key=df.doc_id)).collect()
    want = []
    for doc_id, text, _ in rows:
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
        h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(collapsed(words, runs))
        want.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r.n_runs > 0 for r in got) > 20


def test_other_columns_ride_along_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a a a a a a a", "x")], "doc_id long, text string, Collapsed string")
    row = periodic.detect(df).collect()[0]
    assert row.collapsed == "a" and [tuple(r) for r in row.runs] == [(0, 7, 1)] and row.text == "a a a a a a a"
    assert periodic.digest(periodic.detect(df.limit(0))).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(4, np.int64), np.array([0, 4]), 2, 1)
