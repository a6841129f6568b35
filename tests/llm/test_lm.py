"""Language-model scores against a model counted and evaluated by brute force."""

import math
import random
import zlib
import time
from collections import Counter

import numpy as np
import pytest

from vigil.llm import lm
from vigil.session import ensure_checkpoint_dir, stored_bytes

D = lm.DISCOUNT


def brute(rows, share):
    """Scores by the definition: dictionaries of counts and a recursive probability."""
    train = [lm.tokens(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    uni, grams, begins = Counter(), {2: Counter(), 3: Counter()}, len(train)
    for words in train:
        seq = [None, *words, b""]
        uni.update(seq[1:])
        for k in (2, 3):
            grams[k].update(tuple(seq[i : i + k]) for i in range(len(seq) - k + 1))
    n, v = sum(uni.values()), len(uni)
    kept = {k: {g: c for g, c in grams[k].items() if c >= max(2.0, share * n)} for k in (2, 3)}

    def prob(w, history):
        if not history:
            return (uni[w] + 1) / (n + v + 1)
        arcs = {g[-1]: c for g, c in kept[len(history) + 1].items() if g[:-1] == history}
        shorter = prob(w, history[1:])
        if not arcs:
            return shorter
        total = kept[2][history] if len(history) == 2 else (begins if history[0] is None else uni[history[0]])
        rest = (total - sum(arcs.values()) + D * len(arcs)) / total
        return max(arcs.get(w, 0) - D, 0) / total + rest * shorter

    out = []
    for i, t in rows:
        seq = [None, *lm.tokens(t), b""]
        score = sum(math.log10(prob(w, tuple(seq[max(0, k - 1) : k + 1]))) for k, w in enumerate(seq[1:]))
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in seq[1:])
        out.append((i, len(seq) - 1, sum(uni[w] > 0 for w in seq[1:]), n, base, score))
    return out, prob, uni


ROWS = [(i, t) for i, t in enumerate(
    ["the cat sat on the mat", "The cat sat on the hat", "a dog sat", "", None, "the cat sat on a dog", "x", "the the the the", "cat\x0bsat on\x85the", "été the Été cat sat"] * 4
    + ["never seen words here", "the cat sat " * 300])]


@pytest.mark.parametrize("share", [1e-9, 0.004, 0.05])
def test_scores_equal_brute_force(spark, share):
    df = spark.createDataFrame(ROWS + ROWS[:3] + [(None, "the cat")], "doc_id long, text string").selectExpr("*", "1 AS score")
    got = sorted(lm.score(df, share, block_bytes=200).collect(), key=repr)
    want, _, _ = brute(ROWS + ROWS[:3] + [(None, "the cat")], share)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1], round(r[5], 6))
    for g, w in zip(sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], abs=1e-9) and g[5] == pytest.approx(w[5], abs=1e-9)


def test_the_brute_model_is_a_distribution():
    _, prob, uni = brute(ROWS, 1e-9)
    events = [*uni, b"unseen"]
    for history in ((), (b"the",), (b"the", b"cat"), (None,), (None, b"the"), (b"x", b"y")):
        assert sum(prob(w, history) for w in events) == pytest.approx(1)


def test_empty_table_and_no_training_rows(spark):
    df = spark.createDataFrame(ROWS[:1], "doc_id long, text string")
    assert lm.score(df.where("doc_id < 0")).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_python_hash_is_sparks(spark):
    words = [b"", b"a", b"some longer word of bytes", "été".encode()]
    got = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w binary").selectExpr("i", "xxhash64(w) AS h").collect()
    assert [r.h for r in sorted(got)] == lm.word_hash(words).view("int64").tolist()


def test_a_phrase_keeps_its_arcs_in_a_large_corpus(spark):
    # seen three times in over a million tokens, in texts of several blocks; the model keeps every n-gram seen twice
    r = random.Random(5)
    filler = [f"w{k}" for k in range(40)]
    learned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:120]
    rows = [(i, " ".join(r.choices(filler, k=10_000)) + (" rare words meet" if k < 3 else "")) for k, i in enumerate(learned)]
    held = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([*rows, (held, "rare words meet")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score(df, block_bytes=1_000_000).collect()}[held]
    n, v = got.train_tokens, 44
    assert n == 120 * 10_001 + 9 and got.n_known == 4
    rare = math.log10(4 / (n + v + 1))
    assert got.base_score == pytest.approx(3 * rare + math.log10(121 / (n + v + 1)))
    after = (3 - D) / 3 + D / 3 * 10**rare  # of "words" after "rare"
    last = (3 - D) / 3 + D / 3 * after  # of "meet" after both; the end follows as often
    end = (3 - D) / 3 + D / 3 * ((3 - D) / 3 + D / 3 * 121 / (n + v + 1))
    starts = [t.split()[0] for _, t in rows]
    kept = [w for w in set(starts) if starts.count(w) > 1]
    begin = (120 - sum(map(starts.count, kept)) + D * len(kept)) / 120 * 10**rare
    assert got.score == pytest.approx(sum(map(math.log10, (begin, after, last, end))))


def on_disk(spark) -> int:
    """Bytes of the scratch tables and of the shuffle files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return stored_bytes(spark, ensure_checkpoint_dir(spark)) + sum(f.length() for f in files if f.getName().startswith("shuffle_"))


def test_ended_steps_leave_less_than_the_keys_of_the_ngrams(spark):
    # some 360,000 n-grams, nearly all of them once
    r = random.Random(7)
    words = [f"word{k}" for k in range(20_000)]
    df = spark.createDataFrame([(i, " ".join(r.choices(words, k=3000))) for i in range(60)], "doc_id long, text string")
    before = on_disk(spark)
    scored = lm.score(df, block_bytes=300_000)
    for _ in range(40):
        if (left := on_disk(spark) - before) < 8 * 360_000:
            break
        time.sleep(0.25)
    assert left < 8 * 360_000 and scored.count() == 60


def test_keys_come_back():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64, endpoint=False))
    for some in (keys, keys[:1], keys[:0], np.array([0, 2**64 - 1], dtype=np.uint64)):
        assert lm.unpacked_keys(lm.packed_keys(some)).tolist() == some.tolist()


def test_words_and_places_are_numbered_alike_in_all_steps():
    texts = lm.pa.array(["a b a  b\tc", "", " c a b ", "É é"], lm.pa.string())
    hashes, seq = lm.sequences(texts)
    assert [hashes[seq[i]] for i in range(len(seq))] == [x for t in texts.to_pylist() for x in [lm.BEGIN_HASH, *lm.word_hash(lm.tokens(t)), *lm.word_hash([lm.END])]]
    assert lm.Places(seq, hashes).keys.tolist() == lm.Grams(seq, hashes).keys.tolist()
    hashes, seq = lm.sequences(texts[1:2])
    assert seq.tolist() == [0, 1] and lm.Places(seq, hashes).keys.tolist() == lm.Grams(seq, hashes).keys.tolist()
