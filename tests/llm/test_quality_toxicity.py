"""Quality labelling and toxicity: brute force, gradient checks and held-out accuracy."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from vigil.llm import quality as q
from vigil.llm import toxicity as tox
from vigil.llm.common import table

SF = "/root/testdata/sf0.1"
ODD = ["", None, " \n\t", "one", "a b c a b c a b c", "x" * 5000, "#$% &&& |||\n\nline\nline\n line", "é\x85è\x1c ü b", "w " * 3000, "A B C!!\nA B C!!"]


def base_by_definition(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)} if len(windows) < 400 else set(range(len(words)))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def test_base_counts(spark):
    r = random.Random(1)
    rows = ODD + ["".join(r.choice(["a ", "b ", "c\n", "# ", "\n", "D"]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").selectExpr("*", "7 AS kept", "'k' AS other")
    got = {x.doc_id: x for x in q.label_lines(df, q.prior()).collect()}
    for i, t in enumerate(rows):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == base_by_definition(t), t
        assert g.text == t and g.other == "k" and not (g.base_failed and g.kept)
    assert q.label_lines(df.where("doc_id < 0"), q.prior()).count() == 0


def test_viterbi_is_the_best_of_all_sequences():
    r = np.random.default_rng(3)
    for _ in range(40):
        crf = q.Crf(r.normal(size=(len(q.FEATURES), 2)), r.normal(size=(2, 2)), r.normal(size=2))
        x = r.normal(size=(r.integers(1, 7), len(q.FEATURES)))

        def value(states, x=x, crf=crf):
            return crf.start[states[0]] + sum(x[t] @ crf.emit[:, s] for t, s in enumerate(states)) + sum(crf.move[a, b] for a, b in zip(states, states[1:]))

        best = max(itertools.product((0, 1), repeat=len(x)), key=value)
        assert value(q.viterbi(crf, x)) == pytest.approx(value(best))


def test_fit_climbs_to_a_stationary_point():
    r = np.random.default_rng(5)
    chains = [(r.normal(size=(r.integers(1, 6), len(q.FEATURES))) + y, y) for y in (0, 1) for _ in range(20)]
    crf = q.fit(list(chains), steps=3000, rate=0.02, penalty=0.05)

    def objective(crf):
        total = 0.0
        for x, y in chains:
            def value(states):
                return crf.start[states[0]] + sum(x[t] @ crf.emit[:, s] for t, s in enumerate(states)) + sum(crf.move[a, b] for a, b in zip(states, states[1:]))
            total += value((y,) * len(x)) - np.logaddexp.reduce([value(s) for s in itertools.product((0, 1), repeat=len(x))])
        n = sum(len(x) for x, _ in chains)
        return total / n - 0.025 * sum((p**2).sum() for p in (crf.emit, crf.move, crf.start))

    best = objective(crf)
    for i in range(10):
        moved = q.Crf(crf.emit + 0.02 * r.normal(size=crf.emit.shape), crf.move + 0.02 * r.normal(size=(2, 2)), crf.start + 0.02 * r.normal(size=2))
        assert objective(moved) <= best + 1e-6, i


def test_quality_accuracy_on_other_documents(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    crf = q.train(docs.where("doc_id % 2 = 0"), labels)
    rows = q.label_lines(docs.where("doc_id % 2 = 1"), crf).join(labels, "doc_id").where("n_words >= 50").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_training_without_labels(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    assert (q.train(docs.where("doc_id < 0"), labels).emit == q.prior().emit).all()
    assert tox.train(docs.where("doc_id < 0"), labels) is None
    assert {(r.score, r.predicted) for r in tox.score(docs.where("doc_id < 20"), None).collect()} == {(0.0, 0)}


def test_network_gradients():
    v = tox.hashed(["alpha", "beta", "gamma", "été", "x"])
    net = tox.new_net()
    net.p = {k: a.astype(np.float64) for k, a in net.p.items()}
    w = tox.WINDOW
    rows = np.array([[0, 1, 2, 3] * (w // 4), [3, 2, 1] + [5] * (w - 3), [4] + [5] * (w - 1)], dtype=np.int32)
    target = np.array([1.0, 0.0, 1.0])
    _, g = tox.gradients(net, v, rows, target)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        at = np.abs(g[name]).ravel().argmax()
        keep, e = flat[at], 1e-3
        flat[at] = keep + e
        up, _ = tox.gradients(net, v, rows, target)
        flat[at] = keep - e
        down, _ = tox.gradients(net, v, rows, target)
        flat[at] = keep
        assert g[name].ravel()[at] == pytest.approx((up - down) / (2 * e), rel=1e-3, abs=1e-6), name


def test_batched_scoring_is_the_training_forward_pass():
    net = tox.new_net()
    v = tox.hashed([f"w{i}" for i in range(30)])
    r = np.random.default_rng(1)
    ids = [r.integers(0, 30, n).astype(np.int32) for n in (1, 5, 31, 32, 33, 48, 200)]
    rows, owner = tox.windows(ids, 30)
    logits = tox.window_logits(net, tox.inputs(net, v), rows, chunk=3)
    for k, row in enumerate(rows):
        loss, _ = tox.gradients(net, v, row[None], np.array([1.0]))
        assert loss == pytest.approx(np.logaddexp(0, -logits[k]), rel=1e-3, abs=1e-5)
    # the windows cover every word of every text, each starting STRIDE after the last
    for t, own in enumerate(ids):
        mine = rows[owner == t]
        assert len(mine) == max(1, -(-(len(own) - tox.WINDOW) // tox.STRIDE) + 1)
        spread = np.concatenate([mine[0], *[m[-tox.STRIDE :] for m in mine[1:]]])
        assert (spread[: len(own)] == own).all() and (spread[len(own) :] == 30).all()


def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    net = tox.train(docs, labels)
    rows = tox.score(docs, net).join(labels, "doc_id").select("doc_id", "toxic", "score", "predicted").collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    s, y = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    rank = np.empty(len(s))
    rank[np.argsort(s)] = np.arange(len(s))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())
    assert auc > 0.95 and (s[y == 0] >= 0.7).mean() < 0.01
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").selectExpr("*", "'a' AS score")
    got = {r.doc_id: r for r in tox.score(odd, net).collect()}
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert got[0].score == got[1].score == got[2].score == 0.0


def test_a_toxic_passage_is_found_anywhere(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    net = tox.train(docs, labels)
    clean = " ".join("the and thing of ereding onble".split() * 5)
    calm = ". ".join([clean + f" w{i}" for i in range(100)])
    insult = " you pathetic worthless idiot moron scum "
    scores = tox.text_scores(net, [calm, insult + calm, calm + insult, calm[:3000] + insult + calm[3000:]])
    assert scores[0] < 0.5 < scores[1:].min()


def test_held_out_is_never_null(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(30), None]], "doc_id long")
    got = {r.doc_id: r.h for r in ids.select("doc_id", tox.held_out(ids.doc_id).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(30)} | {None: False}
