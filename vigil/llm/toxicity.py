"""Toxicity by a bidirectional GRU with attention pooling over word and character inputs, trained in numpy.

Every word of a text (lower-cased letter and digit runs) has an input vector: an embedding of the word's hash next to
the mean embedding of its character 3- to 5-grams and longer beginnings, so unseen forms of a known root are recognised. Windows of
``WINDOW`` words, starting every ``STRIDE`` words, cover the whole text; each runs through a GRU in both directions, the
states are pooled by a learned attention query, and a logistic layer scores the window. A document's score is the
calibrated by a logistic layer over its worst window, the sum of its windows' scores and their share.

Training: a bounded sample of ``PER_CLASS`` labelled documents per class (rows with crc32(doc_id) mod 3 = 1 are never
looked at). Labels are per document, so the windows to learn from are chosen: first by the odds of their
features, later by the network itself (the worst window of toxic documents, the worst and a random one of others).
Gradients are written out by hand. Scoring is one map-side pass: the model has a fixed size and is broadcast.

Defined cases: null or empty text, or one without words, scores 0; without labels of both classes every text
scores 0; repeated rows score alike; further columns ride along, and clashing ones are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import adding, give_back
from vigil.llm.labelled import sample

PER_CLASS = 2000  # labelled documents per class that the network is trained on
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 16
BUCKETS = 1 << 14
THRESHOLD = 0.7
SLICE_WORDS = 400_000
HASH_BLOCK = 20_000
_WORD = re.compile(r"[^\W_]+")
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))


def learnable(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id's text is not 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def held_out(doc_id: Column) -> Column:
    """Whether a row's id is of the remainder that is never learned from; a null id has no remainder (and no label)."""
    return F.coalesce(~learnable(doc_id), F.lit(False))


@dataclass
class Vocabulary:
    """Hashed inputs of distinct words: one word bucket each, and character n-gram buckets in CSR form."""

    word: np.ndarray
    grams: np.ndarray
    starts: np.ndarray


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int32)


def hashed(words: list[str]) -> Vocabulary:
    """Buckets of all words; blocks of words bound the memory in between."""
    parts = [_hashed_block(words[at : at + HASH_BLOCK]) for at in range(0, len(words), HASH_BLOCK)]
    if not parts:
        return Vocabulary(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(1, np.int64))
    counts = np.concatenate([p[2] for p in parts])
    return Vocabulary(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))


def _hashed_block(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket, n-gram buckets in word order, and n-grams per word; ``<`` and ``>`` mark word ends."""
    raw = [b"<" + w.encode("utf-8") + b">" for w in words]
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - np.repeat(begin, sizes)
    word = _mix(np.add.reduceat(flat * _POWERS[place % 64], begin))
    room = np.repeat(sizes, sizes) - place
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    grams, owners = [], []
    for n in (3, 4, 5, 6, 7, 8):
        # beyond five letters only the word's beginning counts: roots stand there
        at = np.flatnonzero((room >= n) & (place == 0)) if n > 5 else np.flatnonzero(room >= n)
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h += flat[at + k] * _POWERS[k + 7 * n % 32]
        grams.append(_mix(h))
        owners.append(owner[at])
    all_owners = np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    # at least one each: <x> is a 3-gram
    return word, np.concatenate(grams)[order], np.bincount(all_owners, minlength=len(words))


@dataclass
class Net:
    """Parameters by name; gates are ordered update, reset, candidate."""

    p: dict[str, np.ndarray]
    doc: np.ndarray | None = None  # weights of ``evidence``


def new_net(seed: int = 7) -> Net:
    r = np.random.default_rng(seed)
    d = WORD_DIM + CHAR_DIM

    def make(*shape: int, scale: float = 0.1) -> np.ndarray:
        return (r.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": make(BUCKETS, WORD_DIM), "char": make(BUCKETS, CHAR_DIM), "query": make(2 * HIDDEN), "out": make(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for way in ("fwd", "bwd"):
        p |= {f"{way}_in": make(d, 3 * HIDDEN, scale=0.3), f"{way}_rec": make(HIDDEN, 3 * HIDDEN, scale=0.3), f"{way}_b": np.zeros(3 * HIDDEN, np.float32)}
    return Net(p)


def inputs(net: Net, v: Vocabulary) -> np.ndarray:
    """Input vector of each distinct word; a last row of zeros stands for padding."""
    n = len(v.word)
    x = np.zeros((n + 1, WORD_DIM + CHAR_DIM), np.float32)
    for at in range(0, n, HASH_BLOCK):  # a word has dozens of n-grams: their embeddings are gathered block by block
        end = min(n, at + HASH_BLOCK)
        starts = v.starts[at : end + 1]
        x[at:end, :WORD_DIM] = net.p["word"][v.word[at:end]]
        sums = np.add.reduceat(net.p["char"][v.grams[starts[0] : starts[-1]]], starts[:-1] - starts[0], axis=0)
        x[at:end, WORD_DIM:] = sums / (starts[1:] - starts[:-1])[:, None]
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def windows(ids: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts (rows of word numbers, short ones padded) and the text each belongs to."""
    counts = np.array([max(1, -(-(len(i) - WINDOW) // STRIDE) + 1) if len(i) else 0 for i in ids], dtype=np.int64)
    spans = np.where(counts > 0, (counts - 1) * STRIDE + WINDOW, 0)
    flat = np.full(int(spans.sum()), pad, dtype=np.int32)
    base = np.concatenate([[0], np.cumsum(spans)])[:-1]
    for at, own in zip(base, ids):
        flat[at : at + len(own)] = own
    owner = np.repeat(np.arange(len(ids)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return flat[(base[owner] + nth * STRIDE)[:, None] + np.arange(WINDOW)], owner


def window_logits(net: Net, table: np.ndarray, rows: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """Logits of windows; input projections are made once per distinct word."""
    p, out = net.p, np.empty(len(rows), np.float32)
    pad, h = len(table) - 1, HIDDEN
    # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2: the halves go into the projections
    half = np.concatenate([np.full(2 * h, 0.5), np.ones(h)]).astype(np.float32)
    into = {w: ((table @ p[f"{w}_in"] + p[f"{w}_b"]) * half).astype(np.float32) for w in ("fwd", "bwd")}
    rec = {w: (p[f"{w}_rec"] * half).astype(np.float32) for w in ("fwd", "bwd")}
    for at in range(0, len(rows), chunk):
        ids = np.ascontiguousarray(rows[at : at + chunk].T)
        n = ids.shape[1]
        energy = np.zeros((WINDOW, n), np.float32)
        value = np.zeros((WINDOW, n), np.float32)
        for way, steps, part in (("fwd", range(WINDOW), slice(0, h)), ("bwd", range(WINDOW - 1, -1, -1), slice(h, 2 * h))):
            state = np.zeros((n, h), np.float32)
            read = np.stack([p["query"][part], p["out"][part]], axis=1)
            for t in steps:
                gi = into[way][ids[t]]
                gh = state @ rec[way]
                gates = gi[:, : 2 * h] + gh[:, : 2 * h]
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                cand = gates[:, h:] * gh[:, 2 * h :]
                cand += gi[:, 2 * h :]
                np.tanh(cand, out=cand)
                state -= cand
                state *= gates[:, :h]
                state += cand
                both = state @ read
                energy[t] += both[:, 0]
                value[t] += both[:, 1]
        energy[ids == pad] = -1e9
        energy -= energy.max(axis=0)
        np.exp(energy, out=energy)
        out[at : at + n] = (energy * value).sum(axis=0) / energy.sum(axis=0) + p["bias"][0]
    return out


def gradients(net: Net, v: Vocabulary, rows: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean logistic loss of windows and its gradient for every parameter, by back-propagation through time."""
    p, h = net.p, HIDDEN
    pad, n = len(v.word), len(rows)
    used, local = np.unique(rows, return_inverse=True)
    local = local.reshape(rows.shape)
    sub = _subset(v, used[used < pad])
    table = inputs(net, sub)  # its padding row is also the last of ``used`` if padding occurs
    x = table[local]
    states, memo = np.zeros((n, WINDOW, 2 * h), np.float32), {}
    for way, steps, part in (("fwd", range(WINDOW), slice(0, h)), ("bwd", range(WINDOW - 1, -1, -1), slice(h, 2 * h))):
        state = np.zeros((n, h), np.float32)
        proj = x @ p[f"{way}_in"] + p[f"{way}_b"]
        for t in steps:
            gh = state @ p[f"{way}_rec"]
            z, r = _sigmoid(proj[:, t, :h] + gh[:, :h]), _sigmoid(proj[:, t, h : 2 * h] + gh[:, h : 2 * h])
            c = np.tanh(proj[:, t, 2 * h :] + r * gh[:, 2 * h :])
            memo[way, t] = (state, z, r, c, gh[:, 2 * h :])
            state = c + z * (state - c)
            states[:, t, part] = state
    energy = states @ p["query"]
    energy[rows == pad] = -1e9
    weight = np.exp(energy - energy.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = (weight[:, :, None] * states).sum(axis=1)
    logit = pooled @ p["out"] + p["bias"][0]
    loss = float(np.mean(np.logaddexp(0, logit) - target * logit))
    d_logit = (_sigmoid(logit) - target) / n
    g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()])}
    d_pooled = d_logit[:, None] * p["out"]
    d_weight = states @ d_pooled[:, :, None]
    d_energy = weight * (d_weight[:, :, 0] - (weight * d_weight[:, :, 0]).sum(axis=1, keepdims=True))
    g["query"] = np.einsum("nt,nth->h", d_energy, states)
    d_states = weight[:, :, None] * d_pooled[:, None, :] + d_energy[:, :, None] * p["query"]
    d_x = np.zeros_like(x)
    for way, steps, part in (("fwd", range(WINDOW - 1, -1, -1), slice(0, h)), ("bwd", range(WINDOW), slice(h, 2 * h))):
        d_next, d_rec = np.zeros((n, h), np.float32), np.zeros_like(p[f"{way}_rec"])
        d_proj = np.zeros((n, WINDOW, 3 * h), np.float32)
        for t in steps:
            state, z, r, c, ghc = memo[way, t]
            d = d_states[:, t, part] + d_next
            d_c = d * (1 - z) * (1 - c * c)
            d_z = d * (state - c) * z * (1 - z)
            d_r = d_c * ghc * r * (1 - r)
            d_gh = np.concatenate([d_z, d_r, d_c * r], axis=1)
            d_rec += state.T @ d_gh
            d_next = d * z + d_gh @ p[f"{way}_rec"].T
            d_proj[:, t] = np.concatenate([d_z, d_r, d_c], axis=1)
        g[f"{way}_rec"] = d_rec
        g[f"{way}_b"] = d_proj.sum(axis=(0, 1))
        g[f"{way}_in"] = np.tensordot(x, d_proj, axes=([0, 1], [0, 1]))
        d_x += d_proj @ p[f"{way}_in"].T
    m = len(sub.word)
    flat_ids, flat_d = local.ravel(), d_x.reshape(-1, x.shape[2])
    d_table = np.stack([np.bincount(flat_ids, weights=flat_d[:, k], minlength=m + 1)[:m] for k in range(flat_d.shape[1])], axis=1)
    counts = sub.starts[1:] - sub.starts[:-1]
    per_gram = np.repeat(d_table[:, WORD_DIM:] / np.maximum(counts, 1)[:, None], counts, axis=0)
    g["word"] = np.stack([np.bincount(sub.word, weights=d_table[:, k], minlength=BUCKETS) for k in range(WORD_DIM)], axis=1)
    g["char"] = np.stack([np.bincount(sub.grams, weights=per_gram[:, k], minlength=BUCKETS) for k in range(CHAR_DIM)], axis=1)
    return loss, g


def _subset(v: Vocabulary, used: np.ndarray) -> Vocabulary:
    counts = v.starts[used + 1] - v.starts[used]
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    take = np.repeat(v.starts[used] - starts[:-1], counts) + np.arange(starts[-1])
    return Vocabulary(v.word[used], v.grams[take], starts)


class Adam:
    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in net.p.items()}
        self.s = {k: np.zeros_like(x) for k, x in net.p.items()}

    def update(self, g: dict[str, np.ndarray]) -> None:
        self.step += 1
        a, b = 1 - 0.9**self.step, 1 - 0.999**self.step
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.s[k] += 0.001 * (d * d - self.s[k])
            self.net.p[k] -= (self.rate * (self.m[k] / a) / (np.sqrt(self.s[k] / b) + 1e-7)).astype(np.float32)


def numbered(texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """Distinct words of the texts and each text as word numbers; a word that repeats its neighbour is read once."""
    index: dict[str, int] = {}
    out = []
    for t in texts:
        own = np.array([index.setdefault(w, len(index)) for w in _WORD.findall(t.lower())], dtype=np.int32)
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    return list(index), out


def worst(logits: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    best = np.full(n, -np.inf)
    np.maximum.at(best, owner, logits)
    return best


def _odds(v: Vocabulary, ids: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Per distinct word: the largest log odds, toxic against other documents, of its word and n-gram buckets."""
    n = len(v.word)
    seen = {c: np.zeros(2 * BUCKETS) for c in (0, 1)}
    for own, c in zip(ids, y):
        words = np.unique(own)
        sub = _subset(v, words)
        seen[int(c)][np.unique(np.concatenate([sub.word, sub.grams + BUCKETS]))] += 1
    total = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    log_odds = np.log((seen[1] + 0.1) / (total[1] + 0.2)) - np.log((seen[0] + 0.5) / (total[0] + 1))
    log_odds *= np.minimum(1, seen[1] / 3)  # a bucket seen in one or two toxic documents says little
    log_odds = log_odds.astype(np.float32)
    out = np.zeros(n + 1, np.float32)
    for at in range(0, n, HASH_BLOCK):
        end = min(n, at + HASH_BLOCK)
        starts = v.starts[at : end + 1]
        grams = v.grams[starts[0] : starts[-1]] + BUCKETS
        out[at:end] = np.maximum(log_odds[v.word[at:end]], np.maximum.reduceat(log_odds[grams], starts[:-1] - starts[0]))
    return out


def train_net(texts: list[str], y: np.ndarray, rounds: int = 4, epochs: int = 4, batch: int = 256, seed: int = 7) -> Net | None:
    """Train on whole texts with document labels; None without both classes."""
    if len(set(y.tolist())) < 2:
        return None
    words, ids = numbered(texts)
    v = hashed(words)
    rows, owner = windows(ids, len(words))
    net, r = new_net(seed), np.random.default_rng(seed)
    # every fifth text of a class is kept from the network, for the calibration
    spare = np.zeros(len(texts), bool)
    for c in (0, 1):
        spare[np.flatnonzero(y == c)[::5]] = True
    learn = ~spare
    score = _odds(v, [i for i, k in zip(ids, learn) if k], y[learn])[rows].max(axis=1)
    adam = Adam(net, 0.01)
    first = np.searchsorted(owner, np.arange(len(texts)))
    ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
    for turn in range(rounds):
        best = worst(score, owner, len(texts))
        top = score >= best[owner] - 1e-6
        is_toxic, used = y[owner] == 1, learn[owner]
        # of a toxic document: its worst window, and later whatever the network is sure of
        positive = np.flatnonzero(used & is_toxic & (top if turn == 0 else top | (score > 3)))
        others = [np.flatnonzero(used & ~is_toxic & (top if turn == 0 else top | (score > 0)))]
        for _ in range(3):
            some = np.flatnonzero((y == 0) & learn & (ends > first))
            others.append(first[some] + (r.random(len(some)) * (ends - first)[some]).astype(int))
        negative = np.unique(np.concatenate(others))
        if len(positive) > 3 * len(negative):
            positive = r.choice(positive, 3 * len(negative), replace=False)
        chosen = np.concatenate([positive, negative])
        target = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))])
        least = 60  # small samples get more passes, so that the network is trained at all
        passes = max(epochs, -(-least * batch // max(1, len(chosen))))
        for _ in range(min(passes, 40)):
            order = r.permutation(len(chosen))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                _, g = gradients(net, v, rows[chosen[part]], target[part].astype(np.float32))
                adam.update(g)
        adam.rate *= 0.7
        score = window_logits(net, inputs(net, v), rows)
    net.doc = _calibrate(*evidence(score, owner, len(texts)), y, spare)
    return net


PRIOR = np.array([0.5, 1.0, 0.5, 0.0])


def evidence(logits: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: worst logit, log of the summed window scores, log of their mean, 1; and whether it has a window."""
    count = np.bincount(owner, minlength=n)
    total = np.bincount(owner, weights=1 / (1 + np.exp(-np.clip(logits, -30, 30).astype(float))), minlength=n)
    best = worst(logits, owner, n)
    some = count > 0
    mean = np.where(some, total / np.maximum(count, 1), 1.0)
    return np.stack([np.where(some, np.clip(best, -10, 10), 0.0), np.log(total + 1e-3), np.log(mean + 1e-4), np.ones(n)], axis=1), some


def _calibrate(x: np.ndarray, some: np.ndarray, y: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on the evidence of texts that the network was not trained on; damped Newton
    steps with a ridge towards ``PRIOR``."""
    x, y = x[some & spare], y[some & spare]
    w = PRIOR.copy()
    if len(set(y.tolist())) < 2:
        return w
    for _ in range(60):
        prob = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - prob) - 0.3 * (w - PRIOR)
        hess = (x * (prob * (1 - prob))[:, None]).T @ x + 0.3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    return w


def text_scores(net: Net | None, texts: list[str]) -> np.ndarray:
    """Scores of whole texts; slices of some hundred thousand words bound the memory."""
    out = np.zeros(len(texts))
    if net is None:
        return out
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size < SLICE_WORDS * 6 or end == at):
            size += len(texts[end])
            end += 1
        words, ids = numbered(texts[at:end])
        rows, owner = windows(ids, len(words))
        x, some = evidence(window_logits(net, inputs(net, hashed(words)), rows), owner, end - at)
        out[at:end] = np.where(some, 1 / (1 + np.exp(-np.clip(x @ net.doc, -30, 30))), 0.0)
        at = end
    return out


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Net | None:
    """Train on a bounded sample of the rows that may be learned from."""
    rows = sample(docs, labels, "toxic", per_class, learnable(F.col("doc_id"))).select("doc_id", "text", "label").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    net = train_net([r.text for r in rows], np.array([r.label for r in rows], dtype=int))
    del rows
    give_back()
    return net


ADDED = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def score(docs: DataFrame, net: Net | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input's columns plus score (0 to 1) and predicted (1 from the threshold on)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed size: two hashed tables and a few small matrices

    def columns(texts: list[str]) -> list[pa.Array]:
        s = text_scores(shared.value, texts)
        return [pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())]

    return adding(docs, columns, ADDED, text_col)
