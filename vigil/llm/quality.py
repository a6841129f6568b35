"""Quality rules: a linear-chain CRF labels every line as content or boilerplate; the content share decides.

Each line with a word gives a feature vector (shape of the line: symbols, capitals, repeats, digits, length). The
CRF has two states; its weights are learned in numpy by gradient ascent on the exact chain likelihood (forward-backward),
from a bounded sample of ``PER_CLASS`` documents per quality class, whose lines all carry the document's class. Viterbi
decoding labels the lines of every whole text; a document stays when the words on content lines are at least
``MIN_CONTENT`` of its words and the base rules do not reject it. Scoring is one map-side pass; nothing is shuffled.

Defined cases: null text = no words; a text without words has content share 0; a table without labels of both classes
uses ``PRIOR`` weights; repeated rows are labelled alike; further columns ride along.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vigil.llm.common import adding, tidy, with_python
from vigil.llm.labelled import sample

PER_CLASS = 1500  # labelled documents per class that the CRF is fitted on
MIN_CONTENT = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"
FEATURES = ("bias", "short", "long", "symbols", "many_symbols", "capitals", "all_capitals", "exclaims", "same_neighbour", "few_distinct", "repeated_line", "digits", "no_stop")
CONTENT, BOILERPLATE = 0, 1


@dataclass(frozen=True)
class Crf:
    """emit: features x 2 states, move: 2 x 2, start: 2 (log weights)."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray


def prior() -> Crf:
    """Weights before any data: symbols, capitals and repeats speak for boilerplate, plain lines for content."""
    emit = np.zeros((len(FEATURES), 2))
    for name, weight in {"bias": -2.0, "symbols": 2.0, "many_symbols": 2.0, "all_capitals": 3.0, "exclaims": 1.0, "same_neighbour": 3.0, "few_distinct": 1.0}.items():
        emit[FEATURES.index(name), BOILERPLATE] = weight
    return Crf(emit, np.array([[0.5, 0.0], [0.0, 0.5]]), np.zeros(2))


def line_features(line: bytes, words: list[bytes], repeated: bool) -> tuple[float, ...]:
    n, size = len(words), len(line)
    symbols = (size - len(line.translate(None, SYMBOLS))) / n
    upper = size - len(line.translate(None, UPPER))
    capitals = upper / max(1, upper + size - len(line.translate(None, LOWER)))
    same = sum(map(operator.eq, words, words[1:])) / n
    return (
        1.0, n < 5, n > 80, min(symbols, 3.0), symbols > 0.5, capitals, capitals > 0.7 and upper > 3, min(line.count(b"!") / n, 2.0),
        same, len(set(words)) / n < 0.5, repeated, (size - len(line.translate(None, DIGITS))) / size, words[-1][-1:] not in b".!?:;\"')",
    )


@dataclass
class Text:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: list[int]
    features: list[tuple[float, ...]]


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def read(text: str) -> Text:
    """Counts and line features of one whole text. Words are runs without ASCII white space, lines end at \\n."""
    raw = text.encode("utf-8")
    line_words, features, seen, dup = [], [], set(), 0
    for line in raw.split(b"\n"):
        words = line.split()
        if not words:
            continue
        repeated = line in seen
        dup += repeated
        seen.add(line)
        line_words.append(len(words))
        features.append(line_features(line, words, repeated))
    words = raw.split()
    return Text(len(words), len(text) - (len(raw) - len(raw.translate(None, SPACES))), len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeat_words(words), line_words, features)


def viterbi(crf: Crf, features: np.ndarray) -> list[int]:
    """The most likely state sequence of a document's lines."""
    score = features @ crf.emit
    (cc, cb), (bc, bb) = crf.move.tolist()
    best_c, best_b = (crf.start + score[0]).tolist()
    back: list[tuple[int, int]] = []
    for own_c, own_b in score[1:].tolist():
        from_c = (best_c + cc, best_b + bc)
        from_b = (best_c + cb, best_b + bb)
        step = (int(from_c[1] > from_c[0]), int(from_b[1] > from_b[0]))
        back.append(step)
        best_c, best_b = from_c[step[0]] + own_c, from_b[step[1]] + own_b
    states = [int(best_b > best_c)]
    for step in reversed(back):
        states.append(step[states[-1]])
    return states[::-1]


def content_share(crf: Crf, text: Text) -> float:
    if not text.features:
        return 0.0
    states = viterbi(crf, np.array(text.features, dtype=np.float64))
    return sum(n for n, s in zip(text.line_words, states) if s == CONTENT) / text.n_words


def fit(chains: list[tuple[np.ndarray, int]], steps: int = 200, rate: float = 0.1, penalty: float = 1e-3) -> Crf:
    """Fit a CRF to (line features, state of all lines) by Adam on the penalised mean log-likelihood per line."""
    model = prior()
    chains = [(x, y) for x, y in chains if len(x)]
    if len({y for _, y in chains}) < 2:
        return model
    chains.sort(key=lambda c: -len(c[0]))  # so the chains still running at step t are a prefix
    k, y, lengths = len(FEATURES), np.array([s for _, s in chains]), np.array([len(x) for x, _ in chains])
    live = [int((lengths > t).sum()) for t in range(lengths[0])]
    feats = [np.stack([x[t] for x, _ in chains[:n]]) for t, n in enumerate(live)]
    total, steps_of = sum(live), range(len(live))
    seen_emit, seen_move, seen_start = np.zeros((k, 2)), np.zeros((2, 2)), np.bincount(y, minlength=2).astype(float)
    for s in (0, 1):
        seen_emit[:, s] = sum(x.sum(axis=0) for x, state in chains if state == s)
        seen_move[s, s] = (lengths[y == s] - 1).sum()
    params = [model.emit.copy(), model.move.copy(), model.start.copy()]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        emit, move, start = params
        score = [f @ emit for f in feats]
        alpha = [start + score[0]]
        for t in steps_of[1:]:
            alpha.append(np.logaddexp.reduce(alpha[-1][: live[t], :, None] + move, axis=1) + score[t])
        beta = [np.zeros_like(s) for s in score]
        for t in reversed(steps_of[1:]):
            beta[t - 1][: live[t]] = np.logaddexp.reduce(move + (score[t] + beta[t])[:, None, :], axis=2)
        log_z = np.logaddexp.reduce(alpha[0] + beta[0], axis=1)
        want_emit, want_move = np.zeros((k, 2)), np.zeros((2, 2))
        for t in steps_of:
            z = log_z[: live[t], None]
            want_emit += feats[t].T @ np.exp(alpha[t] + beta[t] - z)
            if t:
                want_move += np.exp(alpha[t - 1][: live[t], :, None] + move + (score[t] + beta[t])[:, None, :] - z[:, :, None]).sum(axis=0)
        want_start = np.exp(alpha[0] + beta[0] - log_z[:, None]).sum(axis=0)
        for i, grad in enumerate(((seen_emit - want_emit), (seen_move - want_move), (seen_start - want_start))):
            grad = grad / total - penalty * params[i]
            m1[i] = 0.9 * m1[i] + 0.1 * grad
            m2[i] = 0.999 * m2[i] + 0.001 * grad**2
            params[i] = params[i] + rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.999**step)) + 1e-8)
    return Crf(*params)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Crf:
    """Fit on a bounded sample; features are made on the executors, only they come to the driver."""
    with_python(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(read(t).features, dtype="<f4") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([x.tobytes() for x in rows], pa.binary())], names=["doc_id", "label", "x"])

    chosen = sample(docs, labels, "quality", per_class)
    rows = chosen.select("doc_id", "text", "label").mapInArrow(tidy(features), f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, label int, x binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))  # the fit does not depend on the order of arrival
    return fit([(np.frombuffer(r.x, "<f4").reshape(-1, len(FEATURES)).astype(float), BOILERPLATE if r.label == 0 else CONTENT) for r in rows])


ADDED = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()), T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType()),
]


def label_lines(docs: DataFrame, crf: Crf, text_col: str = "text") -> DataFrame:
    """The input's columns plus the base counts, base_failed, content_share and kept."""

    def columns(texts: list[str]) -> list[pa.Array]:
        rows = []
        for text in texts:
            r = read(text)  # a text's features are dropped once its lines are labelled
            failed, share = r.n_words < MIN_WORDS or 100 * r.n_repeat_words > 50 * r.n_words, content_share(crf, r)
            rows.append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, failed, share, not failed and share >= MIN_CONTENT))
        types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        return [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]

    return adding(docs, columns, ADDED, text_col)
