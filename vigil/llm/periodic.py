"""Periodic run detection: every maximal repetition of words in a text, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q and a length of at least ``max(min_length, min_exponent * q)``
that no neighbouring word extends keeping that period. One map-side pass over whole texts; nothing is shuffled.

A batch's texts are numbered word by word and share one suffix array; the text's number leads every suffix, so no suffix is
compared with one of another text and equal texts do not slow each other down. Steps, all on arrays:

1. suffix array by prefix doubling; only suffixes that still share their rank are sorted again. The ranks of every round are
   kept for those suffixes alone and give the LCP array by descent over the rounds.
2. every LCP value ``depth`` at k splits its interval into suffixes before and from k on; its ends are the nearest smaller
   values (a stack over the LCP array, no tree nodes). The suffixes i of the smaller side ask whether ISA[i + depth] or
   ISA[i - depth] lies in the other side: if so, the two begin a square of that root that its right neighbour does not
   continue. Each suffix is on a smaller side at most log n times.
3. such a square ends where its run ends. It is rotated to the left as far as the words agree, which gives the run; a square
   whose root is a multiple of the period of a run with the same end that covers it is that run again and is merged into it.

Defined cases: null text = no words; a text without words or without runs gives an empty list and its words joined by single
spaces; repeated rows are treated alike; input columns named ``runs`` or ``collapsed`` are replaced, others ride along; an empty
table gives an empty result. Memory follows one Arrow batch (8 MB) or one text, whichever is larger.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import nullable, tidy, with_python, without

MIN_LENGTH, MIN_EXPONENT = 6, 4
PACKED_BITS = 21  # three numbers below 2**21 fit one sort key
CHUNK = 1 << 21  # suffixes that ask at once

#: Gives, for a row's key and its number of words, the words to read in place of 0, 1, 2, ...; None leaves the text alone.
Order = Callable[[str | None, int], np.ndarray | None]


def _sorted_by(rank: np.ndarray, after: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ``at`` in order of (rank, after), and where a new such pair begins."""
    if n < (1 << PACKED_BITS) - 1:
        packed = np.sort((rank << 2 * PACKED_BITS) | (after << PACKED_BITS) | at)
        pair = packed >> PACKED_BITS
        at = packed & ((1 << PACKED_BITS) - 1)
        new = np.ones(len(at), bool)
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        return at, new
    turn = np.lexsort((at, after, rank))
    rank, after, at = rank[turn], after[turn], at[turn]
    new = np.ones(len(at), bool)
    new[1:] = (rank[1:] != rank[:-1]) | (after[1:] != after[:-1])
    return at, new


def suffix_arrays(code: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(SA, ISA, LCP) of word numbers ``code``; ``ends[i]`` is the end of the text that word i is in. LCP[k] is of SA[k - 1], SA[k]."""
    n = len(code)
    here = np.arange(n, dtype=np.int64)
    # the text's end stands for the text: it leads the word in the first order
    sa, new = _sorted_by(np.cumsum(np.r_[False, ends[1:] != ends[:-1]]), code.astype(np.int64), here, max(n, int(code.max()) + 1))
    rank = np.empty(n, np.int64)
    place = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[sa] = place
    first_new = new
    open_ = ~(new & np.r_[new[1:], True])  # suffixes that share their rank
    pos, at, rounds, h = np.flatnonzero(open_), sa[open_], [], 1
    while len(at):
        own = rank[at]
        rounds.append((h, at, own))
        beyond = at + h
        inside = beyond < ends[at]
        after = np.zeros(len(at), np.int64)
        after[inside] = rank[beyond[inside]] + 1
        at, new = _sorted_by(own, after, at, n)
        sa[pos] = at
        rank[at] = pos[np.flatnonzero(new)[np.cumsum(new) - 1]]
        open_ = ~(new & np.r_[new[1:], True])
        pos, at, h = pos[open_], at[open_], 2 * h
    lcp = np.zeros(n + 1, np.int64)
    k = np.flatnonzero(~first_new)
    a, b, shared = sa[k - 1], sa[k], np.zeros(len(k), np.int64)
    table = np.full(n + 1, -1, np.int64)
    for h, at, own in reversed(rounds):
        table[at] = own
        left = table[a]
        same = (left >= 0) & (left == table[b])
        step = h * same
        shared += step
        a, b = a + step, b + step
        table[at] = -1
    lcp[k] = shared
    return sa, rank, lcp


def _nearest_smaller(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places k with LCP[k] > 0, for each the last place before it with a value <= its own and the first after with a smaller one."""
    inner = np.flatnonzero(lcp > 0)
    # one zero before every stretch of values stands for all the zeros there
    stops = inner[np.r_[True, np.diff(inner) > 1]] - 1 if len(inner) else inner
    places = np.sort(np.concatenate([inner, stops]))
    values = lcp[places].tolist()
    left, right, stack = [0] * len(values), [len(values)] * len(values), []
    for i, value in enumerate(values):
        if value == 0:
            for j in stack:
                right[j] = i
            stack = [i]
            continue
        while values[stack[-1]] > value:
            right[stack.pop()] = i
        left[i] = stack[-1]
        stack.append(i)
    keep = lcp[places] > 0
    before, after = np.array(left, np.int64)[keep], np.array(right, np.int64)[keep]
    # an interval that ends at a zero ends right behind its last own value
    own_end = np.append(places, 0)[after - 1] + 1
    return places[keep], places[before] if len(before) else before, own_end


def _squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, root length) of every square that the word behind it does not continue."""
    k, low, high = _nearest_smaller(lcp)
    depth = lcp[k]
    lefts = k - low <= high - k
    begin, size = np.where(lefts, low, k), np.where(lefts, k - low, high - k)
    other_low, other_high = np.where(lefts, k, low), np.where(lefts, high, k)
    n, starts, roots = len(sa), [], []
    cuts = np.searchsorted(np.cumsum(size), np.arange(CHUNK, int(size.sum()) + CHUNK, CHUNK)) + 1 if len(size) else []
    first = 0
    for cut in cuts:
        part = slice(first, min(int(cut), len(size)))
        first = part.stop
        many = size[part]
        if not len(many):
            continue
        of = np.repeat(np.arange(part.start, part.stop), many)
        i = sa[np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + begin[of]]
        d = depth[of]
        for start, partner in ((i, i + d), (i - d, i - d)):
            there = (partner >= 0) & (partner < n)
            rank = isa[np.where(there, partner, 0)]
            hit = there & (rank >= other_low[of]) & (rank < other_high[of])
            starts.append(start[hit])
            roots.append(d[hit])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(roots)


def _reach(code: np.ndarray, start: int, root: int, floor: int) -> int:
    """The first place from which on the words up to ``start`` repeat after ``root`` words; not below ``floor``."""
    block = 64
    while start > floor:
        low = max(floor, start - block)
        differ = np.flatnonzero(code[low:start] != code[low + root : start + root])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, block = low, block * 2
    return start


def find_runs(code: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int, int]]:
    """(text, start in it, length, period) of every run, sorted. Text j has the words ``code[offsets[j] : offsets[j + 1]]``."""
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    if not len(code):
        return []
    sizes = np.diff(offsets)
    ends, begins = np.repeat(offsets[1:], sizes), np.repeat(offsets[:-1], sizes)
    start, root = _squares(*suffix_arrays(code, ends))
    need = np.maximum(min_length, min_exponent * root) - 2 * root  # words before the square that the run must reach
    ok = start - need >= begins[start]
    start, root, need = start[ok], root[ok], need[ok]
    for back in (1, 2):
        ok = (need < back) | (code[start - np.minimum(back, need)] == code[start - np.minimum(back, need) + root])
        start, root, need = start[ok], root[ok], need[ok]
    ok = code[start - need] == code[start - need + root]
    start, root = start[ok], root[ok]
    found, out = {}, []
    for i in np.lexsort((root, start + 2 * root)).tolist():
        s, d = int(start[i]), int(root[i])
        ending = found.setdefault(s + 2 * d, [])
        if any(d % period == 0 and begin <= s for begin, period in ending):
            continue
        begin = _reach(code, s, d, int(begins[s]))
        if s + 2 * d - begin >= max(min_length, min_exponent * d):
            ending.append((begin, d))
            text = int(np.searchsorted(offsets, begin, side="right")) - 1
            out.append((text, begin - int(offsets[text]), s + 2 * d - begin, d))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def _columns(texts: list[str], keys: list[str | None], order: Order | None, min_length: int, min_exponent: int) -> list[pa.Array]:
    """The runs and the collapsed text of each text."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    coded = lists.values.dictionary_encode()
    named = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    all_codes = coded.indices.to_numpy()
    there = named[all_codes] if len(named) else np.zeros(0, bool)
    code = all_codes[there].astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(there)])[lists.offsets.to_numpy()].astype(np.int64)
    offsets -= offsets[0]
    moved: dict[int, np.ndarray] = {}
    if order is not None:
        for j, key in enumerate(keys):
            low, high = int(offsets[j]), int(offsets[j + 1])
            places = order(key, high - low)
            if places is not None:
                moved[j] = places
                code[low:high] = code[low:high][places]
    runs: list[list[dict]] = [[] for _ in texts]
    for text, begin, length, period in find_runs(code, offsets, min_length, min_exponent):
        runs[text].append({"start": begin, "length": length, "period": period})
    collapsed = []
    for j, text in enumerate(texts):
        words = text.encode("utf-8").split()  # the same white space: space, \t to \r
        if j in moved:
            words = [words[i] for i in moved[j].tolist()]
        if runs[j]:
            drop = np.zeros(len(words) + 1, np.int64)
            for r in runs[j]:
                drop[r["start"] + r["period"]] += 1
                drop[r["start"] + r["length"]] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(words).decode("utf-8"))
    return [pa.array(runs, RUNS_ARROW), pa.array(collapsed, pa.string())]


RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def detect(docs: DataFrame, text_col: str = "text", order: Order | None = None, key: Column | None = None,
           min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """The input's columns plus ``runs`` (by start, then period) and ``collapsed``: the text without the words that a run
    repeats after its first period, joined by single spaces. With ``order``, each text is read in the order it gives for
    the row's ``key``."""
    with_python(docs.sparkSession)
    added = [T.StructField("runs", RUNS_TYPE), T.StructField("collapsed", T.StringType())]
    base = without(docs, [f.name for f in added])
    work = docs.select(
        *[F.col(f"`{c}`") for c in base.columns],
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text__"),
        (F.lit(None) if key is None else key).cast("string").alias("__key__"),
    )
    n_keep = len(base.columns)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not batch.num_rows:
                continue
            extra = _columns(batch.column(n_keep).to_pylist(), batch.column(n_keep + 1).to_pylist(), order, min_length, min_exponent)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], *extra], names=[*batch.schema.names[:n_keep], *[f.name for f in added]])

    return work.mapInArrow(tidy(batches), T.StructType([*nullable(base.schema).fields, *added]))


def planted(doc_id: str | None, n: int) -> np.ndarray | None:
    """The order that plants a repetition into every tenth text (by the CRC of its id); texts without an id stay as they are."""
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def digest(found: DataFrame) -> DataFrame:
    """One row per input row: doc_id, the number of runs, the longest one (ties: smallest start, then period) and the digests."""
    # runs are sorted by start and period, so of equal lengths the first is the one
    longest = F.expr("element_at(filter(runs, r -> r.length = array_max(transform(runs, x -> x.length))), 1)")
    best = F.when(F.size("runs") > 0, longest)
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, doc_id::VARCHAR AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
crc AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(id[i])::BIGINT for i in range(1, length(id) + 1)]),
                lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                      lambda x, y: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END)))) AS h FROM t),
g AS (SELECT doc_id, words, len(words) AS n, h, h // 10 AS g FROM crc),
a AS (SELECT doc_id, words, n, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a, g FROM g),
w AS (SELECT doc_id, n, i, words[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1] AS word
      FROM (SELECT *, unnest(range(n)) AS i FROM a)),
alike AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike),
stretches AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
facts AS (SELECT doc_id, count(*) AS n_runs, arg_min({s: start, l: length, p: period}, (-length, start, period)) AS best,
                 string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT w.doc_id, w.i FROM w JOIN runs r ON w.doc_id = r.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length),
kept AS (SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS collapsed FROM w ANTI JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN facts f ON d.doc_id = f.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id"""
