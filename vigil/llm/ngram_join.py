"""N-gram Jaccard self-join by chosen paths: documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

Sets: words are runs without ASCII white space, A-Z lower-cased; a text of fewer than five words has one shingle of all
of them, a text without words has none. Equal sets are one class from the start and are joined once.

Chosen paths: every set is sketched by ``SKETCH`` min-hash tokens (position, value); two sets share a token with
probability equal to their similarity. In each of ``RUNS`` independent runs a set steps from the root to the buckets of
tokens picked by a hash of the run and the token, 1 / THRESHOLD of them per run on average, so similar sets meet while others part. A path
ends in a bucket of at most ``BUCKET`` sets or in one whose sets are all alike. A pair at the threshold shares no such bucket
in ``RUNS`` runs with probability exp(-RUNS) = 2.1e-9.

A larger bucket of unlike sets is hot: its token is a passage that many share. It is no place to meet, so a set with hot picks
takes further runs (``STAGES``) until it has enough picks in other buckets. Where the share h of a set's tokens is hot, a cold
token of it is also that of a set at the threshold with probability r = (0.8 - h) / (1 - h) or more, and c cold picks miss a pair
with probability (1 - r) ** c: 17 are enough (``FEW_HOT``) up to h = 0.33, shown by a quarter of the picks, and 30 (``COLD``)
up to h = 0.6; both give 1.3e-9 at most. Sets that have taken all runs and still have fewer than ``DOMINATED`` cold picks
consist of hot tokens mostly: they, and only they, are compared in their hot buckets of the first ``RUNS`` runs, which is
what every other set does in its buckets. Only where more than ``DENSE`` * ``BUCKET`` such sets meet do they walk on from the hot buckets of
all runs, along further tokens, for up to ``LEVELS`` steps in all. A pair walks together for k steps with probability q(k),
q(1) = 0.63, q(k + 1) = 1 - exp(-q(k)), in one run; ``RUNS_AT`` [k] runs are enough for every depth k, and these sets have
taken more.

Brute force: a bucket is cut into cells of at most two blocks of ``BUCKET`` sets, so no task holds a large bucket. A cell
compares sizes (exactly) and sketches (a byte per token) and stores, per set, those partners that may reach the threshold; then
the full sets are intersected. A pair at the threshold agrees in fewer than ``AGREE`` tokens with probability 3.0e-10; with the
runs, a pair is missed with probability 2.4e-9 at most, and less the more similar it is. A pair belongs to the first of its
common buckets, so it is stored and counted once. Cells give each set's number of links and a spanning forest; components make
the classes. Equal sets are one set here, but links between different sets are counted exactly: a group of m different near
copies costs, and stores for a while, m * (m - 1) / 2 partners.

Defined cases: null text = empty; all texts without words are one class; equal doc_ids are documents of their
own; ties: a class is named after and kept by its smallest doc_id (null last, then by row); empty tables give empty
results; further columns are ignored. Sets are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import runs_of, stored, tidy, with_python, word_codes
from vigil.llm.components import components

SHINGLE = 5
SLICE_CHARS = 8_000_000
THRESHOLD = (8, 10)  # similarity of at least 8 / 10
SKETCH = 128
RUNS = 20
BUCKET = 1024
LEVELS = 6
ALIKE = 0.7  # mean share of common tokens from which a bucket's sets are alike
PROBES = 48  # sets of a large bucket, on average, from which that share is estimated; it steers the walk only
AGREE = 72  # tokens that must agree; at the threshold 102 do on average, with a standard deviation of 4.5
MISS = 2.1e-9  # probability of missing a pair at the threshold, at every depth


def meeting(steps: int) -> float:
    """q: the probability that a pair at the threshold walks ``steps`` steps together in one run."""
    return 1 - math.exp(-meeting(steps - 1)) if steps else 1.0


#: runs that make a depth's miss small enough; index 0 is not used
RUNS_AT = [0, *(max(RUNS, math.ceil(math.log(MISS) / math.log(1 - meeting(k)))) for k in range(1, LEVELS + 1))]
#: where the stages of runs end: all sets take the first, the others are for sets with too few cold picks
STAGES = (RUNS, 76)
COLD = 30
FEW_HOT = (17, 4)  # cold picks that are enough where at most one pick in four is hot
DOMINATED = 47  # of 95 picks
DENSE = 16
assert STAGES[-1] >= max(RUNS_AT)
_RNG = np.random.default_rng(20240501)
_MUL = _RNG.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32)
_PLACE = _RNG.integers(0, 1 << 63, SKETCH, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(SHINGLE, _STEP, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Arrow numbers the words of a slice; each is hashed once."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size < SLICE_CHARS or end == at):
            size += len(texts[end] or "")
            end += 1
        yield from _shingle_slice([t or "" for t in texts[at:end]])
        at = end


def _shingle_slice(texts: list[str]) -> Iterator[np.ndarray]:
    names, code, ends = word_codes(texts)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in names], dtype=np.uint64)[code]
    n = len(h) - SHINGLE + 1
    key = np.full(max(n, 0), SHINGLE, dtype=np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        key += h[k : k + n] * _POWERS[k]
    key = mix(key)
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= SHINGLE:
            yield np.unique(key[a : b - SHINGLE + 1])
        elif b > a:  # a short text is one shingle
            yield mix((np.array([b - a], dtype=np.uint64) + (h[a:b] * _POWERS[: b - a]).sum(dtype=np.uint64)))
        else:
            yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Min-hash values by multiply-add over 32 well-mixed bits."""
    out = np.full(SKETCH, 0xFFFFFFFF, dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    buffer = np.empty((min(256, len(x)), SKETCH), np.uint32)
    for at in range(0, len(x), 256):
        part = x[at : at + 256, None]
        drawn = buffer[: len(part)]
        np.multiply(part, _MUL, out=drawn)
        np.add(drawn, _ADD, out=drawn)
        np.minimum(out, drawn.min(axis=0), out=out)
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Sketches of a binary column as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, SKETCH)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sid, size, values, low = [], [], [], []
        for s in shingle_sets(batch.column("text").to_pylist()):
            sid.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
            size.append(len(s))
            drawn = sketch(s)
            values.append(drawn.astype("<u4").tobytes())
            low.append((_tokens(drawn[None])[0] >> np.uint64(56)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(sid, pa.int64()), pa.array(size, pa.int32()), pa.array(values, pa.binary()), pa.array(low, pa.binary())],
                                         names=["doc_id", "row", "mark", "sid", "size", "sketch", "bytes"])


def _tokens(values: np.ndarray) -> np.ndarray:
    """(position, value) tokens of sketches as 64-bit numbers."""
    return mix(values.astype(np.uint64) * _STEP + _PLACE)


def _pick(per_set: float, salts: np.ndarray):
    """A function: tokens -> (set, child) of the picked tokens, ``per_set`` per salt and set on average."""
    limit = np.uint64(int(per_set / SKETCH * 2**64))

    def run(tokens: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sets, children = [], []
        for salt in salts:
            drawn = mix(tokens ^ (own[:, None] + salt))
            at, place = np.nonzero(drawn < limit)
            sets.append(at)
            children.append(mix(drawn[at, place] + _STEP).view(np.int64))
        return np.concatenate(sets), np.concatenate(children)

    return run


_PER_RUN = THRESHOLD[1] / THRESHOLD[0]


def _root_buckets(first: int, end: int):
    """A function that takes the first step of the runs from ``first`` to before ``end``; ``picks``: the set's picks in all of them."""
    pick = _pick(_PER_RUN, mix(np.arange(first + 1, end + 1, dtype=np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column("sketch"))
                sets, children = pick(_tokens(values), np.zeros(len(values), np.uint64))
                picks = np.bincount(sets, minlength=len(values)).astype(np.int32)[sets]
                yield pa.RecordBatch.from_arrays([batch.column("sid").take(pa.array(sets)), pa.array(children), pa.array(picks)], names=["sid", "bucket", "picks"])

    return run


_STEP_SALT = mix(np.array([STAGES[-1] + 1], dtype=np.uint64))


def _split_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pick = _pick(_PER_RUN, _STEP_SALT)
    for batch in batches:
        if batch.num_rows:
            parent = batch.column("bucket").to_numpy().view(np.uint64)
            sets, children = pick(_tokens(_matrix(batch.column("sketch"))), mix(parent))
            yield pa.RecordBatch.from_arrays([batch.column("sid").take(pa.array(sets)), pa.array(children)], names=["sid", "bucket"])


def _likeness(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The mean share of common tokens among a bucket's probes."""
    values = _matrix(rows["sketch"])[: 4 * PROBES]
    n, same = len(values), 0
    for i in range(n - 1):
        same += int((values[i + 1 :] == values[i]).sum())
    share = same / (SKETCH * n * (n - 1) / 2) if n > 1 else 0.0
    return pa.table({"bucket": [key[0].as_py()], "share": [share]})


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of buckets with at least two sets, with the bucket's size m."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return rows.join(sizes, "bucket").select(*rows.columns, "m")


def _ended(level: DataFrame, sketches: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """The rows of ``level`` whose buckets are leaves (small, or of alike sets), and those of hot buckets, if there are any."""
    small, large = level.where(F.col("m") <= BUCKET).select("sid", "bucket", "m"), level.where(F.col("m") > BUCKET)
    if large.isEmpty():
        return [small], None
    chosen = F.pmod(F.xxhash64("bucket", "sid", F.lit(1)), F.lit(1 << 20)) < F.lit(PROBES << 20) / F.col("m")
    probes = large.where(chosen).join(sketches, "sid").select("bucket", "sketch")
    alike = probes.groupBy("bucket").applyInArrow(_likeness, "bucket long, share double").where(F.col("share") >= ALIKE)
    alike = stored(alike.select("bucket"), "alike")
    apart = large.join(alike, "bucket", "left_anti")
    return [small, large.join(alike, "bucket", "left_semi").select("sid", "bucket", "m")], None if apart.isEmpty() else apart


def _walk_on(level: DataFrame, sketches: DataFrame) -> list[DataFrame]:
    """The leaves of the paths of ``level`` (sid, bucket, m) from their hot buckets on."""
    leaves: list[DataFrame] = []
    for _ in range(LEVELS - 1):
        ended, apart = _ended(level, sketches)
        leaves += ended
        if apart is None:
            return leaves
        paths = apart.select("sid", "bucket").join(sketches, "sid").select("sid", "bucket", "sketch").mapInArrow(tidy(_split_buckets), "sid long, bucket long")
        level = stored(_sized(paths.distinct()), "buckets")
    return [*leaves, level.select("sid", "bucket", "m")]


def leaf_buckets(reps: DataFrame) -> DataFrame:
    """(sid, bucket, m): the buckets in which sets are compared."""
    sketches = reps.select("sid", "sketch")
    leaves: list[DataFrame] = []
    hot: list[DataFrame] = []
    todo, short = sketches, None
    for first, end in zip((0, *STAGES), STAGES):
        picked = todo.mapInArrow(tidy(_root_buckets(first, end)), "sid long, bucket long, picks int").distinct()
        level = stored(_sized(picked), "buckets")
        ended, apart = _ended(level, sketches)
        leaves += ended
        if apart is None:
            short = None
            break
        apart = stored(apart.select("sid", "bucket", "picks"), "hot")
        hot.append(apart.select("sid", "bucket"))
        own = apart.groupBy("sid").agg(F.max("picks").cast("long").alias("picks"), F.count(F.lit(1)).alias("hot"))
        if short is not None:
            before = short.select("sid", F.col("picks").alias("p"), F.col("hot").alias("h"))
            own = own.join(before, "sid").select("sid", (F.col("picks") + F.col("p")).alias("picks"), (F.col("hot") + F.col("h")).alias("hot"))
        cold = F.col("picks") - F.col("hot")
        enough = (cold >= COLD) | ((cold >= FEW_HOT[0]) & (F.col("hot") * FEW_HOT[1] <= F.col("picks")))
        short = stored(own.where(cold < DOMINATED if end == STAGES[-1] else ~enough), "short")
        todo = sketches.join(short.select("sid"), "sid", "left_semi")
        if short.isEmpty():
            short = None
            break
    if short is not None:
        own = short.select("sid")
        first = stored(_sized(hot[0].join(own, "sid", "left_semi")), "dense")
        leaves.append(first.where(F.col("m") <= DENSE * BUCKET).select("sid", "bucket", "m"))
        if not first.where(F.col("m") > DENSE * BUCKET).isEmpty():
            every = stored(_sized(reduce(DataFrame.unionByName, hot).join(own, "sid", "left_semi")), "dense")
            leaves += _walk_on(every.where(F.col("m") > DENSE * BUCKET), sketches)
    return reduce(DataFrame.unionByName, leaves)


def cells(leaves: DataFrame) -> DataFrame:
    """(cell, bucket, sid, part, cross): each bucket as pairs of blocks of about BUCKET sets; a block meets every other."""
    blocks = F.ceil(F.col("m") / BUCKET).cast("int")
    rows = leaves.withColumn("blocks", blocks).withColumn("part", F.pmod(F.xxhash64("sid", "bucket"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return rows.select(F.xxhash64("bucket", low, high).alias("cell"), "bucket", "sid", "part", (low != high).alias("cross"))


def _edges_of(keys: np.ndarray) -> np.ndarray:
    """Begins of the runs of a sorted array, and its end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


class _Earlier:
    """Which sets of a cell are together in a bucket that comes before the cell's own."""

    def __init__(self, paths: list[list[int]], bucket: int):
        flat = np.concatenate([np.asarray(p, np.int64) for p in paths])
        row = np.repeat(np.arange(len(paths)), [len(p) for p in paths])
        before = flat < bucket
        _, self.code = np.unique(flat[before], return_inverse=True)
        self.ends = np.searchsorted(row[before], np.arange(len(paths) + 1))
        self.marked = np.zeros(int(self.code.max(initial=-1)) + 1, bool)

    def with_later(self, i: int) -> np.ndarray:
        """For the sets after ``i``: whether they meet set i before."""
        own = self.code[self.ends[i] : self.ends[i + 1]]
        self.marked[own] = True
        met = np.concatenate([[0], np.cumsum(self.marked[self.code[self.ends[i + 1] :]])])
        self.marked[own] = False
        ends = self.ends[i + 1 :] - self.ends[i + 1]
        return met[ends[1:]] > met[ends[:-1]]


MANY = 8  # partners of one set in one cell from which their buckets are compared all at once


def _similar_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell the sets that have a partner whose sketch agrees enough, with their partners (each pair once)."""
    for rows in runs_of(batches, "cell"):
        values = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        cell, sid, part, cross = (rows[c].to_numpy() for c in ("cell", "sid", "part", "cross"))
        bucket, size = rows["bucket"].to_numpy(), rows["size"].to_numpy().astype(np.int64)
        paths = rows["paths"].to_pylist()
        out: list[tuple[int, int, list[int]]] = []
        edges = _edges_of(cell)
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a < 2:
                continue
            partners: dict[int, list[int]] = {}
            earlier: _Earlier | None = None
            for i in range(a, b - 1):
                near = (values[i + 1 : b] == values[i]).sum(axis=1) >= AGREE
                near &= np.minimum(size[i + 1 : b], size[i]) * THRESHOLD[1] >= np.maximum(size[i + 1 : b], size[i]) * THRESHOLD[0]
                if cross[i]:
                    near &= part[i + 1 : b] != part[i]
                found = np.flatnonzero(near)
                if not len(found):
                    continue
                # a pair belongs to the first bucket that both are in
                if len(found) >= MANY:
                    earlier = earlier or _Earlier(paths[a:b], int(bucket[a]))
                    found = found[~earlier.with_later(i - a)[found]] + i + 1
                else:
                    own = set(paths[i])
                    found = [j for j in found + i + 1 if min(own.intersection(paths[j])) == bucket[i]]
                if len(found):
                    partners.setdefault(i, []).extend(sid[found].tolist())
                    for j in found:
                        partners.setdefault(int(j), [])
            out += [(int(cell[i]), int(sid[i]), p) for i, p in partners.items()]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int64()))], names=["cell", "sid", "partners"])


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [s.astype("<u8").tobytes() for s in shingle_sets(batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(found, pa.binary())], names=["sid", "shingles"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell: each set's number of links, and an edge to the smallest set of its part of the cell's forest."""
    for rows in runs_of(batches, "cell"):
        cell, sid = rows["cell"].to_numpy(), rows["sid"].to_numpy()
        edges = _edges_of(cell)
        who, root_of, links = [], [], []
        for a, b in zip(edges[:-1], edges[1:]):
            part = rows.slice(a, b - a)
            sets = {int(s): np.frombuffer(x, "<u8") for s, x in zip(sid[a:b], part["shingles"].to_pylist())}
            up = {s: s for s in sets}
            count = dict.fromkeys(sets, 0)

            def top(s: int) -> int:
                while up[s] != s:
                    up[s] = up[up[s]]
                    s = up[s]
                return s

            for s, partners in zip(sid[a:b], part["partners"].to_pylist()):
                if not partners:
                    continue
                own = sets[int(s)]
                sizes = np.array([len(sets[p]) for p in partners])
                flat = np.concatenate([sets[p] for p in partners])
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                common = np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                union = len(own) + sizes - common
                for p in np.flatnonzero(common * THRESHOLD[1] >= union * THRESHOLD[0]):
                    x, y = top(int(s)), top(partners[p])
                    up[max(x, y)] = min(x, y)
                    count[int(s)] += 1
                    count[partners[p]] += 1
            for s, c in count.items():
                if c:
                    who.append(s)
                    root_of.append(top(s))
                    links.append(c)
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(root_of, pa.int64()), pa.array(links, pa.int64())], names=["sid", "root", "links"])


def _by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell")


def text_mark(text: Column) -> Column:
    """A hash that tells a document's text apart from others of the same doc_id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links (other sets of similarity >= 0.8), n_copies (documents with this very set), class_size,
    kept (one per class), mark (hash of the text) for every document."""
    with_python(docs.sparkSession)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_mark(F.col("text")).alias("mark"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sets = stored(rows.mapInArrow(tidy(_sets), f"doc_id {id_type}, row long, mark long, sid long, size int, sketch binary, bytes binary"), "sets")
    # sets of one shingle or none are similar to equal sets only, and those are one class already
    reps = stored(sets.where("size > 1").select("sid", "size", "sketch", "bytes").dropDuplicates(["sid"]), "reps")
    leaves = stored(leaf_buckets(reps), "leaves")
    paths = leaves.groupBy("sid").agg(F.collect_list("bucket").alias("paths"))  # about a hundred at most
    info = paths.join(reps.select("sid", "size", "bytes"), "sid")
    near = stored(_by_cell(cells(leaves).join(info, "sid")).mapInArrow(tidy(_similar_sketches), "cell long, sid long, partners array<long>"), "near")

    # the full sets of what is left, from one document of each set
    one = sets.join(near.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("doc_id", "mark")).alias("d"))
    one = stored(one.select("sid", F.col("d.doc_id").alias("doc_id"), F.col("d.mark").alias("mark")), "near-docs")
    texts = docs.select(F.col("doc_id").alias("id"), text_mark(F.col("text")).alias("text_mark"), F.col("text").cast("string").alias("text"))
    texts = texts.join(one.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_mark") == F.col("mark"))).select("sid", "text")
    shingles = texts.mapInArrow(tidy(_with_shingles), "sid long, shingles binary").dropDuplicates(["sid"])
    checked = stored(_by_cell(near.join(shingles, "sid")).mapInArrow(tidy(_verified), "sid long, root long, links long"), "links")

    roots = components(checked.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    linked = checked.groupBy("sid").agg(F.sum("links").alias("n_links"))
    per_set = sets.groupBy("sid").agg(F.count(F.lit(1)).alias("n_copies"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    per_set = per_set.join(linked, "sid", "left").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    per_set = stored(per_set.withColumn("class", F.coalesce("root", "sid")), "classes")
    per_class = per_set.groupBy("class").agg(F.min("first").alias("first"), F.sum("n_copies").alias("class_size"))
    per_set = per_set.select("sid", "class", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links")).join(per_class, "class")
    return sets.select("doc_id", "row", "sid", "mark").join(per_set, "sid").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "n_links", "n_copies", "class_size", (F.col("row") == F.col("first.row")).alias("kept"), "mark")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each class, all columns as they came. Rows that repeat the kept doc_id and text stay."""
    found = stored(join(docs).where("class_size > 1").select("doc_id", "mark", "kept"), "decisions")
    gone = found.groupBy("doc_id", "mark").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"))
    same = F.col("`doc_id`").eqNullSafe(F.col("gone_id")) & (text_mark(F.col("`text`")) == F.col("gone_mark"))
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
