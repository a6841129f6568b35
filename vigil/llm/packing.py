"""Best-fit decreasing packing of whole documents into sequences, exact over the whole corpus.

Best-fit decreasing only looks at lengths, and there are at most ``capacity`` of them. So the corpus is reduced to a
histogram of piece lengths (at most ``capacity`` rows, pre-aggregated), the packing is planned on the histogram, and
the plan, whose size depends on ``capacity`` only, is sent back to the pieces:

1. every worker encodes its texts and cuts longer documents into full pieces, the short one first; a piece knows
   its task, its length and its number among the task's pieces of that length. Pieces are stored once.
2. ``plan`` walks the lengths in decreasing order. A segment tree over remaining capacities finds the tightest open
   bin that still takes the length in O(log capacity) steps; documents of equal length that best fit would treat
   alike are placed as one run, which gives exactly the bins of placing them one after the other (tested).
3. a piece's rank among all pieces of its length (its own number plus the counts of earlier tasks) picks its run,
   and the run its bin and offset. Full pieces are bins of their own and need no rank.

Defined cases: null or empty text is one token (the end id); equal lengths are ranked by task and row order; repeated
rows are documents of their own; an empty table gives no pieces; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import stored, tidy, with_python
from vigil.llm.pieces import hf_encoder

CAPACITY = 1024
END_ID = 2


class TightestFit:
    """Segment tree over remaining capacities 0..capacity: which of them open bins have.

    ``find(need)`` gives the smallest remaining capacity of at least ``need`` that some open bin has, or -1.
    """

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.tree = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        node = remaining + self.size
        while node:
            self.tree[node] += bins
            node //= 2

    def find(self, need: int) -> int:
        node = need + self.size
        if self.tree[node]:
            return need
        while node > 1:  # climb until a right neighbour has a bin, then go down to its leftmost one
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return -1


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over {length: pieces}: runs (length, first rank, pieces, first bin, per bin, offset).

    Piece number r of a run lies in bin ``first bin + r // per bin`` at ``offset + (r % per bin) * length``.
    """
    tree = TightestFit(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> (first bin, bins) with it
    runs, bins = [], 0

    def put(remaining: int, first: int, n: int) -> None:
        open_.setdefault(remaining, []).append((first, n))
        tree.add(remaining, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.find(length)
            if remaining >= 0:
                first, n = open_[remaining].pop()
                tree.add(remaining, -n)
            else:  # no open bin takes it: open as many as are filled
                remaining = capacity
                first, n = bins, -(-left // (capacity // length))
                bins += n
            # the tightest bin stays the tightest until it no longer takes the length
            per_bin = remaining // length
            full = min(n, left // per_bin)
            offset = capacity - remaining
            if full:
                runs.append((length, rank, full * per_bin, first, per_bin, offset))
                put(remaining - per_bin * length, first, full)
                rank, left = rank + full * per_bin, left - full * per_bin
            if left and full < n:  # the last pieces fill one more bin partly
                runs.append((length, rank, left, first + full, per_bin, offset))
                put(remaining - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                put(remaining, first + full, n - full)
    return runs


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the capacity."""
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text_col: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (null unless asked for), task, number: the pieces to be packed."""
    with_python(docs.sparkSession)
    end = end_id.to_bytes(4, "little")
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = hf_encoder(path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row, text_ids in enumerate(encoder([t or "" for t in batch.column(1).to_pylist()])):
                text_ids += end
                for k, (start, length) in enumerate(cut(len(text_ids) // 4, capacity)):
                    part = text_ids[4 * start : 4 * (start + length)]
                    for column, value in zip(out, (row, k, start, length, zlib.crc32(part), part if ids else None, seen[length])):
                        column.append(value)
                    seen[length] += 1
            n = len(out[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:5]],
                 pa.array(out[5], pa.binary()), pa.array([task] * n, pa.int64()), pa.array(out[6], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "number"])

    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long, ids binary, task long, number long"
    return docs.select("doc_id", F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(tidy(run), schema)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. ``pieces`` must be stored: its tasks and numbers are read repeatedly."""
    spark = pieces.sparkSession
    short = pieces.where(F.col("length") < capacity)
    counts = short.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # under ``capacity`` rows
    runs = plan(histogram, capacity)
    per_length: dict[int, tuple] = {}
    for length in histogram:
        own = [r for r in runs if r[0] == length]
        per_length[length] = tuple(np.array([r[i] for r in own], dtype=np.int64) for i in (1, 3, 4, 5))
    shared = spark.sparkContext.broadcast(per_length)  # the plan: bounded by the capacity, not by the input
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = short.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("number")).drop("base")
    keep = pieces.drop("task", "number")
    n_keep = len(keep.columns)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), dtype=np.int64) for c in ("length", "rank"))
            bin_, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                first_rank, first_bin, per_bin, start = shared.value[int(value)]
                run = np.searchsorted(first_rank, rank[at], side="right") - 1
                own = rank[at] - first_rank[run]
                bin_[at] = first_bin[run] + own // per_bin[run]
                offset[at] = start[run] + own % per_bin[run] * value
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n_keep)], pa.array(bin_), pa.array(offset)], names=[*batch.schema.names[:n_keep], "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema.fields)
    seated = ranked.select(*keep.columns, "rank").mapInArrow(seat, f"{fields}, sequence_id long, offset long")
    # a full piece is a sequence of its own, numbered below zero by its task and number
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -(F.col("task") * (1 << 33) + F.col("number")) - 1, "offset": F.lit(0).cast("long")})
    return seated.unionByName(full.drop("task", "number"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text_col: str = "text", ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset of every piece of every document."""
    return place(stored(pieces_of(docs, path, capacity, end_id, text_col, ids), "pieces"), capacity)
