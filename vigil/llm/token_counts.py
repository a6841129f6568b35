"""Token counts by a two-tier look-up on the map side; no pre-token is ever shuffled with its document.

Tier 1: a compact table of the corpus's frequent pre-tokens and their token counts, broadcast. Each task counts the
pre-tokens of all its texts in a bounded Misra-Gries summary and passes on its heaviest entries; these bounded
summaries are added up, and the heaviest ``TABLE`` of them are encoded once. The table has at most
TABLE x (MAX_KEY characters + 2 bytes), whatever the input's size.
Tier 2: what the table misses is encoded by the library and kept in a bounded cache of the worker.
The tables only save time: counts are the library's for every text.

Defined cases: null text = empty = 0 tokens; special strings inside texts are taken as the library takes them;
further columns ride along, and input columns with the names added here are replaced.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import adding, tidy, with_python
from vigil.llm.pieces import MAX_KEY, PATTERN, HfBackend

TABLE = 32_768  # entries of the broadcast table
SUMMARY = 4_096  # entries that a task passes on
COUNTERS = 131_072  # counters of a task's summary
CACHE = 300_000  # entries of a worker's cache
LIMIT = 1024


def summarise(counts: Counter, most: int) -> None:
    """Misra-Gries reduction: subtract the (most+1)-th count from all and forget what reaches zero."""
    if len(counts) <= most:
        return
    floor = sorted(counts.values(), reverse=True)[most]
    for key in [k for k, v in counts.items() if v <= floor]:
        del counts[key]
    for key in counts:
        counts[key] -= floor


def frequent_pieces(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(piece, weight): the heaviest pre-tokens over all texts, at most TABLE rows."""
    with_python(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(PATTERN.findall(text or ""))
                if len(counts) > 2 * COUNTERS:
                    summarise(counts, COUNTERS)
        top = [(k, v) for k, v in counts.most_common(SUMMARY) if len(k) <= MAX_KEY]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], names=["piece", "weight"])

    parts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(tidy(count), "piece string, weight long")
    return parts.groupBy("piece").agg(F.sum("weight").alias("weight")).orderBy(F.col("weight").desc(), "piece").limit(TABLE)


class Lengths(dict):
    """Tier 1 entries plus a bounded cache of what was encoded since."""

    def __init__(self, path: str, table: list[tuple[str, int]]):
        super().__init__(table)
        self.backend = HfBackend(path)
        self.most = len(self) + CACHE

    def __missing__(self, piece: str) -> int:
        n = len(next(iter(self.backend.pieces([piece]))))
        if len(self) < self.most and len(piece) <= MAX_KEY:
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        whole = self.backend.text(text)
        return len(whole) if whole is not None else sum(map(self.__getitem__, PATTERN.findall(text)))


_LENGTHS: dict[tuple[str, str], Lengths] = {}


def lengths(path: str, shared: Broadcast) -> Lengths:
    """The worker's look-up for one broadcast table; a later table replaces an earlier one."""
    key = (path, shared.value[2])
    if key not in _LENGTHS:
        keys, values, _ = shared.value
        _LENGTHS.clear()
        _LENGTHS[key] = Lengths(path, list(zip(pa.ipc.open_stream(keys).read_all()["piece"].to_pylist(), values)))
    return _LENGTHS[key]


def broadcast_table(docs: DataFrame, path: str, text_col: str = "text") -> Broadcast:
    """The frequent pre-tokens as one Arrow column and one length each (a byte where it fits)."""
    spark = docs.sparkSession
    pieces = [r.piece for r in frequent_pieces(docs, text_col).collect()]  # at most TABLE short strings
    backend = HfBackend(path)
    counts = [len(ids) for ids in backend.pieces(pieces)] if pieces else []
    keys = pa.table({"piece": pa.array(pieces, pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, keys.schema) as writer:
        writer.write_table(keys)
    return spark.sparkContext.broadcast((sink.getvalue().to_pybytes(), counts, uuid.uuid4().hex))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """The input's columns plus n_bytes, n_tokens and over_limit."""
    shared = broadcast_table(docs, path, text_col)

    def columns(texts: list[str]) -> list[pa.Array]:
        table = lengths(path, shared)
        n = [table.count(t) for t in texts]
        return [pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]

    return adding(docs, columns, [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())], text_col)
