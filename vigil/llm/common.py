"""Shared pieces of the training-data operators: reading, shared scratch tables, Arrow batch helpers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import vigil
from vigil.session import ensure_checkpoint_dir

_SHIPPED = "vigil.llm.shipped"
_BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def give_back() -> None:
    """Return freed memory to the operating system: Python workers are reused, and what one operator's batches needed
    would otherwise stay with them while the next one runs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def tidy(fn):
    """Wrap a ``mapInArrow`` function so that its task gives freed memory back when it ends."""

    @functools.wraps(fn)
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


def tidy_group(fn):
    """The same for an ``applyInArrow`` function of two arguments (Spark counts them), after each group."""

    def one(first, second):
        try:
            return fn(first, second)
        finally:
            give_back()

    return one


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends at files that outlive executors.

    Tables go to ``<spark.checkpoint.dir>/<application id>/<label>-<uuid>`` and can be removed once the
    application has ended.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def with_python(spark: SparkSession) -> None:
    """Give this package to the Python workers once per application, wherever the driver imported it from.

    Also holds Arrow batches to BATCH_BYTES for the session, so a worker's memory does not depend on text lengths."""
    limit = spark.conf.get(_BATCH_CONF)
    if not limit.rstrip("b").lstrip("-").isdigit() or not 0 < int(limit.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)
    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", None) == _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(vigil.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vigil-src-"), "vigil_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("vigil", os.path.relpath(full, root)))
    sc.addPyFile(archive)
    sc._vigil_shipped = _SHIPPED


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are. Null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # the JVM's lower() has a fast path for pure ASCII, where it changes exactly A-Z
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns that an operator is about to add, so a clashing input column is replaced."""
    drop = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def adding(df: DataFrame, fn, added: list[T.StructField], text_col: str = "text") -> DataFrame:
    """Run ``fn(list of texts) -> list of pyarrow arrays`` over every batch and append its columns.

    All input columns but clashing ones ride along unchanged; nothing is shuffled. Null texts are passed as "".
    """
    with_python(df.sparkSession)
    source = "__text__"
    base = without(df, [f.name for f in added])
    keep = [F.col(f"`{c}`") for c in base.columns]
    # an added column may carry the text column's own name, so the text goes in under a name of its own
    work = df.select(*[F.col(f"`{c}`") for c in base.columns], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(source))
    schema = T.StructType([*nullable(base.schema).fields, *added])
    n_keep = len(keep)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            columns = [batch.column(i) for i in range(n_keep)]
            extra = fn(batch.column(n_keep).to_pylist())
            yield pa.RecordBatch.from_arrays([*columns, *extra], names=[*batch.schema.names[:n_keep], *[f.name for f in added]])

    return work.mapInArrow(tidy(batches), schema)


def word_codes(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of texts (runs without ASCII white space, A-Z lower-cased) numbered by Arrow: the distinct words, all words
    as numbers, and the position at which each text's words begin, with the end last."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    coded = lists.values.dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    there = np.array([w != "" for w in names], dtype=bool)[code] if names else np.zeros(0, bool)
    return names, code[there], np.concatenate([[0], np.cumsum(there)])[lists.offsets.to_numpy()]


def runs_of(it: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole key runs out of key-sorted batches: every key's rows are in exactly one of them."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[batch.num_rows - 1]
        if held and keys[0] == held[-1].column(key)[held[-1].num_rows - 1] and keys[0] == last:
            held.append(batch)  # the whole batch continues the open run
            continue
        values = keys.to_pylist()
        cut = len(values) - 1
        while cut > 0 and values[cut - 1] == values[cut]:
            cut -= 1
        ready = [*held, batch.slice(0, cut)] if cut else held
        ready = [b for b in ready if b.num_rows]
        if ready and not (cut == 0 and held and values[0] == held[-1].column(key)[held[-1].num_rows - 1].as_py()):
            yield pa.Table.from_batches(ready)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)
