"""Sinks: keyed merge (upsert) without a table format, versioned all-or-nothing writes, exports.

No MERGE-capable table format is installed, so an upsert is a full-outer join of the stored rows with the incoming
rows on the identity key (compared NULL-safe, so re-running is idempotent). A table is a fixed number of
key-hash buckets; a run rewrites the buckets that its incoming keys fall into, under a name of its own, and the other
buckets stay where they are. Readers see a run when its pointer is complete: pointers are numbered, never
overwritten, and the newest complete one names the folder of every bucket of every table.

One writer at a time per store is assumed (two that race write the same number; the run id decides).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 32
_BUCKET = "__bucket"
SEEN_COLUMNS = ("first_seen_at", "last_seen_at")


def keyed_merge(
    stored: DataFrame,
    incoming: DataFrame,
    keys: tuple[str, ...],
    update: tuple[str, ...],
    now: Column | None = None,
    keep_existing: tuple[str, ...] = (),
) -> DataFrame:
    """Insert new keys; on a key match overwrite ``update`` columns from the incoming row
    (``keep_existing`` columns keep the stored value when the incoming one is NULL), keep
    ``first_seen_at`` and set ``last_seen_at`` to ``now``; stored rows without a match are unchanged.

    ``incoming`` must be unique per key (F1 checks that before any write). One shuffle on the key for
    each side; the join is NULL-safe on every key column."""
    now = now if now is not None else F.current_timestamp()
    s = stored.select(*[F.col(c).alias(f"s_{c}") for c in stored.columns])
    i = incoming.select(*[F.col(c).alias(f"i_{c}") for c in incoming.columns], F.lit(True).alias("i__present"))
    cond = None
    for k in keys:
        c = F.col(f"s_{k}").eqNullSafe(F.col(f"i_{k}"))
        cond = c if cond is None else cond & c
    j = s.join(i, cond, "full_outer")
    matched_new = F.col("i__present").isNotNull()
    out = [F.when(matched_new, F.col(f"i_{k}")).otherwise(F.col(f"s_{k}")).alias(k) for k in keys]
    for c in update:
        new = F.col(f"i_{c}")
        if c in keep_existing:
            new = F.coalesce(new, F.col(f"s_{c}"))
        out.append(F.when(matched_new, new).otherwise(F.col(f"s_{c}")).alias(c))
    stored_first = F.col("s_first_seen_at")
    out.append(F.when(matched_new & stored_first.isNull(), now).otherwise(stored_first).alias("first_seen_at"))
    out.append(F.when(matched_new, now).otherwise(F.col("s_last_seen_at")).alias("last_seen_at"))
    return j.select(*out)


# ------------------------------------------------------------------------------ versioned tables


def _list(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder, None when there is no such folder. Any other failure is raised."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    return [s.getPath().getName() for s in fs.listStatus(folder)]


def empty_state() -> dict:
    return {"number": 0, "tables": {}, "applied": {}}


def current_state(spark: SparkSession, base: str) -> dict:
    """The newest complete pointer: {number, tables: {name: {schema, buckets}}, applied: {stream: batch id}}.

    Only a store without a pointer folder (or without a complete pointer in it) is empty; a pointer that is there but
    cannot be read is an error, because merging into an empty store would drop all history."""
    pointers = f"{base.rstrip('/')}/_pointers"
    for name in sorted(_list(spark, pointers) or [], reverse=True):
        if "_SUCCESS" in (_list(spark, f"{pointers}/{name}") or []):
            return json.loads(spark.read.text(f"{pointers}/{name}", wholetext=True).first()[0])
    return empty_state()


def switch(spark: SparkSession, base: str, state: dict) -> dict:
    """Publish ``state`` under the next number: one small write to a new folder, the run's commit point."""
    state = state | {"number": state["number"] + 1}
    path = f"{base.rstrip('/')}/_pointers/{state['number']:020d}-{uuid.uuid4().hex[:12]}"
    line = spark.createDataFrame([(json.dumps(state, sort_keys=True),)], "state string")
    line.coalesce(1).write.mode("errorifexists").text(path)
    return state


def bucket_of(keys: Iterable[str]) -> Column:
    keys = list(keys)
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int") if keys else F.lit(0)


def write_table(df: DataFrame, base: str, table: str, version: str, keys: Iterable[str] = ()) -> dict:
    """Write rows bucketed by ``keys`` under a folder that no earlier run has; gives the table's pointer entry.

    ``version`` is a label: the run's own suffix keeps a repeated label from touching a published folder."""
    folder = f"version={version}-{uuid.uuid4().hex[:12]}"
    path = f"{base.rstrip('/')}/{table}/{folder}"
    rows = df.withColumn(_BUCKET, bucket_of(keys)).hint("rebalance", _BUCKET)
    rows.write.mode("errorifexists").partitionBy(_BUCKET).parquet(path)
    found = [n for n in _list(df.sparkSession, path) or [] if n.startswith(f"{_BUCKET}=")]
    return {"schema": df.schema.json(), "buckets": {n.split("=")[1]: f"{folder}/{n}" for n in found}}


def read_table(spark: SparkSession, base: str, table: str, entry: dict, buckets: Iterable[str] | None = None) -> DataFrame:
    """The rows of a pointer entry, of all buckets or of those named."""
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    wanted = entry["buckets"] if buckets is None else {b: entry["buckets"][b] for b in buckets if b in entry["buckets"]}
    paths = [f"{base.rstrip('/')}/{table}/{p}" for p in wanted.values()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    entry = current_state(spark, base)["tables"].get(table)
    return None if entry is None else read_table(spark, base, table, entry)


def merge_table(
    spark: SparkSession,
    base: str,
    table: str,
    entry: dict | None,
    incoming: DataFrame,
    keys: tuple[str, ...],
    update: tuple[str, ...],
    version: str,
    now: Column | None = None,
    keep_existing: tuple[str, ...] = (),
) -> dict:
    """Merge ``incoming`` (unique per key) into a stored table; only buckets with incoming keys are read and rewritten."""
    now = now if now is not None else F.current_timestamp()
    touched = [str(r[0]) for r in incoming.select(bucket_of(keys)).distinct().collect()]  # at most BUCKETS numbers
    if entry is None:
        old = incoming.where(F.lit(False)).withColumns({c: now for c in SEEN_COLUMNS})
        kept: dict = {}
    else:
        old = read_table(spark, base, table, entry, touched)
        kept = {b: p for b, p in entry["buckets"].items() if b not in touched}
    written = write_table(keyed_merge(old, incoming, keys, update, now, keep_existing), base, table, version, keys)
    return {"schema": written["schema"], "buckets": kept | written["buckets"]}


def last_per_key(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key, the last by ``order``: pre-aggregated before the shuffle, so a hot key is one row per task."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__last")
    return df.groupBy(*keys).agg(best).select(*[c if c in keys else F.col(f"__last.{c}").alias(c) for c in df.columns])


def export_csv(df: DataFrame, path: str) -> None:
    """A small report (e.g. the coefficient table) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
