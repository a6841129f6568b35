"""Incremental letter ingestion with Structured Streaming (D3-D5 as a stream).

Landed listing payload files (JSON lines: ``batch``, ``payload``) are read with ``readStream``; each
micro-batch is parsed, deduplicated against the URLs already stored, joined with the landed pages for
details and merged into the letter store (only the buckets of its URLs). ``trigger(availableNow=True)`` drains what has
landed and stops. The store's pointer records the last applied batch id together with the tables, so a replayed
micro-batch is skipped and each takes effect once.

``run_stateful`` is the form for a store that has grown large: the URLs seen so far are the stream's own keyed state (one entry
per URL, partitioned by it, in RocksDB next to the checkpoint), so a micro-batch costs what it holds and reads nothing of
the store to tell new letters from known ones. Letters stored before the stream existed are landed once as ``seeds``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import letters as L
from vigil.session import cut_lineage, ensure_checkpoint_dir
from vigil.sources.sinks import current_state, keyed_merge, last_per_key, merge_table, read_table, switch

PAYLOAD_SCHEMA = "batch long, payload string"
SEEDED_SCHEMA = f"{PAYLOAD_SCHEMA}, url string"
SEED = -1  # the batch and row number of a URL that is known without having been listed
LISTED_SCHEMA = ("batch long, row_index int, posted_date date, issue_date date, company_name string, url string, issuing_office string, subject string")
STATE_PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
LETTER_COLUMNS = ("posted_date", "issue_date", "company_name", "issuing_office", "subject", "title", "content", "hash")
TABLE = "warning_letters"


def one_per_url(incoming: DataFrame) -> DataFrame:
    """A URL listed twice in a batch is one letter: its last listing row wins."""
    return last_per_key(incoming, ("url",), ("batch", "row_index"))


def upsert_letters(stored: DataFrame | None, incoming: DataFrame, now=None) -> DataFrame:
    """Letters keyed by URL (unique in ``incoming``); a summary never erases stored title, content or hash."""
    if stored is None:
        stored = incoming.where(F.lit(False)).withColumns(
            {"first_seen_at": F.current_timestamp(), "last_seen_at": F.current_timestamp()}
        )
    return keyed_merge(stored, incoming, ("url",), LETTER_COLUMNS, now=now, keep_existing=("title", "content", "hash"))


def process_batch(spark: SparkSession, payloads: DataFrame, pages: DataFrame, store: str, batch_id: int,
                  base_url: str, root: str = "main", host: str | None = None, stream: str = "letters") -> dict:
    """One micro-batch: parse listing rows, keep one row per new URL, parse the landed pages of those URLs only, merge,
    publish. A batch id that the store has already applied is skipped, so a replay changes nothing.

    ``host``: letters elsewhere are refused (B12)."""
    state = current_state(spark, store)
    if state["applied"].get(stream, -1) >= batch_id:
        return state
    rows = L.listing_rows(payloads, base_url)
    if host is not None:
        rows = L.allowed_rows(rows, host)
    rows = one_per_url(L.dedup_seen(rows))
    entry = state["tables"].get(TABLE)
    todo = rows if entry is None else L.missing(rows, read_table(spark, store, TABLE, entry))
    return _publish(spark, state, todo, pages, store, batch_id, root, stream)


def _publish(spark: SparkSession, state: dict, todo: DataFrame, pages: DataFrame, store: str, batch_id: int, root: str, stream: str) -> dict:
    """Merge the letters ``todo`` (one row per URL) with their pages' details and publish them with the batch id."""
    entry = state["tables"].get(TABLE)
    wanted = pages.select("url", "html").join(todo.select("url"), "url", "left_semi")
    details = last_per_key(L.parse_detail(wanted, root), ("url",), ("title", "content"))
    incoming = todo.join(details, "url", "left").select(
        "url", "posted_date", "issue_date", "company_name", "issuing_office", "subject", "title", "content",
        F.when(F.col("title").isNotNull() & F.col("content").isNotNull(),
               L.letter_hash(F.col("posted_date"), F.col("company_name"), F.col("url"), F.col("content"))).alias("hash"),
    )
    merged = merge_table(spark, store, TABLE, entry, incoming, ("url",), LETTER_COLUMNS, f"b{batch_id:08d}",
                         keep_existing=("title", "content", "hash"))
    return switch(spark, store, state | {"tables": state["tables"] | {TABLE: merged}, "applied": state["applied"] | {stream: batch_id}})


def run_available(spark: SparkSession, landing: str, pages: DataFrame, store: str, base_url: str,
                  root: str = "main", checkpoint: str | None = None, host: str | None = None) -> None:
    """Drain every landed payload file once (``availableNow``) through :func:`process_batch`.

    The stream's checkpoint and the store belong together: batch ids are those of one checkpoint."""
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/letters-stream"
    stream = spark.readStream.schema(PAYLOAD_SCHEMA).json(landing)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        process_batch(spark, batch_df, pages, store, batch_id, base_url, root, host)

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


# ------------------------------------------------------------------------------------- with keyed state


def _first_sight(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The last listing row of a URL that was never seen before; a seed makes it known without a row."""
    last, seeded = None, False
    for frame in frames:  # the rows of one URL in one micro-batch
        seeded = seeded or bool((frame["row_index"] == SEED).any())
        frame = frame.sort_values(["batch", "row_index"]).tail(1)
        if last is None or tuple(frame[["batch", "row_index"]].iloc[0]) > tuple(last[["batch", "row_index"]].iloc[0]):
            last = frame
    known = state.exists or seeded
    if not state.exists:
        state.update((True,))
    if not known:
        yield last


def unseen(rows: DataFrame) -> DataFrame:
    """Of a stream of listing rows, one row per URL that no earlier micro-batch had."""
    return rows.groupBy("url").applyInPandasWithState(_first_sight, LISTED_SCHEMA, "seen boolean", "append", "NoTimeout").select(*rows.columns)


def listed(payloads: DataFrame, base_url: str, host: str | None = None) -> DataFrame:
    """The listing rows of landed payloads, and the seeds among them (see ``write_seeds``)."""
    rows = L.listing_rows(payloads.where("payload IS NOT NULL"), base_url)
    if host is not None:
        rows = L.allowed_rows(rows, host)
    seeds = payloads.where("url IS NOT NULL AND payload IS NULL").select("url", F.lit(SEED).cast("long").alias("batch"), F.lit(SEED).alias("row_index"))
    return rows.unionByName(seeds, allowMissingColumns=True).select("batch", "row_index", "posted_date", "issue_date", "company_name", "url", "issuing_office", "subject")


def write_seeds(letters: DataFrame, landing: str) -> None:
    """Land the URLs of letters that were stored before the stream existed, so that it knows them. Once, before its first run."""
    letters.select("url").distinct().write.mode("append").json(landing)


def run_stateful(spark: SparkSession, landing: str, pages: DataFrame, store: str, base_url: str, root: str = "main",
                 checkpoint: str | None = None, host: str | None = None, stream: str = "letters-stateful") -> None:
    """Drain every landed file once, telling new letters by the stream's keyed state.

    State and store advance together: a micro-batch that was cut off is run again from the state before it, with the same rows
    and batch id, and the store skips an id that it has applied."""
    spark.conf.set(*STATE_PROVIDER)
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/letters-stateful"
    rows = unseen(listed(spark.readStream.schema(SEEDED_SCHEMA).json(landing), base_url, host))

    def each(new: DataFrame, batch_id: int) -> None:
        # the state advances once per micro-batch: what it gave is stored before it is read several times
        new = cut_lineage(new)
        state = current_state(spark, store)
        if state["applied"].get(stream, -1) < batch_id:
            _publish(spark, state, new, pages, store, batch_id, root, stream)

    q = rows.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
