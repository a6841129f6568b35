"""End-to-end jobs: ingest (F5), feature build (A8/G19), training run.

Each job validates everything before its commit point and writes new table versions; readers switch
to them with one pointer write, so a failed run leaves the previous versions in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import model as M
from vigil.operators.integrity import duplicate_identities, feature_snapshot_checks, snapshot_problems
from vigil.operators.loaders import DATASETS, BadRowsError, apply_policy, load
from vigil.plans.features import FeaturePlan
from vigil.sources.sinks import current_state, merge_table, read_current, read_table, switch, write_table

FEATURE_TABLE = "inspection_classification_v1"


class DuplicateIdentityError(ValueError):
    pass


class FeatureBuildError(ValueError):
    pass


def ingest_all(spark: SparkSession, raw: dict[str, DataFrame], store: str, version: str, mode: str = "fail") -> dict:
    """load all five extracts, validate all (bad rows, duplicate identities), then merge and publish at once.

    Each extract is cleaned once, into a staging folder of the run; checks, merge and counts read that.
    Returns per dataset the loaded rows, the quarantined rows and the rows then stored."""
    stage = f"{store.rstrip('/')}/_staging/{version}-{uuid.uuid4().hex[:12]}"
    good: dict[str, DataFrame] = {}
    bad: dict[str, DataFrame] = {}
    for d, ds in DATASETS.items():
        load(raw[d], d).write.mode("errorifexists").parquet(f"{stage}/{d}")
        out = apply_policy(spark.read.parquet(f"{stage}/{d}"), mode, key=ds.key)
        good[d], bad[d] = out if isinstance(out, tuple) else (out.drop("errors"), None)
    for d, ds in DATASETS.items():
        dup = duplicate_identities(good[d], ds.key)
        examples = dup.limit(10).collect()  # at most ten rows reach the driver
        if examples:
            raise DuplicateIdentityError(f"{d}: {dup.count()} identity keys occur more than once, such as {[tuple(r) for r in examples]}")
    state = current_state(spark, store)
    tables = dict(state["tables"])
    counts = {}
    for d, ds in DATASETS.items():
        update = tuple(f.name for f in ds.fields if f.name not in ds.key) + ("hash",)
        tables[d] = merge_table(spark, store, d, tables.get(d), good[d], ds.key, update, version)
        counts[d] = {
            "loaded": good[d].count(), "quarantined": bad[d].count() if bad[d] is not None else 0,
            "stored": read_table(spark, store, d, tables[d]).count(),
        }
    switch(spark, store, state | {"tables": tables})
    return counts


def build_features(spark: SparkSession, tables, store: str, version: str, dataset_version: str = "v1",
                   cutoff_date: str | None = None) -> int:
    """Build, write, validate what was written against the labelled inspections of the source, publish."""
    plan = FeaturePlan(tables, cutoff_date)
    df = plan.features(dataset_version).withColumn("created_at", F.current_timestamp())
    entry = write_table(df, store, FEATURE_TABLE, version, ("inspection_id",))
    written = read_table(spark, store, FEATURE_TABLE, entry)
    row = feature_snapshot_checks(written).first()
    expected = FeaturePlan(tables, cutoff_date).labeled.count()
    problems = snapshot_problems(row, expected_count=expected)
    if problems:
        raise FeatureBuildError("; ".join(problems))
    state = current_state(spark, store)
    switch(spark, store, state | {"tables": state["tables"] | {FEATURE_TABLE: entry}})
    return int(row["row_count"])


def build_all(spark: SparkSession, tables, store: str, version: str, dataset_version: str = "v1") -> dict[str, int]:
    """Counts per feature set."""
    return {FEATURE_TABLE: build_features(spark, tables, store, version, dataset_version)}


def load_training_data(spark: SparkSession, store: str, dataset_version: str = "v1") -> DataFrame:
    """Rows of one dataset version from the current feature table (``ordered_training_data`` sorts them)."""
    df = read_current(spark, store, FEATURE_TABLE)
    if df is None:
        raise FileNotFoundError(f"no feature table under {store}")
    return df.where(F.col("dataset_version") == dataset_version)


def ordered_training_data(spark: SparkSession, store: str, dataset_version: str = "v1") -> DataFrame:
    """A9 in (date, id) order, for readers that need it; training does not."""
    return load_training_data(spark, store, dataset_version).orderBy("prediction_date", "inspection_id")


def train_run(spark: SparkSession, store: str, artifact_dir: str, dataset_version: str = "v1") -> M.TrainResult:
    """J1-J11 + A10 over the stored feature table."""
    return M.train(load_training_data(spark, store, dataset_version), artifact_dir)


__all__ = [
    "BadRowsError", "DuplicateIdentityError", "FeatureBuildError", "build_all", "build_features", "ingest_all",
    "load_training_data", "ordered_training_data", "train_run",
]
