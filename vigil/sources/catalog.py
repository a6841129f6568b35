"""Catalog: driver parquet tables and the canonical tables derived from them, per session + folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import bound_tasks, spread_shuffles, stored_bytes
from vigil.sources.adapter import ADAPTER_SQL, RAW_EXTRACTS, driver_tables_in, spark_template


class Catalog:
    """Lazily built DataFrames over one scale-factor folder.

    Nothing is materialised here: every accessor returns a logical plan, so each query only scans the
    columns and row groups it needs. Re-requesting a table returns the same DataFrame object so plans
    that use a table twice share one subtree (and ReuseExchange can dedupe the shuffles).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        bound_tasks(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self._read = 0  # bytes of the driver tables opened so far

    def driver(self, name: str) -> DataFrame:
        key = "driver:" + name
        if key not in self._cache:
            path = f"{self.sf_dir}/{name}.parquet"
            self._cache[key] = self.spark.read.parquet(path)
            self._read += stored_bytes(self.spark, path)
            spread_shuffles(self.spark, self._read)
        return self._cache[key]

    def table(self, name: str) -> DataFrame:
        """Canonical table (inspections, inspections_citations, published483, compliance_actions, recalls, raw_cells)."""
        if name not in self._cache:
            sql = ADAPTER_SQL[name]
            params = {t: self.driver(t) for t in driver_tables_in(sql)}
            self._cache[name] = self.spark.sql(spark_template(sql), **params)
        return self._cache[name]

    # convenience accessors
    @property
    def inspections(self) -> DataFrame:
        return self.table("inspections")

    @property
    def citations(self) -> DataFrame:
        return self.table("inspections_citations")

    @property
    def published483(self) -> DataFrame:
        return self.table("published483")

    @property
    def compliance_actions(self) -> DataFrame:
        return self.table("compliance_actions")

    @property
    def recalls(self) -> DataFrame:
        return self.table("recalls")

    @property
    def raw_cells(self) -> DataFrame:
        return self.table("raw_cells")


def raw_extract(catalog: Catalog, dataset: str) -> DataFrame:
    """The untyped spreadsheet form of one canonical table (test fixture for the 2.C loaders)."""
    base, cells = RAW_EXTRACTS[dataset]
    return catalog.table(base).select(*[F.expr(expr).alias(header) for header, expr in cells])
