"""2.H profiling queries over the canonical (adapter) tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators import profile as P
from vigil.operators.loaders import load
from vigil.operators.quantiles import exact_quantiles
from vigil.oracle import oracle
from vigil.oracle_clean import loader_sql
from vigil.registry import register
from vigil.sources.catalog import Catalog, raw_extract

TABLES = ("inspections", "inspections_citations", "compliance_actions", "published483", "recalls")

# Identity keys the profiling notebook checks per table.
PROFILE_KEYS = {
    "inspections": ("inspection_id", "project_area", "product_type", "additional_details"),
    "inspections_citations": ("inspection_id", "program_area", "act_cfr_number", "short_description", "long_description"),
    "compliance_actions": ("case_injunction_id", "fei_number", "product_type"),
    "published483": ("record_id", "fei_number"),
    "recalls": ("fei_number", "event_id", "product_id"),
}


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    cat = Catalog(spark, sf_dir)
    return {t: cat.table(t) for t in TABLES}


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


# H1 --------------------------------------------------------------------------------------------------

@register(
    "table_inventory",
    oracle(_union([f"SELECT '{t}' AS table_name, count(*) AS row_count, "
                   f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS column_count FROM {t}" for t in TABLES]),
           tables=TABLES),
)
def table_inventory(spark, sf_dir):
    return P.inventory(_tables(spark, sf_dir))


# H2 --------------------------------------------------------------------------------------------------

@register(
    "value_counts",
    oracle("SELECT classification_code AS value, count(*) AS row_count FROM inspections "
           "GROUP BY classification_code ORDER BY row_count DESC, value NULLS LAST LIMIT 20", tables=("inspections",)),
)
def value_counts(spark, sf_dir):
    return P.value_counts(Catalog(spark, sf_dir).inspections, "classification_code", 20)


@register(
    "value_counts_product_type",
    oracle("SELECT product_type AS value, count(*) AS row_count FROM inspections "
           "GROUP BY product_type ORDER BY row_count DESC, value NULLS LAST LIMIT 20", tables=("inspections",)),
)
def value_counts_product_type(spark, sf_dir):
    return P.value_counts(Catalog(spark, sf_dir).inspections, "product_type", 20)


# H3 --------------------------------------------------------------------------------------------------

_INSPECTION_COLS = ("inspection_id", "fei_number", "state", "country", "inspection_end_date", "classification_code",
                    "project_area", "product_type", "additional_details")


@register(
    "null_profile",
    oracle(_union([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
                   f"CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {c} IS NULL) / count(*) "
                   f"ELSE 'NaN'::DOUBLE END AS missing_rate FROM inspections" for c in _INSPECTION_COLS]),
           tables=("inspections",)),
)
def null_profile(spark, sf_dir):
    return P.null_profile(Catalog(spark, sf_dir).inspections)


# H4 --------------------------------------------------------------------------------------------------

def _dup_groups_sql() -> str:
    """Repeated keys per loaded table: rows less distinct keys cannot say how many keys repeat, so keys are counted."""
    ctes: dict[str, str] = {}
    parts = []
    for dataset, keys in PROFILE_KEYS.items():
        final, raw = loader_sql(dataset)
        ctes |= raw
        ctes[f"loaded_{dataset}"] = final
        key = "{" + ", ".join(f"'{k}': {k}" for k in keys) + "}"
        parts.append(f"SELECT '{dataset}' AS table_name, '{', '.join(keys)}' AS keys, "
                     f"(SELECT count(*) FROM (SELECT {key} AS k, count(*) AS n FROM loaded_{dataset} GROUP BY k) WHERE n > 1) AS duplicate_groups")
    return oracle(_union(parts), ctes, tables=TABLES)


@register("duplicate_groups", _dup_groups_sql())
def duplicate_groups(spark, sf_dir):
    """H4 over the tables as they are loaded, citations included."""
    catalog = Catalog(spark, sf_dir)
    return P.duplicate_groups({d: load(raw_extract(catalog, d), d, hashed=False) for d in PROFILE_KEYS}, PROFILE_KEYS)


# H5-H7 -----------------------------------------------------------------------------------------------

@register(
    "inspection_overview",
    oracle("SELECT count(*) AS raw_rows, count(DISTINCT inspection_id) AS distinct_inspections, "
           "count(DISTINCT fei_number) AS distinct_feis, "
           "count(*) FILTER (WHERE fei_number IS NULL OR trim(CAST(fei_number AS VARCHAR)) = '') AS rows_without_fei "
           "FROM inspections", tables=("inspections",)),
)
def inspection_overview(spark, sf_dir):
    i = Catalog(spark, sf_dir).inspections
    fei = F.col("fei_number")
    return i.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_distinct("inspection_id").alias("distinct_inspections"),
        F.count_distinct("fei_number").alias("distinct_feis"),
        F.count_if(fei.isNull() | (F.trim(fei.cast("string")) == "")).alias("rows_without_fei"),
    )


@register(
    "inspection_timeline",
    oracle("SELECT CAST(year(inspection_end_date) AS INTEGER) AS year, classification_code AS classification, "
           "count(*) AS row_count FROM inspections WHERE inspection_end_date IS NOT NULL AND classification_code IS NOT NULL "
           "GROUP BY 1, 2", tables=("inspections",)),
)
def inspection_timeline(spark, sf_dir):
    i = Catalog(spark, sf_dir).inspections
    return (
        i.where(F.col("inspection_end_date").isNotNull() & F.col("classification_code").isNotNull())
        .groupBy(F.year("inspection_end_date").alias("year"), F.col("classification_code").alias("classification"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


_PER_FEI_SQL = ("SELECT fei_number, count(DISTINCT inspection_id) AS inspection_count FROM inspections "
                "WHERE fei_number IS NOT NULL AND trim(CAST(fei_number AS VARCHAR)) <> '' GROUP BY fei_number")


def _per_fei(spark, sf_dir) -> DataFrame:
    i = Catalog(spark, sf_dir).inspections
    return (
        i.where(F.col("fei_number").isNotNull() & (F.trim(F.col("fei_number").cast("string")) != ""))
        .groupBy("fei_number")
        .agg(F.count_distinct("inspection_id").alias("inspection_count"))
    )


@register("inspections_per_fei", oracle(_PER_FEI_SQL, tables=("inspections",)))
def inspections_per_fei(spark, sf_dir):
    return _per_fei(spark, sf_dir)


@register(
    "inspections_per_fei_hist",
    oracle(f"SELECT least(inspection_count, 10) AS clipped_count, count(*) AS feis FROM ({_PER_FEI_SQL}) p GROUP BY 1",
           tables=("inspections",)),
)
def inspections_per_fei_hist(spark, sf_dir):
    p = _per_fei(spark, sf_dir)
    return p.groupBy(F.least("inspection_count", F.lit(10)).alias("clipped_count")).agg(F.count(F.lit(1)).alias("feis"))


def _describe_sql(source: str, col: str) -> str:
    return (f"SELECT count({col}) AS count, avg({col}) AS mean, stddev_samp({col}) AS std, CAST(min({col}) AS DOUBLE) AS min, "
            f"quantile_cont({col}, 0.25) AS p25, quantile_cont({col}, 0.5) AS p50, quantile_cont({col}, 0.75) AS p75, "
            f"CAST(max({col}) AS DOUBLE) AS max FROM ({source}) s")


@register("describe_numeric", oracle(_describe_sql(_PER_FEI_SQL, "CAST(inspection_count AS DOUBLE)"), tables=("inspections",)))
def describe_numeric(spark, sf_dir):
    """H8 over the inspections-per-site counts."""
    return P.describe(_per_fei(spark, sf_dir), "inspection_count")


# H9-H10 ----------------------------------------------------------------------------------------------

@register(
    "citation_linkage",
    oracle("SELECT count(*) AS citation_rows, count(*) FILTER (WHERE i.inspection_id IS NOT NULL) AS linked_rows, "
           "count(*) FILTER (WHERE i.inspection_id IS NULL) AS orphan_rows, "
           "count(DISTINCT c.inspection_id) AS distinct_cited_inspections, count(DISTINCT c.fei_number) AS distinct_cited_feis "
           "FROM inspections_citations c LEFT JOIN (SELECT DISTINCT inspection_id FROM inspections) i "
           "ON i.inspection_id = c.inspection_id", tables=("inspections", "inspections_citations")),
)
def citation_linkage(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    ids = cat.inspections.select(F.col("inspection_id").alias("linked_id")).distinct()
    c = cat.citations.join(ids, cat.citations["inspection_id"] == ids["linked_id"], "left")
    return c.agg(
        F.count(F.lit(1)).alias("citation_rows"),
        F.count_if(F.col("linked_id").isNotNull()).alias("linked_rows"),
        F.count_if(F.col("linked_id").isNull()).alias("orphan_rows"),
        F.count_distinct("inspection_id").alias("distinct_cited_inspections"),
        F.count_distinct("fei_number").alias("distinct_cited_feis"),
    )


_CIT_PER_SQL = ("SELECT inspection_id, count(*) AS citation_count, count(DISTINCT act_cfr_number) AS distinct_cfr_count "
                "FROM inspections_citations GROUP BY inspection_id")


def _cit_per(spark, sf_dir) -> DataFrame:
    return Catalog(spark, sf_dir).citations.groupBy("inspection_id").agg(
        F.count(F.lit(1)).alias("citation_count"), F.count_distinct("act_cfr_number").alias("distinct_cfr_count")
    )


@register("citations_per_inspection", oracle(_CIT_PER_SQL, tables=("inspections_citations",)))
def citations_per_inspection(spark, sf_dir):
    return _cit_per(spark, sf_dir)


@register(
    "citations_hist",
    oracle(f"WITH p AS ({_CIT_PER_SQL}), lim AS (SELECT greatest(1, CAST(floor(quantile_cont(citation_count, 0.99)) AS BIGINT)) AS cap FROM p) "
           "SELECT least(p.citation_count, lim.cap) AS clipped_count, count(*) AS inspections FROM p, lim GROUP BY 1",
           tables=("inspections_citations",)),
)
def citations_hist(spark, sf_dir):
    """Citation counts clipped at max(1, int(p99)); the cap is a scalar subquery (one value)."""
    p = _cit_per(spark, sf_dir)
    p99 = exact_quantiles(p, "citation_count", [0.99]).select(F.col("quantiles")[0])
    cap = F.greatest(F.lit(1).cast("long"), F.floor(p99.scalar()).cast("long"))
    return p.groupBy(F.least("citation_count", cap).alias("clipped_count")).agg(F.count(F.lit(1)).alias("inspections"))


# H11-H13 ---------------------------------------------------------------------------------------------

@register(
    "action_timeline",
    oracle("SELECT CAST(year(action_taken_date) AS INTEGER) AS year, action_type, count(*) AS row_count "
           "FROM compliance_actions WHERE action_taken_date IS NOT NULL GROUP BY 1, 2", tables=("compliance_actions",)),
)
def action_timeline(spark, sf_dir):
    a = Catalog(spark, sf_dir).compliance_actions
    return a.where(F.col("action_taken_date").isNotNull()).groupBy(
        F.year("action_taken_date").alias("year"), "action_type"
    ).agg(F.count(F.lit(1)).alias("row_count"))


@register(
    "recall_timeline",
    oracle("SELECT CAST(year(center_classification_date) AS INTEGER) AS year, count(DISTINCT event_id) AS recall_events, "
           "count(*) AS product_rows FROM recalls WHERE center_classification_date IS NOT NULL GROUP BY 1",
           tables=("recalls",)),
)
def recall_timeline(spark, sf_dir):
    r = Catalog(spark, sf_dir).recalls
    return r.where(F.col("center_classification_date").isNotNull()).groupBy(
        F.year("center_classification_date").alias("year")
    ).agg(F.count_distinct("event_id").alias("recall_events"), F.count(F.lit(1)).alias("product_rows"))


_LAG_SQL = ("SELECT CAST(datediff('day', record_date, publish_date) AS DOUBLE) AS publication_lag_days FROM published483 "
            "WHERE record_date IS NOT NULL AND publish_date IS NOT NULL")


@register("publication_lag", oracle(_describe_sql(_LAG_SQL, "publication_lag_days"), tables=("published483",)))
def publication_lag(spark, sf_dir):
    p = Catalog(spark, sf_dir).published483
    lag = p.where(F.col("record_date").isNotNull() & F.col("publish_date").isNotNull()).select(
        F.datediff("publish_date", "record_date").alias("publication_lag_days")
    )
    return P.describe(lag, "publication_lag_days")


# H14-H15 ---------------------------------------------------------------------------------------------

_SITES_SQL = _union([
    f"SELECT DISTINCT '{t}' AS table_name, trim(CAST(fei_number AS VARCHAR)) AS fei_number FROM {t} "
    f"WHERE fei_number IS NOT NULL AND trim(CAST(fei_number AS VARCHAR)) <> ''" for t in TABLES
])


@register("fei_coverage", oracle(f"SELECT table_name, count(*) AS distinct_feis FROM ({_SITES_SQL}) s GROUP BY table_name", tables=TABLES))
def fei_coverage(spark, sf_dir):
    return P.fei_coverage(_tables(spark, sf_dir))


@register(
    "fei_overlap",
    oracle(f"WITH s AS ({_SITES_SQL}), names AS (SELECT DISTINCT table_name FROM s) "
           "SELECT a.table_name AS left_table, b.table_name AS right_table, "
           "(SELECT count(*) FROM s x JOIN s y ON x.fei_number = y.fei_number "
           " WHERE x.table_name = a.table_name AND y.table_name = b.table_name) AS shared_feis "
           "FROM names a, names b", tables=TABLES),
)
def fei_overlap(spark, sf_dir):
    return P.fei_overlap(_tables(spark, sf_dir))


# H16-H17 ---------------------------------------------------------------------------------------------

# every visit beside all visits of its site that come before it by (day, id)
_COHORT_SQL = """
WITH coded AS (
  SELECT inspection_id AS id, trim(CAST(fei_number AS VARCHAR)) AS site, inspection_end_date AS day,
         list_position(['NAI', 'VAI', 'OAI'], upper(CAST(classification_code AS VARCHAR))) - 1 AS level
  FROM inspections
), visit AS (
  SELECT id, site, min(day) AS day, max(level) AS level FROM coded
  WHERE level IS NOT NULL AND day IS NOT NULL AND site <> '' GROUP BY id, site
), beside AS (
  SELECT v.id, v.site, v.day, v.level, count(p.id) AS n, count(*) FILTER (WHERE p.level = 0) AS n0, count(*) FILTER (WHERE p.level = 1) AS n1, count(*) FILTER (WHERE p.level = 2) AS n2,
         max({'day': p.day, 'id': p.id, 'level': p.level}) FILTER (WHERE p.id IS NOT NULL) AS latest
  FROM visit v LEFT JOIN visit p ON p.site = v.site AND (p.day < v.day OR (p.day = v.day AND p.id < v.id))
  GROUP BY v.id, v.site, v.day, v.level
)
SELECT id AS inspection_id, site AS fei_number, day AS prediction_date, ['NAI', 'VAI', 'OAI'][level + 1] AS target_classification,
       level AS target_severity, level > 0 AS target_adverse, n AS prior_inspection_count, CAST(day - latest.day AS INTEGER) AS days_since_previous_inspection,
       ['NAI', 'VAI', 'OAI'][latest.level + 1] AS previous_classification, CAST(n = 0 AS SMALLINT) AS is_first_observed_inspection,
       n0 AS prior_nai_count, n1 AS prior_vai_count, n2 AS prior_oai_count, CASE WHEN n > 0 THEN CAST(n1 + n2 AS DOUBLE) / n END AS prior_adverse_rate
FROM beside"""


@register("inspection_cohort", oracle(_COHORT_SQL, tables=("inspections",)))
def inspection_cohort(spark, sf_dir):
    return P.inspection_cohort(Catalog(spark, sf_dir).inspections)


@register(
    "target_distribution",
    oracle(f"SELECT target_classification AS classification, count(*) AS count, "
           f"count(*) / sum(count(*)) OVER () AS rate FROM ({_COHORT_SQL}) c GROUP BY 1", tables=("inspections",)),
)
def target_distribution(spark, sf_dir):
    return P.target_distribution(P.inspection_cohort(Catalog(spark, sf_dir).inspections))


@register(
    "cohort_date_range",
    oracle(f"SELECT min(prediction_date) AS first_date, max(prediction_date) AS last_date FROM ({_COHORT_SQL}) c",
           tables=("inspections",)),
)
def cohort_date_range(spark, sf_dir):
    return P.cohort_date_range(P.inspection_cohort(Catalog(spark, sf_dir).inspections))
