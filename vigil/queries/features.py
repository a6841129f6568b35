"""2.G point-in-time feature queries."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.integrity import FEATURE_CHECKS, feature_snapshot_checks
from vigil.oracle import FEATURE_ORACLES as O
from vigil.oracle import FEATURE_SELECT, feature_oracle
from vigil.plans.features import FeaturePlan, compliance_action_events, inspection_product_types
from vigil.plans.incremental import refresh_features, site_prints
from vigil.registry import register
from vigil.session import set_aside
from vigil.sources.catalog import Catalog


UNTIL = "1996-06-30"  # cut-off date of the registered G20 query


def plan(spark: SparkSession, sf_dir: str) -> FeaturePlan:
    return FeaturePlan(Catalog(spark, sf_dir))


@register("normalized_inspections", O["normalized_inspections"])
def normalized_inspections(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).rows


@register("inspection_events", O["inspection_events"])
def inspection_events(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).events


@register("labeled_inspections", O["labeled_inspections"])
def labeled_inspections(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).labeled


@register("inspection_history", O["inspection_history"])
def inspection_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).inspection_history()


@register("inspection_product_types", O["inspection_product_types"])
def product_types(spark, sf_dir) -> DataFrame:
    return inspection_product_types(plan(spark, sf_dir).rows)


@register("product_history", O["product_history"])
def product_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).product_history()


@register("citation_history", O["citation_history"])
def citation_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).citation_history()


@register("cfr_history", O["cfr_history"])
def cfr_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).cfr_history()


@register("repeated_cfr", O["repeated_cfr"])
def repeated_cfr(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).repeated_cfr()


@register("published_483_history", O["published_483_history"])
def published_483_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).published_483_history()


@register("compliance_action_events", O["compliance_action_events"])
def action_events(spark, sf_dir) -> DataFrame:
    return compliance_action_events(Catalog(spark, sf_dir).compliance_actions)


@register("warning_letter_history", O["warning_letter_history"])
def warning_letter_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).warning_letter_history()


@register("recall_history", O["recall_history"])
def recall_history(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).recall_history()


@register("cold_start", O["cold_start"])
def cold_start(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).cold_start()


@register("per_inspection_rates", O["per_inspection_rates"])
def per_inspection_rates(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).per_inspection_rates()


@register("features", O["features"])
def features(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).features("v1")


# A8 as a refresh: the earlier build lacks the latest rows of every seventh site (by the first byte of the site's SHA-256)
# and all recalls of two more; the refresh over the whole tables must give the whole feature table.


def earlier_tables(tables) -> SimpleNamespace:
    byte = F.conv(F.substring(F.sha2(F.trim(F.col("fei_number").cast("string")), 256), 1, 2), 16, 10).cast("int")
    late = F.coalesce(byte % 7 == 0, F.lit(False))
    return SimpleNamespace(
        inspections=tables.inspections.where(~late | (F.col("inspection_id") % 3 > 0)), citations=tables.citations.where("inspection_id % 35 <> 0"),
        published483=tables.published483.where(~late | (F.col("record_id") % 2 == 0)), compliance_actions=tables.compliance_actions,
        recalls=tables.recalls.where(~F.coalesce(byte.isin(3, 4), F.lit(False))),
    )


@register("features_refreshed", O["features"])
def features_refreshed(spark, sf_dir) -> DataFrame:
    tables = Catalog(spark, sf_dir)
    earlier = earlier_tables(tables)
    stored, prints = set_aside(FeaturePlan(earlier, stepwise=True).features("v1")), site_prints(earlier)
    return refresh_features(tables, stored, prints, "v1").features


@register("features_exploratory", O["features_exploratory"])
def features_exploratory(spark, sf_dir) -> DataFrame:
    return plan(spark, sf_dir).features(variant="exploratory")


# F10 / G19 --------------------------------------------------------------------------------------------


def _checks_sql(rows: str) -> str:
    broken = ", ".join(f"count(*) FILTER (WHERE ({sql}) = false) AS ck_{name}" for name, sql in FEATURE_CHECKS)
    return (
        "SELECT count(*) AS row_count, count(DISTINCT inspection_id) AS inspection_count, "
        "count(*) - count(*) FILTER (WHERE target_classification IN ('NAI', 'VAI', 'OAI')) AS invalid_targets, "
        "count(*) FILTER (WHERE prior_inspection_count < 0) AS invalid_history, "
        "count(*) FILTER (WHERE prior_inspection_count = 0 AND (is_first_observed_inspection, previous_classification_adverse, "
        f"days_since_previous_inspection) IS DISTINCT FROM (1, 0, 0)) AS invalid_cold_start, {broken} FROM ({rows}) f"
    )


@register("feature_snapshot_checks", feature_oracle(_checks_sql(FEATURE_SELECT)))
def snapshot_checks(spark, sf_dir) -> DataFrame:
    return feature_snapshot_checks(plan(spark, sf_dir).features("v1"))


#: column -> what it becomes where inspection_id % 11 has the given remainder, so that every F10 rule has rows that
#: break it; ids divisible by 50 come a second time under another site (valid in Spark and DuckDB)
PLANTED = {
    "target_classification": (0, "'BAD'"), "prior_inspection_count": (1, "-1"), "is_first_observed_inspection": (2, "3"),
    "previous_classification_adverse": (3, "7"), "target_severity": (4, "9"), "target_adverse": (5, "NOT target_adverse"),
    "days_since_previous_inspection": (6, "5"),
}


def planted_sql(rows: str) -> str:
    cells = [f"CASE WHEN inspection_id % 11 = {r} THEN {bad} ELSE {c} END AS {c}" for c, (r, bad) in PLANTED.items()]
    columns = ", ".join(["inspection_id", "fei_number", *cells])
    again = columns.replace("fei_number", "concat(fei_number, '-2') AS fei_number", 1)
    return f"SELECT {columns} FROM {rows} f UNION ALL SELECT {again} FROM {rows} f WHERE inspection_id % 50 = 0"


@register("feature_snapshot_checks_planted", feature_oracle(_checks_sql(planted_sql(f"({FEATURE_SELECT})"))))
def snapshot_checks_planted(spark, sf_dir) -> DataFrame:
    """F10 over a snapshot into which every kind of fault was planted."""
    return feature_snapshot_checks(spark.sql(planted_sql("{snapshot}"), snapshot=plan(spark, sf_dir).features("v1")))


@register("features_until", feature_oracle(FEATURE_SELECT).replace("i.inspection_end_date IS NOT NULL", f"i.inspection_end_date <= DATE '{UNTIL}'"))
def features_until(spark, sf_dir) -> DataFrame:
    """The feature table of the rows up to a cut-off date."""
    return FeaturePlan(Catalog(spark, sf_dir), UNTIL).features("v1")


@register(
    "features_strict",
    feature_oracle("SELECT * REPLACE (CAST(round_even(prior_recall_event_count_per_inspection, 0) AS INTEGER) AS prior_recall_event_count_per_inspection) "
                   f"FROM ({FEATURE_SELECT}) f WHERE prior_inspection_count >= 1"),
)
def features_strict(spark, sf_dir) -> DataFrame:
    """The feature table with the options ``min_prior`` and ``strict_storage``."""
    return plan(spark, sf_dir).features("v1", min_prior=1, strict_storage=True)


@register(
    "feature_build_counts",
    feature_oracle(f"SELECT 'inspection_classification_v1' AS feature_set, count(*) AS row_count FROM ({FEATURE_SELECT}) f"),
)
def feature_build_counts(spark, sf_dir) -> DataFrame:
    """Rows produced per feature set by one build."""
    f = plan(spark, sf_dir).features("v1")
    return f.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("inspection_classification_v1").alias("feature_set"), "row_count")
