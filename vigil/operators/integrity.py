"""2.F integrity: duplicate identities, CHECK / NOT NULL / max-length rules, snapshot and training checks.

Every check is one distributed aggregation; only counts (and at most ``examples`` key rows) ever reach
the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# CHECK constraints of the stored tables (SQL text, valid in Spark and DuckDB).
CHECKS: dict[str, list[tuple[str, str]]] = {
    "inspections": [
        ("classification_code_valid", "classification_code IS NULL OR classification_code IN ('NAI', 'VAI', 'OAI')"),
    ],
    "compliance_actions": [
        ("action_type_valid", "action_type IN ('Warning Letter', 'Injunction', 'Seizure')"),
    ],
}

# NOT NULL columns of the stored tables.
NOT_NULL: dict[str, tuple[str, ...]] = {
    "inspections": ("inspection_id", "inspection_end_date", "project_area"),
    "inspections_citations": ("inspection_id", "legal_name", "inspection_end_date", "program_area", "act_cfr_number"),
    "compliance_actions": (
        "fei_number", "legal_name", "country_area", "product_type", "action_taken_date", "action_type",
        "case_injunction_id", "hash",
    ),
    "published483": ("record_date", "publish_date", "record_id"),
    "recalls": ("center_classification_date", "event_id", "product_id"),
}

# Maximum text lengths (String(n)) of the stored tables.
MAX_LENGTH: dict[str, dict[str, int]] = {
    "inspections": {
        "fei_number": 20, "legal_name": 500, "city": 255, "state": 255, "zip_code": 30, "country": 255,
        "classification": 255, "classification_code": 3, "project_area": 500, "product_type": 100, "hash": 64,
    },
    "inspections_citations": {
        "fei_number": 20, "legal_name": 500, "program_area": 100, "act_cfr_number": 255, "hash": 64,
    },
    "compliance_actions": {
        "fei_number": 20, "legal_name": 500, "state": 100, "country_area": 255, "product_type": 100,
        "action_type": 100, "case_injunction_id": 100, "hash": 64,
    },
    "published483": {"fei_number": 20, "legal_name": 500, "record_type": 20, "download": 100, "hash": 64},
    "recalls": {
        "fei_number": 20, "legal_name": 500, "product_type": 100, "product_classification": 100, "status": 100,
        "recalling_firm_city": 255, "recalling_firm_state": 255, "recalling_firm_country": 255,
        "event_classification": 100, "center": 20, "recall_details": 255, "hash": 64,
    },
}

# CHECK constraints of the feature table.
FEATURE_CHECKS: list[tuple[str, str]] = [
    ("target_classification_valid", "target_classification IN ('NAI', 'VAI', 'OAI')"),
    ("target_severity_range", "target_severity BETWEEN 0 AND 2"),
    ("prior_count_non_negative", "prior_inspection_count >= 0"),
    ("first_observed_flag", "is_first_observed_inspection IN (0, 1)"),
    ("previous_adverse_flag", "previous_classification_adverse IS NULL OR previous_classification_adverse IN (0, 1)"),
    (
        "target_consistency",
        "(target_classification = 'NAI' AND target_severity = 0 AND target_adverse = false) OR "
        "(target_classification = 'VAI' AND target_severity = 1 AND target_adverse = true) OR "
        "(target_classification = 'OAI' AND target_severity = 2 AND target_adverse = true)",
    ),
]


def duplicate_identities(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """F1/H4: identity groups holding more than one row (NULL keys are equal).

    Two steps, because identities are long texts and nearly all occur once: rows are counted per 64-bit hash of their key (eight
    bytes are shuffled, summed map-side), then only rows of repeated hashes are grouped by the key itself, so two keys of one hash
    stay apart. ``df`` is read twice, its key columns only."""
    # a struct's hash skips NULL fields; the flags keep (NULL, x) and (x, NULL) apart
    keyed = df.select(*keys, F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]).alias("__key"))
    again = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    suspects = keyed.join(again, "__key", "left_semi")
    return suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def rules_for(table: str, computed: tuple[str, ...] = ()) -> list[tuple[str, str, Column]]:
    """(kind, rule, violated) for one stored table; a NULL CHECK result is not a violation (SQL). Columns that are ``computed``
    hold what their rules ask for by construction: those rules cannot be broken and read nothing."""
    out = []
    for rule, sql in CHECKS.get(table, []):
        out.append(("check", rule, ~F.coalesce(F.expr(sql), F.lit(True))))
    for col in NOT_NULL.get(table, ()):
        out.append(("not_null", col, F.lit(False) if col in computed else F.col(col).isNull()))
    for col, n in MAX_LENGTH.get(table, {}).items():
        out.append(("max_length", f"{col}<={n}", F.lit(False) if col in computed else F.coalesce(F.length(col) > n, F.lit(False))))
    return out


def violation_table(tables: dict[str, DataFrame], kinds: tuple[str, ...] = ("check", "not_null", "max_length"), computed: tuple[str, ...] = ()) -> DataFrame:
    """One row per (table, kind, rule) with its violation count; one aggregate scan per table."""
    parts = []
    for name, df in tables.items():
        rules = [r for r in rules_for(name, computed) if r[0] in kinds]
        if not rules:
            continue
        counts = df.agg(*[F.count_if(v).alias(f"r{i}") for i, (_, _, v) in enumerate(rules)])
        stack = ", ".join(f"'{kind}', '{rule}', r{i}" for i, (kind, rule, _) in enumerate(rules))
        parts.append(
            counts.selectExpr(f"stack({len(rules)}, {stack}) AS (kind, rule, violations)").select(
                F.lit(name).alias("table_name"), "kind", "rule", "violations"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def feature_snapshot_checks(features: DataFrame) -> DataFrame:
    """one aggregate: rows, distinct inspections, illegal targets, negative history, bad cold starts."""
    prior = F.col("prior_inspection_count")
    cold_bad = (prior == 0) & (
        ~F.col("is_first_observed_inspection").eqNullSafe(F.lit(1))
        | ~F.col("previous_classification_adverse").eqNullSafe(F.lit(0))
        | ~F.col("days_since_previous_inspection").eqNullSafe(F.lit(0))
    )
    tc = F.col("target_classification")
    return features.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("inspection_id").alias("inspection_count"),
        F.count_if(~tc.isin("NAI", "VAI", "OAI") | tc.isNull()).alias("invalid_targets"),
        F.count_if(prior < 0).alias("invalid_history"),
        F.count_if(cold_bad).alias("invalid_cold_start"),
        *[F.count_if(~F.coalesce(F.expr(sql), F.lit(True))).alias(f"ck_{name}") for name, sql in FEATURE_CHECKS],
    )


#: measure of the one-row F10 result -> what it means when it is not zero
_MEANINGS = {
    "invalid_targets": "targets outside NAI, VAI, OAI",
    "invalid_history": "negative numbers of earlier inspections",
    "invalid_cold_start": "first inspections that carry values of an earlier one",
    **{f"ck_{name}": f"breaches of the {name} constraint" for name, _ in FEATURE_CHECKS},
}


def snapshot_problems(row, expected_count: int) -> list[str]:
    """The problems that the one-row F10 result shows (none: the snapshot is sound). ``expected_count`` is the number
    of labelled inspections at the source, counted apart from the snapshot."""
    found = row.asDict()
    found |= {"unexpected": found["row_count"] - expected_count, "repeated": found["row_count"] - found["inspection_count"]}
    meanings = {"unexpected": f"rows more than the source's {expected_count} inspections", "repeated": "rows that repeat an inspection", **_MEANINGS}
    return [f"{found[measure]} {meaning}" for measure, meaning in meanings.items() if found[measure]]
