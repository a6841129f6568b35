"""2.J training, scoring, evaluation and interpretation of the adverse-outcome model (Spark ML).

Pipeline: constant imputation (0 / ``UNKNOWN``) -> sorted one-hot of ``state`` with the first level
dropped and unknown levels all-zero -> VectorAssembler (no scaling) -> L2 logistic regression whose
objective equals ``C * sum(logloss) + ||w||^2 / 2`` (``regParam = 1 / (C * n_train)``).
Evaluation figures are exact aggregates (rank-sum AUC with ties averaged, step-wise average precision),
computed with distributed running sums, never on the driver.
"""

from __future__ import annotations

import json
import math
import os
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions.ordered import running_sums
from vigil.session import set_aside

# Model inputs (order matters for the coefficient vector).
IDENTIFIER_COLUMNS = ("inspection_id", "fei_number", "prediction_date")
CONTINUOUS_FEATURES = (
    "prior_inspection_count",
    "days_since_previous_inspection",
    "historical_product_type_count",
    "prior_citation_count",
    "previous_inspection_citation_count",
    "prior_citations_per_inspection",
    "repeated_cfr_count",
    "prior_published_483_count_per_inspection",
    "prior_warning_letter_count_per_inspection",
    "prior_recall_event_count_per_inspection",
)
BINARY_FEATURES = (
    "is_first_observed_inspection",
    "previous_classification_adverse",
    "has_prior_product_food",
    "has_prior_product_drug",
    "has_prior_product_device",
    "has_prior_product_biologic",
    "has_prior_product_veterinary",
    "has_prior_product_tobacco",
    "has_prior_product_other",
)
CATEGORICAL_FEATURES = ("state",)
FEATURE_COLUMNS = CONTINUOUS_FEATURES + BINARY_FEATURES + CATEGORICAL_FEATURES
TARGET_COLUMN = "target_adverse"
UNKNOWN = "UNKNOWN"

# Model settings.
C = 0.1
MAX_ITER = 500
THRESHOLD = 0.5
TEST_FRACTION_START = 0.8
MIN_DATES = 10
MAX_LEVELS = 10_000  # levels of the categorical input that a fit accepts


class TrainingDataError(ValueError):
    pass


# ------------------------------------------------------------------------------------------- F11 / J1


def training_data_checks(data: DataFrame) -> DataFrame:
    """required columns (plan time) + one aggregate of row-level problems."""
    required = set(IDENTIFIER_COLUMNS) | {TARGET_COLUMN} | set(FEATURE_COLUMNS)
    missing = sorted(required - set(data.columns))
    if missing:
        raise TrainingDataError(f"columns that training needs are not there: {missing}")
    y = F.col(TARGET_COLUMN).cast("int")
    return data.agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.count(F.lit(1)) - F.count_distinct("inspection_id")).alias("duplicate_ids"),
        F.count_if(F.col("prediction_date").isNull()).alias("null_dates"),
        F.count_if(F.col(TARGET_COLUMN).isNull()).alias("null_targets"),
        F.count_if(y == 0).alias("negatives"),
        F.count_if(y == 1).alias("positives"),
        F.count_if(~y.isin(0, 1)).alias("other_targets"),
    )


def validate_training_data(data: DataFrame) -> None:
    r = training_data_checks(data).first()
    if r["row_count"] == 0:
        raise TrainingDataError("no rows to train on")
    if r["duplicate_ids"]:
        ex = [x[0] for x in data.groupBy("inspection_id").count().where("count > 1").select("inspection_id").limit(10).collect()]
        raise TrainingDataError(f"{r['duplicate_ids']} rows repeat an inspection, such as {ex}")
    if r["null_dates"]:
        raise TrainingDataError(f"{r['null_dates']} rows have no prediction date")
    if r["null_targets"]:
        raise TrainingDataError(f"{r['null_targets']} rows have no target")
    if r["other_targets"] or not r["negatives"] or not r["positives"]:
        raise TrainingDataError("targets must be 0 and 1, and both must occur")


def test_start_date(data: DataFrame) -> Column:
    """J1 boundary as a scalar subquery: sorted distinct dates, index clamp(int(n * 0.8), 1, n - 1).

    The ranking window runs over *distinct dates* only (one row per calendar day)."""
    dates = data.select("prediction_date").distinct()
    n = dates.agg(F.count(F.lit(1))).scalar()
    idx = F.greatest(F.lit(1), F.least(F.floor(n * F.lit(TEST_FRACTION_START)).cast("long"), n - 1))
    ranked = dates.withColumn("i", F.row_number().over(Window.orderBy("prediction_date")) - 1)
    return ranked.where(F.col("i") == idx).agg(F.max("prediction_date")).scalar()


def temporal_split(data: DataFrame) -> DataFrame:
    """``split`` = train (date < boundary) or test (date >= boundary)."""
    start = test_start_date(data)
    return data.withColumn("split", F.when(F.col("prediction_date") < start, "train").otherwise("test"))


def check_split(split: DataFrame) -> None:
    dates = split.agg(F.count_distinct("prediction_date").alias("n")).first()["n"]
    if dates < MIN_DATES:
        raise TrainingDataError(f"a split by date needs {MIN_DATES} dates, there are {dates}")
    y = F.col(TARGET_COLUMN).cast("int")
    r = split.groupBy("split").agg(F.count_if(y == 0).alias("neg"), F.count_if(y == 1).alias("pos")).collect()
    seen = {row["split"]: row for row in r}  # at most two rows
    for name in ("train", "test"):
        row = seen.get(name)
        if row is None:
            raise TrainingDataError(f"the {name} part has no rows")
        if not row["neg"] or not row["pos"]:
            raise TrainingDataError(f"the {name} part has one target class only")


# -------------------------------------------------------------------------------------------- J2-J5


def impute(data: DataFrame) -> DataFrame:
    """0 for continuous and binary inputs, ``UNKNOWN`` for the categorical one."""
    fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in CONTINUOUS_FEATURES + BINARY_FEATURES}
    fills.update({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in CATEGORICAL_FEATURES})
    return data.withColumns(fills)


def build_pipeline(n_levels: int, n_train: int) -> Pipeline:
    """J3-J5. ``n_levels`` = distinct state levels in the training rows (after imputation)."""
    idx = StringIndexer(inputCol="state", outputCol="state_idx", stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=["state_idx"], outputCols=["state_ohe"], dropLast=True)  # drops the unseen bucket
    stages = [idx, ohe]
    cat_cols = []
    if n_levels > 1:
        stages.append(VectorSlicer(inputCol="state_ohe", outputCol="state_vec", indices=list(range(1, n_levels))))
        cat_cols = ["state_vec"]
    stages.append(VectorAssembler(inputCols=list(CONTINUOUS_FEATURES + BINARY_FEATURES) + cat_cols, outputCol="features"))
    stages.append(
        LogisticRegression(
            featuresCol="features",
            labelCol="label",
            regParam=1.0 / (C * n_train),
            elasticNetParam=0.0,
            standardization=False,
            fitIntercept=True,
            maxIter=MAX_ITER,
            tol=1e-10,
        )
    )
    return Pipeline(stages=stages)


def one_hot_index(model: PipelineModel, data: DataFrame) -> DataFrame:
    """J3 in long form: position of the single 1 in the state block, NULL when the row is all zeros
    (first level, or a level unseen in training)."""
    out = model.transform(data)
    if "state_vec" not in out.columns:
        return out.select("inspection_id", F.lit(None).cast("int").alias("encoded_index"))
    pos = F.array_position(vector_to_array("state_vec"), 1.0)
    return out.select("inspection_id", F.when(pos > 0, (pos - 1).cast("int")).alias("encoded_index"))


@dataclass
class TrainResult:
    model: PipelineModel
    test_start: object
    n_train: int
    n_test: int
    levels: list[str]
    iterations: int
    converged: bool
    metrics: dict


def fit(data: DataFrame, validate: bool = True) -> tuple[PipelineModel, DataFrame, list[str], int]:
    """Temporal split + fit on the training rows. Returns (model, split frame, state levels, n_train)."""
    # the rows feed the checks and, three times, the split: built once, and their shuffle files are gone before the next job
    data = set_aside(data, "training")
    if validate:
        validate_training_data(data)
    # the split frame feeds several actions and every optimiser iteration: cut its lineage once
    split = set_aside(impute(temporal_split(data)).withColumn("label", F.col(TARGET_COLUMN).cast("double")))
    if validate:
        check_split(split)
    train = split.where(F.col("split") == "train")
    levels = sorted(r[0] for r in train.select("state").distinct().limit(MAX_LEVELS + 1).collect())
    if len(levels) > MAX_LEVELS:  # free text would make one coefficient per spelling
        raise TrainingDataError(f"state has more than {MAX_LEVELS} levels")
    n_train = train.count()
    model = build_pipeline(len(levels), n_train).fit(train)
    return model, split, levels, n_train


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """P(class 1) per row."""
    return model.transform(rows).select(
        "inspection_id", "prediction_date", F.col(TARGET_COLUMN).cast("int").alias("target"),
        vector_to_array("probability")[1].alias("score"),
    )


# ------------------------------------------------------------------------------------------- J7-J11


def confusion_matrix(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    p = F.col("score") >= threshold
    y = F.col("target") == 1
    return scored.agg(
        F.count_if(~y & ~p).alias("true_negative"),
        F.count_if(~y & p).alias("false_positive"),
        F.count_if(y & ~p).alias("false_negative"),
        F.count_if(y & p).alias("true_positive"),
    )


def classification_metrics(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 on zero division), threshold, adverse rate."""
    cm = scored.agg(
        F.count_if((F.col("target") == 0) & (F.col("score") < threshold)).alias("tn"),
        F.count_if((F.col("target") == 0) & (F.col("score") >= threshold)).alias("fp"),
        F.count_if((F.col("target") == 1) & (F.col("score") < threshold)).alias("fn"),
        F.count_if((F.col("target") == 1) & (F.col("score") >= threshold)).alias("tp"),
        F.avg(F.col("target").cast("double")).alias("test_adverse_rate"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    return cm.select(
        ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        F.lit(float(threshold)).alias("threshold"),
        "test_adverse_rate",
    )


def _score_table(scored: DataFrame) -> DataFrame:
    """Per distinct score: positives, negatives, and running totals below it (exact, distributed)."""
    g = scored.groupBy("score").agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")
    )
    return running_sums(g, "score", ["pos", "neg"], inclusive=False, prefix="below_")


def roc_auc(scored: DataFrame) -> DataFrame:
    """Rank-sum AUC, ties counted one half: sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)."""
    t = _score_table(scored)
    return t.agg(
        (F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2.0)) / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("roc_auc")
    )


def average_precision(scored: DataFrame) -> DataFrame:
    """Step-wise AP = sum over distinct thresholds (descending) of (R_i - R_{i-1}) * P_i
    = sum_s pos_s * precision_s / P, with TP/FP counted over scores >= s (a descending running sum)."""
    g = scored.groupBy("score").agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")
    ).withColumn("neg_score", -F.col("score"))
    t = running_sums(g, "neg_score", ["pos", "neg"], inclusive=True, prefix="at_or_above_")
    tp, fp = F.col("at_or_above_pos"), F.col("at_or_above_neg")
    return t.agg((F.sum(F.col("pos") * (tp / (tp + fp))) / F.sum("pos")).alias("average_precision"))


def brier_score(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col("score") - F.col("target"), 2)).alias("brier_score"))


def evaluate(scored: DataFrame, threshold: float = THRESHOLD) -> dict:
    """All J7-J11 figures as one dict (each is a one-row aggregate)."""
    out = {}
    for df in (confusion_matrix(scored, threshold), classification_metrics(scored, threshold), roc_auc(scored),
               average_precision(scored), brier_score(scored)):
        out.update(df.first().asDict())
    return out


# ------------------------------------------------------------------------------------------ J12-J13


STATE_PREFIX = "state_"
HIGHER, LOWER, SAME = "Higher adverse odds", "Lower adverse odds", "No estimated change"  # fixed values
TOP = 15  # length of the strongest-association lists


def feature_names(levels: list[str]) -> list[str]:
    """Names of the coefficients: inputs, then one per state but the first, which is the baseline."""
    return [*CONTINUOUS_FEATURES, *BINARY_FEATURES, *[STATE_PREFIX + level for level in levels[1:]]]


def coefficient_rows(model: PipelineModel, levels: list[str]) -> DataFrame:
    """(transformed_feature, coefficient) of a fitted pipeline; one row per coefficient."""
    values = model.stages[-1].coefficients.toArray().tolist()
    named = list(zip(feature_names(levels), values, strict=True))
    return SparkSession.getActiveSession().createDataFrame(named, "transformed_feature string, coefficient double")


def odds_ratio_table(coefficients: DataFrame) -> DataFrame:
    """(transformed_feature, coefficient) with a readable name, odds ratio, change in odds and direction."""
    name, b = F.col("transformed_feature"), F.col("coefficient")
    state = name.startswith(STATE_PREFIX)
    label = F.when(state, F.concat(F.lit("State: "), F.substr(name, F.lit(len(STATE_PREFIX) + 1)))).otherwise(F.initcap(F.replace(name, F.lit("_"), F.lit(" "))))
    way = F.when(b > 0, HIGHER).when(b < 0, LOWER).otherwise(SAME)
    return coefficients.select(
        name, label.alias("feature"), b, F.exp(b).alias("odds_ratio"), (100 * F.expm1(b)).alias("odds_change_percent"),
        way.alias("direction"), F.abs(b).alias("absolute_coefficient"),
    )


def coefficient_table(model: PipelineModel, levels: list[str]) -> DataFrame:
    """J12 of a fitted pipeline."""
    return odds_ratio_table(coefficient_rows(model, levels))


def top_associations(table: DataFrame, top: int = TOP) -> DataFrame:
    """The strongest positive and the strongest negative associations, ranked (a top-k report)."""
    parts = []
    for side, best in (("positive", F.desc("coefficient")), ("negative", F.asc("coefficient"))):
        strongest = table.where(F.col("coefficient") > 0 if side == "positive" else F.col("coefficient") < 0).orderBy(best, "transformed_feature").limit(top)
        rank = F.row_number().over(Window.orderBy(best, "transformed_feature"))  # ``top`` rows at most
        parts.append(strongest.select(F.lit(side).alias("side"), rank.alias("rank"), *table.columns))
    return parts[0].unionByName(parts[1])


def state_odds(table: DataFrame, baseline: Column) -> DataFrame:
    """The states, with the baseline state as a row of odds ratio 1."""
    states = table.where(F.col("transformed_feature").startswith(STATE_PREFIX))
    rows = states.select(F.substr("feature", F.lit(len("State: ") + 1)).alias("state"), "coefficient", "odds_ratio", "odds_change_percent", "direction", F.lit(False).alias("is_baseline"))
    base = table.sparkSession.range(1).select(baseline.alias("state"), F.lit(0.0).alias("coefficient"), F.lit(1.0).alias("odds_ratio"),
                                              F.lit(0.0).alias("odds_change_percent"), F.lit("Baseline").alias("direction"), F.lit(True).alias("is_baseline"))
    return rows.unionByName(base)


def product_odds(table: DataFrame) -> DataFrame:
    """The product-history indicators."""
    return table.where(F.col("transformed_feature").startswith("has_prior_product_"))


def continuous_odds(table: DataFrame) -> DataFrame:
    """The counts and rates."""
    return table.where(F.col("transformed_feature").isin(*CONTINUOUS_FEATURES))


def loss_gradient(model: PipelineModel, train: DataFrame, n_train: int) -> DataFrame:
    """Largest absolute component of the fitted objective's gradient, per training row (0 at the optimum).

    Objective: mean log-loss + ||w||^2 / (2 C n). One pass over the training rows; the driver gets one vector of
    as many numbers as there are coefficients."""
    lr = model.stages[-1]
    scored = model.transform(train).select(vector_to_array("features").alias("x"), (vector_to_array("probability")[1] - F.col("label")).alias("r"))
    long = scored.select(F.posexplode("x").alias("i", "v"), "r").groupBy("i").agg((F.sum(F.col("v") * F.col("r")) / n_train).alias("g"))
    weights = train.sparkSession.createDataFrame(list(enumerate(lr.coefficients.toArray().tolist())), "i int, w double")
    slope = long.join(F.broadcast(weights), "i").select(F.abs(F.col("g") + F.col("w") / (C * n_train)).alias("g"))
    bias = scored.agg(F.abs(F.avg("r")).alias("g"))
    return slope.unionByName(bias).agg(F.max("g").alias("largest_gradient"))


def reference_levels(data: DataFrame) -> DataFrame:
    """Per categorical input (after imputation): the baseline (first in order) and the number of levels."""
    known = {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in CATEGORICAL_FEATURES}
    per_input = [F.struct(F.lit(c).alias("feature"), F.min(v).alias("reference_level"), F.count_distinct(v).alias("level_count")) for c, v in known.items()]
    return data.agg(F.array(*per_input).alias("levels")).select(F.inline("levels"))


# ----------------------------------------------------------------------------------------------- A10


def train(data: DataFrame, artifact_dir: str | None = None) -> TrainResult:
    """J1-J11 end to end; optionally saves the PipelineModel plus metadata/metrics JSON (A10)."""
    model, split, levels, n_train = fit(data)
    test = split.where(F.col("split") == "test")
    scored = score(model, test)
    metrics = evaluate(scored)
    lr_summary = model.stages[-1].summary
    iterations = int(lr_summary.totalIterations)
    start = split.where(F.col("split") == "test").agg(F.min("prediction_date")).first()[0]
    result = TrainResult(model, start, n_train, test.count(), levels, iterations, iterations < MAX_ITER, metrics)
    if artifact_dir:
        model.write().overwrite().save(os.path.join(artifact_dir, "pipeline"))
        meta = {
            "test_start_date": str(start), "n_train": n_train, "n_test": result.n_test, "levels": levels,
            "iterations": iterations, "converged": result.converged, "C": C, "max_iter": MAX_ITER,
            "threshold": THRESHOLD, "features": list(FEATURE_COLUMNS),
        }
        spark = data.sparkSession
        spark.createDataFrame([(json.dumps(meta), json.dumps(_jsonable(metrics)))], "metadata string, metrics string") \
            .coalesce(1).write.mode("overwrite").json(os.path.join(artifact_dir, "metadata"))
    return result


def _jsonable(d: dict) -> dict:
    return {k: (None if isinstance(v, float) and math.isnan(v) else v) for k, v in d.items()}
