"""2.J model queries: split, imputation, encoding, checks, deterministic-score metrics, fitted model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorSlicer
from pyspark.sql import functions as F

from vigil.operators import model as M
from vigil.oracle import FEATURE_SELECT, feature_oracle, oracle
from vigil.plans.features import FeaturePlan
from vigil.registry import register
from vigil.sources.catalog import Catalog


def _features(spark, sf_dir, stepwise: bool = False):
    return FeaturePlan(Catalog(spark, sf_dir), stepwise=stepwise).features("v1")


def _labels(spark, sf_dir):
    """The rows of the feature table with the columns that split, encoding and metrics read; no history is built."""
    rows = FeaturePlan(Catalog(spark, sf_dir)).labeled
    return rows.select("inspection_id", "prediction_date", "state", F.col("adverse_classification").alias("target_adverse"))


_SPLIT_CTES = f"""WITH f AS ({FEATURE_SELECT}),
d AS (SELECT DISTINCT prediction_date FROM f),
r AS (SELECT prediction_date, row_number() OVER (ORDER BY prediction_date) - 1 AS i FROM d),
n AS (SELECT count(*) AS n FROM d),
b AS (SELECT max(r.prediction_date) AS start FROM r, n
      WHERE r.i = greatest(1, least(CAST(floor(n.n * CAST(0.8 AS DOUBLE)) AS BIGINT), n.n - 1))),
s AS (SELECT f.*, CASE WHEN f.prediction_date < b.start THEN 'train' ELSE 'test' END AS split FROM f, b)"""


@register("temporal_split", feature_oracle(_SPLIT_CTES + " SELECT inspection_id, prediction_date, split FROM s"))
def temporal_split(spark, sf_dir):
    return M.temporal_split(_labels(spark, sf_dir)).select("inspection_id", "prediction_date", "split")


_IMPUTED = ", ".join(
    [f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in M.CONTINUOUS_FEATURES + M.BINARY_FEATURES]
    + [f"COALESCE({c}, 'UNKNOWN') AS {c}" for c in M.CATEGORICAL_FEATURES]
)


@register("impute_features", feature_oracle(f"SELECT inspection_id, {_IMPUTED} FROM ({FEATURE_SELECT}) f"))
def impute_features(spark, sf_dir):
    return M.impute(_features(spark, sf_dir)).select("inspection_id", *M.FEATURE_COLUMNS)


@register(
    "one_hot_state",
    feature_oracle(_SPLIT_CTES + """,
tr AS (SELECT DISTINCT COALESCE(state, 'UNKNOWN') AS lvl FROM s WHERE split = 'train'),
lv AS (SELECT lvl, row_number() OVER (ORDER BY lvl) - 1 AS k FROM tr)
SELECT s.inspection_id, CASE WHEN lv.k >= 1 THEN CAST(lv.k - 1 AS INTEGER) END AS encoded_index
FROM s LEFT JOIN lv ON lv.lvl = COALESCE(s.state, 'UNKNOWN')"""),
)
def one_hot_state(spark, sf_dir):
    """Sorted state levels fitted on the training split, first dropped, unseen -> all zeros."""
    split = M.temporal_split(_labels(spark, sf_dir)).withColumn("state", F.coalesce("state", F.lit(M.UNKNOWN)))
    train = split.where(F.col("split") == "train")
    n_levels = train.agg(F.count_distinct("state")).first()[0]
    stages = [
        StringIndexer(inputCol="state", outputCol="state_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=["state_idx"], outputCols=["state_ohe"], dropLast=True),
    ]
    if n_levels > 1:
        stages.append(VectorSlicer(inputCol="state_ohe", outputCol="state_vec", indices=list(range(1, n_levels))))
    enc = Pipeline(stages=stages).fit(train)
    return M.one_hot_index(enc, split)


@register(
    "reference_levels",
    feature_oracle(_SPLIT_CTES + " SELECT 'state' AS feature, min(COALESCE(state, 'UNKNOWN')) AS reference_level, "
                   "count(DISTINCT COALESCE(state, 'UNKNOWN')) AS level_count FROM s WHERE split = 'train'"),
)
def reference_levels(spark, sf_dir):
    """J13 on the training split (the rows the encoder is fitted on)."""
    split = M.temporal_split(_labels(spark, sf_dir))
    return M.reference_levels(split.where(F.col("split") == "train"))


@register(
    "training_data_checks",
    feature_oracle(f"SELECT count(*) AS row_count, count(*) - count(DISTINCT inspection_id) AS duplicate_ids, "
                   f"count(*) FILTER (WHERE prediction_date IS NULL) AS null_dates, "
                   f"count(*) FILTER (WHERE target_adverse IS NULL) AS null_targets, "
                   f"count(*) FILTER (WHERE CAST(target_adverse AS INTEGER) = 0) AS negatives, "
                   f"count(*) FILTER (WHERE CAST(target_adverse AS INTEGER) = 1) AS positives, "
                   f"count(*) FILTER (WHERE CAST(target_adverse AS INTEGER) NOT IN (0, 1)) AS other_targets "
                   f"FROM ({FEATURE_SELECT}) f"),
)
def training_data_checks(spark, sf_dir):
    return M.training_data_checks(_features(spark, sf_dir))


# --- J7-J11 on deterministic scores (FIXTURES): score = ((id * 37) % 101) / 101, label = target_adverse

_SCORED_SQL = (f"SELECT inspection_id, CAST(target_adverse AS INTEGER) AS target, "
               f"CAST((inspection_id * 37) % 101 AS DOUBLE) / 101 AS score FROM ({FEATURE_SELECT}) f")


def _scored(spark, sf_dir):
    return _labels(spark, sf_dir).select(
        "inspection_id",
        F.col("target_adverse").cast("int").alias("target"),
        ((F.col("inspection_id") * 37) % 101).cast("double") / 101,
    ).toDF("inspection_id", "target", "score")


_CM = ("count(*) FILTER (WHERE target = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE target = 0 AND score >= 0.5) AS fp, "
       "count(*) FILTER (WHERE target = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE target = 1 AND score >= 0.5) AS tp")


@register(
    "confusion_matrix",
    feature_oracle(f"SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive "
                   f"FROM (SELECT {_CM} FROM ({_SCORED_SQL}) s) c"),
)
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_scored(spark, sf_dir))


@register(
    "classification_metrics",
    feature_oracle(f"SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy, "
                   f"CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, "
                   f"CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall, "
                   f"CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1, "
                   f"0.5 AS threshold, rate AS test_adverse_rate "
                   f"FROM (SELECT {_CM}, avg(CAST(target AS DOUBLE)) AS rate FROM ({_SCORED_SQL}) s) c"),
)
def classification_metrics(spark, sf_dir):
    return M.classification_metrics(_scored(spark, sf_dir))


_GROUPS = (f"g AS (SELECT score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg "
           f"FROM ({_SCORED_SQL}) s GROUP BY score)")


@register(
    "roc_auc",
    # oracle by pairwise counting of (positive, negative) score groups: ties count one half
    feature_oracle(f"WITH {_GROUPS} SELECT sum(a.pos * b.neg * CASE WHEN a.score > b.score THEN 1.0 "
                   f"WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) / ((SELECT sum(pos) FROM g) * (SELECT sum(neg) FROM g)) "
                   f"AS roc_auc FROM g a, g b"),
)
def roc_auc(spark, sf_dir):
    return M.roc_auc(_scored(spark, sf_dir))


@register(
    "average_precision",
    feature_oracle(f"WITH {_GROUPS}, d AS (SELECT score, pos, sum(pos) OVER (ORDER BY score DESC) AS tp, "
                   f"sum(neg) OVER (ORDER BY score DESC) AS fp FROM g) "
                   f"SELECT sum(pos / (SELECT sum(pos) FROM g) * tp / (tp + fp)) AS average_precision FROM d"),
)
def average_precision(spark, sf_dir):
    return M.average_precision(_scored(spark, sf_dir))


@register("brier_score", feature_oracle(f"SELECT avg(pow(score - target, 2)) AS brier_score FROM ({_SCORED_SQL}) s"))
def brier_score(spark, sf_dir):
    return M.brier_score(_scored(spark, sf_dir))


# --- F11 over rows with every kind of fault ------------------------------------------------------------

_FAULTS = ("SELECT inspection_id, CASE WHEN inspection_id % 7 = 0 THEN NULL ELSE prediction_date END AS prediction_date, "
           "CASE WHEN inspection_id % 11 = 0 THEN NULL WHEN inspection_id % 13 = 0 THEN 2 ELSE CAST(target_adverse AS INT) END AS target_adverse")


def faults_sql(rows: str) -> str:
    return f"{_FAULTS} FROM {rows} f UNION ALL {_FAULTS} FROM {rows} f WHERE inspection_id % 50 = 0"


@register(
    "training_data_checks_planted",
    feature_oracle("SELECT count(*) AS row_count, count(*) - count(DISTINCT inspection_id) AS duplicate_ids, count(*) - count(prediction_date) AS null_dates, "
                   "count(*) - count(target_adverse) AS null_targets, count_if(target_adverse = 0) AS negatives, count_if(target_adverse = 1) AS positives, "
                   f"count_if(target_adverse > 1) AS other_targets FROM ({faults_sql(f'({FEATURE_SELECT})')}) f"),
)
def training_data_checks_planted(spark, sf_dir):
    rows = spark.sql(faults_sql("{rows}"), rows=_labels(spark, sf_dir))
    missing = [c for c in (*M.IDENTIFIER_COLUMNS, *M.FEATURE_COLUMNS) if c not in rows.columns]
    return M.training_data_checks(rows.withColumns({c: F.lit(0) for c in missing}))


# --- J12 on deterministic coefficients: per state the share of adverse inspections less one half, per input a value
# --- made from its name, so that SQL can check the arithmetic

_INPUTS = [*M.CONTINUOUS_FEATURES, *M.BINARY_FEATURES]
_INPUT_VALUES = [(name, round(((7 * i) % 19 - 9) / 8, 3)) for i, name in enumerate(_INPUTS)]
_COEF_SQL = (
    f"WITH st AS (SELECT COALESCE(state, 'UNKNOWN') AS state, count_if(target_adverse) AS bad, count(*) AS n FROM ({FEATURE_SELECT}) f GROUP BY 1), "
    "co AS (SELECT 'state_' || state AS name, bad / n - 0.5 AS b FROM st WHERE state > (SELECT min(state) FROM st) "
    + "".join(f"UNION ALL SELECT '{name}', CAST({value} AS DOUBLE) " for name, value in _INPUT_VALUES)
    + "), od AS (SELECT name AS transformed_feature, CASE WHEN name LIKE 'state!_%' ESCAPE '!' THEN 'State: ' || substr(name, 7) "
    "ELSE array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(name, '_')], ' ') END AS feature, b AS coefficient, exp(b) AS odds_ratio, "
    "(exp(b) - 1) * 100 AS odds_change_percent, ['Lower adverse odds', 'No estimated change', 'Higher adverse odds'][CAST(sign(b) AS INTEGER) + 2] AS direction, "
    "abs(b) AS absolute_coefficient FROM co) "
)


def _coefficients(spark, sf_dir):
    """The deterministic coefficients and the baseline state."""
    state = F.coalesce("state", F.lit(M.UNKNOWN)).alias("state")
    shares = _labels(spark, sf_dir).groupBy(state).agg((F.count_if("target_adverse") / F.count(F.lit(1)) - 0.5).alias("coefficient"))
    baseline = shares.agg(F.min("state")).scalar()
    states = shares.where(F.col("state") > baseline).select(F.concat(F.lit(M.STATE_PREFIX), "state").alias("transformed_feature"), "coefficient")
    return states.unionByName(spark.createDataFrame(_INPUT_VALUES, "transformed_feature string, coefficient double")), baseline


def _odds(spark, sf_dir):
    return M.odds_ratio_table(_coefficients(spark, sf_dir)[0])


@register("odds_ratio_table", feature_oracle(_COEF_SQL + "SELECT * FROM od"))
def odds_ratio_table(spark, sf_dir):
    return _odds(spark, sf_dir)


@register(
    "top_associations",
    feature_oracle(_COEF_SQL + f"SELECT * FROM (SELECT CASE WHEN coefficient > 0 THEN 'positive' ELSE 'negative' END AS side, "
                   "row_number() OVER (PARTITION BY sign(coefficient) ORDER BY absolute_coefficient DESC, transformed_feature) AS rank, * FROM od "
                   f"WHERE coefficient <> 0) WHERE rank <= {M.TOP}"),
)
def top_associations(spark, sf_dir):
    return M.top_associations(_odds(spark, sf_dir))


@register(
    "state_odds",
    feature_oracle(_COEF_SQL + "SELECT substr(transformed_feature, 7) AS state, coefficient, odds_ratio, odds_change_percent, direction, false AS is_baseline "
                   "FROM od WHERE feature LIKE 'State: %' UNION ALL SELECT min(state), 0.0, 1.0, 0.0, 'Baseline', true FROM st"),
)
def state_odds(spark, sf_dir):
    coefficients, baseline = _coefficients(spark, sf_dir)
    return M.state_odds(M.odds_ratio_table(coefficients), baseline)


@register("product_odds", feature_oracle(_COEF_SQL + "SELECT * FROM od WHERE feature LIKE 'Has Prior Product %'"))
def product_odds(spark, sf_dir):
    return M.product_odds(_odds(spark, sf_dir))


@register("continuous_odds", feature_oracle(_COEF_SQL + f"SELECT * FROM od WHERE transformed_feature IN {tuple(M.CONTINUOUS_FEATURES)}"))
def continuous_odds(spark, sf_dir):
    return M.continuous_odds(_odds(spark, sf_dir))


# --- J5/J6/J12: the fitted model (rows-only checks; model_gradient says whether the fit is the optimum)


@register("model_scores")
def model_scores(spark, sf_dir):
    """P(adverse) for every test-split inspection from the model fitted on the training split."""
    model, split, _levels, _n = M.fit(_features(spark, sf_dir, stepwise=True))
    return M.score(model, split.where(F.col("split") == "test"))


@register("model_coefficients")
def model_coefficients(spark, sf_dir):
    """Coefficients, odds ratios, % change in odds and direction, largest effects first."""
    model, _split, levels, _n = M.fit(_features(spark, sf_dir, stepwise=True))
    return M.coefficient_table(model, levels).orderBy(F.desc("absolute_coefficient"))


@register("model_gradient", oracle("SELECT CAST(0.0 AS DOUBLE) AS largest_gradient", tables=()))
def model_gradient(spark, sf_dir):
    """The largest gradient component of the fitted objective, rounded to four places: 0 at the optimum."""
    model, split, _levels, n = M.fit(_features(spark, sf_dir, stepwise=True))
    return M.loss_gradient(model, split.where("split = 'train'"), n).select(F.round("largest_gradient", 4).alias("largest_gradient"))
