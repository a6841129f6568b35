"""What queries leave on disk while they run: shuffle files of ended steps, and input that is built more than once."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import test_features as TF
from tests.test_incremental import BASE, MOST, tables
from vigil.operators import model as M
from vigil.plans.features import FeaturePlan
from vigil.plans.incremental import refresh_features, site_prints
from vigil.queries.ingest import unique_valid, upsert_fixture
from vigil.session import CLEANUP_CONF, set_aside


def shuffles(spark) -> set[str]:
    """Names of the shuffle files on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}


def left_by(spark, run) -> set[str]:
    """Shuffle files that are there some seconds after a call and were not before; what it returned is held meanwhile."""
    before = shuffles(spark)
    held = run()  # noqa: F841
    for _ in range(40):
        if not (left := shuffles(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_rows_set_aside_are_the_same_and_leave_no_shuffles(spark):
    rows = spark.createDataFrame([(1, None, float("nan")), (1, "é", -0.0), (None, "", None), (1, "é", -0.0)], "k long, `a b` string, x double")
    held = spark.conf.get(CLEANUP_CONF)
    again = set_aside(rows)
    assert spark.conf.get(CLEANUP_CONF) == held
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows.collect())) and again.dtypes == rows.dtypes
    assert set_aside(rows.where("false")).count() == 0
    assert not left_by(spark, lambda: set_aside(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()))


def test_rows_set_aside_can_be_used_after_their_source_was_read(spark):
    df = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 5).alias("k")).count()
    assert df.count() == 5
    once = set_aside(df)
    assert sorted(once.collect()) == sorted(df.collect()) == sorted(set_aside(df).collect())


@pytest.mark.parametrize("variant", ["production", "exploratory"])
def test_a_stepwise_plan_gives_the_same_rows(spark, variant):
    t = tables(spark, MOST | {"inspections": MOST["inspections"] + MOST["inspections"][:2], "citations": TF.CITATIONS + [(None, None, None, None, None, None)]})
    whole, steps = (FeaturePlan(t, stepwise=s).features(variant=variant) for s in (False, True))
    assert steps.dtypes == whole.dtypes and sorted(map(repr, steps.collect())) == sorted(map(repr, whole.collect()))


def test_a_refresh_leaves_no_shuffles(spark):
    stored = set_aside(FeaturePlan(tables(spark, BASE)).features("v1"))
    assert not left_by(spark, lambda: refresh_features(tables(spark, MOST), stored, set_aside(site_prints(tables(spark, BASE))), "v1"))


def test_an_upsert_leaves_no_shuffles_of_the_load_and_the_key_check(spark):
    assert not left_by(spark, lambda: upsert_fixture(spark, "/root/testdata/sf0.001", "inspections"))
    rows = spark.createDataFrame([(1, []), (1, []), (2, []), (None, []), (3, ["bad"])], "k long, errors array<string>")
    assert sorted(map(repr, unique_valid(rows, ("k",)).collect())) == ["Row(k=2)", "Row(k=None)"]


def test_a_fit_builds_its_input_once(spark):
    n, seen = 400, spark.sparkContext.accumulator(0)

    def count(i):
        seen.add(1)
        return i

    rows = spark.range(n).withColumn("inspection_id", F.udf(count, T.LongType()).asNondeterministic()("id"))
    names = {c: (F.col("id") % (3 + i)).cast("double") for i, c in enumerate(M.CONTINUOUS_FEATURES + M.BINARY_FEATURES)}
    data = rows.withColumns(names).withColumns({
        "fei_number": F.lit("A"), "state": F.when(F.col("id") % 2 == 0, "CA").otherwise("NY"),
        "prediction_date": F.date_add(F.lit("2020-01-01"), (F.col("id") % 20).cast("int")), "target_adverse": F.col("id") % 3 == 0})
    model, split, levels, n_train = M.fit(data.where("inspection_id IS NOT NULL"))
    assert split.count() == n and n_train == 320 and levels == ["CA", "NY"]
    assert seen.value == n
