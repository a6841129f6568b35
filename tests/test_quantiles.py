"""Exact quantiles by rank selection against numpy and against Spark's own percentile."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators.profile import describe
from vigil.operators.quantiles import SPLITS, brackets_of, exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.755, 0.99, 1.0]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: most of a test's time would go to empty shuffle partitions."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", held)


def quantiles(df, **options):
    return exact_quantiles(df, "x", PROBABILITIES, **options).first()["quantiles"]


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0] * 1000, list(range(-500, 500)), [0.0, -0.0, 1e-300, -1e-300, 5e-324, 1e308, -1e308],
    [float("inf"), 1.0, float("-inf"), 2.0, 1.7e308], [2.0**k for k in range(-1000, 1000)] + [-(2.0**k) for k in range(-1000, 1000)],
    [1e9 + k * 2**-20 for k in range(3000)], [0.1] * 500 + [math.nextafter(0.1, 1)] * 500 + [7.0],
])
@pytest.mark.parametrize("rows_at_once", [1, 1 << 16])
def test_equals_sorting(spark, values, rows_at_once):
    df = spark.createDataFrame([(float(v),) for v in random.Random(1).sample(values, len(values))] + [(None,)] * 3, "x double")
    got, ordered = quantiles(df, rows_at_once=rows_at_once), sorted(values)
    for p, g in zip(PROBABILITIES, got):
        position = p * (len(ordered) - 1)
        low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
        assert g == pytest.approx(low if low == high else low * (math.ceil(position) - position) + high * (position - math.floor(position)), rel=1e-12, nan_ok=True)


def test_a_million_distinct_values_over_many_partitions(spark):
    rows = spark.range(0, 1_000_000, 1, 8).select((F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 7.0).alias("x"))
    want = np.quantile(np.array([r.x for r in rows.collect()]), PROBABILITIES)
    assert quantiles(rows) == pytest.approx(want.tolist(), rel=1e-12)
    values = rows.select(F.struct(F.lit(0).alias("g0")).alias("g"), F.col("x").alias("v"))
    found, rounds = brackets_of(values, PROBABILITIES, 500)
    assert 1 <= rounds <= 5
    # what is sorted in the end is bounded, and no bracket list grows with the values
    sizes = [r for r in found.collect() if r.low != r.high]
    assert max(r.n for r in sizes) <= 500 and len(sizes) <= 2 * len(PROBABILITIES)


def test_rounds_are_few_for_any_spread(spark):
    spread = [(float(f"{m}e{e}"),) for e in range(-300, 300, 3) for m in range(1, 40)] + [(1.0 + k * 2.0**-52,) for k in range(4000)]
    values = spark.createDataFrame(spread, "v double").select(F.struct(F.lit(0).alias("g0")).alias("g"), "v")
    _, rounds = brackets_of(values, [0.1, 0.5, 0.9], 1)
    assert rounds <= 5 and SPLITS == 4096


def test_groups_nulls_and_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([1, 2]), rng.gauss(0, 100) if rng.random() < 0.9 else 5.0) for _ in range(3000)]
    rows += [("alone", 1, 4.5), ("none", 1, None)]
    df = spark.createDataFrame(rows, "k string, j int, x double")
    got = {(r.k, r.j): r.quantiles for r in exact_quantiles(df, "x", PROBABILITIES, ["k", "j"], rows_at_once=20).collect()}
    want = {}
    for k, j, x in rows:
        if x is not None:
            want.setdefault((k, j), []).append(x)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(np.quantile(values, PROBABILITIES).tolist(), rel=1e-9, abs=1e-9)


def test_nan_is_the_greatest_value(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "x double")
    got = exact_quantiles(df, "x", [0.0, 0.5, 1.0]).first()["quantiles"]
    assert got[:2] == [1.0, 2.0] and math.isnan(got[2])


def test_describe_has_no_percentile_buffer(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 77).alias("x"))
    out = describe(df, "x")
    assert "percentile" not in out._jdf.queryExecution().executedPlan().toString().lower()
    want = df.agg(F.percentile("x", [0.25, 0.5, 0.75]).alias("q")).first().q
    assert [out.first()[c] for c in ("p25", "p50", "p75")] == pytest.approx(want)
    empty = describe(df.where("x < 0"), "x").first()
    assert empty["count"] == 0 and empty["p50"] is None


def test_wrong_probabilities(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(3), "id", [1.5])
