"""A refresh of the feature table equals a full build, whatever came late, was corrected or went away."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests import test_features as T
from vigil.plans.features import FeaturePlan
from vigil.plans.incremental import changed_sites, refresh_features, site_prints

D = dt.date
BASE = {"inspections": T.INSPECTIONS, "citations": T.CITATIONS, "published483": T.PUBLISHED, "compliance_actions": T.ACTIONS, "recalls": T.RECALLS}
SCHEMAS = {"inspections": T.INSP, "citations": T.CIT, "published483": T.P483, "compliance_actions": T.ACT, "recalls": T.REC}
SITE_C = [(20 + i, "C", "TX", T.US, D(2020, 1, 1 + i), "VAI", "Area 1", "Drugs", "x") for i in range(5)]
MOST = BASE | {"inspections": T.INSPECTIONS + SITE_C}


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: most of a test's time would go to empty shuffle partitions."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", held)


def tables(spark, rows):
    return SimpleNamespace(**{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()})


def without(rows, source, drop):
    return rows | {source: [r for r in rows[source] if not drop(r)]}


LATE = {
    "an early inspection of one site": (without(MOST, "inspections", lambda r: r[0] == 2), MOST, {"A": D(2020, 3, 1)}),
    "a citation of one inspection": (without(MOST, "citations", lambda r: r[4] == "21 CFR 9"), MOST, {"B": D(2020, 9, 1)}),
    "a recall": (without(MOST, "recalls", lambda r: r[1] == 100), MOST, {"A": D(2020, 3, 1)}),
    "a record of a form": (without(MOST, "published483", lambda r: r[0] == 11), MOST, {"A": D(2021, 1, 1)}),
    "a new site": (BASE, MOST, {"C": D(2020, 1, 1)}),
    "a site that goes away": (MOST, BASE, {"C": D(2020, 1, 1)}),
    "a corrected code": (MOST | {"inspections": [(*r[:5], "NAI", *r[6:]) if r[0] == 22 else r for r in MOST["inspections"]]}, MOST, {"C": D(2020, 1, 3)}),
    "a moved date": (MOST | {"inspections": [(*r[:4], D(2020, 1, 9), *r[5:]) if r[0] == 21 else r for r in MOST["inspections"]]}, MOST, {"C": D(2020, 1, 2)}),
    "nothing": (MOST, MOST, {}),
    "a row that no feature reads": (MOST, MOST | {"inspections": MOST["inspections"] + [(30, "C", "TX", "Canada", D(2020, 1, 2), "VAI", "Area 1", "Drugs", "x")]}, {}),
    "everything": ({n: r[:0] for n, r in MOST.items()}, MOST, {"A": D(2020, 1, 1), "B": D(2020, 6, 1), "C": D(2020, 1, 1)}),
}


@pytest.mark.parametrize("case", LATE)
def test_refresh_equals_a_full_build(spark, case):
    before, now, first = LATE[case]
    earlier, later = tables(spark, before), tables(spark, now)
    stored = FeaturePlan(earlier).features("v1").withColumn("created_at", F.lit("2020-01-01").cast("timestamp_ntz"))
    out = refresh_features(later, stored, site_prints(earlier))
    got, full = out.features.collect(), FeaturePlan(later).features("v1").collect()
    assert sorted((tuple(v for c, v in r.asDict().items() if c != "created_at") for r in got), key=repr) == sorted(map(tuple, full), key=repr)
    assert {r.fei_number: r.first_day for r in out.first_changes.collect()} == first

    def renewed(r):
        return r.fei_number in first and r.prediction_date >= first[r.fei_number]

    # rows of other sites, and earlier rows of a changed one, were not written again
    assert {r.inspection_id for r in got if r.created_at == dt.datetime(2020, 1, 1)} == {r.inspection_id for r in full if not renewed(r)}
    # the prints kept are those of the tables as they are now
    assert changed_sites(out.prints, site_prints(later)).count() == 0


def test_prints_do_not_depend_on_the_order_and_count_repeats(spark):
    shuffled = tables(spark, {n: r[::-1] for n, r in MOST.items()})
    assert changed_sites(site_prints(tables(spark, MOST)), site_prints(shuffled)).count() == 0
    # a row that comes twice more cancels in the exclusive or, not in the count and the sum
    thrice = tables(spark, MOST | {"recalls": MOST["recalls"] + [MOST["recalls"][3]] * 2})
    assert [r.fei_number for r in changed_sites(site_prints(tables(spark, MOST)), site_prints(thrice)).collect()] == ["B"]
