"""Properties of the point-in-time feature plan, and agreement with the join form on edge sets."""

import datetime as dt
from types import SimpleNamespace

import duckdb
from pyspark.sql import functions as F

from vigil.oracle import FEATURE_CTES, FEATURE_SELECT
from vigil.plans.features import FeaturePlan

D = dt.date
INSP = "inspection_id long, fei_number string, state string, country string, inspection_end_date date, classification_code string, project_area string, product_type string, additional_details string"
CIT = "inspection_id long, fei_number string, inspection_end_date date, program_area string, act_cfr_number string, short_description string"
P483 = "record_id long, fei_number string, record_date date, publish_date date, record_type string"
ACT = "fei_number string, case_injunction_id string, action_taken_date date, action_type string, product_type string"
REC = "fei_number string, event_id long, product_id long, center_classification_date date, event_classification string, status string"

US = "United States"
INSPECTIONS = [
    (1, "A", "CA", US, D(2020, 1, 1), "NAI", "Area 1", "Food/Cosmetics", "x"),
    (1, "A", "CA", US, D(2020, 1, 1), "oai ", "Area 2", "Drugs", "x"),
    (2, " A ", "CA", US, D(2020, 3, 1), "VAI", "Area 1", "Animal Drugs", "x"),
    (3, "A", "CA", US, D(2020, 3, 1), "NAI", "Area 1", None, "x"),  # same day as 2: never its history
    (4, "A", "", US, D(2021, 1, 1), "OAI", "Area 1", "Radiological", "x"),
    (5, "B", "NY", US, D(2020, 6, 1), "NAI", "Area 1", "Tobacco", "x"),
    (6, "B", "NY", "Canada", D(2020, 7, 1), "NAI", "Area 1", "Devices", "x"),  # not US: dropped
    (7, "B", "NY", US, D(2020, 8, 1), None, "Area 1", "Devices", "x"),  # no code: dropped
    (8, "", "NY", US, D(2020, 8, 1), "NAI", "Area 1", "Devices", "x"),  # blank site: dropped
    (9, "B", "NY", US, D(2020, 9, 1), "VAI", "Area 1", "Biologics", "x"),
]
CITATIONS = [
    (1, "A", D(2020, 1, 1), "Drugs", "21 CFR 1", "R"),
    (1, "A", D(2020, 1, 1), "Drugs", " 21 cfr 2", "R"),
    (2, "A", D(2020, 3, 1), "Drugs", "21 CFR 1 ", "A"),
    (2, "A", D(2020, 3, 1), "Drugs", "  ", "A"),
    (3, "A", D(2020, 3, 1), "Drugs", "21 cfr 2", "A"),
    (5, "B", D(2020, 6, 1), "Drugs", "21 CFR 9", "A"),
]
PUBLISHED = [
    (10, "A", D(2019, 12, 1), D(2020, 2, 1), "483"),
    (10, "A", D(2019, 11, 1), D(2019, 11, 20), "483"),
    (11, " A", D(2020, 2, 15), D(2020, 5, 1), "483"),
    (12, "B", D(2020, 1, 1), None, "483"),
]
ACTIONS = [
    ("A", " ", D(2019, 6, 1), "Warning Letter", "Drugs"),
    ("A", " ", D(2019, 6, 1), "Warning Letter", "Devices"),
    ("A", "77", D(2020, 2, 1), "warning letter", "Drugs"),
    ("A", "78", D(2020, 2, 1), "Seizure", "Drugs"),
    ("B", "79", D(2020, 8, 1), "Warning Letter", "Drugs"),
]
RECALLS = [
    ("A", 100, 1, D(2020, 2, 1), "Class I", "Ongoing"),
    ("A", 100, 2, D(2020, 2, 1), "Class I", "Ongoing"),
    ("A", 101, 3, D(2020, 3, 1), "Class II", "Ongoing"),
    ("B", 102, 1, D(2020, 7, 1), "Class I", "Ongoing"),
]


def tables(spark, extra_inspections=()):
    return SimpleNamespace(
        inspections=spark.createDataFrame(INSPECTIONS + list(extra_inspections), INSP),
        citations=spark.createDataFrame(CITATIONS, CIT),
        published483=spark.createDataFrame(PUBLISHED, P483),
        compliance_actions=spark.createDataFrame(ACTIONS, ACT),
        recalls=spark.createDataFrame(RECALLS, REC),
    )


def join_form(t):
    con = duckdb.connect()
    for name, df in (("inspections", t.inspections), ("inspections_citations", t.citations),
                     ("published483", t.published483), ("compliance_actions", t.compliance_actions),
                     ("recalls", t.recalls)):
        pdf = df.toPandas()
        con.register(name, pdf)
    sql = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in FEATURE_CTES.items()) + "\n" + FEATURE_SELECT
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, res.fetchall()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


def test_matches_join_form_on_edge_set(spark):
    t = tables(spark)
    f = FeaturePlan(t).features("v1")
    cols, expect = join_form(t)
    got = [tuple(r) for r in f.collect()]
    assert sorted(f.columns) == sorted(cols)
    assert _norm(got, f.columns) == _norm(expect, cols)


def test_same_day_and_cold_start(spark):
    f = {r["inspection_id"]: r for r in FeaturePlan(tables(spark)).features().collect()}
    assert set(f) == {1, 2, 3, 4, 5, 9}
    assert f[1]["prior_inspection_count"] == 0 and f[1]["is_first_observed_inspection"] == 1
    assert f[1]["days_since_previous_inspection"] == 0 and f[1]["previous_classification_adverse"] == 0
    # 2 and 3 share a day: each sees only inspection 1
    assert f[2]["prior_inspection_count"] == 1 and f[3]["prior_inspection_count"] == 1
    assert f[2]["target_classification"] == "VAI" and f[1]["target_classification"] == "OAI"
    # 4 sees 1, 2, 3; previous = latest date then highest id = 3 (NAI)
    assert f[4]["prior_inspection_count"] == 3 and f[4]["previous_classification_adverse"] == 0
    assert f[4]["repeated_cfr_count"] == 2  # CFR 1 in {1, 2}, CFR 2 in {1, 3}
    assert f[4]["prior_citation_count"] == 5 and f[4]["previous_inspection_citation_count"] == 1
    assert f[4]["has_prior_product_drug"] == 1 and f[4]["has_prior_product_veterinary"] == 1


def test_no_leakage_from_future_events(spark):
    base = {r["inspection_id"]: r.asDict() for r in FeaturePlan(tables(spark)).features().collect()}
    future = [(50, "A", "CA", US, D(2030, 1, 1), "OAI", "Area 1", "Tobacco", "x"),
              (51, "B", "NY", US, D(2030, 1, 1), "OAI", "Area 1", "Food", "x")]
    grown = {r["inspection_id"]: r.asDict() for r in FeaturePlan(tables(spark, future)).features().collect()}
    for k, row in base.items():
        assert grown[k] == row


def test_rows_are_distinct_inspections_and_history_monotone(spark):
    from vigil.sources.catalog import Catalog

    plan = FeaturePlan(Catalog(spark, "/root/testdata/sf0.001"))
    f = plan.features()
    assert f.count() == f.select("inspection_id").distinct().count() == plan.events.count()
    from pyspark.sql import Window

    w = Window.partitionBy("fei_number").orderBy("prediction_date", "inspection_id")
    bad = f.withColumn("prev", F.lag("prior_inspection_count").over(w)).where(F.col("prev") > F.col("prior_inspection_count"))
    assert bad.count() == 0
