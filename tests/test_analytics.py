"""Survival and evaluation operators against plain-Python loops; distributed running sums."""

import random

from pyspark.sql import functions as F

from vigil.functions.ordered import running_sums
from vigil.operators import model as M
from vigil.operators import survival as S


def km_loop(durations, events):
    times = sorted({d for d, e in zip(durations, events) if e})
    s, rows = 1.0, [(0.0, len(durations), 0, 1.0)]
    for t in times:
        n = sum(1 for d in durations if d >= t)
        d_ = sum(1 for d, e in zip(durations, events) if d == t and e)
        s *= 1.0 - d_ / n
        rows.append((float(t), n, d_, s))
    return rows


def test_km_matches_loop(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 40), int(rnd.random() < 0.7)) for _ in range(300)] + [(40, 1), (40, 1)]
    df = spark.createDataFrame(data, "duration_days int, event_observed int")
    got = sorted((r["time"], r["at_risk"], r["events"], round(r["survival_probability"], 12))
                 for r in S.km_curve(df).collect())
    exp = sorted((t, n, d, round(s, 12)) for t, n, d, s in km_loop([d for d, _ in data], [e for _, e in data]))
    assert got == exp
    probs = [r[3] for r in sorted(got)]
    assert all(0.0 <= p <= 1.0 for p in probs)


def test_horizon_and_median(spark):
    df = spark.createDataFrame([(10, 1), (20, 1), (30, 0), (40, 1)], "duration_days int, event_observed int")
    curve = S.km_curve(df)
    h = {r["horizon_days"]: r["probability_no_inspection"] for r in S.survival_at_horizon(curve, (5, 25)).collect()}
    assert h[5] == 1.0 and abs(h[25] - 0.5) < 1e-12
    assert S.median_survival(curve).first()["median_days"] == 20.0


def test_running_sums(spark):
    rnd = random.Random(3)
    rows = [(float(i), rnd.randint(0, 5)) for i in rnd.sample(range(10_000), 2_000)]
    df = spark.createDataFrame(rows, "k double, v long")
    got = {r["k"]: (r["cum_v"]) for r in running_sums(df, "k", ["v"], partitions=7).collect()}
    acc, exp = 0, {}
    for k, v in sorted(rows):
        acc += v
        exp[k] = acc
    assert got == exp


def _auc_pairs(scored):
    pos = [s for s, y in scored if y == 1]
    neg = [s for s, y in scored if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _ap_loop(scored):
    P = sum(y for _, y in scored)
    ap, prev_r = 0.0, 0.0
    for s in sorted({s for s, _ in scored}, reverse=True):
        tp = sum(1 for x, y in scored if x >= s and y == 1)
        fp = sum(1 for x, y in scored if x >= s and y == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_auc_ap_brier(spark):
    rnd = random.Random(11)
    scored = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(500)]
    df = spark.createDataFrame([(i, y, s) for i, (s, y) in enumerate(scored)], "inspection_id long, target int, score double")
    assert abs(M.roc_auc(df).first()[0] - _auc_pairs(scored)) < 1e-12
    assert abs(M.average_precision(df).first()[0] - _ap_loop(scored)) < 1e-12
    brier = sum((s - y) ** 2 for s, y in scored) / len(scored)
    assert abs(M.brier_score(df).first()[0] - brier) < 1e-12
    # AUC is invariant under a monotone transform of the scores
    df2 = df.withColumn("score", F.exp(F.col("score") * 3))
    assert abs(M.roc_auc(df2).first()[0] - _auc_pairs(scored)) < 1e-9


def test_cohort_with_a_hot_site_day_equals_a_loop(spark):
    """A third of all rows on one site and day, split into ranges of four ids."""
    import datetime as dt
    import random

    from vigil.operators.profile import inspection_cohort

    r = random.Random(6)
    day = dt.date(2020, 1, 1)
    ids = r.sample(range(1, 2000), 300)
    rows = [(i, "hot", day, r.choice(["NAI", "vai", "OAI"])) if n < 100 else (i, r.choice(["hot", "a", " b "]), day + dt.timedelta(r.randint(-5, 5)), r.choice(["NAI", "VAI", "OAI", "?", None])) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "inspection_id long, fei_number string, inspection_end_date date, classification_code string")
    got = {x.inspection_id: x for x in inspection_cohort(df, id_range=4).collect()}
    level = {"NAI": 0, "VAI": 1, "OAI": 2}
    visits = sorted((s.strip(), d, i, level[c.upper()]) for i, s, d, c in rows if c and c.upper() in level)
    assert len(got) == len(visits)
    for site, d, i, lv in visits:
        before = [v for v in visits if v[0] == site and v[1:3] < (d, i)]
        g = got[i]
        assert (g.prior_inspection_count, g.prior_nai_count, g.prior_vai_count, g.prior_oai_count) == (len(before), *(sum(v[3] == k for v in before) for k in (0, 1, 2)))
        assert g.target_severity == lv and g.is_first_observed_inspection == int(not before)
        assert g.days_since_previous_inspection == ((d - before[-1][1]).days if before else None)
        assert g.previous_classification == (["NAI", "VAI", "OAI"][before[-1][3]] if before else None)


def test_survival_intervals_per_product(spark):
    from vigil.operators.survival import survival_intervals

    rows = [(1, "a", "2000-01-01", "Drugs"), (1, "a", "2000-01-01", "Devices"), (2, "a", "2000-02-01", None)]
    df = spark.createDataFrame(rows, "inspection_id long, fei_number string, d string, product_type string").selectExpr("*", "CAST(d AS DATE) AS inspection_end_date")
    got = sorted((x.inspection_id, x.product_type or "", x.duration_days, x.event_observed) for x in survival_intervals(df, "2001-01-01", per_product=True).collect())
    assert got == [(1, "Devices", 31, 1), (1, "Drugs", 31, 1), (2, "", 335, 0)]
    assert survival_intervals(df, "2001-01-01").count() == 2
