"""Plans that must keep their shape at scale: CFR history by change intervals on a hot site, site overlap by masks."""

import datetime as dt
import itertools
import random
from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vigil.operators import profile as P
from vigil.plans.features import FeaturePlan

INSP = "inspection_id long, fei_number string, state string, country string, inspection_end_date date, classification_code string, project_area string, product_type string, additional_details string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: most of a test's time would go to empty shuffle partitions."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", held)


def _tables(spark, visits, citations):
    inspections = [(i, site, "CA", "United States", day, "VAI", "Area", "Drugs", "x") for i, site, day in visits]
    return SimpleNamespace(inspections=spark.createDataFrame(inspections, INSP), citations=spark.createDataFrame(citations, "inspection_id long, act_cfr_number string"))


def _brute(visits, citations):
    cited = defaultdict(set)
    for i, cfr in citations:
        if cfr and cfr.strip():
            cited[i].add(cfr.strip().upper())
    out = set()
    for i, site, day in visits:
        counts = defaultdict(int)
        for j, other, earlier in visits:
            if other == site and earlier < day:
                for cfr in cited[j]:
                    counts[cfr] += 1
        out |= {(i, cfr, n) for cfr, n in counts.items()}
    return out


@pytest.mark.parametrize("part_rows", [1, 40, 50_000])
def test_cfr_history_with_a_third_of_all_rows_on_one_site(spark, part_rows):
    rng = random.Random(part_rows)
    days = [dt.date(2015, 12, 25) + dt.timedelta(days=d) for d in range(0, 1200, 9)]
    visits = [(i, "hot" if i % 3 == 0 else f"s{rng.randrange(40)}", rng.choice(days)) for i in range(360)]
    citations = [(i, rng.choice([f"21 cfr {rng.randrange(12)}", f" 21 CFR {rng.randrange(12)}", " ", None])) for i, _, _ in visits for _ in range(rng.randrange(4))]
    plan = FeaturePlan(_tables(spark, visits, citations))
    got = [(r.inspection_id, r.normalized_cfr, r.cited_inspection_count) for r in plan.cfr_history(part_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(visits, citations)


def test_cfr_history_at_the_turn_of_a_year(spark):
    # a change on 31 December holds from 1 January on; an interval over several years is met in each of them
    visits = [(1, "a", dt.date(2019, 12, 31)), (2, "a", dt.date(2020, 1, 1)), (3, "a", dt.date(2023, 6, 1)), (4, "a", dt.date(2023, 6, 1)), (5, "b", dt.date(2023, 1, 1))]
    citations = [(1, "x"), (2, "x"), (3, "y"), (5, "x")]
    got = {tuple(r) for r in FeaturePlan(_tables(spark, visits, citations)).cfr_history().collect()}
    assert got == {(2, "X", 1), (3, "X", 2), (4, "X", 2)}


def test_cfr_history_sorts_nothing_of_the_results_size(spark):
    visits = [(i, "a", dt.date(2020, 1, 1) + dt.timedelta(days=i)) for i in range(20)]
    out = FeaturePlan(_tables(spark, visits, [(i, f"c{i % 5}") for i in range(20)])).cfr_history()
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    # above the join of targets and intervals (the first in the tree) there is no aggregate, window or further join
    first_join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any(word in line for line in plan[:first_join] for word in ("Window", "Aggregate", "Distinct"))


def test_overlap_and_coverage_by_masks(spark):
    rng = random.Random(3)
    sites = {name: [rng.choice([" s1", "s1", "s2", "s3 ", "s4", None, " "]) for _ in range(n)] for name, n in (("b", 9), ("a", 5), ("c", 1), ("empty", 0))}
    tables = {n: spark.createDataFrame([(s,) for s in v], ("fei string" if n == "c" else "fei_number string")) for n, v in sites.items()}
    tables["no_site"] = spark.range(3)
    found = {n: {s.strip() for s in v if s and s.strip()} for n, v in sites.items()}
    got = {(r.left_table, r.right_table): r.shared_feis for r in P.fei_overlap(tables).collect()}
    assert got == {(x, y): len(found[x] & found[y]) for x, y in itertools.product(found, found)}
    assert {r.table_name: r.distinct_feis for r in P.fei_coverage(tables).collect()} == {n: len(s) for n, s in found.items() if s}
    assert "Join" not in P.fei_overlap(tables)._jdf.queryExecution().executedPlan().toString()
    nothing = {n: t.where(F.lit(False)) for n, t in tables.items()}
    assert {r.shared_feis for r in P.fei_overlap(nothing).collect()} == {0}
