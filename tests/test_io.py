"""Keyed merge, versioned pipelines, letter parsing and the streaming ingestion."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vigil.operators import letters as L
from vigil.sources.sinks import keyed_merge

TS = "timestamp_ntz"


def test_upsert_is_idempotent_and_null_safe(spark):
    stored = spark.createDataFrame([(1, None, "old", None, None)], "k long, k2 string, v string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz")
    inc = spark.createDataFrame([(1, None, "new"), (2, "x", "two")], "k long, k2 string, v string")
    now = F.lit("2024-01-01 00:00:00").cast(TS)
    once = keyed_merge(stored, inc, ("k", "k2"), ("v",), now=now)
    twice = keyed_merge(once, inc, ("k", "k2"), ("v",), now=now)
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in twice.collect())
    assert a == b and len(a) == 2  # NULL key matched (no re-insert)
    assert {r[2] for r in a} == {"new", "two"}


def test_keep_existing_details(spark):
    stored = spark.createDataFrame([("u", "T", "C")], "url string, title string, content string").withColumns(
        {"first_seen_at": F.lit(None).cast(TS), "last_seen_at": F.lit(None).cast(TS)})
    inc = spark.createDataFrame([("u", None, "C2")], "url string, title string, content string")
    r = keyed_merge(stored, inc, ("url",), ("title", "content"), now=F.lit("2024-01-01").cast(TS),
                    keep_existing=("title", "content")).first()
    assert r["title"] == "T" and r["content"] == "C2"


def test_fragment_text_and_detail(spark):
    df = spark.createDataFrame([(
        "u", '<html><main><h1> Title &amp; more </h1><script>x=1</script><p>one</p>  <p> two &copy;</p><!-- c --></main></html>')],
        "url string, html string")
    r = L.parse_detail(df, "main").first()
    assert r["title"] == "Title & more"
    assert r["content"] == "Title & more\none\ntwo ©"
    missing = spark.createDataFrame([("u", "<html><body>none</body></html>")], "url string, html string")
    r2 = L.parse_detail(missing, "main").first()
    assert r2["title"] is None and r2["content"] is None


def _clean_raw(spark, part=None):
    """Raw extracts without the adapter's planted faults: valid rows, one per identity key; ``part`` keeps one half."""
    from vigil.operators.loaders import DATASETS, load
    from vigil.sources.catalog import Catalog, raw_extract

    cat = Catalog(spark, "/root/testdata/sf0.001")
    raw = {}
    for d, ds in DATASETS.items():
        extract = raw_extract(cat, d).dropDuplicates()
        numbered = extract.withColumn("n", F.xxhash64(*extract.columns))
        loaded = load(numbered.drop("n"), d, hashed=True)
        keys = loaded.where(F.size("errors") == 0).groupBy(*ds.key).count().where("count = 1").drop("count")
        typed = loaded.where(F.size("errors") == 0).join(keys, list(ds.key), "left_semi") if all(True for _ in ds.key) else loaded
        # back to headers: the loaders accept typed cells as well
        raw[d] = typed.select(*[F.col(f.name).alias(f.headers[0]) for f in ds.fields if f.kind != "code"], F.col("hash").alias("n"))
        if part is not None:
            raw[d] = raw[d].where((F.substring("n", 1, 1) < "8") if part == 0 else (F.substring("n", 1, 1) >= "4"))
        raw[d] = raw[d].drop("n")
    return raw


def _stored(spark, store):
    from vigil.operators.loaders import DATASETS
    from vigil.sources.sinks import read_current

    return {d: sorted(map(str, (tuple(r) for r in read_current(spark, store, d).drop("last_seen_at", "first_seen_at").collect()))) for d in DATASETS}


def test_ingest_refuses_bad_rows_and_duplicates_before_publishing(spark, scratch):
    from vigil.plans import pipelines as P
    from vigil.operators.loaders import DATASETS
    from vigil.sources.catalog import Catalog, raw_extract
    from vigil.sources.sinks import current_state, empty_state

    cat = Catalog(spark, "/root/testdata/sf0.001")
    raw = {d: raw_extract(cat, d) for d in DATASETS}
    store = os.path.join(scratch, "store")
    with pytest.raises(P.BadRowsError):
        P.ingest_all(spark, raw, store, "v1")
    with pytest.raises(P.DuplicateIdentityError):
        P.ingest_all(spark, raw, store, "v1", mode="quarantine")
    assert current_state(spark, store) == empty_state()


def test_ingest_twice_is_idempotent_and_merges_by_key(spark, scratch):
    from vigil.plans import pipelines as P

    store = os.path.join(scratch, "store")
    first = P.ingest_all(spark, _clean_raw(spark, 0), store, "v1")
    assert all(c["loaded"] == c["stored"] > 0 for c in first.values())
    once = _stored(spark, store)
    again = P.ingest_all(spark, _clean_raw(spark, 0), store, "v1")  # the same label: nothing published is overwritten
    assert _stored(spark, store) == once and {d: c["stored"] for d, c in again.items()} == {d: c["stored"] for d, c in first.items()}
    P.ingest_all(spark, _clean_raw(spark, 1), store, "v2")
    both, whole = _stored(spark, store), os.path.join(scratch, "whole")
    P.ingest_all(spark, _clean_raw(spark), whole, "v1")
    assert both == _stored(spark, whole)


def _keyed(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def test_a_run_that_fails_before_or_while_switching_changes_nothing(spark, scratch):
    from vigil.sources import sinks as S

    store = os.path.join(scratch, "s")
    entry = S.merge_table(spark, store, "t", None, _keyed(spark, [(i, "old") for i in range(50)]), ("k",), ("v",), "v1")
    state = S.switch(spark, store, S.empty_state() | {"tables": {"t": entry}})

    def values():
        return {r.k: r.v for r in S.read_current(spark, store, "t").collect()}

    # written but never switched
    S.merge_table(spark, store, "t", entry, _keyed(spark, [(1, "new")]), ("k",), ("v",), "v1")
    assert values() == {i: "old" for i in range(50)}
    # a write that fails half way leaves the published folders alone
    with pytest.raises(Exception, match="no such row"):
        S.merge_table(spark, store, "t", entry, _keyed(spark, [(1, "new")]).withColumn("v", F.raise_error(F.lit("no such row")).cast("string")), ("k",), ("v",), "v1")
    assert values() == {i: "old" for i in range(50)}
    # a pointer that was begun and never completed is not the newest
    os.makedirs(f"{store}/_pointers/{99:020d}-broken")
    assert values() == {i: "old" for i in range(50)}
    # only touched buckets are rewritten
    new = S.merge_table(spark, store, "t", state["tables"]["t"], _keyed(spark, [(1, "new"), (77, "new")]), ("k",), ("v",), "v2")
    S.switch(spark, store, state | {"tables": {"t": new}})
    assert values() == {i: "old" for i in range(50)} | {1: "new", 77: "new"}
    assert sum(p != entry["buckets"].get(b) for b, p in new["buckets"].items()) <= 2


def test_an_unreadable_pointer_is_an_error(spark, scratch):
    from vigil.sources import sinks as S

    store = os.path.join(scratch, "s")
    S.switch(spark, store, S.empty_state())
    (name,) = [n for n in os.listdir(f"{store}/_pointers")]
    for f in os.listdir(f"{store}/_pointers/{name}"):
        if f.startswith("part-"):
            with open(f"{store}/_pointers/{name}/{f}", "w") as out:
                out.write("{not json")
        elif f.startswith("."):
            os.remove(f"{store}/_pointers/{name}/{f}")
    with pytest.raises(ValueError):
        S.current_state(spark, store)


def test_feature_build_and_training(spark, scratch, monkeypatch):
    from vigil.plans import pipelines as P
    from vigil.plans.features import FeaturePlan
    from vigil.sources.catalog import Catalog
    from vigil.sources.sinks import current_state

    cat = Catalog(spark, "/root/testdata/sf0.001")
    store = os.path.join(scratch, "store")
    n = P.build_features(spark, cat, store, "f1")
    assert n == FeaturePlan(cat).events.count() == P.load_training_data(spark, store).count()
    before = current_state(spark, store)
    with monkeypatch.context() as m:  # a snapshot that lacks rows is refused and not published
        whole = FeaturePlan.features
        m.setattr(FeaturePlan, "features", lambda self, *a, **k: whole(self, *a, **k).where("inspection_id % 2 = 0"))
        with pytest.raises(P.FeatureBuildError, match="inspections"):
            P.build_features(spark, cat, store, "f1")
    assert current_state(spark, store) == before
    rows = [tuple(r) for r in P.ordered_training_data(spark, store).select("prediction_date", "inspection_id").collect()]
    assert rows == sorted(rows)
    result = P.train_run(spark, store, os.path.join(scratch, "artifact"))
    assert 0.0 <= result.metrics["roc_auc"] <= 1.0
    assert os.path.isdir(os.path.join(scratch, "artifact", "pipeline"))
    meta = spark.read.json(os.path.join(scratch, "artifact", "metadata")).first()
    assert json.loads(meta["metadata"])["threshold"] == 0.5


def test_export_csv(spark, scratch):
    from vigil.sources.sinks import export_csv

    export_csv(spark.createDataFrame([("a", 1.5), (None, 2.0)], "name string, value double"), scratch + "/out")
    back = spark.read.option("header", True).csv(scratch + "/out").collect()
    assert sorted((r["name"], r["value"]) for r in back if r["name"]) == [("a", "1.5")] and len(back) == 2


def test_streaming_letters_with_replay_and_repeats(spark, scratch):
    from vigil.streaming.letters import TABLE, process_batch, run_available
    from vigil.sources.sinks import current_state, read_current

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    landing = os.path.join(scratch, "landing")
    L.listing_fixture(pages).write.json(landing)
    store = os.path.join(scratch, "letters")
    landed = L.landed_pages(pages)
    run_available(spark, landing, landed, store, "https://www.fda.gov/", root="article", checkpoint=os.path.join(scratch, "ckpt"))
    listed = L.dedup_seen(L.listing_rows(L.listing_fixture(pages), "https://www.fda.gov/"))
    out = read_current(spark, store, TABLE)
    assert out.count() == listed.select("url").distinct().count() < listed.count()  # a URL listed twice is one letter
    assert out.where(F.col("title").isNull()).count() == 0
    # a replayed batch id changes nothing, also when its payload differs
    state, rows = current_state(spark, store), sorted(map(str, out.collect()))
    twice = spark.createDataFrame([(0, json.dumps({"data": [["1/2/2024", "1/1/2024", '<a href="https://a/b">x</a>', "o", "s"]] * 2}))], "batch long, payload string")
    assert process_batch(spark, twice, landed, store, state["applied"]["letters"], "https://www.fda.gov/", "article") == state
    assert sorted(map(str, read_current(spark, store, TABLE).collect())) == rows
    # the next id is applied: the URL that its payload has twice is stored once; elsewhere the guard refuses it
    process_batch(spark, twice, landed, store, state["applied"]["letters"] + 1, "https://www.fda.gov/", "article", host="www.fda.gov")
    assert read_current(spark, store, TABLE).count() == len(rows)
    process_batch(spark, twice, landed, store, state["applied"]["letters"] + 2, "https://www.fda.gov/", "article")
    assert read_current(spark, store, TABLE).where("url = 'https://a/b'").count() == 1


def test_stop_rule_known_batches_short_batches_and_gaps(spark):
    schema = "batch long, returned long, missing long"
    b = spark.createDataFrame([(0, 10, 3), (1, 10, 0), (2, 10, 0), (3, 10, 0), (4, 10, 2)], schema)
    got = sorted((r["batch"], r["consecutive_known"], r["stopped_here"]) for r in L.stop_rule(b, 2).collect())
    assert got == [(0, 0, False), (1, 1, False), (2, 2, True)]
    short = spark.createDataFrame([(0, 10, 1), (1, 7, 0), (2, 10, 0)], schema)
    assert sorted(r["batch"] for r in L.stop_rule(short, 5).collect()) == [0, 1]
    gap = spark.createDataFrame([(0, 10, 1), (1, 10, 1), (3, 10, 0)], schema)
    rows = L.stop_rule(gap, None).collect()
    assert sorted(r["batch"] for r in rows) == [0, 1] and not any(r["stopped_here"] for r in rows)


def test_a_landed_batch_without_usable_rows_ends_the_run(spark):
    rows = spark.createDataFrame([(1, 0, "u")], "batch long, row_index int, url string")
    payloads = spark.createDataFrame([(0, "{}"), (1, "{}")], "batch long, payload string")
    table = L.batch_table(payloads, rows, rows)
    assert sorted(tuple(r) for r in table.collect()) == [(0, 0, 0), (1, 1, 1)]
    assert [tuple(r) for r in L.stop_rule(table, 2).select("batch", "stopped_here").collect()] == [(0, True)]
