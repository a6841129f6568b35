"""Letters told apart by the stream's keyed state: repeats, restarts, replays after a crash, seeds."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vigil.sources.sinks import current_state, read_current
from vigil.streaming import letters as SL

BASE = "https://www.fda.gov/"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: most of a test's time would go to empty shuffle partitions."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", held)


def cell(url, office="o", day="1/2/2024"):
    return [day, "1/1/2024", f'<a href="{url}">n</a>', office, "s"]


def land(scratch, name, batches):
    os.makedirs(os.path.join(scratch, "landing"), exist_ok=True)
    with open(os.path.join(scratch, "landing", name), "w") as fh:
        for batch, cells in batches:
            fh.write(json.dumps({"batch": batch, "payload": json.dumps({"data": cells})}) + "\n")


@pytest.fixture()
def pages(spark):
    urls = [f"{BASE}{c}" for c in "abcdef"]
    return spark.createDataFrame([(u, f"<main><h1>T {u[-1]}</h1>text {u[-1]}</main>") for u in urls], "url string, html string")


def run(spark, scratch, pages):
    SL.run_stateful(spark, os.path.join(scratch, "landing"), pages, os.path.join(scratch, "store"), BASE, checkpoint=os.path.join(scratch, "ckpt"))
    out = read_current(spark, os.path.join(scratch, "store"), SL.TABLE)
    return {} if out is None else {r.url[-1]: (r.issuing_office, r.title, r.first_seen_at) for r in out.collect()}


def test_repeats_restarts_and_new_letters(spark, scratch, pages):
    land(scratch, "1.json", [(0, [cell("/a", "first"), cell("/b")]), (1, [cell("/a", "last"), cell("/c")])])
    one = run(spark, scratch, pages)
    assert {k: v[:2] for k, v in one.items()} == {"a": ("last", "T a"), "b": ("o", "T b"), "c": ("o", "T c")}
    # a restart with nothing new changes nothing
    number = current_state(spark, os.path.join(scratch, "store"))["number"]
    assert run(spark, scratch, pages) == one and current_state(spark, os.path.join(scratch, "store"))["number"] == number
    # known letters that are listed again stay as they are; a new one is added, with its details
    land(scratch, "2.json", [(2, [cell("/b", "changed"), cell("/d")]), (3, [cell("/c", "changed"), cell("/x")])])
    two = run(spark, scratch, pages)
    assert {k: two[k] for k in "abc"} == one and two["d"][:2] == ("o", "T d") and two["x"][:2] == ("o", None)


def test_a_batch_that_was_cut_off_takes_effect_once(spark, scratch, pages, monkeypatch):
    land(scratch, "1.json", [(0, [cell("/a"), cell("/b")])])
    whole = SL.switch
    with monkeypatch.context() as m:  # published, then the driver dies before the stream commits the batch

        def publish_and_die(*args):
            whole(*args)
            raise RuntimeError("cut off")

        m.setattr(SL, "switch", publish_and_die)
        with pytest.raises(Exception, match="cut off"):
            run(spark, scratch, pages)
    store = os.path.join(scratch, "store")
    state, before = current_state(spark, store), sorted(map(str, read_current(spark, store, SL.TABLE).collect()))
    run(spark, scratch, pages)
    assert current_state(spark, store) == state and sorted(map(str, read_current(spark, store, SL.TABLE).collect())) == before
    with monkeypatch.context() as m:  # dies before publishing: the same rows come again

        def die(*args):
            raise RuntimeError("cut off")

        land(scratch, "2.json", [(1, [cell("/b"), cell("/c")])])
        m.setattr(SL, "switch", die)
        with pytest.raises(Exception, match="cut off"):
            run(spark, scratch, pages)
    assert set(run(spark, scratch, pages)) == {"a", "b", "c"}


def test_seeds_are_known_without_reading_the_store(spark, scratch, pages, monkeypatch):
    SL.write_seeds(pages.where(F.col("url").endswith("a") | F.col("url").endswith("b")), os.path.join(scratch, "landing"))
    land(scratch, "1.json", [(0, [cell("/a"), cell("/b"), cell("/c")])])
    monkeypatch.setattr(SL.L, "missing", None)  # no anti-join with the store
    assert set(run(spark, scratch, pages)) == {"c"}
