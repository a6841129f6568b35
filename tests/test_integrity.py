"""Repeated identities by key hashes, and rules that need no reading."""

from collections import Counter

from pyspark.sql import functions as F

from vigil.operators import integrity as I
from vigil.queries.ingest import unique_valid


def test_duplicates_equal_a_count_of_whole_keys(spark):
    rows = [(i % 40, None if i % 3 == 0 else f"k{i % 7}", None if i % 5 == 0 else f"d{i % 2}", "x") for i in range(200)]
    rows += [(1000, None, "a", "x"), (1000, "a", None, "x"), (1001, None, None, "x"), (1001, None, None, "y"), (None, "z", "z", "x"), (None, "z", "z", "y")]
    df = spark.createDataFrame(rows, "a long, b string, c string, __n string")
    got = {tuple(r)[:3]: r.duplicate_count for r in I.duplicate_identities(df, ("a", "b", "c")).collect()}
    assert got == {k: n for k, n in Counter(r[:3] for r in rows).items() if n > 1}
    assert (1000, None, "a") not in got and got[(None, "z", "z")] == 2


def test_one_hash_for_two_keys_stays_two_keys(spark, monkeypatch):
    # every key gets the same hash: the second step must tell them apart
    monkeypatch.setattr(I.F, "xxhash64", lambda *columns: F.lit(1).cast("long"))
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 2)], "k string, j int")
    assert [tuple(r) for r in I.duplicate_identities(df, ("k", "j")).collect()] == [("a", 1, 2)]


def test_the_first_exchange_carries_no_key_texts(spark):
    df = spark.range(0, 100, 1, 4).select(F.concat(F.lit("long text "), F.col("id") % 90).alias("k"), F.lit("other").alias("j"))
    out = I.duplicate_identities(df, ("k", "j"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.split("\n") if "Aggregate [__key" in line]
    assert counted and all("k#" not in line.split("[__key", 1)[1].replace("__key#", "") for line in counted)
    assert out.count() == 10


def test_unique_valid_drops_every_row_of_a_repeated_key(spark):
    none = F.array().cast("array<string>")
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 3), (None, None, 4), ("b", "y", 5)], "k string, j string, v int")
    df = df.withColumn("errors", F.when(F.col("v") == 5, F.array(F.lit("bad"))).otherwise(none))
    assert sorted(r.v for r in unique_valid(df, ("k", "j")).collect()) == [3, 4]
    assert unique_valid(df.where("v < 0"), ("k", "j")).columns == ["k", "j", "v"]


def test_rules_of_computed_columns_read_nothing(spark):
    tables = {"compliance_actions": spark.createDataFrame(
        [("1", "n" * 501, None, "c", "p", None, "Letter", "i")],
        "fei_number string, legal_name string, state string, country_area string, product_type string, action_taken_date date, action_type string, case_injunction_id string")}
    got = {(r.kind, r.rule): r.violations for r in I.violation_table(tables, computed=("hash",)).collect()}
    assert got[("max_length", "hash<=64")] == 0 and got[("not_null", "hash")] == 0
    assert got[("max_length", "legal_name<=500")] == 1 and got[("not_null", "action_taken_date")] == 1 and got[("check", "action_type_valid")] == 1
