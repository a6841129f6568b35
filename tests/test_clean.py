"""Unit rows for the 2.B cleaning rules (input -> expected), including the Python-digest check of B10."""

import datetime as dt
import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import clean as C


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    out = fn(F.col("v"))
    if isinstance(out, C.Cleaned):
        return [(r[0], r[1]) for r in df.select(out.value, out.error).collect()]
    return [r[0] for r in df.select(out).collect()]


def test_optional_text(spark):
    got = _one(spark, ["  a ", "", "   ", None, " x　", "-", "N/A"], lambda c: C.optional_text(c, ("-", "n/a")))
    assert got == ["a", None, None, None, "x", None, None]


def test_identifier(spark):
    vals = ["3012457996.0", "007", "12.50", " 12 ", "123.000", "-5.0", "", None, "1.0e3"]
    got = _one(spark, vals, lambda c: C.optional_identifier(c).value)
    assert got == ["3012457996", "007", "12.50", "12", "123", "-5.0", None, None, "1.0e3"]


def test_identifier_from_double(spark):
    got = _one(spark, [3012457996.0, 12.5, float("nan"), None], lambda c: C.optional_identifier(c, __import__("pyspark").sql.types.DoubleType()).value, "double")
    assert got == ["3012457996", "12.5", None, None]


def test_integer(spark):
    got = _one(spark, ["12", "12.0", "12.50", "+5", "1_000", "abc", None], lambda c: C.optional_integer(c, "N"))
    assert [g[0] for g in got] == [12, 12, None, 5, 1000, None, None]
    assert got[2][1] == "N is not a whole number: '12.50'"
    assert got[5][1] == "N is not a whole number: 'abc'"
    assert got[6][1] is None


def test_date(spark):
    got = _one(spark, [" 2024-01-05", "1/5/2024", "2024-01-05 00:00:00", "N/A", "-", "", "bad", "2024-02-30", None],
               lambda c: C.optional_date(c, "D"))
    values = [g[0] for g in got]
    assert values[:3] == [dt.date(2024, 1, 5)] * 3
    assert values[3:6] == [None, None, None]
    assert got[6] == (None, "D is not a date: 'bad'")
    assert got[7][1] is not None
    assert got[8] == (None, None)


def test_boolean(spark):
    got = _one(spark, ["Yes", " POSTED ", "n", "Not Posted", "0", "maybe", "", None], lambda c: C.optional_boolean(c, "B"))
    assert [g[0] for g in got] == [True, True, False, False, False, None, None, None]
    assert got[5][1] == "B is neither yes nor no: 'maybe'"
    assert got[6][1] == "B is neither yes nor no: ''"


def test_classification_code(spark):
    got = _one(spark, ["No Action Indicated (NAI)", "vai", "Official Action (OAI)", "Pending", None],
               lambda c: C.classification_code(c).value)
    assert got == ["NAI", "VAI", "OAI", None, None]
    df = spark.createDataFrame([("Pending", " oai "), ("(NAI)", "bad"), ("(NAI)", "")], "t string, e string")
    r = df.select(*C.classification_code(F.col("t"), F.col("e"))).collect()
    assert [tuple(x) for x in r] == [("OAI", None), (None, "Classification Code is none of NAI, VAI, OAI"), ("NAI", None)]


def test_row_hash_matches_python(spark):
    rows = [("a\"b\\c\td", None, dt.date(2024, 1, 2), True, 7, "ñandú")]
    df = spark.createDataFrame(rows, "s string, n string, d date, b boolean, i long, u string")
    h = df.select(C.row_hash({c: F.col(c) for c in df.columns})).first()[0]
    payload = {"s": "a\"b\\c\td", "n": None, "d": "2024-01-02", "b": True, "i": 7, "u": "ñandú"}
    expect = hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert h == expect


def test_canonical_json_equals_python(spark):
    rng = random.Random(7)
    alphabet = ['"', "\\", "\n", "\t", "\b", "\f", "\r", "\x00", "\x0b", "\x0e", "\x1f", "\x7f", "u", "0", "a", "é", "\u2028", "\U0001f600", "/", "<", " "]
    texts = ["", None, "\\u000B", "plain", "ñandú", *("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(300)), "x\ny" * 20000]
    rows = [(t, rng.choice(texts[:4]), rng.choice([None, 0, -7, 2**62]), rng.choice([None, True, False]), rng.choice([None, dt.date(1, 1, 1), dt.date(2024, 12, 31)])) for t in texts]
    df = spark.createDataFrame(rows, "`b\"q` string, a string, i long, f boolean, d date")
    got = df.select(C.canonical_json({c: F.col(f"`{c}`") for c in df.columns}, {c: df.schema[c].dataType for c in df.columns}).alias("j")).collect()
    for row, g in zip(rows, got):
        values = dict(zip(df.columns, row))
        if values["d"] is not None:
            values["d"] = values["d"].isoformat()
        assert g.j == json.dumps(values, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_canonical_json_refuses_what_it_cannot_write_alike(spark):
    with pytest.raises(TypeError):
        C.canonical_json({"x": F.lit(1.5)}, {"x": T.DoubleType()})
    assert spark.range(1).select(C.canonical_json({}, {})).first()[0] == "{}"


def test_loader_hash_has_no_generic_json(spark):
    from vigil.operators.loaders import load
    from vigil.sources.catalog import Catalog, raw_extract

    plan = load(raw_extract(Catalog(spark, "/root/testdata/sf0.001"), "inspections"), "inspections")._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan and "to_json" not in plan and "structstojson" not in plan.lower()


@pytest.mark.parametrize("ch", [" ", "\t", " ", " ", "　", "\x1f"])
def test_strip_matches_python(spark, ch):
    s = f"{ch}{ch}x y{ch}"
    got = _one(spark, [s], C.py_strip)
    assert got == [s.strip()]


def test_short_cuts_of_the_rules_change_no_cell(spark):
    """Texts that the cheap checks let pass or send on: visible ends, odd spaces, other scripts, tokens, whole decimals."""
    edges = ["", " ", "a", " a", "a ", "a b", "　a", "a ", "\x7fa", "a\x7f", "~", "!", "\x1ca\x1f", "é", "né", "éa", "İ", "日本", "0", "00", ".0", "0.0", "7.00", "7.0 ", "a.0", "1_0", "1.50", None]
    raw = [("-",), ("NONE",), (" n/a ",), ("NULLS",), ("nai",), ("Nai ",), ("ΝΑΙ",)] + [(e,) for e in edges]
    df = spark.createDataFrame(raw, "x string")
    got = df.select(
        "x", C.py_strip("x").alias("s"), C.optional_text("x", ("-", "none")).alias("t"), C.optional_identifier("x").value.alias("i"),
        C.optional_integer("x", "N").value.alias("n"), C.optional_date("x", "D").error.alias("d"), C.classification_code("x", "x").value.alias("c"),
    ).collect()
    for r in got:
        s = None if r.x is None else r.x.strip()
        text = s or None
        whole = text[: text.index(".")] if text and re.fullmatch(r"[0-9]+\.0+", text) else text
        assert r.s == s
        assert r.t == (None if text is None or text.lower() in ("-", "none") else text)
        assert r.i == whole
        assert r.n == (int(whole) if whole and re.fullmatch(r"[+-]?[0-9]+(_[0-9]+)*", whole) else None)
        assert (r.d is None) == (s is None or s == "" or s.lower() in C.DATE_NULL_TOKENS)
        assert r.c == (text.upper() if text and text.upper() in C.CODES else None)


def test_a_condition_on_the_errors_is_no_interpreted_filter(spark):
    """Rows without a message are told by their messages; only the others go through the interpreted ``filter``."""
    df = spark.createDataFrame([("a", None), (None, None), ("b", "c")], "p string, q string").select(C.errors_array(F.col("p"), F.col("q")).alias("errors"))
    assert [r.errors for r in df.collect()] == [["a"], [], ["b", "c"]]
    plan = df.where(F.size("errors") > 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(coalesce(" in plan


def test_a_condition_on_the_errors_runs_no_rule_again(spark):
    """The rules of the bad rows' filter are read from the staged messages."""
    from vigil.operators.loaders import DATASETS, apply_policy, load

    headers = [f.headers[0] for f in DATASETS["published483"].fields]
    raw = spark.createDataFrame([("1", "Firm", "2020-01-02", "483", "2020-02-01", "f", "7"), ("2", "Firm", "no day", "483", "2020-02-01", "f", "8")], headers)
    good, bad = apply_policy(load(raw, "published483"), "quarantine")
    assert [r.record_id for r in good.collect()] == ["7"] and [r.record_id for r in bad.collect()] == ["8"]
    conditions = [x for x in bad._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert not any("gettimestamp" in x for x in conditions)
