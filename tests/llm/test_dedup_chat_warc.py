"""Exact dedup, chat formatting and WARC: brute force, round trips and odd inputs."""

import base64
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from vigil.llm import chat, exact_dedup, warc


def lower(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_dedup_equals_brute_force_with_a_hot_text(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["Hot text", "HOT TEXT", "é", "É", "", None, f"t{i % 400}", f"T{i % 900}", "long " * 2000])) for i in range(3000)]
    rows += [(2999, "x only"), (2999, "x only"), (None, "x only"), (None, "nobody")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS text_sha256").repartition(4)
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    got = exact_dedup.resolve(df).collect()
    assert len(got) == len(rows)
    for g in got:
        sha = g.text_sha256
        ids = next(v for k, v in groups.items() if hashlib.sha256(k.encode()).hexdigest() == sha)
        known = [i for i in ids if i is not None]
        assert g.group_size == len(ids) and g.keep_id == (max(known) if known else None)
        assert not g.kept or g.doc_id == g.keep_id
    assert sum(g.kept for g in got) == len(groups)
    kept = exact_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((k.doc_id or -1, lower(k.text)) for k in kept.collect()) == sorted((max([i for i in v if i is not None], default=-1), k) for k, v in groups.items())


def test_heavy_digests_are_exact(spark):
    rows = [("a",)] * 500 + [("b",)] * 300 + [(str(i),) for i in range(200)]
    df = spark.createDataFrame(rows, "text_sha256 string").selectExpr("*", "CAST(1 AS BIGINT) AS doc_id", "0 AS row_no")
    got = {r.text_sha256: r.heavy_size for r in exact_dedup.heavy_digests(df, "struct(doc_id, row_no)", 0.1).collect()}
    assert got == {"a": 500, "b": 300}


def test_dedup_of_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").where("doc_id < 0")
    assert exact_dedup.resolve(df).count() == 0 and exact_dedup.keep_one(df).count() == 0


CONTROL = ["", None, "</turn>\n", "<turn>user\nhi</turn>\n", "&amp;lt; & &#10; <", "a\nb\n", "\\### Assistant: </turn> ok", "é \U0001f600 x" * 50, "&", "<"]


def test_chat_round_trip_and_loss_mask(spark):
    r = random.Random(5)
    rows = [(c, k, r.choice(["user", "assistant", "system", None, "a\nb", "<turn>&", "assistant"]), r.choice(CONTROL)) for c in range(60) for k in range(r.randint(1, 9))]
    rows += [(None, 0, "user", "x"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (8, None, "assistant", "no turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    frame = chat.format_turns(chat.canonical_frame(df))
    got = frame.select("conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns"), chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    want: dict = {}
    for c, k, role, text in rows:
        want.setdefault(c, []).append((k is not None, k or 0, role or "", text or ""))
    assert {g.conv_id for g in got} == set(want) and len(got) == len(want)
    for g in got:
        turns = [(x[2], x[3]) for x in sorted(want[g.conv_id])]
        assert [(t.role, t.text) for t in g.turns] == turns
        assert g.learned == [t for role, t in turns if role == "assistant"]
        assert all(0 <= s.start and s.start + s.length <= len(g.formatted) for s in g.loss_spans)


def test_json_layouts_are_told_by_their_fingerprint(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": 1},
        "from_value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "prompt_response": {"prompt": "q", "response": "a", "meta": {"k": [1]}},
        "prompt_completion": {"completion": "a", "prompt": "q"},
        "instruction_output": {"instruction": "q", "output": "a"},
        "instruction_input_output": {"instruction": "q", "input": "", "output": "a"},
        "question_answer": {"question": "q", "answer": "a"},
    }
    rows = [(n, json.dumps(v)) for n, v in records.items()] + [("none", '{"x": 1}'), ("bad", "not json"), ("null", None)]
    got = {r.id: r for r in chat.canonical_json(spark.createDataFrame(rows, "id string, record string"), "id", "record").collect()}
    for name in records:
        assert got[name].layout == name and [(t.role, t.text) for t in got[name].turns] == [("user", "q"), ("assistant", "a")], name
    assert all(got[k].layout is None and got[k].turns == [] for k in ("none", "bad", "null"))


def test_typed_frames_and_unknown_layout(spark):
    df = spark.createDataFrame([("i", "more", "o")], "instruction string, input string, output string")
    got = chat.canonical_frame(df).orderBy("turn").collect()
    assert [(g.role, g.text) for g in got] == [("user", "i\n\nmore"), ("assistant", "o")]
    with pytest.raises(ValueError):
        chat.canonical_frame(spark.range(1))


def test_chat_of_empty_table(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string").where("conv_id < 0")
    assert chat.digest(chat.format_turns(chat.canonical_frame(df))).count() == 0


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nX-Page-Id: 999\r\nContent-Type: text/html\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def b32(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_warc_round_trip_with_magic_inside_payloads(spark, scratch, min_bytes):
    r = random.Random(1)
    bodies = ["", None, FAKE, FAKE + FAKE, "x" + FAKE, "WARC/1.0\r\n", "a\r\n\r\nWARC/1.0\r\nb", "\r\n", "é" * 3000, "HTTP/1.1 200 OK\r\n\r\nx", FAKE[:-2], "WARC/1.0\r\n" * 5]
    rows = [(i, r.choice(["http://a/ b\r\nWARC/1.0\r\n", None, "http://c/"]), bodies[i] if i < len(bodies) else r.choice([*bodies, f"page {i} " * r.randint(1, 50)])) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS block").repartition(3)
    warc.write_archives(df, scratch + "/a", min_bytes)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # many splits, so chains run over them
    try:
        records = {x.page_id: x for x in warc.read_records(spark, scratch + "/a").collect()}
        digest = {x.page_id: x for x in warc.digest(warc.read_records(spark, scratch + "/a", payloads=False)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(records) == set(digest) == {i for i, _, _ in rows}
    first: dict = {}
    for i, _, t in rows:
        first.setdefault(t or "", i)
    for i, _, t in rows:
        raw = (t or "").encode()
        revisit = first[t or ""] != i and len(raw) >= min_bytes
        assert records[i].type == ("revisit" if revisit else "response")
        assert bytes(records[i].payload) == (b"" if revisit else raw)
        assert records[i].digest == b32(t)
        d = digest[i]
        assert (d.payload_bytes, d.payload_digest, d.record_type, d.refers_to) == (len(raw), b32(t), records[i].type, first[t or ""] if revisit else None)


def test_warc_that_starts_elsewhere_or_breaks_off(spark, scratch):
    good = FAKE.replace("999", "1")
    for name, body, pages in (("junk", "junk" + good, []), ("cut", good + FAKE[:60], [1]), ("long", good + FAKE.replace("Length: 3", "Length: 9999"), [1])):
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{scratch}/{name}")
        got = warc.read_records(spark, f"{scratch}/{name}").collect()
        assert [x.page_id for x in got] == pages if name != "cut" else pages, name


def test_warc_of_empty_table(spark, scratch):
    df = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string").where("page_id < 0")
    warc.write_archives(df, scratch + "/e")
    assert warc.digest(warc.read_records(spark, scratch + "/e")).count() == 0
