"""The corpus pipeline stage by stage against brute force, and on odd tables."""

import random
import struct
import zlib

import public_tokenizers
import pytest

import corpus_pipeline as cp
from tests.llm.test_ngram_join import brute
from vigil.llm import exact_dedup, quality, toxicity
from vigil.llm.common import table

SF = "/root/testdata/sf0.01"
EXTRA = ["kept", "score", "text_sha256", "sid", "class_id", "sequence_id", "n_words"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """sf0.01 documents with nulls, repeated rows and columns that clash with those the operators add."""
    path = str(tmp_path_factory.mktemp("pipe"))
    docs = table(spark, SF, "documents").where("doc_id < 400").selectExpr("*", *[f"doc_id AS {c}" for c in EXTRA])
    good = " ".join(f"word{i} and other{i % 17} things." for i in range(40))
    rows = [(9001, good, "en", "s", 1), (9002, good.upper(), None, None, None), (9002, good.upper(), None, None, None), (9003, None, "en", "s", 0), (None, good + " more", "en", "s", 0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *[f"doc_id AS {c}" for c in EXTRA])
    docs.unionByName(odd).repartition(3).write.parquet(path + "/documents.parquet")
    table(spark, SF, "labels").write.parquet(path + "/labels.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    labels = table(spark, folder, "labels")
    crf, columns = quality.train(docs, labels), docs.columns
    step = {}
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == columns
        before = [tuple(r) for r in docs.collect()]
        out.write.parquet(f"{folder}/{k}")
        if name == "toxicity":
            net = toxicity.train(docs, labels)
        docs = spark.read.parquet(f"{folder}/{k}")
        after = [tuple(r) for r in docs.collect()]
        assert set(after) <= set(before)
        step[name] = before, after
    key = lambda rows: sorted(map(repr, rows))
    at, text = columns.index("doc_id"), columns.index("text")

    before, after = step["quality_rules"]

    def good(t):
        r = quality.read(t or "")
        return r.n_words >= 50 and 100 * r.n_repeat_words <= 50 * r.n_words and quality.content_share(crf, r) >= 0.5

    assert key(after) == key([r for r in before if good(r[text])])
    before, after = step["toxicity"]
    scores = toxicity.text_scores(net, [r[text] or "" for r in before])
    assert key(after) == key([r for r, s in zip(before, scores) if s < 0.7])
    assert len(after) < len(before)
    before, after = step["exact_dedup"]
    low = [(r[text] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for r in before]
    best: dict = {}
    for r, t in zip(before, low):
        best[t] = max(best.get(t, -1), -1 if r[at] is None else r[at])
    assert sorted(-1 if r[at] is None else r[at] for r in after) == sorted(best.values()) and len(after) == len(best)
    before, after = step["ngram_jaccard_join"]
    named = [(10**9 if r[at] is None else r[at], r[text]) for r in before]
    keep = {c for c, *_ in brute(named).values()}
    assert sorted(10**9 if r[at] is None else r[at] for r in after) == sorted(keep)

    # the packed pieces are the remaining texts' tokens
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = cp.STAGES[-1][1](spark, docs, folder).collect()
    want = []
    for r in after:
        ids = [*tok.encode(r[text] or "", add_special_tokens=False).ids, 2]
        cuts = range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)
        starts = [0, *cuts][: len(cuts)]
        want += [(r[at], a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for a, b in zip(starts, cuts)]
    assert key([(p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces]) == key(want)
    run = cp.run(spark, folder).collect()
    assert key([(p.doc_id, p.start, p.length, p.ids_crc32) for p in run]) == key(want)


def test_empty_documents_and_no_labels(spark, folder, tmp_path):
    docs = spark.read.parquet(folder + "/documents.parquet")
    docs.where("doc_id < 0").write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, folder, "labels").where("doc_id < 0").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs.where("doc_id < 0"), str(tmp_path)).columns == docs.columns
    # without labels nothing can be learned: the prior weights decide on quality, and nothing is toxic
    assert cp.STAGES[1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_entry_registers_what_is_here():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_heavy_share_of_one_text(spark):
    r = random.Random(3)
    rows = [(i, "the same text") for i in range(2000)] + [(5000 + i, f"text {r.random()}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = exact_dedup.keep_one(df)
    assert kept.count() == 4001 and kept.where("text = 'the same text'").first().doc_id == 1999
