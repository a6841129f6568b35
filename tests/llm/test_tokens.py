"""Token counts, byte-level BPE and packing against the libraries and brute force."""

import base64
import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest

from vigil.llm import bpe, packing, pieces, token_counts

HF = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = [*"ab c  \n\t\r\x0b\x0c\x85\xa0\x1c\x1fAé1²'s'll!?|你ñ 　՘\U0001f600", "<|endoftext|>", "  ", "\n ", " \n", "'re", "the ", " of"]


def texts(n=1500, seed=3):
    r = random.Random(seed)
    made = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return [*made, "", " ", "a" * 5000, "xyz" * 2000, " " * 1500, "word " * 4000, None]


@pytest.fixture(scope="module")
def hf():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(HF)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda x: e.encode_ordinary(x or "")


def frame(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)


def test_encoder_equals_library_with_tiny_caches(hf):
    backend = pieces.HfBackend(HF)
    for chunks, keep in ((5, 5), (10_000, 10_000)):
        encoder = pieces.TextEncoder(backend.pieces, backend.text, chunks, keep)
        for _ in range(2):
            rows = [t or "" for t in texts()]
            assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in encoder(rows)] == [hf(t) for t in rows]
        assert len(encoder.chunk) <= chunks and len(encoder.piece) <= keep


def test_merging_by_rank_is_proven_to_be_the_library(hf):
    from tokenizers import Tokenizer

    ranks = pieces.mergeable_ranks(Tokenizer.from_file(HF))
    assert len(ranks) == 50_256 and sorted(ranks.values()) == list(range(50_256))
    backend = pieces.HfBackend(HF)
    assert backend.merge is not None
    r = random.Random(4)
    words = [" " * r.randint(0, 1) + "".join(r.choice("abcdeéñßthinger") for _ in range(r.randint(1, 14))) for _ in range(20_000)]
    assert list(backend.pieces(words)) == [hf(w) for w in words]
    # a word-level vocabulary with word ends is no such case
    assert pieces.mergeable_ranks(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))) is None


def test_token_counts(spark, hf):
    rows = texts()
    df = frame(spark, rows).selectExpr("*", "'x' AS n_tokens", "1 AS other")
    got = {r.doc_id: r for r in token_counts.count_tokens(df, HF).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        n = len(hf(t))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit, got[i].other) == (n, len((t or "").encode()), n > 1024, 1)


def test_token_counts_of_empty_table(spark):
    assert token_counts.count_tokens(frame(spark, ["a"]).where("doc_id < 0"), HF).count() == 0


def test_frequent_pieces_finds_the_common_ones(spark):
    found = token_counts.frequent_pieces(frame(spark, ["the cat and the dog"] * 50 + ["rare"])).collect()
    assert {" the", " cat", "the"} <= {r.piece for r in found}


def test_bpe_digest_and_decoding(spark, tik):
    rows = texts(seed=8)
    got = {r.doc_id: r for r in bpe.encode_digest(frame(spark, rows), RANKS).collect()}
    for i, t in enumerate(rows):
        ids = tik(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    full = {r.doc_id: r for r in bpe.encode(frame(spark, rows[:50]), RANKS).collect()}
    assert all(bytes(full[i].decoded) == (rows[i] or "").encode() for i in full)


def test_replay_equals_merging_each_word_alone(tmp_path):
    # a vocabulary in which later merges open pairs of lower rank
    toks = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"cd", b"ab", b"bcd", b"aa", b"aaa", b"da"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(toks)))
    m = bpe.Merges(str(path))
    r = random.Random(1)
    words = list({"".join(r.choice("abcd") for _ in range(r.randint(1, 12))) for _ in range(3000)})
    for w, ids in zip(words, m.replay(words)):
        raw = w.encode()
        assert ids == ([m.ranks[raw]] if raw in m.ranks else m.alone(raw)), w


def naive_best_fit(lengths, capacity):
    """One document after the other into the tightest open bin."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(60))
def test_plan_gives_the_bins_of_one_by_one_placement(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 16, 50, 101])
    lengths = [r.randint(1, capacity - 1) for _ in range(r.randint(0, 200))] + [r.randint(1, capacity - 1)] * r.randint(0, 50)
    histogram = {n: lengths.count(n) for n in set(lengths)}
    fill: dict[int, list] = {}
    for length, rank, n, first, per_bin, offset in packing.plan(histogram, capacity):
        for i in range(n):
            fill.setdefault(first + i // per_bin, []).append((offset + i % per_bin * length, length))
    placed = []
    for cells in fill.values():
        at = 0
        for start, length in sorted(cells):
            assert start == at
            at += length
            placed.append(length)
        assert at <= capacity
    assert sorted(placed) == sorted(lengths)
    assert sorted(capacity - sum(n for _, n in c) for c in fill.values()) == naive_best_fit(lengths, capacity)


def test_tightest_fit_tree():
    tree = packing.TightestFit(10)
    for r in (3, 7, 10):
        tree.add(r, 1)
    assert [tree.find(n) for n in (1, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    tree.add(10, -1)
    assert tree.find(8) == -1


def test_packing_pieces(spark, hf):
    rows = texts(300) + ["same text here"] * 400
    got = packing.pack(frame(spark, rows), HF).collect()
    by_doc: dict = {}
    by_seq: dict = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(rows)))
    lengths = []
    for i, t in enumerate(rows):
        ids = [*hf(t), 2]
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        at = 0
        for r in parts:
            assert r.start == at
            raw = struct.pack(f"<{r.length}I", *ids[at : at + r.length])
            assert r.ids_crc32 == zlib.crc32(raw) and bytes(r.ids) == raw
            at += r.length
            lengths.append(r.length)
        assert at == len(ids) and all(r.length == 1024 for r in parts[1:])
        assert len(parts) == -(-len(ids) // 1024)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    full = sum(n == 1024 for n in lengths)
    assert len(by_seq) == full + len(naive_best_fit([n for n in lengths if n < 1024], 1024))


def test_packing_of_empty_table(spark):
    assert packing.pack(frame(spark, ["a"]).where("doc_id < 0"), HF).count() == 0
