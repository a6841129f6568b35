"""Language-model scoring with a weighted backoff automaton over words.

Model: words (and the end of a text) with add-one smoothing; on top, bigrams and trigrams with absolute discounting,
interpolated with the shorter history. Kept are all n-grams seen at least ``LEAST`` times in the training texts, at
every corpus size, so the model grows with the corpus. A kept history is a state: its arcs carry log-probabilities, its
failure arc the weight of the shorter history. The state before a word is the longest history that is one, so all words of
a block step together; those without an arc follow failure arcs until they have one or the history is empty.

Nothing of the model is broadcast or collected; each block gets what it contains and builds its automaton from that:
1. texts are dealt into blocks of about ``BLOCK_BYTES`` by the hash of their id; a block counts its words and its n-grams
   (64-bit keys, sorted, in one array per bucket of keys).
2. a bucket sums the counts over all blocks and answers every block with the totals of the keys it sent, in the order it sent
   them, and with the keys that it was the first to send.
3. a block reports the kept n-grams that it was the first to send to their histories: it sums them by history and sends the sums
   with the keys of all its kept words and bigrams, again in one array per bucket.
4. a bucket sums these over all blocks and answers as before; the block scores its texts.
Buckets grow in number with the blocks, so that none outgrows a task; an n-gram has one entry per block, however frequent. No
entry carries the key of its history, and sorted keys are stored by their differences; the shuffle files of a step go when it ends.

Defined cases: null text = empty = the end token alone; a null doc_id is learned from; without training texts every
probability is 1; equal rows score alike; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.common import tidy, tidy_group, with_python
from vigil.session import set_aside

LEAST = 2  # occurrences in the training texts from which an n-gram is kept
BUCKETS = 128  # at least, and two per block
BLOCK_BYTES = 12_000_000
DISCOUNT = 0.75
END = b""  # the end of a text as a word
BEGIN_HASH = np.uint64(0x5851F42D4C957F2D)
HASH_SEED = 42  # the seed of Spark's xxhash64


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text is 2 modulo 7."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    """Words (runs without ASCII white space, A-Z lower-cased)."""
    return (text or "").encode("utf-8").lower().split()


def word_hash(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, HASH_SEED) for w in words], dtype=np.uint64)


def ngram_key(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit key of aligned word hashes."""
    key = np.full(parts[0].shape, len(parts), dtype=np.uint64)
    for part in parts:
        key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


BEGIN = 0  # numbers of a text's begin and end; words are numbered from 2 on


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a text's begin, its end and all distinct words, by number, and all texts as one sequence of numbers: begin,
    words, end, begin, ..."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.values.dictionary_encode()
    names, code = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()
    hashes = np.concatenate([[BEGIN_HASH], word_hash([END]), word_hash(bytes_of(names))])
    there = (pc.binary_length(names).to_numpy(zero_copy_only=False) > 0)[code] if len(names) else np.zeros(0, bool)  # Arrow also numbers the gap between two blanks
    ends = np.concatenate([[0], np.cumsum(there)])[lists.offsets.to_numpy()]
    code, d = code[there], len(texts)
    seq = np.zeros(len(code) + 2 * d, dtype=np.int64)
    place = np.arange(len(code)) + 2 * np.repeat(np.arange(d), np.diff(ends)) + 1
    seq[place] = code + 2
    seq[ends[1:] + 2 * np.arange(d) + 1] = 1
    return hashes, seq


def bytes_of(values: pa.Array) -> list[bytes]:
    """Binary values, cut out of their buffer."""
    if not len(values):
        return []
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1].tolist()
    data = data.to_pybytes() if data else b""
    return [data[i:j] for i, j in zip(at[:-1], at[1:])]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the order of all keys, and where in it each distinct one begins."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), ordered[1:] != ordered[:-1]]))
    return ordered[starts], order, starts


class Places:
    """The keys of a sequence's distinct words and of the bigram and the trigram at every place."""

    def __init__(self, seq: np.ndarray, hashes: np.ndarray):
        self.words = np.flatnonzero(np.bincount(seq, minlength=len(hashes)))
        self.one = ngram_key(hashes)
        on = seq[1:] != BEGIN  # a text's begin ends no n-gram
        self.pair_from, self.triple_from = np.flatnonzero(on), np.flatnonzero(on[:-1] & on[1:])
        self.pair_no = np.cumsum(on) - 1  # by place
        at = hashes[seq]
        self.two = ngram_key(at[self.pair_from], at[self.pair_from + 1])
        three = ngram_key(at[self.triple_from], at[self.triple_from + 1], at[self.triple_from + 2])
        self.keys, self.order, self.starts = distinct(np.concatenate([self.one[self.words], self.two, three]))


class Grams:
    """The distinct words, bigrams and trigrams of a sequence: their places in it, and their keys in sorted order."""

    def __init__(self, seq: np.ndarray, hashes: np.ndarray):
        self.width = width = len(hashes)
        self.words = np.flatnonzero(np.bincount(seq, minlength=width))
        pair = np.flatnonzero(seq[1:] != BEGIN)  # a text's begin ends no n-gram
        pairs, at = np.unique(seq[pair] * width + seq[pair + 1], return_inverse=True)
        self.pair_at = np.full(len(seq), -1, dtype=np.int32)  # the bigram that begins at a place
        self.pair_at[pair] = at
        triple = np.flatnonzero((self.pair_at[:-1] >= 0) & (self.pair_at[1:] >= 0))
        triples, at = np.unique(self.pair_at[triple].astype(np.int64) * width + seq[triple + 2], return_inverse=True)
        self.triple_at = np.full(len(seq), -1, dtype=np.int32)
        self.triple_at[triple] = at
        self.first, self.second = ((x.astype(np.int32)) for x in np.divmod(pairs, width))
        self.left, self.last = ((x.astype(np.int32)) for x in np.divmod(triples, width))  # the first two words as a bigram, and the third
        self.right = np.empty(len(triples), dtype=np.int32)  # the last two as a bigram
        self.right[at] = self.pair_at[triple + 1]
        del pair, triple, triples, at
        self.n_pairs = len(pairs)
        one = ngram_key(hashes)
        two = ngram_key(hashes[self.first], hashes[self.second])
        three = ngram_key(hashes[self.first[self.left]], hashes[self.second[self.left]], hashes[self.last])
        self.keys, at = np.unique(np.concatenate([one[self.words], two, three]), return_inverse=True)
        self.at = at.astype(np.int32)
        self.short = np.zeros(len(self.keys), bool)  # of the keys: words and bigrams, which are histories
        self.short[self.at[: len(self.words) + self.n_pairs]] = True

    def by_word(self, aligned: np.ndarray) -> np.ndarray:
        """Values aligned with ``keys`` by word number."""
        of_word = np.zeros(self.width, aligned.dtype)
        of_word[self.words] = aligned[self.at[: len(self.words)]]
        return of_word

    def split(self, aligned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values aligned with ``keys`` by word number, by bigram and by trigram."""
        w, p = len(self.words), len(self.words) + self.n_pairs
        return self.by_word(aligned), aligned[self.at[w:p]], aligned[self.at[p:]]

    def histories(self, aligned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by word number and by bigram alone."""
        w = len(self.words)
        return self.by_word(aligned), aligned[self.at[w : w + self.n_pairs]]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of keys; a larger key is never in a smaller one."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers compressed, their first bytes together, then their second ones: most high ones are zero."""
    values = np.ascontiguousarray(values.astype(kind))
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    columns = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(columns.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences. The low bytes of these are as good as random and stay as they are."""
    steps = np.diff(keys, prepend=np.uint64(0))
    low = int(np.log2(max(1.0, float(keys[-1] - keys[0]) / len(keys))) // 8) if len(keys) else 0
    columns = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return bytes([low]) + len(keys).to_bytes(8, "little") + columns[:low].tobytes() + packed(columns[low:].reshape(-1), "u1")


def unpacked_keys(data: bytes) -> np.ndarray:
    low, n = data[0], int.from_bytes(data[1:9], "little")
    columns = np.concatenate([np.frombuffer(data, np.uint8, low * n, 9), unpacked(data[9 + low * n :], "u1")]).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(columns.T).view("<u8").reshape(-1), dtype=np.uint64)


def squeezed(batches):
    """The texts (binary) of batches compressed, for the shuffle."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array([packed(np.frombuffer(x, np.uint8), "u1") for x in batch.column(at).to_pylist()], pa.binary()))


def texts_of(table: pa.Table) -> pa.Array:
    """The texts of a block, squeezed or not."""
    text = table["text"].combine_chunks()
    if pa.types.is_binary(text.type) or pa.types.is_large_binary(text.type):
        text = pa.array([unpacked(x, "u1").tobytes() for x in text.to_pylist()], pa.binary())
    return text.cast(pa.string())


ROWS_OUT = 16  # rows of arrays per Arrow batch


def rows_of(schema: pa.Schema, rows: list[dict]) -> pa.Table:
    """Rows of arrays as a table of small batches."""
    return pa.Table.from_batches([pa.RecordBatch.from_pylist(rows[i : i + ROWS_OUT], schema=schema) for i in range(0, len(rows), ROWS_OUT)], schema=schema)


def slices(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys, of buckets that have any."""
    edges = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1)).tolist()
    return [(k, a, b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]


#: ``tokens``: training tokens of a block, on one of its rows
COUNT_ROWS = "block long, bucket long, tokens long, keys binary, counts binary"
_COUNT = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("tokens", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def count_block(buckets: int):
    """A function that counts one block: a row of words and n-grams per bucket. What only held-out texts contain counts 0."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        used = ~table["held_out"].to_numpy().astype(bool)
        hashes, seq = sequences(texts_of(table))
        p, used = Places(seq, hashes), used[np.cumsum(seq == BEGIN) - 1]
        words = np.bincount(seq[used], minlength=len(hashes))
        counts = np.add.reduceat(np.concatenate([words[p.words], used[p.pair_from], used[p.triple_from]])[p.order], p.starts)
        tokens = int(words[1:].sum())
        return rows_of(_COUNT, [{"block": key[0].as_py(), "bucket": k, "tokens": 0 if i else tokens, "keys": packed_keys(p.keys[a:b]), "counts": packed(counts[a:b], "<u4")}
                                for i, (k, a, b) in enumerate(slices(p.keys, buckets))])

    return run


TOTAL_ROWS = "block long, bucket long, tokens long, totals binary"
_TOTAL = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("tokens", pa.int64()), ("totals", pa.binary())])


def total_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One bucket's counts summed over all blocks. Per block, twice the total of each key it sent, and 1 more where it is the first."""
    sent = [unpacked_keys(x) for x in table["keys"].to_pylist()]
    _, order, starts = distinct(np.concatenate(sent))
    counts = np.concatenate([unpacked(x, "<u4") for x in table["counts"].to_pylist()]).astype(np.int64)
    answer = np.empty(len(order), np.int64)
    answer[order] = np.repeat(2 * np.add.reduceat(counts[order], starts), np.diff(starts, append=len(order)))
    answer[order[starts]] += 1
    ends = np.cumsum([len(s) for s in sent]).tolist()
    return rows_of(_TOTAL, [{"block": block, "bucket": key[0].as_py(), "tokens": n, "totals": packed(answer[a:b], "<i8")}
                            for block, n, a, b in zip(table["block"].to_pylist(), table["tokens"].to_pylist(), [0, *ends], ends)])


class Answers:
    """What the buckets told a block of its keys."""

    def __init__(self, answers: pa.Table, n_keys: int, floor: float):
        found = np.concatenate([unpacked(x, "<i8") for x in answers.sort_by("bucket")["totals"].to_pylist()])
        assert len(found) == n_keys, "a block's texts have changed since they were counted"
        self.totals, self.first = found >> 1, (found & 1).astype(bool)
        self.kept = self.totals >= floor


#: ``known``: distinct training words that a block was the first to send, on one of its rows
HISTORY_ROWS = "block long, bucket long, known long, keys binary, sums binary, types binary"
_HISTORY = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("known", pa.int64()), ("keys", pa.binary()), ("sums", pa.binary()), ("types", pa.binary())])


def report_block(buckets: int, floor: float):
    """A function that sums one block's kept n-grams, as far as it is the first to hold them, by the history they continue."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _HISTORY.empty_table()
        block = answers["block"][0].as_py()
        hashes, seq = sequences(texts_of(docs))
        p = Places(seq, hashes)
        a = Answers(answers, len(p.keys), floor)
        w, short = len(p.words), len(p.words) + len(p.two)
        place = p.order[p.starts]  # one place of each key: words by number, then bigrams, then trigrams
        keys = p.keys[(place < short) & a.kept]
        of_pair, of_triple = (a.kept & a.first & x for x in ((place >= w) & (place < short), place >= short))
        history = np.concatenate([p.one[seq[p.pair_from[place[of_pair] - w]]], p.two[p.pair_no[p.triple_from[place[of_triple] - short]]]])
        n = np.concatenate([a.totals[of_pair], a.totals[of_triple]])
        sums, types = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if len(history):  # a history of a kept n-gram is as frequent, so it is kept
            of, order, starts = distinct(history)
            at = np.searchsorted(keys, of)
            sums[at], types[at] = np.add.reduceat(n[order], starts), np.diff(starts, append=len(order))
        new = a.first & (a.totals > 0) & (place < w)
        known = int(np.count_nonzero(p.words[place[new]] != BEGIN))
        rows = [{"block": block, "bucket": k, "known": 0, "keys": packed_keys(keys[a:b]), "sums": packed(sums[a:b], "<i8"), "types": packed(types[a:b], "<i8")}
                for k, a, b in slices(keys, buckets)]
        none = np.zeros(0, np.uint64)
        rows = rows or [{"block": block, "bucket": 0, "keys": packed_keys(none), "sums": packed(none, "<i8"), "types": packed(none, "<i8")}]
        rows[0]["known"] = known
        return rows_of(_HISTORY, rows)

    return run


SUM_ROWS = "block long, bucket long, known long, sums binary, types binary"
_SUM = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("known", pa.int64()), ("sums", pa.binary()), ("types", pa.binary())])


def sum_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One bucket's histories: per block, sum and number of the kept n-grams that continue the keys it sent."""
    sent = [unpacked_keys(x) for x in table["keys"].to_pylist()]
    found, at = np.unique(np.concatenate(sent), return_inverse=True)
    sums, types = (np.bincount(at, weights=np.concatenate([unpacked(x, "<i8") for x in table[c].to_pylist()]), minlength=len(found))[at] for c in ("sums", "types"))
    ends = np.cumsum([len(s) for s in sent]).tolist()
    return rows_of(_SUM, [{"block": block, "bucket": key[0].as_py(), "known": v, "sums": packed(sums[a:b], "<i8"), "types": packed(types[a:b], "<i8")}
                          for block, v, a, b in zip(table["block"].to_pylist(), table["known"].to_pylist(), [0, *ends], ends)])


@dataclass
class Model:
    """What all blocks share."""

    n: int  # training tokens
    v: int  # distinct training tokens

    def base(self, c: np.ndarray) -> np.ndarray:
        """Log10 of the add-one probability of words seen ``c`` times; unseen words share one event."""
        return np.log10((c + 1) / (self.n + self.v + 1))


class Automaton:
    """States, arcs and failure arcs of the n-grams of one block. State 0 is the empty history."""

    def __init__(self, grams: Grams, single: np.ndarray, total: np.ndarray, sums: np.ndarray, types: np.ndarray):
        self.grams = grams
        (c1, c2, c3), (s1, s2), (t1, t2) = grams.split(total), grams.histories(sums), grams.histories(types)
        rest1, rest2 = ((c - s + DISCOUNT * t) / np.maximum(c, 1) for c, s, t in ((c1, s1, t1), (c2, s2, t2)))  # weight of the shorter history
        a, b = grams.first, grams.second
        pair, triple = np.flatnonzero(c2), np.flatnonzero(c3)
        p2 = np.zeros(len(c2))
        p2[pair] = (c2[pair] - DISCOUNT) / c1[a[pair]] + rest1[a[pair]] * 10 ** single[b[pair]]
        two = grams.left[triple]
        p3 = (c3[triple] - DISCOUNT) / c2[two] + rest2[two] * p2[grams.right[triple]]

        short, long = np.flatnonzero(t1), np.flatnonzero(t2)
        self.short = len(short)  # states up to this number are words, further ones are bigrams
        self.of_word, self.of_pair = np.zeros(len(c1), np.int32), np.zeros(len(c2), np.int32)  # 0 without arcs
        self.of_word[short] = np.arange(1, len(short) + 1)
        self.of_pair[long] = np.arange(1, len(long) + 1) + len(short)
        self.fail = np.concatenate([np.zeros(len(short) + 1, np.int32), self.of_word[b[long]]])
        self.weight = np.concatenate([[0.0], np.log10(rest1[short]), np.log10(rest2[long])])
        # arcs by the number of the n-gram, which tells the state and the word; NaN: no arc (and last: no such n-gram)
        self.pair_arc, self.triple_arc = np.full(len(c2) + 1, np.nan), np.full(len(c3) + 1, np.nan)
        self.pair_arc[pair], self.triple_arc[triple] = np.log10(p2[pair]), np.log10(p3)

    def traverse(self, seq: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Log10 probability at each place of a sequence (0 at begins); ``single`` are log10 without a history, by word."""
        out = np.zeros(len(seq))
        place = np.flatnonzero(seq != BEGIN)
        state = self.of_word[seq[place - 1]]
        before = np.where(place > 1, self.grams.pair_at[place - 2], -1)
        longer = np.where(before >= 0, self.of_pair[before], 0) if len(self.of_pair) else np.zeros_like(state)
        state = np.where(longer > 0, longer, state)
        while len(place):
            log_p = np.where(state > self.short, self.triple_arc[self.grams.triple_at[place - 2]], self.pair_arc[self.grams.pair_at[place - 1]])
            log_p[state == 0] = np.nan
            hit = ~np.isnan(log_p)
            out[place[hit]] += log_p[hit]
            alone = ~hit & (state == 0)
            out[place[alone]] += single[seq[place[alone]]]
            on = ~hit & (state > 0)
            place, state = place[on], state[on]
            out[place] += self.weight[state]
            state = self.fail[state]
        return out


def score_block(model: Model, floor: float, id_type: pa.DataType):
    """A function that scores one block's texts with the totals of its words and n-grams and the sums of its histories."""

    def run(docs: pa.Table, sent: pa.Table) -> pa.Table:
        n = docs.num_rows
        if n:
            hashes, seq = sequences(texts_of(docs))
            grams, reports = Grams(seq, hashes), sent.filter(sent["totals"].is_null()).sort_by("bucket")
            a = Answers(sent.filter(sent["totals"].is_valid()), len(grams.keys), floor)
            history = grams.short & a.kept
            sums, types = np.zeros(len(history), np.int64), np.zeros(len(history), np.int64)
            for values, name in ((sums, "sums"), (types, "types")):
                values[history] = np.concatenate([unpacked(x, "<i8") for x in reports[name].to_pylist()])
            count = grams.by_word(a.totals)
            count[BEGIN] = 0
            single = model.base(count)
            begins = np.flatnonzero(seq == BEGIN)
            inside = seq != BEGIN
            scores = Automaton(grams, single, np.where(a.kept, a.totals, 0), sums, types).traverse(seq, single)
            tokens_, known, base, full = (np.add.reduceat(x, begins) for x in (inside.astype(np.int64), (inside & (count[seq] > 0)).astype(np.int64), np.where(inside, single[seq], 0.0), scores))
        else:
            tokens_, known, base, full = (np.zeros(0, t) for t in (np.int64, np.int64, float, float))
        return pa.table({
            "doc_id": docs["doc_id"] if n else pa.nulls(0, id_type), "held_out": docs["held_out"] if n else pa.nulls(0, pa.bool_()),
            "n_tokens": pa.array(tokens_), "n_known": pa.array(known), "train_tokens": pa.array([model.n] * n, pa.int64()),
            "base_score": pa.array(base), "score": pa.array(full)})

    return run


def score(docs: DataFrame, share: float = 0.0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    A ``share`` keeps only n-grams that also make up that share of the training tokens, for a smaller model."""
    spark = docs.sparkSession
    with_python(spark)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = max(BUCKETS, 2 * blocks)
    id_type = docs.schema["doc_id"].dataType
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)))
    # the largest step by far: its texts are shuffled squeezed, the others' as they are
    packed_up = T.StructType([T.StructField("block", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("text", T.BinaryType())])
    texts = dealt.select("block", "held_out", F.col("text").cast("binary").alias("text")).mapInArrow(tidy(squeezed), packed_up)

    counted = texts.groupBy("block").applyInArrow(tidy_group(count_block(buckets)), COUNT_ROWS)
    totals = set_aside(counted.groupBy("bucket").applyInArrow(tidy_group(total_bucket), TOTAL_ROWS), "lm-totals")
    n = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    floor = max(float(LEAST), share * n)

    reported = dealt.select("block", "text").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(tidy_group(report_block(buckets, floor)), HISTORY_ROWS)
    sums = set_aside(reported.groupBy("bucket").applyInArrow(tidy_group(sum_bucket), SUM_ROWS), "lm-sums")
    v = sums.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]

    out = f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    right = totals.select("block", "bucket", "totals").unionByName(sums.select("block", "bucket", "sums", "types"), allowMissingColumns=True)
    return dealt.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(tidy_group(score_block(Model(n, v), floor, to_arrow_type(id_type))), out)
