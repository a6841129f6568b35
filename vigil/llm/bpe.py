"""Byte-level BPE by merge replay over a batch's vocabulary, with decoding.

All words of a batch that are not yet known are laid out as one symbol array with neighbour links. An inverted
index maps every mergeable token pair, under the rank of its merge, to the positions where it stands. Ranks are
applied in order over all words at once; a merge touches only its two neighbours, whose new pairs are entered into
the index. Words stay independent, so each word sees its own merges in rank order, leftmost first.

A merge may open a pair of lower rank than itself; such words leave the batch and are merged one by one, so the
result is the library's in every case. A word that is in the vocabulary as a whole takes its id directly.

Defined cases: null or empty text gives no ids; very long words are words like others; repeated rows repeat.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vigil.llm.common import adding
from vigil.llm.pieces import TextEncoder, newer_letters


class Merges:
    """Ranks of a tiktoken file, merge replay for batches of words, and decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.bytes_ = [self.ranks[bytes([b])] for b in range(256)]
        self.pair: dict[int, int] = {}  # (left << 32 | right) -> rank of the merge, or -1; filled as pairs turn up

    def rank(self, left: int, right: int) -> int:
        key = left << 32 | right
        found = self.pair.get(key)
        if found is None:
            found = self.pair[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            if len(self.pair) > 2_000_000:
                self.pair.clear()
        return found

    def alone(self, word: bytes) -> list[int]:
        """Merge one word: the lowest rank first, leftmost among equals."""
        ids = [self.bytes_[b] for b in word]
        while len(ids) > 1:
            ranks = [self.rank(a, b) for a, b in zip(ids, ids[1:])]
            best = min((r for r in ranks if r >= 0), default=-1)
            if best < 0:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [best]
        return ids

    def replay(self, words: list[str]) -> list[list[int]]:
        """Ids of each distinct word, every merge applied in rank order over the whole batch."""
        raw = [w.encode("utf-8") for w in words]
        out: list[list[int] | None] = [None] * len(raw)
        symbols: list[int] = []
        owner: list[int] = []
        starts: list[int] = []
        laid: list[int] = []
        for n, word in enumerate(raw):
            if word in self.ranks:
                out[n] = [self.ranks[word]]
                continue
            starts.append(len(symbols))
            laid.append(n)
            symbols.extend(map(self.bytes_.__getitem__, word))
            owner.extend([n] * len(word))
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        for s in starts:
            before[s] = -1
            if s:
                after[s - 1] = -1
        if size:
            after[-1] = -1
        rank, index, heap = self.rank, {}, []
        known = self.pair.get
        for i in range(size):
            j = after[i]
            if j >= 0:
                r = known(symbols[i] << 32 | symbols[j])
                if r is None:
                    r = rank(symbols[i], symbols[j])
                if r >= 0:
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                        heappush(heap, r)
        late: set[int] = set()
        while heap:
            r = heappop(heap)
            places = index.pop(r)
            places.sort()
            for i in places:
                left, j = symbols[i], after[i]
                if left < 0 or j < 0 or rank(left, symbols[j]) != r:
                    continue  # an earlier merge has taken one of the two
                symbols[i], symbols[j] = r, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    q = known(r << 32 | symbols[k])
                    if q is None:
                        q = rank(r, symbols[k])
                    if q >= 0:
                        if q < r:
                            late.add(owner[i])
                        if q in index:
                            index[q].append(i)
                        else:
                            index[q] = [i]
                            heappush(heap, q)
                p = before[i]
                if p >= 0:
                    q = known(symbols[p] << 32 | r)
                    if q is None:
                        q = rank(symbols[p], r)
                    if q >= 0:
                        if q < r:
                            late.add(owner[i])
                        if q in index:
                            index[q].append(p)
                        else:
                            index[q] = [p]
                            heappush(heap, q)
        for n, s, e in zip(laid, starts, [*starts[1:], size]):
            out[n] = self.alone(raw[n]) if n in late else [x for x in symbols[s:e] if x >= 0]
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of little-endian 32-bit ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


    def whole(self, text: str) -> list[int] | None:
        """Ids by the library for a text whose letters are too recent for all Unicode tables to agree on, else None."""
        if not newer_letters(text):
            return None
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary(text)


_MERGES: dict[str, tuple[Merges, TextEncoder]] = {}


def merges(path: str) -> tuple[Merges, TextEncoder]:
    """The worker's merges and encoder for a rank file; kept for the worker's life."""
    if path not in _MERGES:
        m = Merges(path)
        _MERGES[path] = m, TextEncoder(m.replay, m.whole)
    return _MERGES[path]


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The input's columns plus ``ids`` (little-endian unsigned 32-bit, binary) and ``decoded`` (binary)."""

    def columns(texts: list[str]) -> list[pa.Array]:
        m, encoder = merges(path)
        ids = list(encoder(texts))
        return [pa.array(ids, pa.binary()), pa.array([m.decode(x) for x in ids], pa.binary())]

    return adding(docs, columns, [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())], text_col)


def encode_digest(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The input's columns plus n_tokens, ids_sha256 and decoded_sha256, so neither ids nor bytes leave the worker."""

    def columns(texts: list[str]) -> list[pa.Array]:
        m, encoder = merges(path)
        n, a, b = [], [], []
        for ids in encoder(texts):
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(m.decode(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]

    return adding(docs, columns, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())], text_col)
