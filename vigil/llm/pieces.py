"""Byte-level BPE encoding of whole texts through worker caches, without changing a single id.

A text is cut at single blanks into chunks. With the splitting pattern of the byte-level tokenizers no match crosses
such a cut unless white space stands on both sides of the blank, so a chunk's ids do not depend on its neighbours
and can be cached. Chunks that are not cached are split by the pattern into pieces, and pieces that are not cached
are encoded by the given back end, all those of a batch at once. Texts the rule does not cover are split by the
pattern as a whole or, where Unicode versions may disagree, handed to the library.

Caches are bounded and keep what comes first, which holds the frequent entries; the rest lives for one slice only.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
from array import array
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken

PATTERN = regex.compile(public_tokenizers.PATTERN)
#: white space on both sides of a blank, or before a blank that ends the text
_UNSAFE = ("  ", "\n ", "\t ", "\r ", "\v ", "\f ", "\x85 ", "\xa0 ")
_WIDE_SPACE = re.compile("[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: every library agrees on the classes of these code points
_AGREED = re.compile("[^\x00-\u0557]")
_LETTER = regex.compile(r"\p{L}|\p{N}")
CACHE_CHUNKS, CACHE_PIECES = 100_000, 500_000  # about 130 MB per worker
_SIGNS = frozenset(".,;:!?)\"")
MAX_KEY = 48  # longer chunks and pieces are rare and not kept
SLICE_CHARS = 8_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def mergeable_ranks(tokenizer) -> dict[bytes, int] | None:
    """Token bytes -> id if merging by lowest id gives this tokenizer's ids for every piece, else None.

    That holds when ids follow the order of the merges and every token, alone, is merged to itself: then whenever two
    neighbours join to a token's bytes, nothing has crossed its borders, its bytes have been merged as they are alone,
    and the two are the pair that the merge list has for it."""
    model = json.loads(tokenizer.to_str())["model"]
    letters, vocab = byte_letters(), model["vocab"]
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return None
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    tokens = {t: i for t, i in vocab.items() if t not in special}
    if not all(set(t) <= letters.keys() for t in tokens) or not letters.keys() <= tokens.keys():
        return None
    made = [vocab["".join(m.split(" ", 1) if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(made) or any(len(tokenizer.model.tokenize(t)) != 1 for t in tokens):
        return None
    return {bytes([letters[c] for c in t]): i for t, i in tokens.items()}


class HfBackend:
    """Ids of pieces and of whole texts by the tokenizers library.

    Pieces are merged by tiktoken from the tokenizer's own vocabulary where that is proven to give the same ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = mergeable_ranks(self.tokenizer)
        self.merge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary if ranks else None

    def pieces(self, words: list[str]) -> Iterable[list[int]]:
        if self.merge:
            return map(self.merge, words)
        return (e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False))

    def text(self, text: str) -> list[int] | None:
        """Ids by the library where splitting by ourselves might differ from it, else None."""
        if _AGREED.search(text) or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return None


class TextEncoder:
    """Encode batches of texts to little-endian 32-bit ids with bounded chunk and piece caches."""

    def __init__(self, pieces: Callable[[list[str]], Iterable[list[int]]], whole: Callable[[str], list[int] | None], chunks: int = CACHE_CHUNKS, keep: int = CACHE_PIECES):
        self.encode_pieces, self.whole = pieces, whole
        self.chunk: dict[str, bytes] = {}
        self.piece: dict[str, bytes] = {}
        self.max_chunks, self.max_pieces = chunks, keep

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; slices of a few million characters bound what is split at once."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size < SLICE_CHARS or end == at):
                size += len(texts[end])
                end += 1
            gc.disable()  # many short-lived strings and lists, no cycles: collecting them again and again only costs
            try:
                done = self._slice(texts[at:end])
            finally:
                gc.enable()
            yield from done
            at = end

    def _slice(self, texts: list[str]) -> list[bytes]:
        """Chunks of the slice are numbered by Arrow, so the caches are asked once per distinct chunk."""
        out: list[bytes | None] = [None] * len(texts)
        loose: dict[int, list[str]] = {}  # pieces of a text's first chunk, or of a text that must not be cut
        cut: list[int] = []
        tails: list[str] = []
        for i, text in enumerate(texts):
            if (ids := self.whole(text)) is not None:
                out[i] = pack(ids)
            elif any([u in text for u in _UNSAFE]) or _WIDE_SPACE.search(text):
                loose[i] = PATTERN.findall(text)
            else:
                head, blank, tail = text.partition(" ")
                loose[i] = PATTERN.findall(head)
                if blank:
                    cut.append(i)
                    tails.append(tail)
        lists = pc.split_pattern(pa.array(tails, pa.string()), " ")
        coded = lists.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        values, known = self._chunks(distinct, list(loose.values()))
        heads = {i: b"".join([known(p) for p in found]) for i, found in loose.items()}
        joined = pa.array(values, pa.binary()).take(coded.indices)
        if len(joined):
            _, at, data = joined.buffers()
            # byte positions of the texts' first chunks, and the end
            edges = np.frombuffer(at, np.int32)[joined.offset :][lists.offsets.to_numpy()]
            data = memoryview(data) if data is not None else memoryview(b"")
            for k, i in enumerate(cut):
                heads[i] += data[edges[k] : edges[k + 1]].tobytes()
        for i, ids in heads.items():
            out[i] = ids
        return out

    def _chunks(self, distinct: list[str], loose: list[list[str]]) -> tuple[list[bytes], Callable[[str], bytes]]:
        """Ids of distinct chunks (each stands behind a blank), and a look-up that also knows the loose pieces.

        A word is one piece, a word and a sign are two; only other chunks are split by the pattern and cached as such."""
        piece = self.piece
        get = piece.get
        values: list[bytes | None] = [None] * len(distinct)
        alone = [i for i, c in enumerate(distinct) if c.isalpha()]
        words = [" " + distinct[i] for i in alone]
        rest = [i for i, c in enumerate(distinct) if not c.isalpha()]
        signed = [i for i in rest if distinct[i][-1:] in _SIGNS and distinct[i][:-1].isalpha()]
        stems = [" " + distinct[i][:-1] for i in signed]
        plain = set(signed)
        odd = [i for i in rest if i not in plain]
        odd_values = [self.chunk.get(distinct[i]) for i in odd]
        split = {i: PATTERN.findall(" " + distinct[i]) for i, v in zip(odd, odd_values) if v is None}

        new: set[str] = set()
        found_words, found_stems = list(map(get, words)), list(map(get, stems))
        new.update([w for w, v in zip(words, found_words) if v is None])
        new.update([w for w, v in zip(stems, found_stems) if v is None])
        for found in (_SIGNS, *split.values(), *loose):
            new.update([p for p in found if p not in piece])
        spare: dict[str, bytes] = {}
        fresh = list(new)
        room = self.max_pieces - len(piece)
        for p, ids in zip(fresh, self.encode_pieces(fresh)):
            if room > 0 and len(p) <= MAX_KEY:
                piece[p] = pack(ids)
                room -= 1
            else:
                spare[p] = pack(ids)

        def known(p: str) -> bytes:
            v = get(p)
            return spare[p] if v is None else v

        for i, w, v in zip(alone, words, found_words):
            values[i] = known(w) if v is None else v
        sign = {s: known(s) for s in _SIGNS}
        for i, w, v in zip(signed, stems, found_stems):
            values[i] = (known(w) if v is None else v) + sign[distinct[i][-1]]
        room = self.max_chunks - len(self.chunk)
        for i, v in zip(odd, odd_values):
            if v is None:
                c = distinct[i]
                v = b"".join([known(p) for p in split[i]])
                if room > 0 and len(c) <= MAX_KEY:
                    self.chunk[c] = v
                    room -= 1
            values[i] = v
        return values, known


def pack(ids: list[int]) -> bytes:
    words = array("I", ids)
    if sys.byteorder == "big":
        words.byteswap()
    return words.tobytes()


def newer_letters(text: str) -> bool:
    """Whether a letter or digit of the text was assigned so recently that libraries may not know it yet."""
    return bool(_AGREED.search(text)) and any(unicodedata.category(c) == "Cn" and _LETTER.match(c) for c in set(text))


_ENCODERS: dict[str, TextEncoder] = {}


def hf_encoder(path: str) -> TextEncoder:
    """The worker's encoder for a tokenizers file; kept for the worker's life."""
    if path not in _ENCODERS:
        backend = HfBackend(path)
        _ENCODERS[path] = TextEncoder(backend.pieces, backend.text)
    return _ENCODERS[path]
