"""Token ids of whole texts with a tokenizers file.

Byte-level BPE without normaliser encodes each pre-token (a word with the space
before it, a run of digits, of signs or of white space) alone. So a task cuts
its texts into pre-tokens with array operations, has the tokenizers library
encode each distinct one once, and gathers the ids of all texts from those.
Texts with characters beyond Latin letters, or with a special token in them, and
all texts under other tokenizers, are encoded whole by the library. The cache is
per Python worker and bounded; it changes no result.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from casebook.llm.arrays import utf8

GROUP_BYTES = 2 << 20  # text encoded at once
MAX_PIECES = 400_000  # entries of the cache
JOINED = 100  # words encoded in one call

# Classes of bytes: letters (ASCII, and the bytes of U+00C0 to U+023F), digits, white space, signs; 4: none of these.
_LETTER, _DIGIT, _SPACE, _SIGN, _OTHER = range(5)
_CLASS = np.full(256, _SIGN, dtype=np.uint8)
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[0x80:0xC0] = _CLASS[0xC3:0xC9] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[0xC0:0xC3] = _CLASS[0xC9:] = _OTHER


def cuts(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens of byte-level BPE begin (a mask over the bytes), and which texts the classes do not cover.

    Pre-tokens: 's 't 're 've 'm 'll 'd; letters, digits or signs with at most one space before them; white
    space, of which the last character stays alone or goes to what follows."""
    n = len(data)
    kind = _CLASS[data]
    head = np.zeros(n + 1, dtype=bool)
    head[off] = True
    head = head[:n]
    bad = kind == _OTHER
    # the signs U+00D7 and U+00F7 lie between the letters
    pair = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    bad[:-1] |= pair
    odd = np.add.reduceat(np.r_[bad, False].astype(np.int64), np.minimum(off[:-1], n))
    odd = (odd > 0) & (np.diff(off) > 0)
    space = kind == _SPACE
    begin = head.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    end = np.empty(n, dtype=bool)  # last byte of its run
    end[:-1] = begin[1:]
    end[-1:] = True
    last_of_text = np.zeros(n + 1, dtype=bool)
    last_of_text[off] = True
    last_of_text = last_of_text[1:]
    blank = space & end & ~last_of_text  # white space right before something else
    cut = begin.copy()
    cut |= blank  # the last white space leaves its run
    joined = np.zeros(n, dtype=bool)
    joined[1:] = (blank & (data == 32))[:-1]
    cut &= ~joined  # a space goes to what follows
    # contractions, where a run of signs begins with an apostrophe that has no space before it
    apostrophe = np.flatnonzero((data[:-1] == 39) & begin[:-1] & ~joined[:-1] & ~last_of_text[:-1]) if n > 1 else \
        np.zeros(0, dtype=np.int64)
    if len(apostrophe):
        one = data[apostrophe + 1]
        single = np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
        third = np.minimum(apostrophe + 2, n - 1)
        two = data[third]
        double = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        double &= ~single & (apostrophe + 2 < n) & ~last_of_text[apostrophe + 1]
        for chosen, width in ((single, 2), (double, 3)):
            at = apostrophe[chosen]
            cut[at + 1] = False
            after = at + width
            inside = (after < n)
            after = after[inside]
            # a letter or sign that goes on after the contraction begins a pre-token; white space keeps its own rule
            cut[after[kind[after] != _SPACE]] = True
    return cut, odd


class Encoder:
    def __init__(self, path: str, plain: bool = False):
        """``plain``: special tokens' strings in a text are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel"
                         and not before.get("add_prefix_space") and before.get("use_regex", True)
                         and not spec["model"].get("dropout"))
        self.special = "" if plain else "|".join(re.escape(t["content"]) for t in spec["added_tokens"])
        self.pieces: dict[bytes, bytes] = {}
        self.word = re.compile(rb" [A-Za-z\x80-\xff]+").fullmatch
        if self.by_piece:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.begins[[k for t, k in vocabulary.items() if t[0] == "\u0120"]] = True  # tokens that start with a space

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces. Words with a space before them go many to a call: each begins at a token with a space."""
        known = self.pieces
        words = [p for p in pieces if self.word(p)]
        for lo in range(0, len(words), 100 * JOINED):
            lines = [words[k:k + JOINED] for k in range(lo, min(lo + 100 * JOINED, len(words)), JOINED)]
            for line, raw in zip(lines, self._encode([b"".join(x).decode() for x in lines]), strict=True):
                at = (np.flatnonzero(self.begins[np.frombuffer(raw, dtype=np.uint32)]) * 4).tolist()
                if len(at) == len(line):
                    known.update(zip(line, [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)], strict=True))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self._encode([p.decode() for p in rest]), strict=True))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (uint32) and each text's range of them (n + 1 offsets); null is empty."""
        texts = texts.fill_null("")
        n = len(texts)
        off, data = utf8(texts)
        if not self.by_piece or not len(data):
            return _joined(self._encode(texts.to_pylist()) if len(data) else [b""] * n)
        cut, odd = cuts(off, data)
        if self.special:
            odd |= pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(odd)
        starts = np.flatnonzero(cut)
        bounds = np.searchsorted(starts, off)
        if len(whole):  # one entry, of no bytes, in place of the pieces
            keep = ~np.repeat(odd, np.diff(bounds))
            starts, stops = starts[keep], np.r_[starts[1:], len(data)][keep]
            bounds = np.r_[0, np.cumsum(np.where(odd, 0, np.diff(bounds)))]
            lens = stops - starts
            packed = data[np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())]
            edges = np.r_[0, np.cumsum(lens)]
        else:
            packed, edges = data, np.r_[starts, len(data)]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1,
                                       [None, pa.py_buffer(edges.astype(np.int64).tobytes()),
                                        pa.py_buffer(np.ascontiguousarray(packed))])
        coded = pieces.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary.to_pylist()
        if len(self.pieces) > MAX_PIECES:
            self.pieces.clear()
        get = self.pieces.get
        new = [p for p in distinct if get(p) is None]
        if new:
            self._learn(new)
        flat, at = _joined([*map(get, distinct)])
        size = np.diff(at)[code]
        ends = np.cumsum(size)
        ids = flat[np.repeat(at[code] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        where = np.r_[0, ends][bounds]
        if not len(whole):
            return ids, where
        parts = [ids[a:b].tobytes() for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]
        for k, raw in zip(whole.tolist(), self._encode([texts[k].as_py() for k in whole.tolist()]), strict=True):
            parts[k] = raw
        return _joined(parts)


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) // 4 for p in parts], out=off[1:])
    return np.frombuffer(b"".join(parts), dtype="<u4"), off


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder of a tokenizers file (the file is installed with the library on every executor)."""
    return Encoder(path, plain)


def forget() -> None:
    """Drop the worker's encoders: workers outlive a stage, and an encoder with its cache is some 70 MB in each."""
    encoder.cache_clear()


def groups(batches: Iterator[pa.RecordBatch], column: int, most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with some ``most`` bytes of text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
        total = np.cumsum(size)
        lo = 0
        while lo < batch.num_rows:
            base = total[lo] - size[lo]
            hi = max(lo + 1, int(np.searchsorted(total, base + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
