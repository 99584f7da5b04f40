"""Exact tokenisation of whole texts in Arrow batches.

A text is cut at ASCII white space, which no token of the word vocabulary spans, so that every word is
encoded once and its ids are gathered for all its places.  The words of a batch are dictionary-encoded
by Arrow; ids of word stems are kept between batches in a cache of ``CACHE`` entries and ``CACHE_BYTES`` at most,
emptied when full.  Texts with characters from U+0300 on (where normalisation may join characters) go through the
tokenizer whole.  The ids are those of the tokenizer over the whole text.

Strings of special tokens in a text are ordinary text, or with ``special`` these tokens, as the tokenizer
has it by itself; texts that may hold one then go through the tokenizer whole too.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 500_000
CACHE_BYTES = 64 << 20     # of the cache, with what Python's objects take
ENTRY = 130                # bytes of an entry besides its word and ids
SLICE_BYTES = 3 << 20      # text that is worked on at once


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of a word-end tokenizer (one that drops white space and marks word ends by ``</w>``)."""

    def __init__(self, path: str, special: bool = False, cache_bytes: int | None = None):
        self.most = CACHE_BYTES if cache_bytes is None else cache_bytes
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not special
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()] if special else []
        # how the special tokens begin, before any letter: what is not there holds none
        self.mark = re.match(r"[^\w\s]*", os.path.commonprefix(added)).group() if added else None
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.type = np.dtype(np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)
        self.cache: dict[str, bytes] = {}        # ids as bytes take a third of what small arrays do
        self.held = 0
        self.marks = {"": b""} | {m: self._each([m])[0].tobytes() for m in ",."}

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.type) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _stems(self, stems: list[str]) -> None:
        """Encode words of letters alone: one string, cut where a word ends."""
        ids = self._each([" ".join(stems)])[0]
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.type.itemsize).tolist()
        if len(ends) != len(stems):      # a letter that the tokenizer doesn't take as one
            self.cache.update(zip(stems, (x.tobytes() for x in self._each(stems)), strict=True))
        else:
            raw = ids.tobytes()
            self.cache.update(zip(stems, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word; a word of letters, perhaps with a comma or full stop, goes by its stem."""
        each = list(map(self.cache.get, words))
        unknown, stems, ends = [i for i, e in enumerate(each) if e is None], [], []
        for i in unknown:
            w = words[i]
            mark = w[-1:] if w[-1:] in (",", ".") and len(w) > 1 else ""
            stem = w[:-1] if mark else w
            if not (stem.isalpha() and "İ" not in stem):
                stem, mark = w, ""
            stems.append(stem)
            ends.append(mark)
        new = set(stems).difference(self.cache)
        if len(self.cache) + len(new) > CACHE or self.held > self.most:
            self.cache.clear()
            self.held, new = 0, set(stems)
        if new:
            letters = [s for s in new if s.isalpha() and "İ" not in s]
            others = [s for s in new if not (s.isalpha() and "İ" not in s)]
            if letters:
                self._stems(letters)
            self.cache.update(zip(others, (x.tobytes() for x in self._each(others)), strict=True))
            self.held += sum(len(s) + ENTRY for s in new) + sum(len(self.cache[s]) for s in new)
        get, marks = self.cache.__getitem__, self.marks
        for i, s, m in zip(unknown, stems, ends, strict=True):
            each[i] = get(s) + marks[m]
        return each

    def slices(self, texts: pa.Array, most: int | None = None):
        """(first text, ids of a few texts in a row, where each text's begin, with the end), a slice at a time.  No text is null."""
        texts = texts.cast(pa.large_string())        # before slicing: kernels misread a cast slice
        for a, b in _slices(texts, most):
            ids, counts = self._slice(texts.slice(a, b - a))
            yield a, ids, np.concatenate(([0], np.cumsum(counts)))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin, with the end).  No text is null.

        Ids have 16 bits if the vocabulary allows.
        """
        texts = texts.cast(pa.large_string())        # before slicing: kernels misread a cast slice
        parts = [self._slice(texts.slice(a, b - a)) for a, b in _slices(texts)]
        if not parts:
            return np.zeros(0, self.type), np.zeros(1, np.int64)
        counts = np.concatenate([c for _, c in parts])
        return np.concatenate([i for i, _ in parts]), np.concatenate(([0], np.cumsum(counts)))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        start = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[start[0]:start[-1]] if data is not None else np.zeros(0, np.uint8)
        high = np.flatnonzero(raw >= 0xCC) + start[0]        # first bytes of U+0300 and above
        rare = np.unique(np.searchsorted(start, high, side="right") - 1) if len(high) else np.zeros(0, np.int64)
        if self.mark is not None:
            marked = pc.match_substring(texts, self.mark).to_numpy(zero_copy_only=False)
            rare = np.union1d(rare, np.flatnonzero(marked)).astype(np.int64)
        if len(rare):
            plain = np.ones(len(texts), bool)
            plain[rare] = False
            whole = self._each(texts.take(pa.array(rare)).to_pylist())
            texts = pc.if_else(pa.array(plain), texts, pa.scalar("", pa.large_string()))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        each = self.words(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, each), np.int32, len(each)) // self.type.itemsize
        flat = np.frombuffer(b"".join(each), self.type)
        at = np.cumsum(size, dtype=np.int32) - size
        index = coded.indices.to_numpy()
        n = size[index]
        upto = np.concatenate((np.zeros(1, np.int32), np.cumsum(n, dtype=np.int32)))
        take = np.repeat(at[index] - upto[:-1], n)
        take += np.arange(upto[-1], dtype=np.int32)
        ids = flat[take]
        counts = (upto[bounds[1:]] - upto[bounds[:-1]]).astype(np.int64)
        if len(rare):
            where = np.concatenate(([0], np.cumsum(counts)))
            pieces = np.split(ids, where[1:-1])
            for k, v in zip(rare, whole, strict=True):
                pieces[k] = v
            ids, counts = np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
        return ids, counts


def _slices(texts: pa.Array, most: int | None = None):
    """Ranges of texts of about ``most`` (``SLICE_BYTES``) each."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // (SLICE_BYTES if most is None else most)
    cuts = np.flatnonzero(np.diff(part)) + 1 if len(part) else []
    edges = [0, *map(int, cuts), len(size)]
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False, cache_bytes: int | None = None) -> WordEncoder:
    """One for each Python worker and vocabulary."""
    return WordEncoder(path, special, cache_bytes)
