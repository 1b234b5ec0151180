"""Vectorised pre-tokenizer split and a bounded per-worker cache of words.

``piece_spans`` cuts a batch of texts exactly where the public byte-level BPE
pattern does (``PATTERN`` in the README of the tokenizer files): contractions,
an optional leading space with a run of letters, numbers or other characters,
and white-space runs that leave their last character to what follows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np

from caprank.llm.common import span_hashes, span_positions

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3

#: Code points with the Unicode property White_Space (fixed values).
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]

_CLASSES: np.ndarray | None = None


def class_table() -> np.ndarray:
    global _CLASSES
    if _CLASSES is None:
        kind = {"L": LETTER, "N": NUMBER}
        t = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                        dtype=np.uint8, count=0x110000)
        t[WHITE_SPACE] = SPACE
        _CLASSES = t
    return _CLASSES


def piece_spans(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all documents of a batch; they cover
    every character and cross no document border."""
    n = len(cps)
    if not n:
        e = np.empty(0, dtype=np.int64)
        return e, e
    cls = class_table()[cps]
    space = cls == SPACE
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    cut = np.zeros(n + 4, dtype=bool)
    b = cut[:n]
    prev_space, prev_blank = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    prev_space[1:], prev_blank[1:] = space[:-1], cps[:-1] == 32
    changed = np.zeros(n, dtype=bool)
    changed[1:] = cls[1:] != cls[:-1]
    # the last white space of a run that a non-space follows in the same text
    last = np.zeros(n, dtype=bool)
    last[:-1] = space[:-1] & ~space[1:] & ~border[1:n]
    b[:] = np.where(space, ~prev_space | last, np.where(prev_space, ~prev_blank, changed))
    b |= border[:n]
    # contractions: an apostrophe that starts a piece, letters right behind it
    at = np.flatnonzero((cps == 39) & b)
    if len(at):
        pad = np.concatenate((cps, np.zeros(3, dtype=cps.dtype)))
        end1, end2 = border[np.minimum(at + 1, n)], border[np.minimum(at + 2, n)]
        c1, c2 = pad[at + 1], pad[at + 2]
        alone = ~end1 & (border[at] | (np.concatenate(([SPACE], cls))[at] != OTHER))
        one = alone & np.isin(c1, [ord(c) for c in "stmd"])
        two = alone & ~end2 & (((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e")))
                               | ((c1 == ord("l")) & (c2 == ord("l"))))
        cut[at[one] + 1] = False
        cut[at[two] + 1] = False
        cut[at[one] + 2] = True
        cut[at[two] + 3] = True
    starts = np.flatnonzero(cut[:n])
    return starts, np.append(starts[1:], n)


def as_arrays(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all ids, where each word's begin, how many it has) of lists of ids."""
    lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.array([x for w in ids for x in w], dtype=np.int32), np.cumsum(lens) - lens, lens


class WordIds:
    """Token ids of words, kept for the life of a Python worker.

    Words are looked up by a 64-bit hash and compared with the stored letters on
    every hit, so that two words of one hash never share ids.  At most ``max_words``
    words and ``max_chars`` letters are held; beyond either the table starts anew
    with the next batch, so memory is bounded whatever the vocabulary of the corpus."""

    SLOTS = 1 << 20

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], max_words: int = 500_000, max_chars: int = 6_000_000):
        self.encode_words = encode_words
        self.max_words, self.max_chars = max_words, max_chars
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(self.SLOTS, dtype=np.uint64)
        self.vals = np.zeros(self.SLOTS, dtype=np.int32)
        self.hashes = np.zeros(0, dtype=np.uint64)  # of all words, ascending, and their indexes
        self.order = np.zeros(0, dtype=np.int32)
        self.odd: dict[str, int] = {}  # words whose hash another word has
        self.n = self.used = self.n_chars = 0
        self.offs = np.zeros(1024, dtype=np.int32)
        self.lens = np.zeros(1024, dtype=np.int32)
        self.flat = np.zeros(8192, dtype=np.int32)
        self.char_offs = np.zeros(1024, dtype=np.int32)
        self.char_lens = np.zeros(1024, dtype=np.int32)
        self.chars = np.zeros(8192, dtype=np.uint32)

    def _store(self, words: list[str]) -> None:
        flat, offs, lens = self.encode_words(words)
        k, total = len(words), len(flat)
        size = np.fromiter(map(len, words), dtype=np.int32, count=k)
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        while self.n + k > len(self.offs):
            for name in ("offs", "lens", "char_offs", "char_lens"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while self.n_chars + len(text) > len(self.chars):
            self.chars = np.concatenate((self.chars, np.zeros_like(self.chars)))
        self.lens[self.n:self.n + k] = lens
        self.offs[self.n:self.n + k] = self.used + offs
        self.flat[self.used:self.used + total] = flat
        self.char_lens[self.n:self.n + k] = size
        self.char_offs[self.n:self.n + k] = self.n_chars + np.cumsum(size) - size
        self.chars[self.n_chars:self.n_chars + len(text)] = text
        self.n += k
        self.used += total
        self.n_chars += len(text)

    def words(self, joined: str, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Index of every piece in this table, encoding the new ones.  The pieces
        are sorted, disjoint and cover ``cps``."""
        h = span_hashes(cps, starts, ends)
        h[h == 0] = 1
        slot = (h & np.uint64(self.SLOTS - 1)).astype(np.int64)
        if self.n > self.max_words or self.n_chars > self.max_chars:
            self._reset()
        hit = self.keys[slot] == h
        out = np.where(hit, self.vals[slot], -1)
        miss = np.flatnonzero(~hit)
        if len(miss):
            uniq, first, inv = np.unique(h[miss], return_index=True, return_inverse=True)
            place = np.searchsorted(self.hashes, uniq)
            near = np.minimum(place, max(len(self.hashes) - 1, 0))
            old = self.hashes[near] == uniq if len(self.hashes) else np.zeros(len(uniq), dtype=bool)
            idx = np.full(len(uniq), -1, dtype=np.int64)
            idx[old] = self.order[near[old]]
            new = np.flatnonzero(~old)
            if len(new):
                at = miss[first[new]]
                idx[new] = np.arange(self.n, self.n + len(new))
                words = [joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                for lo in range(0, len(words), 8192):
                    self._store(words[lo:lo + 8192])
                self.hashes = np.insert(self.hashes, place[new], uniq[new])
                self.order = np.insert(self.order, place[new], idx[new].astype(np.int32))
            out[miss] = idx[inv]
            s = (uniq & np.uint64(self.SLOTS - 1)).astype(np.int64)
            self.keys[s], self.vals[s] = uniq, idx
        return self._checked(out.astype(np.int64), joined, cps, starts, ends)

    def _checked(self, out: np.ndarray, joined: str, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``out`` with the words that differ from what the table holds under their
        hash replaced by entries of their own."""
        lens = ends - starts
        other = np.flatnonzero(self.char_lens[out] != lens)
        if not len(other):
            differs = self.chars[span_positions(self.char_offs[out], lens)] != cps
            if not differs.any():
                return out
            other = np.unique(np.searchsorted(starts, np.flatnonzero(differs), side="right") - 1)
        else:  # lengths first: the rest can only be compared letter by letter
            same = np.flatnonzero(self.char_lens[out] == lens)
            differs = (self.chars[span_positions(self.char_offs[out[same]], lens[same])]
                       != cps[span_positions(starts[same], lens[same])])
            upto = np.cumsum(lens[same])
            other = np.union1d(other, same[np.searchsorted(upto, np.flatnonzero(differs), side="right")])
        for i in other.tolist():
            word = joined[starts[i]:ends[i]]
            if word not in self.odd:
                self._store([word])
                self.odd[word] = self.n - 1
            out[i] = self.odd[word]
        return out

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Token ids of the words, concatenated."""
        return self.flat[span_positions(self.offs[words], self.lens[words])]


def encode_batch(table: WordIds, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets by text)."""
    from caprank.llm.common import code_points

    cps, offsets, joined = code_points(texts)
    starts, ends = piece_spans(cps, offsets)
    words = table.words(joined, cps, starts, ends)
    upto = np.concatenate(([0], np.cumsum(table.lens[words])))
    return table.ids(words), upto[np.searchsorted(starts, offsets, side="left")]
