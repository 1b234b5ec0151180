"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q and a length of at least
``max(SHORTEST, 3 * q)`` that no neighbouring word extends.  The texts of a batch
become one array of word numbers with a separator of its own behind each text.
Prefix doubling names all blocks of 8, 16, 32, ... words and gives the suffix
array; a wavelet tree over it answers, for many blocks at once, where the next
occurrence of a block at or after a place lies (range successor).

A run of period q, 2**k <= q < 2**(k+1), holds a block of 2**k words at a multiple
of 2**k whose copy q words on lies in the run, too (for q < 8 the same holds for
blocks of 8 words, as a run has 24).  So each dyadic block asks for its occurrences
in the next window.  They form an arithmetic progression.  One or two of them are
candidates as they are; more mean that the block has a period p of its own, the
step, and then only two shifts can be a period of the run: those that map the end,
or the start, of the stretch of period p around the block onto that of the stretch
around the occurrences.  Candidates are extended both ways with the block names and
kept if long enough; of equal stretches the smallest period counts.

Scale: each text is whole in its task and meets no other, so there is no shuffle.
Texts in which no 8 words occur twice have no run and stop there.

Defined results: a null or empty text has no words and no run; equal words are
equal bytes; repeated rows are texts of their own; null ids have a null checksum and
are never rewritten; ties between best runs go to the smallest start, then period;
an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from caprank.llm.common import NO_ID, documents, null_id, text_batches, with_id

SHORTEST = 24
#: Words of the smallest block; a run of SHORTEST words holds one and its copy.
BLOCK = 8


def dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the keys, number of each key's class by value)."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.concatenate(([0], ordered[1:] != ordered[:-1]))
    names = np.empty(len(key), dtype=np.int64)
    names[order] = np.cumsum(new)
    return order, names


def doubled(names: np.ndarray, h: int) -> np.ndarray:
    """Key of the block twice as long at each place; behind the end lies nothing."""
    behind = np.zeros(len(names), dtype=np.int64)
    behind[:-h or None] = names[h:] + 1 if h < len(names) else 0
    return names * (len(names) + 1) + behind


class WaveletTree:
    """Bits of the values of an array, level by level from the highest, each
    level stably split by the bit above."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, self.n.bit_length())  # n itself is asked for, too
        self.zeros, self.counts = [], []
        now = values
        for level in range(self.bits - 1, -1, -1):
            one = (now >> level & 1).astype(bool)
            count = np.zeros(self.n + 1, dtype=np.int32)  # zeros before each place
            np.cumsum(~one, out=count[1:])
            self.counts.append(count)
            self.zeros.append(int(count[-1]))
            now = np.concatenate((now[~one], now[one]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at [lo, hi) are smaller than x."""
        out = np.zeros(len(lo), dtype=np.int64)
        for level, count, zeros in zip(range(self.bits - 1, -1, -1), self.counts, self.zeros, strict=True):
            a, b = count[lo], count[hi]
            one = (x >> level & 1).astype(bool)
            out += np.where(one, b - a, 0)
            lo = np.where(one, zeros + lo - a, a)
            hi = np.where(one, zeros + hi - b, b)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values at [lo, hi)."""
        out = np.zeros(len(lo), dtype=np.int64)
        for level, count, zeros in zip(range(self.bits - 1, -1, -1), self.counts, self.zeros, strict=True):
            a, b = count[lo], count[hi]
            one = k >= b - a
            out |= one.astype(np.int64) << level
            k = np.where(one, k - (b - a), k)
            lo = np.where(one, zeros + lo - a, a)
            hi = np.where(one, zeros + hi - b, b)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value >= x at [lo, hi), or n if there is none."""
        k = self.below(lo, hi, x)
        out = np.full(len(lo), self.n, dtype=np.int64)
        has = np.flatnonzero(k < hi - lo)
        out[has] = self.smallest(lo[has], hi[has], k[has])
        return out


class Blocks:
    """Names of all blocks of ``size`` words for size = BLOCK, 2 * BLOCK, ..., and
    the suffix array, of an array of words in which each text ends with a
    separator that occurs once."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)
        _, names = dense(words)
        h = 1
        while h < BLOCK:
            order, names = dense(doubled(names, h))
            h *= 2
        #: names[j]: class of the BLOCK * 2**j words from each place, by content
        self.names = [names.astype(np.int32)]
        while names.max() < self.n - 1:  # blocks with a separator inside are single
            order, names = dense(doubled(names, h))
            h *= 2
            self.names.append(names.astype(np.int32))
        self.suffixes = order

    def interval(self, j: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the suffix array whose suffixes start with the block of
        BLOCK * 2**j words at each place."""
        ordered = self.names[j][self.suffixes]
        edge = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [self.n]))
        own = self.names[j][at]
        return edge[own], edge[own + 1]

    def _steps(self):
        for j in range(len(self.names) - 1, -1, -1):
            yield self.names[j], BLOCK << j
        # classes shorter than BLOCK are not kept: compare words one by one
        for _ in range(BLOCK - 1):
            yield self.words, 1

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a and from b on (a < b).  A block that
        reaches over the end of the array holds its last separator, which is
        nowhere else, so it is never equal to another."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for names, size in self._steps():
            inside = b < self.n
            same = inside & (names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)])
            step = np.where(same, size, 0)
            a, b, out = a + step, b + step, out + step
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree before a and before b (a < b)."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for names, size in self._steps():
            inside = a >= size
            same = inside & (names[np.where(inside, a - size, 0)] == names[np.where(inside, b - size, 0)])
            step = np.where(same, size, 0)
            a, b, out = a - step, b - step, out + step
        return out


def candidates(blocks: Blocks, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs such that every run is found from one of them;
    ``ends`` is the place of the separator behind each word's text."""
    tree = WaveletTree(blocks.suffixes)
    places, periods = [], []

    def add(at, q):
        ok = q > 0
        places.append(at[ok])
        periods.append(q[ok])

    for j in range(len(blocks.names)):
        size = BLOCK << j
        s = np.arange(0, blocks.n, size)
        s = s[s + 2 * size <= ends[s]]  # the block and its copy lie in the text
        if not len(s):
            break
        lo, hi = blocks.interval(j, s)
        many = hi - lo > 1
        s, lo, hi = s[many], lo[many], hi[many]
        if not len(s):
            continue
        if j == 0:  # periods under BLOCK: the next occurrence
            x = tree.successor(lo, hi, s + 1)
            near = x < s + size
            add(s[near], (x - s)[near])
        x = tree.successor(lo, hi, s + size)
        found = x < s + 2 * size
        s, lo, hi, x = s[found], lo[found], hi[found], x[found]
        add(s, x - s)
        y = tree.successor(lo, hi, x + 1)
        second = y < s + 2 * size
        s, x, y = s[second], x[second], y[second]
        add(s, y - s)
        step = y - x
        periodic = 2 * step <= size  # a progression of any length; else it has two members
        s, x, step = s[periodic], x[periodic], step[periodic]
        if len(s):
            add(s, x + blocks.forward(x, x + step) - s - blocks.forward(s, s + step))
            add(s, x - blocks.backward(x, x + step) - s + blocks.backward(s, s + step))
    if not places:
        none = np.empty(0, dtype=np.int64)
        return none, none
    at, q = np.divmod(np.unique(np.concatenate(places) * (blocks.n + 1) + np.concatenate(periods)), blocks.n + 1)
    inside = at + q < ends[at]
    return at[inside], q[inside]


def runs_of(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs of the texts in ``words``, by start, then
    period."""
    blocks = Blocks(words)
    at, q = candidates(blocks, ends)
    start = at - blocks.backward(at, at + q)
    stop = at + q + blocks.forward(at, at + q)
    long = stop - start >= np.maximum(SHORTEST, 3 * q)
    start, stop, q = start[long], stop[long], q[long]
    order = np.lexsort((q, stop, start))
    start, stop, q = start[order], stop[order], q[order]
    first = np.ones(len(start), dtype=bool)  # of a stretch the smallest period
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, q = start[first], stop[first], q[first]
    order = np.lexsort((q, start))
    return start[order], stop[order], q[order]


def numbers(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers with a separator behind each text, start of each text, place
    of the separator of each word's text)."""
    table: defaultdict[bytes, int] = defaultdict()
    table.default_factory = table.__len__
    lens = np.array([len(x) for x in lists], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    out = np.empty(int(lens.sum()) + len(lists), dtype=np.int64)
    for a, n, x in zip(first.tolist(), lens.tolist(), lists, strict=True):
        out[a:a + n] = np.fromiter(map(table.__getitem__, x), dtype=np.int64, count=n)
    out[first + lens] = len(table) + np.arange(len(lists))
    return out, first, np.repeat(first + lens, lens + 1)


def repeating(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True for each text in which BLOCK words in a row occur twice."""
    _, names = dense(words)
    h = 1
    while h < BLOCK:
        _, names = dense(doubled(names, h))
        h *= 2
    text = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    key = np.sort(names * len(first) + text)
    out = np.zeros(len(first), dtype=bool)
    out[key[1:][key[1:] == key[:-1]] % len(first)] = True
    return out


def find_runs(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    some = [i for i, x in enumerate(lists) if len(x) >= SHORTEST]
    if some:
        words, first, _ = numbers([lists[i] for i in some])
        some = [i for i, r in zip(some, repeating(words, first).tolist(), strict=True) if r]
    if some:
        words, first, ends = numbers([lists[i] for i in some])
        start, stop, period = runs_of(words, ends)
        text = np.searchsorted(first, start, side="right") - 1
        for t, a, b, q in zip(text.tolist(), (start - first[text]).tolist(), (stop - start).tolist(), period.tolist(), strict=True):
            out[some[t]].append((a, b, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    out, at = [], 0
    for a, b in sorted((a + q, a + n) for a, n, q in runs):
        out.extend(words[at:max(a, at)])
        at = max(at, b)
    return out + words[at:]


def best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Run with the greatest length / period, compared exactly."""
    top = None
    for r in runs:  # by start, then period
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    return top


def planted(doc_id: int, words: list[bytes]) -> list[bytes]:
    """Words of the contract's query: every tenth text (by crc32 of its id) goes on
    with a period from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n or doc_id == NO_ID:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * -(-(n - a) // p))[:n - a]


def periodic_runs(docs: DataFrame, rewrite=None) -> DataFrame:
    """doc_id, n_words, runs (array<struct<start, length, period>>) and collapsed
    (binary: the kept words joined by one space) of each row of (doc_id, text);
    ``rewrite(doc_id, words)`` gives the words to search in, if given."""

    def part(batches):
        for ids, texts in text_batches(batches):
            lists = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # splits at 0x20, 0x09-0x0D
            if rewrite:
                lists = [rewrite(i, x) for i, x in zip(ids, lists, strict=True)]
            found = find_runs(lists)
            yield pd.DataFrame({"doc_id": ids, "n_words": [len(x) for x in lists],
                                "runs": [[{"start": a, "length": b, "period": q} for a, b, q in r] for r in found],
                                "collapsed": [b" ".join(collapsed(x, r)) for x, r in zip(lists, found, strict=True)]})

    return (with_id(docs).mapInPandas(part, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                            "collapsed binary")
            .select(null_id(), "n_words", "runs", "collapsed"))


def run_digests(docs: DataFrame, rewrite=None) -> DataFrame:
    """The same search with digests in place of runs and words."""
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def part(batches):
        for ids, texts in text_batches(batches):
            lists = [t.encode("utf-8", "surrogatepass").split() for t in texts]
            if rewrite:
                lists = [rewrite(i, x) for i, x in zip(ids, lists, strict=True)]
            out = []
            for i, words, runs in zip(ids, lists, find_runs(lists), strict=True):
                a, n, q = best(runs) or (None, None, None)
                listing = "".join(f"{x},{y},{z}\n" for x, y, z in runs)
                out.append((i, len(runs), a, n, q, None if q is None else 1000 * n // q,
                            hashlib.sha256(listing.encode()).hexdigest(),
                            hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
            pdf = pd.DataFrame(out, columns=columns)
            for c in columns[2:6]:
                pdf[c] = pd.array([r[columns.index(c)] for r in out], dtype="Int64")
            yield pdf

    return (with_id(docs).mapInPandas(part, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                                            "runs_sha256 string, collapsed_sha256 string")
            .select(null_id(), *columns[1:]))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, after the rewriting of every tenth."""
    return run_digests(documents(spark, sf_dir), planted)
