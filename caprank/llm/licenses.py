"""License scans: winnowed fingerprints, an inverted index, banded alignment.

Texts and templates are sequences of lower-case words of letters and digits.  The
hashes of ``GRAM`` words in a row are winnowed (the smallest of each ``WINDOW``, the
rightmost if equal), so any ``GRAM + WINDOW - 1`` words in common share a
fingerprint.  An inverted index from fingerprints to (template, place) turns those
of a document into hits; hits on near diagonals, in the order of the template, form
a candidate.  Each candidate is aligned with its template inside a band around its
diagonals (match 2, mismatch and gap -1, local), and again left and right of the
match, which gives matched words, coverage of the template and the span in
characters.  Matches of at least ``MIN_COVERAGE`` that hold the phrases of their
template (name, version) are reported; of matches that overlap, the one with more
matched words (then the smaller name).  ``license_texts`` holds the templates.

The index is that of the templates, a parameter, and goes along with the
function; documents are scanned where they lie, without a shuffle.

Defined results: null and empty texts match nothing; each occurrence is a row of
its own, however many; repeated rows are scanned each, null ids give rows with a null
id; texts are scanned whole; equally good alignments go to the earlier place; an empty
table has no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.llm.common import code_points, documents, mix64, null_id, span_hashes, text_batches, with_id
from caprank.llm.license_texts import PHRASES, TEMPLATES
from caprank.llm.pieces import LETTER, NUMBER, class_table

GRAM, WINDOW, BAND, MIN_COVERAGE = 3, 2, 6, 0.75

MATCHES = ("doc_id long, license string, template string, matched int, coverage double, start long, stop long")


def words_of(texts: list[str]):
    """Word hashes of a batch, their character spans within their text, and the
    text's index."""
    cps, offsets, _ = code_points([t.lower() if len(t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t)
                                   for t in texts])
    kind = class_table()[cps]
    word = (kind == LETTER) | (kind == NUMBER)
    border = np.zeros(len(cps) + 1, dtype=bool)
    border[offsets] = True
    starts = np.flatnonzero(word & (~np.concatenate(([False], word[:-1])) | border[:-1])) if len(cps) else np.empty(0, dtype=np.int64)
    ends = np.flatnonzero(word & (~np.concatenate((word[1:], [False])) | border[1:])) + 1 if len(cps) else starts
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return span_hashes(cps, starts, ends), starts - offsets[doc], ends - offsets[doc], doc


def fingerprints(h: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the winnowed word grams of one sequence."""
    n = len(h) - gram + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    g = np.zeros(n, dtype=np.uint64)
    for k in range(gram):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k]
    g = mix64(g)
    if n <= window:
        at = np.array([n - 1 - int(np.argmin(g[::-1]))])
        return g[at], at
    views = np.lib.stride_tricks.sliding_window_view(g, window)
    at = np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))
    return g[at], at


class Index:
    """Inverted index of the fingerprints of the templates."""

    def __init__(self, templates):
        self.phrases = [[words_of([x])[0].tolist() for x in PHRASES.get((a, b), ())] for a, b, _ in templates]
        self.names = [(a, b) for a, b, _ in templates]
        self.words, self.sets, entries = [], [], []
        for i, (_, _, text) in enumerate(templates):
            h, *_ = words_of([text])
            self.words.append(h.tolist())
            self.sets.append(np.unique(h))
            f, at = fingerprints(h)
            entries += [(x, i, p) for x, p in zip(f.tolist(), at.tolist(), strict=True)]
        entries.sort()
        self.keys = np.array([e[0] for e in entries], dtype=np.uint64)
        self.template = np.array([e[1] for e in entries], dtype=np.int64)
        self.place = np.array([e[2] for e in entries], dtype=np.int64)

    def candidates(self, h: np.ndarray):
        """(template, [(hits, first diagonal, last diagonal, first and last text
        place)]) of chains of hits.  A chain goes forward in text and template and
        moves by at most ``BAND`` diagonals from hit to hit, so a new pass over the
        template is a new chain and no chain is wider than its template allows."""
        f, at = fingerprints(h)
        lo, hi = np.searchsorted(self.keys, f, side="left"), np.searchsorted(self.keys, f, side="right")
        found: dict[int, list[tuple[int, int]]] = {}
        for x in np.flatnonzero(hi > lo).tolist():
            for e in range(int(lo[x]), int(hi[x])):
                found.setdefault(int(self.template[e]), []).append((int(at[x]), int(self.place[e])))
        for t, hits in sorted(found.items()):
            far = len(self.words[t]) + BAND
            done, live = [], []  # chains: [hits, first diagonal, last diagonal, first text place, text place, place]
            for x, p in sorted(hits):
                if live and live[0][4] < x - far:
                    done += [c for c in live if c[4] < x - far]
                    live = [c for c in live if c[4] >= x - far]
                near = [(abs(x - p - c[4] + c[5]), -c[4], k) for k, c in enumerate(live) if c[4] < x and c[5] < p]
                step, _, k = min(near, default=(BAND + 1, 0, 0))
                if step > BAND:
                    live.append([1, x - p, x - p, x, x, p])
                else:
                    c = live.pop(k)
                    live.append([c[0] + 1, min(c[1], x - p), max(c[2], x - p), c[3], x, p])
            yield t, sorted((c[:5] for c in done + live), key=lambda c: (-c[0], c[3]))


def banded(template: list, text: list, low: int, high: int):
    """Best local alignment with diagonals (text - template) from ``low`` to
    ``high``: (matched words, first and last text word), or None."""
    width = high - low + 1
    best, top = None, 0
    prev = [(0, 0, -1)] * width  # (score, matched, first text word) by diagonal
    for i, w in enumerate(template):
        row = []
        for d in range(width):
            j = i + low + d
            cell = (0, 0, -1)
            if 0 <= j < len(text):
                s, m, a = prev[d]
                hit = text[j] == w
                s += 2 if hit else -1
                if s > 0:
                    cell = (s, m + hit, a if a >= 0 else j)
                if d + 1 < width and prev[d + 1][0] - 1 > cell[0]:
                    s, m, a = prev[d + 1]
                    cell = (s - 1, m, a)
                if d > 0 and row[d - 1][0] - 1 > cell[0]:
                    s, m, a = row[d - 1]
                    cell = (s - 1, m, a)
                if hit and cell[0] > top:
                    top, best = cell[0], (cell[1], cell[2], j)
            row.append(cell)
        prev = row
    return best


def matches(index: Index, h: np.ndarray, min_coverage: float = MIN_COVERAGE):
    """(template, matched, first word, last word), overlapping ones resolved."""
    found = set()
    text = None
    for t, chains in index.candidates(h):
        text = h.tolist() if text is None else text
        words = index.words[t]
        need = min_coverage * len(words)
        # a piece of text with fewer words of the template than needed has no match
        run = np.concatenate(([0], np.cumsum(np.isin(h, index.sets[t])))).tolist()
        spans: list[tuple[int, int]] = []
        for _, low, high, first, last in chains:
            k = bisect_right(spans, (first, len(text)))
            if k and last <= spans[k - 1][1]:
                continue
            # what lies left and right of a match is aligned again
            todo = [(max(0, low - BAND), min(len(text), high + len(words) + BAND))]
            while todo:
                a, b = todo.pop()
                if b <= a or run[b] - run[a] < need:
                    continue
                best = banded(words, text[a:b], low - BAND - a, high + BAND - a)
                if best and best[0] >= need:
                    match = (t, best[0], best[1] + a, best[2] + a)
                    passage = text[match[2]:match[3] + 1]
                    named = all(any(passage[k:k + len(x)] == x for k in range(len(passage))) for x in index.phrases[t])
                    if named and match not in found:
                        found.add(match)
                        insort(spans, match[2:])
                    todo += [(a, match[2]), (match[3] + 1, b)]
    kept: list[tuple[int, int, int, int]] = []  # (first word, last word, template, matched), in order
    for t, m, a, b in sorted(found, key=lambda x: (-x[1], index.names[x[0]], x[2], x[3])):
        k = bisect_right(kept, (b, len(h)))
        if not k or kept[k - 1][1] < a:
            kept.insert(k, (a, b, t, m))
    return [(t, m, a, b) for a, b, t, m in kept]


def scan(docs: DataFrame, templates=TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row for each occurrence of a template in (doc_id, text)."""

    def part(batches):
        index = Index(templates)
        for ids, texts in text_batches(batches):
            h, starts, stops, doc = words_of(texts)
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            out = []
            for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                grams = h[lo:hi]
                for t, m, a, b in matches(index, grams, min_coverage):
                    out.append((ids[i], *index.names[t], m, m / len(index.words[t]), int(starts[lo + a]), int(stops[lo + b])))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "license", "template", "matched", "coverage", "start", "stop"])

    return with_id(docs).mapInPandas(part, MATCHES).withColumn("doc_id", null_id())


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a license template in every document."""
    return scan(documents(spark, sf_dir)).select(
        "doc_id", "license", "template", "matched", "coverage", F.col("start").alias("span_start"), F.col("stop").alias("span_stop"))
