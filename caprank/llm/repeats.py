"""Suffix-array deduplication by common-prefix interval trees.

Passages are found on UTF-8 bytes.  Every window of ``length`` bytes chooses an
anchor, the smallest hashed ``seed``-byte string in it; equal windows choose equal
anchors at equal offsets.  Anchors that occur in two or more documents get their
context: the bytes of all windows that chose them.  Contexts with one anchor
meet in one task, which sorts their suffixes, computes the common prefixes of
neighbours, and scans them with a stack: every interval of the common-prefix
interval tree of depth ``length`` or more whose left extensions differ is a
maximal repeat, reported with all its occurrences.

Scale: anchors are narrow rows, about one for 16 bytes; only repeated ones carry
text further.  Exact copies of whole texts collapse first; equal contexts
collapse inside the map task (the smallest doc_id stays, the others are covered
whole), so a passage of a third of all documents reaches its task once per map
task.  An anchor with very many different contexts (a common short line) is split
into its windows, which only need the smallest document of each string.  Anchor
lists are window functions, which spill.

Defined results: null and empty texts have no bytes and no spans; a text shorter
than ``length`` keeps all its bytes; repeats inside one document alone remove
nothing; rows that repeat a doc_id count as one document with one of its texts, the
one with the smallest digest; rows without a doc_id are left out (a pipeline keeps
them as they are); an empty table has no rows; other columns are ignored by the
operator and kept by the stage.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caprank.llm.common import (claim, counted_texts, documents, exact_copies, first_copies, mix64, repeated_ids, slices, small_side,
                                span_positions, temporary, text_batches, text_sha, trim, unused, utf8_bytes, written)

LENGTH = 50
SEED = 20
#: Bytes, and characters of whole texts, whose anchors are chosen at once.
PART, PART_CHARS = 1 << 15, 30_000
#: Anchors of one batch that leaves a task.
ROWS = 50_000
#: Bytes of contexts that one suffix array holds; one anchor's contexts stay together.
CHUNK = 500_000
#: An anchor with more distinct contexts is split into its windows.
HOT_CONTEXTS = 16_384
#: Strings of one window's length that a join may broadcast (about 150 bytes each).
WINDOWS = 200_000
#: Occurrences of maximal repeats laid out at once.
OCCURRENCES = 250_000

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _words(data: np.ndarray, kind: str) -> np.ndarray:
    """The 8 bytes from each position on as one integer, read as ``kind`` (bytes
    behind the end are 0)."""
    room = np.zeros(len(data) + 8, dtype=np.uint8)
    room[:len(data)] = data
    return np.ndarray(len(data), kind, room, strides=(1,)).astype(np.uint64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """Anchors of a batch: position, hash, first and last window start that
    chose it, document index.  Windows cross no document border."""
    n = len(data)
    windows = n - length + 1
    empty = np.empty(0, dtype=np.int64)
    if windows <= 0:
        return empty, empty.astype(np.uint64), empty, empty, empty
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = span_positions(offsets[:-1], counts)
    if not len(starts):
        return empty, empty.astype(np.uint64), empty, empty, empty
    w8 = _words(data, "<u8")
    m = n - seed + 1
    h = w8[:m] * _C[0]
    h ^= h >> np.uint64(29)
    at = 8
    while at + 8 <= seed:
        h = (h + w8[at:at + m]) * _C[1]
        h ^= h >> np.uint64(31)
        at += 8
    if at < seed:
        h = (h + (w8[at:at + m] & np.uint64((1 << 8 * (seed - at)) - 1))) * _C[2]
    h = mix64(h)
    low = np.uint64((1 << 26) - 1)
    key = (h & ~low) | np.arange(m, dtype=np.uint64)
    span, width = length - seed + 1, 1
    best = key
    while width * 2 <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[:len(best) - (span - width)], best[span - width:])
    place = (best[starts] & low).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    pos = place[first]
    return pos, h[pos], starts[first], starts[last], doc[first]


def _parts(ids, texts, length):
    """(row index, shift, data, offsets) of a batch.  Arrays of a part fit into the
    processor's cache and below the size from which memory is mapped anew, so longer
    texts go in parts that overlap by ``length - 1`` bytes: every window lies in
    exactly one part."""
    limit = max(PART, 2 * length)
    data, offsets = utf8_bytes(texts)
    if len(data) < limit:
        yield np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64), data, offsets
        return
    for i in range(len(ids)):
        own = data[offsets[i]:offsets[i + 1]]
        for lo in range(0, max(len(own) - length + 1, 1), limit - length + 1):
            part = own[lo:lo + limit]
            yield np.array([i]), np.array([lo]), part, np.array([0, len(part)])


def repeated_anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, h array<long>): anchors of each document that another document
    has as well."""

    def part(batches):
        found, n = [], 0
        for ids, texts in text_batches(batches, PART_CHARS, owner="repeats"):
            own = np.array(ids, dtype=np.int64)
            for rows, _, data, offsets in _parts(ids, texts, length):
                _, h, _, _, doc = anchors(data, offsets, length, seed)
                if len(h):
                    order = np.lexsort((h, doc))
                    h, doc = h[order], doc[order]
                    keep = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
                    found.append((h[keep].view(np.int64), own[rows[doc[keep]]]))
                    n += len(found[-1][0])
            if n >= ROWS:
                yield frame(found)
                found, n = [], 0
        if n:
            yield frame(found)

    def frame(found):
        return pd.DataFrame({"h": np.concatenate([h for h, _ in found]), "doc_id": np.concatenate([d for _, d in found])})

    w = Window.partitionBy("h")
    return (docs.mapInPandas(part, "h long, doc_id long")
            .withColumns({"lo": F.min("doc_id").over(w), "hi": F.max("doc_id").over(w)}).where("lo <> hi")
            .groupBy("doc_id").agg(F.collect_set("h").alias("h")))


def some_contexts(pdf: pd.DataFrame, length: int, seed: int) -> pd.DataFrame:
    """Rows of ``contexts`` of some documents (doc_id, text, h), ascending by doc_id.
    All documents that have a repeated anchor list it, so one sorted list serves them."""
    flagged = np.unique(np.concatenate(pdf["h"].tolist()).astype(np.int64).view(np.uint64))
    ids, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
    seen: dict[bytes, int] = {}
    found: list[bytes] = []
    places = [np.empty((4, 0), dtype=np.int64)]  # h, doc_id, start, stop
    for lo, hi in slices(list(map(len, texts)), PART_CHARS, 256):
        for rows, shift, data, offsets in _parts(ids[lo:hi], texts[lo:hi], length):
            _, h, first, last, doc = anchors(data, offsets, length, seed)
            at = np.minimum(np.searchsorted(flagged, h), len(flagged) - 1)
            some = np.flatnonzero(flagged[at] == h)
            a, stop, row = first[some], last[some] + length, doc[some]
            to_text = shift[row] - offsets[row]
            places.append(np.stack([h[some].view(np.int64), ids[lo:hi][rows[row]], a + to_text, stop + to_text]))
            raw = data.tobytes()
            found += [raw[x:y] for x, y in zip(a.tolist(), stop.tolist(), strict=True)]
    h, d, start, stop = np.concatenate(places, axis=1)
    first = np.fromiter(map(seen.setdefault, found, d.tolist()), dtype=np.int64, count=len(d))
    own = first == d
    whole = merged(pd.DataFrame({"doc_id": d[~own], "start": start[~own], "stop": stop[~own]}))
    n = len(whole)
    return pd.DataFrame({
        "h": pd.arrays.IntegerArray(np.append(h[own], np.zeros(n, dtype=np.int64)), np.arange(own.sum() + n) >= own.sum()),
        "doc_id": np.append(d[own], whole["doc_id"]), "start": np.append(start[own], whole["start"]),
        "stop": np.append(stop[own], whole["stop"]),
        "bytes": pd.Series([x for x, mine in zip(found, own.tolist(), strict=True) if mine] + [None] * n, dtype=object)})


def contexts(docs: DataFrame, repeated: DataFrame, length: int, seed: int) -> DataFrame:
    """Contexts of repeated anchors: h, doc_id, start, off (the anchor's place
    in it), left (the byte before, -1 at a text's start, -2 where another
    anchor's context lies before), bytes.  A row without h is a span covered
    whole: the contexts that it joins lie in smaller documents of this map task."""

    def part(batches):
        claim("repeats")
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                yield some_contexts(pdf.iloc[lo:lo + 256].sort_values("doc_id", kind="stable"), length, seed)

    return (docs.join(repeated, "doc_id").select("doc_id", "text", "h")
            .mapInPandas(part, "h long, doc_id long, start long, stop long, bytes binary"))


def _by_group(group: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Stable order by group and word.  Group, rank of the word and place make one
    integer if they fit, which sorts faster than two keys."""
    n = len(word)
    bits = n.bit_length()
    if int(group.max(initial=0)).bit_length() + 2 * bits > 63:
        return np.lexsort((word, group))
    order = np.argsort(word)
    ordered = word[order]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))[:n]
    key = (group << (2 * bits)) | (rank << bits) | np.arange(n)
    key.sort()
    return key & ((1 << bits) - 1)


def _leading(x: np.ndarray) -> np.ndarray:
    """Equal leading bytes of two words whose exclusive or is ``x``, not 0."""
    lead = np.zeros(len(x), dtype=np.int64)
    for s in range(1, 8):
        lead += (x >> np.uint64(8 * (8 - s))) == 0
    return lead


def suffix_array(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, group: np.ndarray):
    """Order of the suffixes [start, stop) by group and content, and the length
    of the common prefix of each with the one before it (0 across groups).  Suffixes
    are sorted by 8 bytes; of those still equal the next 8 bytes are read, and only
    runs in which these differ are sorted again."""
    words = _words(data, ">u8")
    room = stops - starts
    n, depth = len(data), int((room.max(initial=0) + 7) // 8)

    def word(some, k):
        w = words[np.minimum(starts[some] + 8 * k, n - 1)]
        left = room[some] - 8 * k
        short = np.flatnonzero(left < 8)
        left = np.maximum(left[short], 0).astype(np.uint64)
        w[short] &= np.where(left > 0, ~np.uint64(0) << (np.uint64(64) - np.maximum(left, np.uint64(1)) * np.uint64(8)), np.uint64(0))
        return w

    lcp = np.zeros(len(starts), dtype=np.int64)
    if not len(starts):
        return lcp.copy(), lcp
    w = word(np.arange(len(starts)), 0)
    order = _by_group(group, w)
    w, g = w[order], group[order]
    at = np.arange(len(order))  # places of suffixes equal to a neighbour so far
    tied = np.concatenate(([False], g[1:] == g[:-1]))  # equal to the one before
    for k in range(depth):
        if k:
            w = word(order[at], k)
            mixed = tied[1:] & (w[1:] != w[:-1])
            if mixed.any():
                run = np.cumsum(~tied) - 1
                several = np.zeros(run[-1] + 1, dtype=bool)
                several[run[1:][mixed]] = True
                again = np.flatnonzero(several[run])
                o = again[np.lexsort((w[again], run[again]))]
                order[at[again]], w[again] = order[at[o]], w[o]
        new = np.flatnonzero(tied[1:] & (w[1:] != w[:-1])) + 1
        lcp[at[new]] = 8 * k + _leading(w[new] ^ w[new - 1])
        tied[new] = False
        live = tied | np.append(tied[1:], False)
        at, tied = at[live], tied[live]
        if not len(at):
            break
    if len(at):  # equal but for zero bytes at the end
        o = np.lexsort((room[order[at]], np.cumsum(~tied)))
        order[at] = order[at[o]]
        lcp[at[tied]] = 8 * depth
    lcp[1:] = np.minimum(lcp[1:], np.minimum(room[order[:-1]], room[order[1:]]))
    return order, lcp


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int) -> np.ndarray:
    """Intervals (rows of lo, hi, depth) of the common-prefix interval tree with
    depth ``least`` or more whose left extensions differ.  ``lcp[i]`` belongs to
    suffixes i-1 and i in sorted order; a negative ``left`` differs from everything."""
    deep = lcp >= least
    edge = np.flatnonzero(np.diff(np.concatenate(([False], deep, [False])).astype(np.int8)))
    out = array("q")
    changes = np.concatenate(([0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0))))
    for lo, hi in zip((edge[::2] - 1).tolist(), (edge[1::2] - 1).tolist(), strict=True):
        if changes[lo] == changes[hi]:
            continue  # every occurrence extends to the left: found one byte earlier
        if hi - lo == 1:
            out.extend((lo, hi, int(lcp[hi])))
            continue
        stack = [(int(lcp[lo + 1]), lo)]
        for i, v in enumerate(lcp[lo + 2:hi + 1].tolist() + [-1], lo + 2):
            begin = i - 1
            while stack and stack[-1][0] > v:
                depth, begin = stack.pop()
                if changes[begin] != changes[i - 1]:
                    out.extend((begin, i - 1, depth))
            if v >= 0 and (not stack or stack[-1][0] < v):
                stack.append((v, begin))
    return np.array(out, dtype=np.int64).reshape(-1, 3)


class Chunk:
    """Enhanced suffix array and maximal repeats of the contexts of whole anchors."""

    def __init__(self, pdf: pd.DataFrame, length: int):
        raw = pdf["bytes"].tolist()
        lens = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.base = np.cumsum(lens) - lens
        counts = lens - length + 1
        self.ctx = np.repeat(np.arange(len(raw)), counts)
        self.inner = np.arange(len(self.ctx)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = self.base[self.ctx] + self.inner
        left = np.where(self.inner > 0, data[np.maximum(starts - 1, 0)].astype(np.int64), -1)
        _, group = np.unique(pdf["h"].to_numpy(), return_inverse=True)
        self.order, lcp = suffix_array(data, starts, (self.base + lens)[self.ctx], group[self.ctx])
        self.doc, self.start = pdf["doc_id"].to_numpy(), pdf["start"].to_numpy()
        self.intervals = maximal_repeats(lcp, left[self.order], length)

    def occurrences(self):
        """Suffix, depth and smallest document of each occurrence of each maximal
        repeat, a bounded number at a time (an interval stays together)."""
        lo, hi, depth = self.intervals.T
        size = hi - lo + 1
        upto = np.cumsum(size)
        at = 0
        while at < len(lo):
            stop = max(at + 1, int(np.searchsorted(upto, upto[at] - size[at] + OCCURRENCES, side="right")))
            n = size[at:stop]
            first = np.cumsum(n) - n
            own = np.repeat(np.arange(stop - at), n)
            suffix = self.order[np.repeat(lo[at:stop] - first, n) + np.arange(len(own))]
            doc = self.doc[self.ctx[suffix]]
            yield suffix, depth[at:stop][own], np.minimum.reduceat(doc, first)[own]
            at = stop

    def repeats(self):
        """Frames doc_id, start, size, first_doc of all occurrences."""
        for suffix, depth, first in self.occurrences():
            yield pd.DataFrame({"doc_id": self.doc[self.ctx[suffix]], "start": self.start[self.ctx[suffix]] + self.inner[suffix],
                                "size": depth, "first_doc": first})

    def covered(self):
        """Frame doc_id, start, stop of the bytes that repeat a smaller document:
        of all intervals that hold a suffix the deepest one with a smaller document
        counts, and what overlaps inside a context is one span."""
        best = np.zeros(len(self.ctx), dtype=np.int64)
        for suffix, depth, first in self.occurrences():
            later = first < self.doc[self.ctx[suffix]]
            np.maximum.at(best, suffix[later], depth[later])
        some = np.flatnonzero(best)
        if not len(some):
            return
        ctx, a = self.ctx[some], self.base[self.ctx[some]] + self.inner[some]
        reach = np.maximum.accumulate(a + best[some])
        new = np.ones(len(some), dtype=bool)
        new[1:] = (a[1:] > reach[:-1]) | (ctx[1:] != ctx[:-1])
        at = np.flatnonzero(new)
        stop = reach[np.append(at[1:], len(some)) - 1]
        shift = self.start[ctx[at]] - self.base[ctx[at]]
        yield merged(pd.DataFrame({"doc_id": self.doc[ctx[at]], "start": a[at] + shift, "stop": stop + shift}))


def of_several(pdf: pd.DataFrame) -> pd.DataFrame:
    """Contexts of the anchors that still have contexts of two documents; those of one
    document cannot repeat a smaller one."""
    _, group = np.unique(pdf["h"].to_numpy(), return_inverse=True)
    doc = pdf["doc_id"].to_numpy()
    one = np.empty(group.max(initial=-1) + 1, dtype=np.int64)
    one[group] = doc
    several = np.zeros(len(one), dtype=bool)
    several[group[doc != one[group]]] = True
    return pdf[several[group]]


def in_chunks(some: DataFrame, search, copies, schema: str) -> DataFrame:
    """``search`` over chunks of the contexts (h, doc_id, start, bytes); those with
    one anchor stay together.  Of equal contexts only those of the smallest document
    enter a chunk; ``copies(rows, first)`` makes the rows of the others, which stream
    by, so a chunk holds distinct contexts."""

    def part(batches):
        claim("repeats")
        held: list[pd.DataFrame] = []
        size, last = 0, None  # last: anchor, bytes and smallest document of the context met last
        for pdf in batches:
            if not len(pdf):
                continue
            h, raw, doc = (pdf[c].to_numpy() for c in ("h", "bytes", "doc_id"))
            new = np.concatenate(([last is None or last[:2] != (h[0], raw[0])], (h[1:] != h[:-1]) | (raw[1:] != raw[:-1])))
            at = np.maximum.accumulate(np.where(new, np.arange(len(pdf)), -1))
            owners = np.where(at < 0, doc[0] if last is None else last[2], doc[at])
            last = (h[-1], raw[-1], owners[-1])
            later = owners < pdf["doc_id"].to_numpy()
            if later.any():
                yield copies(pdf[later], owners[later])
            pdf = pdf[~later]
            held.append(pdf)
            size += int(pdf["bytes"].map(len).sum())
            if size >= CHUNK:
                whole = pd.concat(held, ignore_index=True)
                open_ = whole["h"] == whole["h"].iloc[-1]
                held = [whole[open_]]
                size = int(held[0]["bytes"].map(len).sum())
                if (~open_).any():
                    yield from search(whole[~open_])
        held = [x for x in held if len(x)]
        if held:
            yield from search(pd.concat(held, ignore_index=True))
        held = []
        trim()

    return some.repartition("h").sortWithinPartitions("h", "bytes", "doc_id").mapInPandas(part, schema)


def _copied_occurrences(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": rows["doc_id"], "start": rows["start"], "size": rows["bytes"].map(len), "first_doc": first})


def _copied_spans(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
    return merged(pd.DataFrame({"doc_id": rows["doc_id"], "start": rows["start"], "stop": rows["start"] + rows["bytes"].map(len)}))


def repeated_windows(hot: DataFrame, length: int) -> DataFrame:
    """(doc_id, start, stop) of the windows of the contexts of hot anchors that a
    smaller document has as well.  Each string of ``length`` bytes is a group of its
    own, reduced to its smallest document by a combining aggregate, so neither the
    anchor nor a common string meets in one task."""
    window = F.substring("bytes", F.col("i") + 1, F.lit(length))
    rows = (hot.withColumn("i", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)))
            .select("doc_id", (F.col("start") + F.col("i")).alias("start"), window.alias("w")))
    firsts = rows.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = written(firsts.select("w", "first"), "windows")
    return (rows.join(small_side(firsts, WINDOWS), "w").where("first < doc_id")
            .select("doc_id", "start", (F.col("start") + length).alias("stop")))


def gathered(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(contexts of anchors, contexts of hot anchors or None, covered spans)."""
    repeated = written(repeated_anchors(docs, length, seed), "anchors")
    ids = repeated.select("doc_id")
    some = written(contexts(docs.join(small_side(ids), "doc_id", "left_semi"), repeated, length, seed), "contexts")
    distinct = some.where("h is not null").select("h", "doc_id", "start", "bytes")
    hot = written(distinct.groupBy("h").agg(F.count_distinct(F.xxhash64("bytes")).alias("n")).where(f"n > {HOT_CONTEXTS}").select("h"), "hot-anchors")
    covered = some.where("h is null").select("doc_id", "start", "stop")
    if hot.isEmpty():
        return distinct, None, covered
    hot = small_side(hot)
    return distinct.join(hot, "h", "left_anti"), distinct.join(hot, "h", "left_semi"), covered


def repeat_groups(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(occurrences, covered) of (doc_id, text).

    occurrences: doc_id, start, size, first_doc - each occurrence of each maximal
    repeat of ``length`` bytes or more among distinct contexts, and of each further
    equal context, with the smallest document that has it (repeats that go on beyond
    a context appear as overlapping pieces).  covered: doc_id, start, stop of spans that repeat smaller
    documents whole: further equal contexts, joined, and windows of hot anchors."""
    some, hot, covered = gathered(docs, length, seed)
    occurrences = in_chunks(some, lambda pdf: Chunk(pdf, length).repeats(), _copied_occurrences, "doc_id long, start long, size long, first_doc long")
    return occurrences, covered if hot is None else covered.unionByName(repeated_windows(hot, length))


def repeat_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, start, stop) of bytes that repeat a smaller document: the maximal
    repeats reduced to what they cover before they leave their task."""
    some, hot, covered = gathered(docs, length, seed)
    spans = in_chunks(some, lambda pdf: Chunk(of_several(pdf), length).covered(), _copied_spans, "doc_id long, start long, stop long")
    spans = spans.unionByName(merged_parts(covered))  # one Python process a task in each branch
    return spans if hot is None else spans.unionByName(repeated_windows(hot, length))


def kept_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_removed, n_spans, kept binary) of the documents with spans
    (doc_id, spans array<struct<start,stop>>)."""

    def part(batches):
        for pdf in batches:
            out = []
            for d, text, some in zip(pdf["doc_id"], pdf["text"], pdf["spans"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                kept, at, removed, runs = [], 0, 0, 0
                lo = hi = -1
                for a, b in sorted((s["start"], s["stop"]) for s in some):
                    if a > hi:
                        if hi > lo:
                            kept.append(raw[at:lo])
                            at, removed, runs = hi, removed + hi - lo, runs + 1
                        lo, hi = a, b
                    else:
                        hi = max(hi, b)
                kept.append(raw[at:lo])
                kept.append(raw[hi:])
                out.append((d, removed + hi - lo, runs + 1, b"".join(kept)))
            yield pd.DataFrame(out, columns=["doc_id", "n_removed", "n_spans", "kept"])

    return docs.join(spans, "doc_id").select("doc_id", "text", "spans").mapInPandas(
        part, "doc_id long, n_removed long, n_spans long, kept binary")


def merged(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spans (doc_id, start, stop) with those that touch or overlap joined."""
    if len(pdf) < 2:
        return pdf
    d, a, b = (pdf[c].to_numpy() for c in ("doc_id", "start", "stop"))
    order = np.lexsort((a, d))
    d, a, b = d[order], a[order], b[order]
    # stops grow along a document: documents are kept apart by an offset
    doc = np.concatenate(([0], np.cumsum(d[1:] != d[:-1])))
    base = doc * (int(b.max()) + 2)
    reach = np.maximum.accumulate(b + base)
    new = np.concatenate(([True], a[1:] + base[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(d)) - 1
    return pd.DataFrame({"doc_id": d[at], "start": a[at], "stop": reach[last] - base[last]})


def merged_parts(spans: DataFrame) -> DataFrame:
    """Spans joined as far as they meet in a batch."""

    def part(batches):
        for pdf in batches:
            yield merged(pdf)

    return spans.mapInPandas(part, "doc_id long, start long, stop long")


def removed_spans(docs: DataFrame, copies: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, spans) of bytes that repeat a smaller document, for documents
    that are not whole copies of another."""
    spans = repeat_spans(first_copies(docs, copies), length, seed)
    return spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def cut_texts(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``kept_texts`` of the documents with something to remove."""
    with temporary(docs.sparkSession):  # anchors and contexts end where the spans are known
        spans = written(removed_spans(docs, copies), "spans", keep=True)
    return kept_texts(counted_texts(docs, copies).join(small_side(spans.select("doc_id")), "doc_id", "left_semi"), spans)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that remain when each 50-byte string that also
    starts in a document with a smaller doc_id is removed."""
    docs = documents(spark, sf_dir)
    copies = written(exact_copies(docs), "reps")
    cut = cut_texts(docs, copies).select("doc_id", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    copy = (F.col("rep") != F.col("doc_id")) & (F.col("n_bytes") >= LENGTH)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return copies.join(cut, "doc_id", "left").select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without the bytes that repeat a smaller document;
    documents of which nothing but white space is left go.  A cut that splits a
    character drops its broken bytes.  n_chars follows the text.  Of rows that
    repeat a doc_id only those with the text that counts are cut; rows with other
    texts, and rows without a doc_id, stay as they are."""
    valid = F.try_validate_utf8(F.col("kept").cast("string"))
    repaired = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", "")
    key, sha, kept = unused(docs, "cut_id"), unused(docs, "cut_sha"), unused(docs, "kept_text")
    with temporary(spark):
        copies = written(exact_copies(docs), "reps", keep=True)
        cut = cut_texts(docs, copies).select("doc_id", "kept")
        whole = copies.where(f"rep <> doc_id and n_bytes >= {LENGTH}").select("doc_id", F.lit(b"").alias("kept"))
        cut = (cut.unionByName(whole).join(copies.select("doc_id", "sha"), "doc_id")
               .select(F.col("doc_id").alias(key), F.col("sha").alias(sha), F.coalesce(valid, repaired).alias(kept)))
        cut = written(cut, "cut", keep=True)
    same = docs["doc_id"] == cut[key]
    if repeated_ids(copies) is not None:
        same = same & (text_sha() == cut[sha])
    joined = docs.join(cut, same, "left").where(F.col(kept).isNull() | F.col(kept).rlike(r"\S"))
    columns = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(kept).isNotNull(), F.length(kept).cast(docs.schema["n_chars"].dataType)).otherwise(docs["n_chars"])
    return joined.select(*[columns[c].alias(c) if c in columns else docs[c] for c in docs.columns])
