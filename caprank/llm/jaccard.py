"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of 5-word shingles (64-bit hashes).  All sets are put in
one global order, rarest first by a frequency sketch.  Documents with
similarity ``t`` or more share at least ``l`` shingles among the first
``n - ceil(t * n) + l`` of each, for every ``l``.  Each document picks the ``l`` of
the smallest estimated cost: the posting entries that its prefix meets, plus
verifications bounded by ``entries / l``.  Two documents of sizes n1 and n2 must
share ``o = ceil(t / (1 + t) * (n1 + n2))`` shingles, so at most ``n - o`` of a
prefix can miss; of the prefix that ends first all common shingles lie in the
other one.  A pair is a candidate when its prefixes share ``l + o - ceil(t * n)``
shingles for one of the two: more for longer prefixes, and more for like sizes.

Groups of copies never become all pairs:

1. exact copies collapse to their smallest doc_id (combining aggregate);
2. every posting list first links neighbours in (size, doc_id) order only - one
   candidate per entry - and verified links are closed to components;
3. groups of which not all pairs are similar fall into many components at first,
   so the documents of long lists meet once more, exactly, in the largest list of
   each, and return a spanning forest;
4. then only entries of *different* components meet, in lists that hold two or
   more components, so no link between different texts is lost.

The sketch orders shingles and estimates costs; any values give right results,
but a passage that many documents share must stand out of its noise to go to the
end of the order.  It has about one counter for ``SHINGLES_PER_SLOT`` shingles, at
most ``MAX_SKETCH``: that bound makes it fit for a broadcast.  Tasks send it packed,
in segments, which are added up in two steps.

Defined results: null and empty texts have an empty set and link with nothing;
1-4 words are one shingle; repeated texts are ordinary copies; rows that repeat a
doc_id are one document with the text of the smallest digest (a pipeline keeps the
rows with other texts); rows without a doc_id are left out (a pipeline keeps them,
unjudged); texts are read whole; an empty table has no rows; other columns are
ignored by the operator and kept by the stage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caprank.llm.common import (NO_ID, code_points, documents, exact_copies, first_copies, lower_ascii, mix64, packed, repeated_ids,
                                small_side, span_hashes, temporary, text_batches, text_sha, unpacked, unused, word_spans, written)
from caprank.llm.components import components

WORDS = 5
PERCENT = 75
#: Counters of the frequency sketch (4 bytes each).
SHINGLES_PER_SLOT, MIN_SKETCH, MAX_SKETCH = 16, 1 << 16, 1 << 23
SEGMENT = 1 << 16
#: Lists of more entries are met inside a task, in tiles, not by a join.
LONG_LIST, TILE = 16, 2048
#: Longest multi-match and the cost of a verification in posting entries.
MAX_MATCH = 4
VERIFY_COST = 50.0

_MULT = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    cps, offsets, _ = code_points(texts)
    low = lower_ascii(cps)
    starts, ends, doc = word_spans(cps, offsets)
    h = span_hashes(low, starts, ends)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    mult = [np.uint64(_MULT[k % 5] + 2 * (k // 5)) for k in range(words)]
    full = np.zeros(max(len(h) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        full += h[k:k + len(full)] * mult[k]
    full = mix64(full)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(full[lo:hi - words + 1]))
        elif hi > lo:
            part = np.uint64(hi - lo)
            for k in range(hi - lo):
                part = part + h[lo + k:lo + k + 1] * mult[k]
            out.append(mix64(part))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _slots(h: np.ndarray, size: int) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (size - 1)


def sizes_and_sketch(docs: DataFrame, words: int, size: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n) of every document and the counters of all shingles."""

    def part(batches):
        counts = np.zeros(size, dtype=np.uint32)
        for ids, texts in text_batches(batches):
            sets = shingle_sets(texts, words)
            np.add.at(counts, _slots(np.concatenate(sets), size), 1)
            yield pd.DataFrame({"doc_id": ids, "n": [len(s) for s in sets], "segment": 0, "salt": 0, "counts": None})
        if counts.any():
            at = np.arange(0, size, SEGMENT)
            yield pd.DataFrame({"doc_id": NO_ID, "n": 0, "segment": at // SEGMENT, "salt": TaskContext.get().partitionId() % 64,
                                "counts": [packed(counts[a:a + SEGMENT]) for a in at]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(min(size, SEGMENT), dtype=np.uint64)
        for raw in pdf["counts"]:
            total += unpacked(raw)
        return pd.DataFrame({"segment": pdf["segment"].iloc[:1], "counts": [packed(total)]})

    both = written(docs.mapInPandas(part, "doc_id long, n long, segment int, salt int, counts binary"), "sizes")
    total = (both.where("counts is not null").groupBy("segment", "salt").applyInPandas(add, "segment int, counts binary")
             .groupBy("segment").applyInPandas(add, "segment int, counts binary").collect())
    sketch = np.zeros(size, dtype=np.uint32)
    for r in total:
        sketch[r["segment"] * SEGMENT:(r["segment"] + 1) * SEGMENT] = np.minimum(unpacked(bytes(r["counts"])), 0xFFFFFFFF)
    return both.where("counts is null").groupBy("doc_id").agg(F.max("n").alias("n")), sketch


def prefix_of(s: np.ndarray, sketch: np.ndarray, noise: float, percent: int, max_match: int,
              verify_cost: float) -> tuple[np.ndarray, int]:
    """Prefix shingles of a set and the ``l`` that was chosen for it."""
    n = len(s)
    alpha = (percent * n + 99) // 100
    df = sketch[_slots(s, len(sketch))].astype(np.float64)
    order = np.lexsort((s, df))
    top = min(max_match, alpha)
    longest = n - alpha + top
    order = order[:longest]
    entries = np.cumsum(np.maximum(df[order] - noise, 0.0))
    levels = np.arange(1, top + 1)
    cost = entries[n - alpha + levels - 1] * (1.0 + verify_cost / levels)
    need = int(levels[cost.argmin()])
    return s[order[:n - alpha + need]], need


def _enough(shared: str, x: str, y: str, percent: int) -> str:
    """SQL: the shared prefix shingles allow the similarity (columns n, need of
    both sides)."""
    overlap = f"(({percent} * ({x}n + {y}n) + {99 + percent}) div {100 + percent})"
    own = [f"{z}need + {overlap} - (({percent} * {z}n + 99) div 100)" for z in (x, y)]
    return f"{shared} >= least({own[0]}, {own[1]})"


def postings(docs: DataFrame, sketch: np.ndarray, words: int, percent: int, max_match: int,
             verify_cost: float) -> DataFrame:
    """Entries of the posting lists with two or more documents: token, doc_id,
    n, need, and the entry before it in the list (prev, prev_n, prev_need)."""
    noise = float(np.median(sketch)) + 3.0 * float(np.sqrt(np.median(sketch)))

    def part(batches):
        for ids, texts in text_batches(batches):
            tokens, doc, meta = [], [], []
            for i, s in zip(ids, shingle_sets(texts, words), strict=True):
                if len(s):
                    t, need = prefix_of(s, sketch, noise, percent, max_match, verify_cost)
                    tokens.append(t.view(np.int64))
                    doc.append(np.full(len(t), i, dtype=np.int64))
                    meta.append(np.full(len(t), len(s) << 8 | need, dtype=np.int64))
            if tokens:
                yield pd.DataFrame({"token": np.concatenate(tokens), "doc_id": np.concatenate(doc),
                                    "meta": np.concatenate(meta)})

    def lists(batches):
        held = None  # the last row waits for the next one
        before, before_doc, before_meta = None, 0, 0
        for pdf in batches:
            t, d, m = (pdf[c].to_numpy() for c in ("token", "doc_id", "meta"))
            if held is not None:
                t, d, m = (np.concatenate(([h], x)) for h, x in zip(held, (t, d, m), strict=True))
            held = (t[-1], d[-1], m[-1])
            if len(t) == 1:
                continue
            nxt = t[:-1] == t[1:]
            prv = np.concatenate(([before is not None and t[0] == before], nxt[:-1]))
            pd_ = np.concatenate(([before_doc], d[:-2]))
            pm = np.concatenate(([before_meta], m[:-2]))
            before, before_doc, before_meta = t[-2], d[-2], m[-2]
            k = nxt | prv
            if k.any():
                yield _entries(t[:-1][k], d[:-1][k], m[:-1][k], prv[k], pd_[k], pm[k])
        if held is not None and before is not None and held[0] == before:
            one = [np.array([x]) for x in held]
            yield _entries(*one, np.array([True]), np.array([before_doc]), np.array([before_meta]))

    rows = docs.mapInPandas(part, "token long, doc_id long, meta long")
    return (rows.repartition("token").sortWithinPartitions("token", "meta", "doc_id")
            .mapInPandas(lists, "token long, doc_id long, n long, need long, prev long, prev_n long, prev_need long"))


def _entries(t, d, m, has_prev, prev, prev_meta) -> pd.DataFrame:
    def known(x):
        return pd.Series(x).astype("Int64").mask(~has_prev)

    return pd.DataFrame({"token": t, "doc_id": d, "n": m >> 8, "need": m & 255, "prev": known(prev),
                         "prev_n": known(prev_meta >> 8), "prev_need": known(prev_meta & 255)})


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of a materialised frame whose sets are similar enough."""
    ids = written(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
                  .distinct(), "ends")

    def sets(batches):
        for some, texts in text_batches(batches):
            yield pd.DataFrame({"doc_id": some, "s": [x.tobytes() for x in shingle_sets(texts, words)]})

    s = written(docs.join(small_side(ids), "doc_id", "left_semi").mapInPandas(sets, "doc_id long, s binary"), "sets")

    def check(batches):
        for pdf in batches:
            ok = []
            for x, y in zip(pdf["x"], pdf["y"], strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[ok, ["a", "b"]]

    return (pairs.select("a", "b").join(s.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a")
            .join(s.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b")
            .mapInPandas(check, "a long, b long"))


def _similar_pairs(shared: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (n[:, None] + n[None, :] - shared)


def _incidence(rows: list[np.ndarray]) -> np.ndarray:
    """Members x distinct values, 1 where a member has the value."""
    values, at = np.unique(np.concatenate(rows), return_inverse=True)
    m = np.zeros((len(rows), len(values)), dtype=np.float32)
    m[np.repeat(np.arange(len(rows)), [len(r) for r in rows]), at] = 1
    return m


def linked_in_lists(largest: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) inside the long lists: each document goes, with its set, to
    the largest list it is in, where parts of about ``TILE`` documents are
    compared exactly and return the links of a spanning forest."""
    ids = largest.select("doc_id")

    def sets(batches):
        for some, texts in text_batches(batches):
            yield pd.DataFrame({"doc_id": some, "s": [x.tobytes() for x in shingle_sets(texts, words)]})

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(x, dtype=np.uint64) for x in pdf["s"]]
        n, ids = np.array([len(r) for r in rows]), pdf["doc_id"].to_numpy()
        shared = np.zeros((len(rows), len(rows)), dtype=np.float32)
        values, at = np.unique(np.concatenate(rows), return_inverse=True)
        who = np.repeat(np.arange(len(rows)), n)
        for lo in range(0, len(values), 8192):
            some = (at >= lo) & (at < lo + 8192)
            m = np.zeros((len(rows), min(8192, len(values) - lo)), dtype=np.float32)
            m[who[some], at[some] - lo] = 1
            shared += m @ m.T
        ok = _similar_pairs(shared, n, percent)
        np.fill_diagonal(ok, False)
        a, b, todo = [], [], np.ones(len(rows), dtype=bool)
        for first in range(len(rows)):
            if not todo[first]:
                continue
            todo[first] = False
            queue = [first]
            while queue:
                x = queue.pop()
                new = np.flatnonzero(ok[x] & todo)
                todo[new] = False
                a += [ids[x]] * len(new)
                b += ids[new].tolist()
                queue += new.tolist()
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    s = docs.join(small_side(ids), "doc_id", "left_semi").mapInPandas(sets, "doc_id long, s binary")
    return (largest.join(s, "doc_id").withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("k") / TILE)))
            .groupBy("token", "tile").applyInPandas(forest, "a long, b long"))


def met_in_long_lists(rest: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) of different components that share a long list: the
    lists get their members' prefixes, so that shared shingles are counted inside a
    task.  Lists of more than ``TILE`` members are compared tile by tile.  A pair
    is reported by the first long list that it shares."""
    tokens = rest.groupBy("doc_id").agg(F.collect_list("token").alias("tokens"),
                                        F.collect_list(F.when(F.col("k") > LONG_LIST, F.col("token"))).alias("long"))
    members = rest.where(f"k > {LONG_LIST}").join(tokens, "doc_id").withColumn("tiles", F.ceil(F.col("k") / TILE))
    members = members.withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    members = members.select("token", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "doc_id",
                             "n", "need", "component", "tokens", "long")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("doc_id").sort_values(["n", "doc_id"], ignore_index=True)
        n, need, ids, comp, tile = (pdf[c].to_numpy() for c in ("n", "need", "doc_id", "component", "tile"))
        m = _incidence([np.asarray(x) for x in pdf["tokens"]])
        t = pdf["token"].iloc[0]
        before = [np.asarray(x)[np.asarray(x) < t] for x in pdf["long"]]
        earlier = _incidence(before) if any(map(len, before)) else np.zeros((len(pdf), 1), dtype=np.float32)
        alpha = (percent * n + 99) // 100
        cross = pdf["lo"].iloc[0] != pdf["hi"].iloc[0]
        a, b = [], []
        for lo in range(0, len(pdf), 512):
            i = slice(lo, lo + 512)
            shared = m[i] @ m.T
            overlap = (percent * (n[i, None] + n[None, :]) + 99 + percent) // (100 + percent)
            least = np.minimum(need[i, None] + overlap - alpha[i, None], need[None, :] + overlap - alpha[None, :])
            ok = (shared >= least) & (comp[i, None] != comp[None, :]) & (100 * n[i, None] >= percent * n[None, :])
            ok &= (earlier[i] @ earlier.T) == 0
            ok &= np.arange(len(pdf))[i, None] < np.arange(len(pdf))[None, :]
            if cross:
                ok &= tile[i, None] != tile[None, :]
            x, y = np.nonzero(ok)
            a.append(ids[x + lo])
            b.append(ids[y])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return members.groupBy("token", "lo", "hi").applyInPandas(meet, "a long, b long")


def mixed_entries(entries: DataFrame, comps: DataFrame) -> DataFrame:
    """Entries with their component and the length k of their list, of lists
    that hold two or more components."""
    label = written(entries.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                    .withColumn("component", F.coalesce("component", "doc_id")), "labelled")
    mixed = (label.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("k"))
             .where("lo <> hi").select("token", "k"))
    return written(label.join(mixed, "token"), "mixed")


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sketch_size: int | None = None,
                   max_match: int = MAX_MATCH, verify_cost: float = VERIFY_COST) -> tuple[DataFrame, DataFrame]:
    """(members, links).  members: doc_id, n_shingles, component_id, sha and n_rows
    (see ``exact_copies``) for every document.  links: verified pairs (a, b) of different texts; their closure,
    with the copies, is the closure of all links."""
    copies = written(exact_copies(docs), "reps")
    firsts = first_copies(docs, copies)
    if sketch_size is None:
        size = copies.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
        sketch_size = min(MAX_SKETCH, max(MIN_SKETCH, 1 << (size // (6 * SHINGLES_PER_SLOT)).bit_length()))
    sizes, sketch = sizes_and_sketch(firsts, words, sketch_size)
    lists = written(postings(firsts, sketch, words, percent, max_match, verify_cost), "postings")

    # neighbours of each list
    near = (lists.where(f"prev is not null and prev <> doc_id and 100 * prev_n >= {percent} * n")
            .groupBy(F.col("prev").alias("a"), F.col("doc_id").alias("b"), "n", "need", "prev_n", "prev_need")
            .agg(F.count("*").alias("shared"))
            .where(_enough("shared", "", "prev_", percent)).select("a", "b"))
    near = written(near, "near")
    first_links = written(verified(near, firsts, words, percent), "links")
    comps = written(components(first_links), "comps")

    entries = lists.drop("prev", "prev_n", "prev_need")
    rest = mixed_entries(entries, comps)
    largest = (rest.where(f"k > {LONG_LIST}").groupBy("doc_id").agg(F.max(F.struct("k", "token")).alias("at"))
               .select("doc_id", "at.k", "at.token"))
    largest = written(largest, "largest")
    links = first_links
    if largest.limit(1).count():
        links = written(first_links.unionByName(linked_in_lists(largest, firsts, words, percent)), "list-links")
        rest = mixed_entries(entries, written(components(links), "comps"))
    short = rest.where(f"k <= {LONG_LIST}")
    x, y = short.alias("x"), short.alias("y")
    met = (x.join(y, F.expr(f"""x.token = y.token and x.component <> y.component
                and (x.n < y.n or (x.n = y.n and x.doc_id < y.doc_id)) and 100 * x.n >= {percent} * y.n"""))
           .selectExpr("x.doc_id as a", "y.doc_id as b", "x.n as x_n", "y.n as y_n", "x.need as x_need", "y.need as y_need")
           .groupBy("a", "b", "x_n", "y_n", "x_need", "y_need").agg(F.count("*").alias("shared"))
           .where(_enough("shared", "x_", "y_", percent)).select("a", "b"))
    met = met.unionByName(met_in_long_lists(rest, percent)).distinct()
    met = written(met.join(near, ["a", "b"], "left_anti"), "met")
    links = links.unionByName(verified(met, firsts, words, percent))
    links = written(links, "all-links")
    final = written(components(links), "classes")

    n = F.coalesce("n", F.lit(0).cast("long"))
    members = (copies.select("doc_id", "sha", "n_rows", "rep")
               .join(sizes.select(F.col("doc_id").alias("rep"), "n"), "rep", "left")
               .join(final.withColumnRenamed("node", "rep"), "rep", "left")
               .select("doc_id", n.alias("n_shingles"),
                       F.when(n == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"),
                       "sha", "n_rows"))
    return members, links


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and class of near copies of every document."""
    return similar_groups(documents(spark, sf_dir))[0].select("doc_id", "n_shingles", "component_id")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document with the smallest doc_id of each class.  Of rows
    that repeat a doc_id, those with the text that counts are one document (one
    stays); rows with other texts, and rows without a doc_id, stay as they are."""
    with temporary(spark):
        members = written(similar_groups(docs)[0], "members", keep=True)
    gone = members.where("doc_id <> component_id").select("doc_id", "sha")
    several = repeated_ids(members)
    if several is None:
        return docs.join(small_side(gone.select("doc_id")), "doc_id", "left_anti").select(docs.columns)
    sha, row = unused(docs, "text_digest"), unused(docs, "row_number")
    own = docs.withColumn(sha, text_sha())
    several = several.withColumnRenamed("sha", sha)
    rest = own.join(small_side(several), ["doc_id", sha], "left_anti")
    first = Window.partitionBy("doc_id").orderBy(row)
    once = (own.join(small_side(several), ["doc_id", sha], "left_semi").withColumn(row, F.monotonically_increasing_id())
            .withColumn(row, F.row_number().over(first)).where(F.col(row) == 1).drop(row))
    kept = rest.unionByName(once).join(small_side(gone.withColumnRenamed("sha", sha)), ["doc_id", sha], "left_anti")
    return kept.select(docs.columns)
