"""Exact top-k by fraction and exact global ranks without single-task windows.

The budget ``k = max(1, ceil(f * n))`` grows with the data, so neither
``Window.orderBy`` without a partition (all rows in one task) nor
``orderBy().limit(k)`` (k rows merged in one task) survive at scale.  The
library order is ``(score DESC, id ASC)`` (ids unique, so it is total).

* :func:`find_cut` returns the k-th row of that order by iterative
  histogram refinement: sample split points of the current range, count rows
  per bucket with one aggregate (bucket ids come from a literal split list, so
  every job sees the same buckets), keep only the bucket that holds position
  k and repeat until it is small; the last step ranks at most
  ``exact_limit`` rows.  Split points are *composite* (score, id), so a giant
  block of equal scores is split by id like any other range.
* ``in_top = (score, id) <= cut`` is then a plain predicate: every metric,
  slice table and bootstrap uses it without sorting anything.
* :func:`rank_rows` gives exact 1-based ranks: bucket by sampled split points,
  count rows per bucket (a tiny table), turn the counts into offsets and add
  ``row_number()`` inside each bucket.  Buckets are balanced by the sample,
  so no task holds more than about ``target_bucket_rows`` rows.

Scores of any value have a place: NaN, +inf, finite values descending, -inf,
null, and ids ascending among equals - Spark's own order of ``score DESC NULLS
LAST, id ASC``.  Ids are compared in their own type, whatever it is (``1 << 60``,
text, binary, dates).  Splitting works on :func:`order_value`, a finite double that is
monotone in that order, so a block of nulls or NaNs is split by id like any
other giant tie, and small and large inputs give the same rows and ranks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caprank.functions.order import as_col, row_at_or_before, sort_key, splits_at_or_before

EXACT_LIMIT = 200_000  # rows ranked inside one task at most
TARGET_BUCKET_ROWS = 50_000
MAX_BUCKETS = 16_384
SAMPLE_PER_BUCKET = 20


def k_from_fraction(n: int, fraction: float) -> int:
    """Driver-side value of :func:`k_column` for a known row count."""
    share = float(fraction)
    if not (n >= 1 and 0.0 < share <= 1.0):
        raise ValueError(f"no budget for {n} rows at fraction {fraction}")
    return int(math.ceil(share * n)) or 1


def k_column(n: Column, fraction: float) -> Column:
    """Column form of :func:`k_from_fraction` (double, never DECIMAL)."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(fraction)) * n).cast("long"))


@dataclass(frozen=True)
class Cut:
    """The k-th row of the order; rows at or before it form the top k.  A
    cut among null scores has ``score`` None."""

    k: int
    score: float | None
    id: object

    def contains(self, score: str | Column, rid: str | Column) -> Column:
        s, i = _dbl(score), as_col(rid)
        if self.score is None:
            return s.isNotNull() | (i <= F.lit(self.id))
        if math.isnan(self.score):
            return F.coalesce(F.isnan(s) & (i <= F.lit(self.id)), F.lit(False))
        # Spark orders NaN above +inf, as the library does; null is never inside
        inside = row_at_or_before((self.score, self.id), s, i)
        return inside if math.isfinite(self.score) else F.coalesce(inside, F.lit(False))


def order_value(s: Column) -> Column:
    """Finite double, monotone (not strictly) in the order of scores."""
    inf = F.lit(float("inf"))
    return (F.when(s.isNull(), F.lit(-1.5e308)).when(F.isnan(s), F.lit(1.5e308)).when(s == inf, F.lit(1.0e308))
            .when(s == -inf, F.lit(-1.0e308)).otherwise(s * F.lit(0.25)))


def _dbl(c: str | Column) -> Column:
    return as_col(c).cast("double")


def _in_range(first, last, s: Column, i: Column) -> Column:
    """Rows r with ``first <= r <= last`` in the library order (None = open)."""
    cond = F.lit(True)
    if first is not None:
        fs, fi = first
        cond = cond & ((s < F.lit(float(fs))) | ((s == F.lit(float(fs))) & (i >= F.lit(fi))))
    if last is not None:
        cond = cond & row_at_or_before(last, s, i)
    return cond


def _splits_from_points(pts: list[tuple[float, object]], n_buckets: int) -> list[tuple[float, object]]:
    pts = sorted(pts, key=lambda p: sort_key(*p))
    if not pts:
        return []
    step = len(pts) / n_buckets
    out: list[tuple[float, object]] = []
    for b in range(1, n_buckets):
        p = pts[min(len(pts) - 1, int(b * step))]
        if not out or out[-1] != p:
            out.append(p)
    return out


def _sample_splits(df: DataFrame, cnt: int, n_buckets: int, seed: int) -> list[tuple[float, object]]:
    """Sorted composite split points from a random sample of about
    ``1.5 * n_buckets * SAMPLE_PER_BUCKET`` rows of the whole input."""
    target = n_buckets * SAMPLE_PER_BUCKET
    frac = min(1.0, 1.5 * target / max(cnt, 1))
    rows = df.sample(False, frac, seed).collect()
    return _splits_from_points([(float(r[0]), r[1]) for r in rows], n_buckets)


def _bucketize(df: DataFrame, cols: list[tuple[str, list[float], str]]) -> DataFrame:
    """JVM binary search (Spark ML ``Bucketizer``): ``out`` = number of
    split values <= input (ascending), one column per (input, splits, out).
    Stays a cheap per-row call inside whole-stage codegen, unlike a large
    CASE WHEN tree."""
    from pyspark.ml.feature import Bucketizer

    if not cols:
        return df
    inf = float("inf")
    bz = Bucketizer(
        splitsArray=[[-inf] + sp + [inf] for _, sp, _ in cols],
        inputCols=[c for c, _, _ in cols], outputCols=[o for _, _, o in cols], handleInvalid="keep",
    )
    return bz.transform(df)


HEAVY_TIE_MULTIPLICITY = 4  # split points on one score value before ids split it
MAX_HEAVY_TIES = 64
MAX_HOT_IN_ONE_PASS = 64  # hot partitions bucketed in a single projection


def _key_plan(splits: list[tuple[float, object]]):
    """Distinct split scores, heavy tie values with their id splits, and the
    key width, for :func:`assign_buckets`."""
    uniq = sorted({p[0] for p in splits}) or [0.0]  # Bucketizer needs one split at least
    mult: dict[float, set] = {}
    for ps, pi in splits:
        mult.setdefault(ps, set()).add(pi)
    heavy = sorted((v for v, ids in mult.items() if len(ids) >= HEAVY_TIE_MULTIPLICITY),
                   key=lambda v: -len(mult[v]))[:MAX_HEAVY_TIES]
    width = max([len(mult[v]) + 2 for v in heavy] + [1])
    return uniq, [(v, sorted(mult[v])) for v in heavy], width


def assign_buckets(df: DataFrame, splits: list[tuple[float, object]], s: Column, i: Column, out: str,
                   partition_col: str | None = None, splits_by_part: dict | None = None) -> DataFrame:
    """Add ``out``: a bucket number that is monotone in the library order.

    Score level: ``#(distinct split scores > score)`` via ``Bucketizer``;
    equal scores share a bucket.  Giant ties: a score value carrying at least
    ``HEAVY_TIE_MULTIPLICITY`` split points (so its block is several buckets
    big) is split again by id with its own id split points, searched in the id's
    own type (at most ``MAX_HEAVY_TIES`` such values).  The key
    is ``score_bucket * width + sub`` with ``sub = 0`` for rows above the
    tie value inside the same score bucket.

    With ``partition_col`` / ``splits_by_part`` every listed partition gets
    its own split points in the same single projection (rows of other
    partitions get bucket 0)."""
    plans = {None: splits} if partition_col is None else dict(splits_by_part or {})
    base = df.withColumn("_bs", s).withColumn("_bi", i)
    specs, temp = [], ["_bs", "_bi"]
    key = F.lit(0).cast("long")
    for t, (p, sp) in enumerate(plans.items()):
        uniq, heavy, width = _key_plan(sp)
        inpart = F.lit(True) if partition_col is None else (F.col(partition_col) == F.lit(p))
        base = base.withColumn(f"_ps{t}", F.when(inpart, F.col("_bs")))
        specs.append((f"_ps{t}", uniq, f"_pb{t}"))
        temp += [f"_ps{t}", f"_pb{t}"]
        sub = F.lit(0).cast("long")
        for h, (v, ids) in enumerate(heavy):
            hit = inpart & (F.col("_bs") == F.lit(v))
            # ids below the first id split get 1, ...; rows above v keep 0
            sub = F.when(hit, (splits_at_or_before(F.col("_bi"), ids) + 1).cast("long")).otherwise(sub)
        sb = F.lit(len(uniq)).cast("long") - F.col(f"_pb{t}").cast("long")
        key = F.when(inpart, sb * F.lit(width) + sub).otherwise(key)
    keyed = _bucketize(base, specs)
    return keyed.withColumn(out, key).drop(*temp)


@dataclass
class _Range:
    """Rows between two points of the order (inside one group) that hold some
    of the wanted positions."""

    group: object
    first: tuple[float, object] | None
    last: tuple[float, object] | None
    count: int
    wanted: dict[int, int]  # k -> position inside the range


def find_cuts(
    df: DataFrame,
    score: str | Column,
    rid: str | Column,
    targets: dict[object, list[int]],
    counts: dict[object, int],
    by: str | None = None,
    exact_limit: int = EXACT_LIMIT,
    n_buckets: int = 256,
    seed: int = 17,
    value_only: bool = False,
) -> dict[tuple[object, int], Cut]:
    """Exact rows at several positions at once: ``targets`` has the positions
    wanted of each group (a value of ``by``; without ``by`` the one group None) and
    ``counts`` the groups' sizes.

    All ranges that still hold more than ``exact_limit`` rows are sampled and
    counted together, two jobs a round however many positions there are; the
    last job ranks inside the ranges, one window partition each."""
    group = F.lit(None).cast("string") if by is None else F.col(by)
    cur = df.select(_dbl(score).alias("_real"), order_value(_dbl(score)).alias("_s"), as_col(rid).alias("_i"), group.alias("_g"))
    s, i = F.col("_s"), F.col("_i")
    for g, ks in targets.items():
        for k in ks:
            if k < 1 or k > counts[g]:
                raise ValueError(f"position {k} outside 1..{counts[g]}")

    def tagged(ranges: list[_Range]) -> DataFrame:
        tag = F.lit(None).cast("int")
        for j, r in enumerate(ranges):
            mine = _in_range(r.first, r.last, s, i)
            if by is not None:
                mine = F.col("_g").eqNullSafe(F.lit(r.group)) & mine
            tag = F.when(mine, F.lit(j)).otherwise(tag)
        return cur.withColumn("_t", tag).filter(F.col("_t").isNotNull())

    found: dict[tuple[object, int], Cut] = {}
    ready: list[_Range] = []
    todo = [_Range(g, None, None, counts[g], {k: k for k in ks}) for g, ks in targets.items() if ks]
    rnd = 0
    while todo:
        ready += [r for r in todo if r.count <= exact_limit]
        todo = [r for r in todo if r.count > exact_limit]
        if not todo:
            break
        scope = tagged(todo)
        size = 1.5 * n_buckets * SAMPLE_PER_BUCKET
        points: dict[int, list] = {j: [] for j in range(len(todo))}
        for r in scope.sampleBy("_t", {j: min(1.0, size / r.count) for j, r in enumerate(todo)}, seed + rnd).select("_t", "_s", "_i").collect():
            points[r["_t"]].append((r["_s"], r["_i"]))
        splits = {j: _splits_from_points(p, n_buckets) for j, p in points.items()}
        stats = assign_buckets(scope, [], s, i, "_b", "_t", splits).groupBy("_t", "_b").agg(
            F.count(F.lit(1)).alias("c"),
            F.min(F.struct(-s, i)).alias("hi"),  # first row of the bucket in library order
            F.max(F.struct(-s, i)).alias("lo"),  # last row of the bucket
            F.first("_real").alias("real"),
        ).collect()
        rnd += 1
        smaller: list[_Range] = []
        for j, r in enumerate(todo):
            before = 0
            for x in sorted((x for x in stats if x["_t"] == j), key=lambda x: x["_b"]):
                inside = {k: p - before for k, p in r.wanted.items() if before < p <= before + x["c"]}
                before += x["c"]
                if not inside:
                    continue
                if value_only and x["hi"][0] == x["lo"][0]:
                    found.update({(r.group, k): Cut(k=k, score=x["real"], id=-1) for k in inside})
                    continue
                part = _Range(r.group, (-x["hi"][0], x["hi"][1]), (-x["lo"][0], x["lo"][1]), x["c"], inside)
                # equal (score, id) pairs cannot be split further
                (smaller if x["c"] < r.count else ready).append(part)
        todo = smaller
    if ready:
        w = Window.partitionBy("_t").orderBy(F.desc("_s"), F.desc("_real"), F.asc("_i"))
        at = F.lit(False)
        for j, r in enumerate(ready):
            at = at | ((F.col("_t") == j) & F.col("_rn").isin(*r.wanted.values()))
        rows = {(x["_t"], x["_rn"]): x for x in
                tagged(ready).select("_t", "_real", "_i", F.row_number().over(w).alias("_rn")).filter(at).collect()}
        for j, r in enumerate(ready):
            for k, p in r.wanted.items():
                if (j, p) not in rows:
                    raise RuntimeError("cut row not found; is the id column unique?")
                found[r.group, k] = Cut(k=k, score=rows[j, p]["_real"], id=rows[j, p]["_i"])
    return found


def find_cut(df: DataFrame, score: str | Column, rid: str | Column, k: int, n: int | None = None, **kw) -> Cut:
    """Exact k-th row of ``(score DESC, id ASC)`` over ``df``.  With
    ``value_only`` only its score is wanted: selection stops once the
    boundary bucket holds a single score (``id`` is then -1)."""
    n = df.count() if n is None else n
    return find_cuts(df, score, rid, {None: [k]}, {None: n}, **kw)[None, k]


def top_k_cut(
    df: DataFrame,
    score: str | Column,
    rid: str | Column,
    fraction: float,
    n: int | None = None,
    **kw,
) -> tuple[Cut, int]:
    """Cut for ``k = k_from_fraction(n, fraction)``; returns ``(cut, n)``."""
    if n is None:
        n = df.count()
    k = k_from_fraction(n, fraction)
    return find_cut(df, score, rid, k, n=n, **kw), n


def flag_top_k(
    df: DataFrame,
    score: str,
    rid: str,
    fraction: float = 0.10,
    flag_col: str = "in_top_k",
    **kw,
) -> tuple[DataFrame, Cut, int]:
    """Add a boolean top-k flag (global, not per group)."""
    cut, n = top_k_cut(df, score, rid, fraction, **kw)
    return df.withColumn(flag_col, cut.contains(score, rid)), cut, n


def rank_rows(
    df: DataFrame,
    score: str,
    rid: str,
    rank_col: str = "rank",
    n: int | None = None,
    exact_limit: int = EXACT_LIMIT,
    target_bucket_rows: int = TARGET_BUCKET_ROWS,
    seed: int = 29,
) -> DataFrame:
    """Exact 1-based rank of every row in ``(score DESC, id ASC)`` order."""
    s, i = _dbl(score), as_col(rid)
    cnt = n if n is not None else df.count()
    if cnt <= exact_limit:
        w = Window.orderBy(s.desc(), i.asc())
        return df.withColumn(rank_col, F.row_number().over(w).cast("long"))
    n_buckets = min(MAX_BUCKETS, max(2, math.ceil(cnt / target_bucket_rows)))
    splits = _sample_splits(df.select(order_value(s), i), cnt, n_buckets, seed)
    bucketed = assign_buckets(df, splits, order_value(s), i, "_rb")
    # per-bucket counts -> offsets: a table with one row per bucket (bounded
    # by MAX_BUCKETS, so its window and its broadcast are bounded too)
    counts = bucketed.groupBy("_rb").count()
    wo = Window.orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_rb", F.coalesce(F.sum("count").over(wo), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_rb").orderBy(s.desc(), i.asc())
    j = bucketed.join(offsets, "_rb")
    return j.withColumn(rank_col, (F.row_number().over(w) + F.col("_off")).cast("long")).drop("_rb", "_off")


def rank_within(
    df: DataFrame,
    partition_col: str,
    score: str | Column,
    rid: str,
    rank_col: str = "rank",
    exact_limit: int = EXACT_LIMIT,
    target_bucket_rows: int = TARGET_BUCKET_ROWS,
    seed: int = 31,
) -> DataFrame:
    """Exact rank inside each value of ``partition_col``.

    Partitions up to ``exact_limit`` rows use a plain partitioned window.
    Larger partitions get their own split points (one ``sampleBy`` job for
    all of them, bucketed in one projection), so a hot partition (say a
    third of all rows) is spread over many tasks; the per-(partition,
    bucket) counts become offsets.
    """
    s, i = _dbl(score), as_col(rid)
    # a key that is never null, so that null is a partition like any other
    key = F.concat(F.lit("="), F.col(partition_col).cast("string"))
    base = df.withColumns({"_rs": s, "_pk": F.coalesce(key, F.lit("null"))})
    # only hot partitions come back to the driver (at most n / exact_limit)
    big = dict(base.groupBy("_pk").count().filter(F.col("count") > exact_limit).collect())
    if not big:
        w = Window.partitionBy("_pk").orderBy(F.desc("_rs"), i.asc())
        return base.withColumn(rank_col, F.row_number().over(w).cast("long")).drop("_rs", "_pk")
    nbs = {p: min(MAX_BUCKETS, max(2, math.ceil(c / target_bucket_rows))) for p, c in big.items()}
    fractions = {p: min(1.0, 1.5 * nbs[p] * SAMPLE_PER_BUCKET / c) for p, c in big.items()}
    sample = base.select(F.col("_pk").alias("_p"), order_value(F.col("_rs")).alias("_rs"), i.alias("_ri")).sampleBy(
        "_p", fractions, seed).collect()
    points: dict = {p: [] for p in big}
    for r in sample:
        points[r["_p"]].append((float(r["_rs"]), r["_ri"]))
    splits_by_part = {p: _splits_from_points(points[p], nbs[p]) for p in big}
    if len(big) <= MAX_HOT_IN_ONE_PASS:
        # one projection: a Bucketizer column per hot partition (+ heavy ties)
        bucketed = assign_buckets(base, [], order_value(F.col("_rs")), i, "_rb", "_pk", splits_by_part)
    else:
        # many hot partitions: one branch each (same bucketing), unioned
        hot = F.col("_pk").isin(*big)
        parts = [base.filter(~hot).withColumn("_rb", F.lit(0).cast("long"))]
        for p in big:
            parts.append(assign_buckets(base.filter(F.col("_pk") == F.lit(p)), splits_by_part[p],
                                        order_value(F.col("_rs")), i, "_rb"))
        bucketed = parts[0]
        for part in parts[1:]:
            bucketed = bucketed.unionByName(part)
    # cold partitions are one bucket and need no offset, so the offsets are the
    # buckets of the hot ones: at most n / target_bucket_rows rows, joined as
    # their size asks for
    counts = bucketed.filter(F.col("_pk").isin(*big)).groupBy("_pk", "_rb").count()
    wo = Window.partitionBy("_pk").orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pk", "_rb", F.sum("count").over(wo).alias("_off"))
    j = bucketed.join(offsets, ["_pk", "_rb"], "left")
    w = Window.partitionBy("_pk", "_rb").orderBy(F.desc("_rs"), i.asc())
    return j.withColumn(rank_col, (F.row_number().over(w) + F.coalesce(F.col("_off"), F.lit(0))).cast("long")).drop(
        "_rs", "_rb", "_off", "_pk"
    )


def rank_top_k(
    df: DataFrame,
    score: str,
    rid: str,
    fraction: float = 0.10,
    rank_col: str = "rank",
    n: int | None = None,
    **kw,
) -> DataFrame:
    """The top ``ceil(f*n)`` rows with exact ranks 1..k ("limit before rank")."""
    cut, n = top_k_cut(df, score, rid, fraction, n=n, **{
        k: v for k, v in kw.items() if k in ("exact_limit", "n_buckets")
    })
    top = df.filter(cut.contains(score, rid))
    return rank_rows(top, score, rid, rank_col=rank_col, n=cut.k, **{
        k: v for k, v in kw.items() if k in ("exact_limit", "target_bucket_rows")
    })


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[float], n: int | None = None,
                    **kw) -> list[float | None]:
    """Linear-interpolated quantiles (numpy "linear", SQL ``quantile_cont``)
    by distributed selection instead of gathering the column in one task:
    the order statistics at ``floor(h)`` and ``ceil(h)``, ``h = (n-1) p``, are
    found with :func:`find_cut` on ``-value`` (ascending), ties broken by a
    row hash.  Nulls are ignored."""
    v = as_col(value).cast("double")
    base = df.select(v.alias("_qv")).filter(F.col("_qv").isNotNull() & ~F.isnan("_qv"))
    # equal values need no tie-break for a quantile: id = hash of the value,
    # and selection stops as soon as the boundary bucket holds one value
    base = base.withColumn("_qk", -F.col("_qv")).withColumn("_qi", F.xxhash64("_qv"))
    cnt = n if n is not None else base.count()
    if cnt == 0:
        return [None for _ in probs]
    positions = set()
    for p in probs:
        h = (cnt - 1) * float(p)
        positions.update({math.floor(h), math.ceil(h)})
    # every order statistic in one selection
    cuts = find_cuts(base, "_qk", "_qi", {None: sorted(q + 1 for q in positions)}, {None: cnt}, value_only=True, **kw)
    cache = {q: -cuts[None, q + 1].score for q in positions}
    out = []
    for p in probs:
        h = (cnt - 1) * float(p)
        lo, hi = math.floor(h), math.ceil(h)
        a = cache[lo]
        out.append(a if hi == lo else a + (h - lo) * (cache[hi] - a))
    return out


def exact_quantiles_by(df: DataFrame, value: str | Column, by: str, probs: list[float], **kw) -> dict[object, list[float | None]]:
    """:func:`exact_quantiles` of every group of ``by`` (a label: few values, null is
    one of them) in one selection for all of them."""
    v = as_col(value).cast("double")
    base = df.select(F.col(f"`{by}`").alias("_grp"), v.alias("_qv")).filter(F.col("_qv").isNotNull() & ~F.isnan("_qv"))
    base = base.withColumn("_qk", -F.col("_qv")).withColumn("_qi", F.xxhash64("_qv"))
    counts = {r["_grp"]: r["count"] for r in base.groupBy("_grp").count().collect()}
    places = {g: sorted({f((n - 1) * float(p)) + 1 for p in probs for f in (math.floor, math.ceil)}) for g, n in counts.items()}
    cuts = find_cuts(base, "_qk", "_qi", places, counts, by="_grp", value_only=True, **kw) if counts else {}
    out = {}
    for g, n in counts.items():
        rows = []
        for p in probs:
            h = (n - 1) * float(p)
            lo, hi = -cuts[g, math.floor(h) + 1].score, -cuts[g, math.ceil(h) + 1].score
            rows.append(lo + (h - math.floor(h)) * (hi - lo))
        out[g] = rows
    return out
