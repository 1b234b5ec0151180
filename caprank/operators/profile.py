"""Profiling aggregates (Q1-Q10, Q12).

Each profile is one aggregate (or one grouped aggregate) over the table;
per-column results are produced by a single ``agg`` and then unpivoted, so
the cost does not grow with the number of profiled columns beyond the
expressions themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caprank.operators.ranking import exact_quantiles_by, find_cut, k_from_fraction, rank_within


def _c(name: str):
    return F.col(f"`{name}`")


def add_binary_target(
    df: DataFrame, source: str, positive: str, new_column: str = "y", check: bool = True
) -> DataFrame:
    """``1`` iff ``source == positive``; keeps the source column.

    KeyError when the column is missing; ValueError when the positive class
    never occurs (one ``max`` aggregate)."""
    if source not in df.columns:
        raise KeyError(f"column {source!r} not found; available: {df.columns}")
    if check:
        present = df.agg(F.max((_c(source) == F.lit(positive)).cast("int"))).first()[0]
        if not present:
            raise ValueError(f"positive class {positive!r} not present in {source!r}")
    return df.withColumn(new_column, (_c(source) == F.lit(positive)).cast("int"))


def outcome_summary(df: DataFrame, target: str, positive: str, lo: float, hi: float) -> DataFrame:
    """Q1: per class count and share, plus total rows, column count, the
    positive base rate and ``OK`` / ``OUT OF RANGE`` against [lo, hi]."""
    g = df.groupBy(_c(target).alias("class")).agg(F.count(F.lit(1)).alias("n_rows"))
    tot = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.avg((_c(target) == F.lit(positive)).cast("double")).alias("base_rate"),
    )
    j = g.crossJoin(F.broadcast(tot))
    return j.select(
        "class",
        F.col("n_rows").cast("long").alias("n_rows"),
        (F.col("n_rows") / F.col("n_total")).alias("share"),
        F.col("n_total").cast("long").alias("n_total"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        "base_rate",
        F.when(F.col("base_rate").between(float(lo), float(hi)), "OK").otherwise("OUT OF RANGE").alias("status"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Q2: ``(column, n_null)`` for every column (NaN counts as null)."""
    dtypes = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(df.columns):
        pred = _c(c).isNull()
        if dtypes[c] in ("double", "float"):
            pred = pred | F.isnan(_c(c))
        aggs.append(F.count_if(pred).alias(f"_n{i}"))
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").cast("long").alias("n_null"))
                    for i, c in enumerate(df.columns)])
    return row.select(F.explode(arr).alias("r")).select("r.*")


def cardinality(df: DataFrame, columns: Sequence[str], high_at: int = 10, approx: bool = False) -> DataFrame:
    """Q3 + Q4: distinct count per column, high/low split, and the capped
    one-hot width ``min(u, cap) + (u > cap)`` per column."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[fn(_c(c)).alias(f"_u{i}") for i, c in enumerate(columns)])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_u{i}").cast("long").alias("n_distinct"))
                    for i, c in enumerate(columns)])
    out = row.select(F.explode(arr).alias("r")).select("r.*")
    u = F.col("n_distinct")
    return out.select(
        "column", "n_distinct",
        (u > high_at).alias("is_high_cardinality"),
        (F.least(u, F.lit(high_at)) + (u > high_at).cast("long")).cast("long").alias("onehot_width"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """Q5: sorted distinct values per column as ``(column, position, value)``."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value"))
                    for c in columns])
    d = df.select(F.explode(arr).alias("r")).select("r.*").distinct()
    # ranks inside a column: all values tie, so ids (the values) order them; a column
    # with very many values is spread over many tasks
    ranked = rank_within(d.withColumn("_tie", F.lit(0.0)), "column", "_tie", "value", "position", **limits)
    return ranked.select("column", "value", "position")


def group_stats(df: DataFrame, feature: str, by: str, **limits) -> DataFrame:
    """Q6: mean, median, sample std per group and the gap of means
    (group 1 minus group 0).  ``by`` is a label (few groups, null is one); the
    medians are exact, by one distributed selection for all groups."""
    med = {g: m[0] for g, m in exact_quantiles_by(df, feature, by, [0.5], **limits).items()}
    g = df.groupBy(_c(by).alias("group")).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(_c(feature)).alias("mean"),
        F.stddev_samp(_c(feature)).alias("std"),
    )
    mean_of = lambda v: F.avg(F.when(_c(by) == v, _c(feature)))
    gap = df.agg((mean_of(1) - mean_of(0)).alias("gap")).first()["gap"]
    median = F.lit(None).cast("double")
    for v, m in med.items():
        median = F.when(F.col("group").eqNullSafe(F.lit(v)), F.lit(m)).otherwise(median)
    return g.select("group", "n", "mean", median.alias("median"), "std", F.lit(gap).cast("double").alias("mean_gap"))


def histogram(df: DataFrame, feature: str, by: str, bins: int = 20, shared_range: bool = False) -> DataFrame:
    """Q7: ``bins``-bin density histogram per group (each group's own
    min..max by default, or one shared range).  The maximum falls in the
    last bin; density = count / (n_group * width)."""
    x = _c(feature).cast("double")
    # a missing value has no bin and does not count towards the density
    df = df.filter(x.isNotNull() & ~F.isnan(x))
    if shared_range:
        rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        grp = df.groupBy(_c(by).alias("group")).agg(F.count(F.lit(1)).alias("_n")).crossJoin(rng)
    else:
        grp = df.groupBy(_c(by).alias("group")).agg(
            F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(F.lit(1)).alias("_n"))
    from caprank.session import broadcast_if_small

    # one row per group: broadcast only after the size check
    j = df.select(_c(by).alias("group"), x.alias("_x")).join(broadcast_if_small(grp), "group")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(F.col("_hi") > F.col("_lo"),
               F.least(F.lit(bins), F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
                                            * F.lit(bins)) + 1)).otherwise(F.lit(1))
    h = j.groupBy("group", b.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.first("_n").alias("_n"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return h.select(
        "group", "bin",
        (F.col("_lo") + (F.col("bin") - 1) * w).alias("bin_lo"),
        (F.col("_lo") + F.col("bin") * w).alias("bin_hi"),
        F.col("n_rows").cast("long").alias("n_rows"),
        F.when(w > 0, F.col("n_rows") / (F.col("_n") * w)).alias("density"),
    )


def correlations(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """Q9: Pearson r for every pair (one aggregate), with a |r| flag."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[F.corr(_c(a).cast("double"), _c(b).cast("double")).alias(f"_r{i}")
                   for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_r{i}").alias("r"))
                    for i, (a, b) in enumerate(pairs)])
    out = row.select(F.explode(arr).alias("x")).select("x.*")
    return out.withColumn("above_threshold", F.abs("r") > F.lit(float(threshold)))


def leakage_scan(
    df: DataFrame, y: str, rid: str, features: Sequence[str], fraction: float = 0.10,
    exact_limit: int | None = None, n_buckets: int = 64,
) -> DataFrame:
    """Q10: single-feature P@k in both directions, best direction, lift.

    Three jobs for all features: split points of each (one aggregate), rows and
    positives of each (feature, bucket) with the features unpivoted (one aggregate), and
    the rows of the boundary buckets alone, ranked (about ``1 / n_buckets`` of them).
    Both directions read the same buckets, one from above and one from below.  A
    boundary bucket that is larger than one task should rank (a giant tie) is cut by
    selection.  Missing values rank last and NaN first in both directions."""
    from caprank.functions.order import splits_at_or_before
    from caprank.operators.ranking import EXACT_LIMIT, order_value
    from caprank.session import pinned

    limit = EXACT_LIMIT if exact_limit is None else exact_limit
    cols = [F.col(f"_f{i}") for i in range(len(features))]
    probs = [i / n_buckets for i in range(1, n_buckets)]
    with pinned(df.select(_c(rid).alias("_id"), _c(y).cast("long").alias("_y"),
                          *[_c(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])) as base:
        usable = [F.when(c.isNotNull() & ~F.isnan(c), order_value(c)) for c in cols]
        head = base.agg(F.count("*").alias("n"), F.avg("_y").alias("rate"),
                        *[F.percentile_approx(v, probs, 10 * n_buckets).alias(f"s{i}") for i, v in enumerate(usable)]).first()
        n, rate = head["n"], head["rate"]
        k = k_from_fraction(n, fraction)
        place = []
        for i, c in enumerate(cols):
            splits = sorted(set(head[f"s{i}"] or []))
            place.append(F.when(c.isNull(), -2).when(F.isnan(c), -1).otherwise(splits_at_or_before(order_value(c), splits)))
        long = base.select("_id", "_y", F.explode(F.array(*[
            F.struct(F.lit(i).alias("f"), c.alias("v"), b.cast("int").alias("b")) for i, (c, b) in enumerate(zip(cols, place, strict=True))
        ])).alias("r")).select("_id", "_y", "r.*")
        counts: dict[int, dict[int, tuple[int, int]]] = {i: {} for i in range(len(features))}
        for r in long.groupBy("f", "b").agg(F.count("*").alias("c"), F.sum("_y").alias("p")).collect():
            counts[r["f"]][r["b"]] = (r["c"], r["p"] or 0)

        tps, need, at = {}, {}, {}
        for i, own in counts.items():
            inner = sorted(b for b in own if b >= 0)
            for d, order in ((0, inner[::-1]), (1, inner)):
                tag, before, tp = 2 * i + d, 0, 0
                for b in [x for x in (-1, *order, -2) if x in own]:
                    size, hits = own[b]
                    if before + size > k:
                        break
                    before, tp = before + size, tp + hits
                tps[tag] = tp
                if before < k:
                    need[tag], at[tag] = k - before, b
        small = {t: b for t, b in at.items() if counts[t // 2][b][0] <= limit}
        if small:
            tags = F.array(*[F.when((F.col("f") == t // 2) & (F.col("b") == b), t) for t, b in small.items()])
            rows = long.select("_id", "_y", "v", F.explode(F.array_compact(tags)).alias("t"))
            first = Window.partitionBy("t").orderBy(F.when(F.col("t") % 2 == 0, -F.col("v")).otherwise(F.col("v")), "_id")
            wanted = F.create_map(*[F.lit(x) for t in small for x in (t, need[t])])
            rows = rows.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= F.element_at(wanted, F.col("t")))
            for r in rows.groupBy("t").agg(F.sum("_y").alias("p")).collect():
                tps[r["t"]] += r["p"] or 0
        for t in at.keys() - small.keys():
            i = t // 2
            own = base.where(place[i] == at[t]).select("_id", "_y", (cols[i] * (1 if t % 2 == 0 else -1)).alias("v"))
            cut = find_cut(own, "v", "_id", need[t], n=counts[i][at[t]][0], exact_limit=limit)
            tps[t] += own.where(cut.contains("v", "_id")).agg(F.sum("_y")).first()[0] or 0
    out = []
    for i, f in enumerate(features):
        pp, pn = tps[2 * i] / k, tps[2 * i + 1] / k
        best = max(pp, pn)
        out.append((f, "pos" if pp >= pn else "neg", float(best), float(best / rate) if rate else 0.0))
    return df.sparkSession.createDataFrame(
        out, "feature string, best_direction string, precision_at_k double, lift_at_k double")


def cutoff_inspection(df: DataFrame, y: str, score: str, rid: str, fraction: float = 0.10) -> DataFrame:
    """Q12: positives in the top k, score range, scores at rank k and k+1."""
    n = df.count()
    k = k_from_fraction(n, fraction)
    cut = find_cut(df, score, rid, k, n=n)
    inside = cut.contains(score, rid)
    agg = df.agg(
        F.sum(F.when(inside, _c(y).cast("long")).otherwise(0)).alias("positives_in_top"),
        # the best of the rows that are not in is row k + 1
        F.max(F.when(~inside, _c(score).cast("double"))).alias("next_score"),
        F.max(_c(score).cast("double")).alias("max_score"),
        F.min(_c(score).cast("double")).alias("min_score"),
    )
    return agg.select(
        F.lit(k).cast("long").alias("k"),
        F.col("positives_in_top").cast("long").alias("positives_in_top"),
        "max_score", "min_score",
        F.lit(cut.score).cast("double").alias("score_at_k"),
        F.col("next_score").alias("score_at_k_plus_1"),
    )
