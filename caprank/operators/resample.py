"""Fixed-size resampling with replacement (T3) for confidence intervals of
ranking metrics (K5) and of their difference between two scorers (K6).

A replicate draws ``n`` of the ``n`` rows; row counts are multinomial.  A metric
at ``k`` needs few of them: in a replicate, the k-th drawn row of a scorer lies, but
for a probability around 1e-18, within ``window`` ranks of rank ``k``, nine standard
deviations of the number of draws above it.  So rows are of two kinds:

* rows inside the window of at least one scorer: their own counts are drawn;
* all others: only how many draws fall into each *cell*, the combination of the
  side (above or below) for each scorer, and the label.

The cells (at most 2 * 2 ** scorers) are one aggregate; the window rows, about
``18 * sqrt(k * (1 - k / n))`` for each scorer, come to the driver and travel to the
tasks, which share out the replicates.  No row is ever repeated for a replicate, and
the work grows with the root of the rows: the same algorithm at every size.

A replicate draws the cell counts one after another (conditional binomials by
inverse distribution function), then one window row for each draw that is left.  All
its random numbers are functions of (seed, replicate, node, draw) in 32-bit integer
arithmetic, so a lost task draws the same again and SQL can draw them as well
(:func:`replicates_sql`).  If a k-th row does lie outside its window, all replicates
are drawn again with a window twice as wide.

Scores of any value have their place in the library order (null last), also here.

Metrics that need the whole order (average precision, ROC area) are resampled over a
*ladder*: cells of (score step, label), where a step is a distinct score, however many
there are.  Beyond ``STEPS`` of them the ladder lies in *blocks* of as many consecutive
steps: a replicate draws how many of its rows fall on each (block, label), then each
block, in a task of its own, spreads them over its steps, which together is the same
multinomial.  What a block adds to a metric needs, besides its own steps, only the
counts above it and of the whole, so nothing but totals of blocks reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caprank.functions.order import as_col
from caprank.operators.prefix import running_totals
from caprank.operators.ranking import EXACT_LIMIT, find_cuts, k_from_fraction, order_value
from caprank.session import pinned, ship_package, small_result

#: Half width of a window, and of a binomial's support, in standard deviations.
DEVIATIONS = 9
MASK = 0xFFFFFFFF
#: 32-bit finaliser: (shift, multiplier) of its steps; fixed values of a public hash.
MIX = ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1))
#: Counts that one task lays out at once.
LAID_OUT = 4_000_000
METRICS = ("precision_at_k", "recall_at_k", "lift_at_k")
#: Score steps of a block of the ladder.
STEPS = 4096


def mix(x):
    """32-bit mix of integers or of an array of them (as uint64)."""
    x = np.asarray(x, dtype=np.uint64) & np.uint64(MASK)
    for shift, factor in MIX:
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor) & np.uint64(MASK)
    return x


def node_keys(seed: int, replicate, node: int):
    """Two 32-bit keys of a node of a replicate."""
    own = mix(mix(seed) ^ np.asarray(replicate, dtype=np.uint64))
    return mix(own ^ np.uint64(2 * node)), mix(own ^ np.uint64(2 * node + 1))


def draws(keys, j):
    """The j-th 32-bit number of a node."""
    return mix(mix(keys[0] ^ np.asarray(j, dtype=np.uint64)) ^ keys[1])


def uniform(keys) -> np.ndarray:
    """One number in [0, 1) with 53 bits for a node."""
    high, low = draws(keys, 0), draws(keys, 1)
    return (high * np.uint64(1 << 21) + (low >> np.uint64(11))).astype(np.float64) / 2.0 ** 53


def binomial(m: int, p: float, u: float) -> int:
    """Smallest x whose distribution function exceeds ``u``, over the support
    within ``DEVIATIONS`` standard deviations (and 10) of the mean."""
    if m <= 0 or p <= 0:
        return 0
    if p >= 1:
        return m
    mean, reach = m * p, DEVIATIONS * math.sqrt(m * p * (1 - p)) + 10
    lo, hi = max(0, math.floor(mean - reach)), min(m, math.ceil(mean + reach))
    x = np.arange(lo + 1, hi + 1, dtype=np.float64)
    steps = np.log((m - x + 1) / x) + (math.log(p) - math.log1p(-p))
    weight = np.concatenate(([0.0], np.cumsum(steps)))
    cdf = np.cumsum(np.exp(weight - weight.max()))
    return lo + min(int(np.searchsorted(cdf, u * cdf[-1], side="right")), hi - lo)


def window_of(n: int, k: int) -> int:
    """Ranks on both sides of ``k`` that a replicate's k-th row may have."""
    return math.ceil(DEVIATIONS * math.sqrt(k * (1 - k / n))) + DEVIATIONS


class Sample:
    """What replicates need of a scored table: cells and window rows."""

    def __init__(self, n: int, k: int, cells: list[tuple[tuple[bool, ...], int, int]], labels: np.ndarray,
                 orders: list[np.ndarray], inside: list[np.ndarray]):
        #: (above for each scorer, label, rows), in the order in which they are drawn
        self.n, self.k, self.cells = n, k, cells
        #: label of each window row; for each scorer its order, and which rows are in its own window
        self.labels, self.orders, self.inside = labels, orders, inside

    def replicate(self, seed: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(positives within k for each scorer, all positives) of some replicates,
        or None if a window is too narrow."""
        scorers, rows = len(self.orders), len(self.labels)
        taken = np.zeros((len(numbers), len(self.cells)), dtype=np.int64)
        counts = np.zeros((len(numbers), rows), dtype=np.int64)
        for i, b in enumerate(numbers.tolist()):
            left, rest = self.n, self.n
            for c, (_, _, size) in enumerate(self.cells):
                x = binomial(left, size / rest, float(uniform(node_keys(seed, b, c))))
                taken[i, c] = x
                left, rest = left - x, rest - size
            if rows:
                at = draws(node_keys(seed, b, len(self.cells)), np.arange(left)) * np.uint64(rows) >> np.uint64(32)
                counts[i] = np.bincount(at.astype(np.int64), minlength=rows)
        label = np.array([y for _, y, _ in self.cells], dtype=np.int64)
        positives = taken @ label + counts @ self.labels
        hits = np.zeros((len(numbers), scorers), dtype=np.int64)
        for s in range(scorers):
            above = np.array([a[s] for a, _, _ in self.cells], dtype=np.int64)
            own, y = counts[:, self.orders[s]], self.labels[self.orders[s]]
            before = (taken @ above)[:, None] + np.cumsum(own, axis=1) - own
            inner = np.flatnonzero(self.inside[s][self.orders[s]])
            if not len(inner) or (before[:, inner[0]] >= self.k).any() or (before[:, inner[-1]] + own[:, inner[-1]] < self.k).any():
                return None
            hits[:, s] = taken @ (above * label) + (np.clip(self.k - before, 0, own) @ y)
        return hits, positives


def _sample(base: DataFrame, scorers: int, n: int, k: int, width: int, exact_limit: int) -> Sample:
    """Cells and window rows of ``base`` (_id, _y, _s0, _s1, ...)."""
    lo, hi = max(0, k - width), min(n, k + width)
    wanted = [p for p in (lo, hi) if 0 < p < n]
    sides = []
    for s in range(scorers):
        cuts = find_cuts(base, f"_s{s}", "_id", {None: wanted}, {None: n}, exact_limit=exact_limit) if wanted else {}
        within = {p: F.coalesce(c.contains(f"_s{s}", "_id"), F.lit(False)) for (_, p), c in cuts.items()}
        above = within.get(lo, F.lit(False))
        below = ~within[hi] if hi in within else F.lit(False)
        sides.append(F.when(above, 1).when(below, -1).otherwise(0).alias(f"_w{s}"))
    placed = base.select("*", *sides)
    inner = F.lit(False)
    for s in range(scorers):
        inner = inner | (F.col(f"_w{s}") == 0)
    names = [f"_w{s}" for s in range(scorers)]
    found = placed.where(~inner).groupBy(*names, "_y").count().collect()
    cells = sorted((tuple(r[c] == 1 for c in names), int(r["_y"]), r["count"]) for r in found)
    rows = placed.where(inner).select("_id", "_y", *names, *[c for s in range(scorers) for c in (
        F.col(f"_s{s}").alias(f"v{s}"), order_value(F.col(f"_s{s}")).alias(f"o{s}"))]).collect()

    def key(s):
        def of(r):
            finite = r[f"v{s}"] is not None and math.isfinite(r[f"v{s}"])
            return -r[f"o{s}"], -r[f"v{s}"] if finite else 0.0, r["_id"]

        return of

    rows.sort(key=key(0))
    orders = [np.array(sorted(range(len(rows)), key=lambda i, of=key(s): of(rows[i])), dtype=np.int64) for s in range(scorers)]
    return Sample(n, k, cells, np.array([r["_y"] for r in rows], dtype=np.int64), orders,
                  [np.array([r[f"_w{s}"] == 0 for r in rows], dtype=bool) for s in range(scorers)])


def replicates(df: DataFrame, y: str, scores: Mapping[str, str], rid: str, fraction: float = 0.10, n_iter: int = 2000,
               seed: int = 42, n: int | None = None, exact_limit: int = EXACT_LIMIT, width: int | None = None) -> DataFrame:
    """One row for each replicate: ``_b`` (from 1), ``positives``, and for each scorer
    ``tp_<name>``, ``precision_at_k_<name>``, ``recall_at_k_<name>`` and
    ``lift_at_k_<name>``.  All scorers see the same draws."""
    spark = df.sparkSession
    base = df.select(F.col(rid).alias("_id"), F.coalesce(F.col(y).cast("int"), F.lit(0)).alias("_y"),
                     *[as_col(c).cast("double").alias(f"_s{s}") for s, c in enumerate(scores.values())])
    names = list(scores)
    with pinned(base) as base:
        n = base.count() if n is None else n
        k = k_from_fraction(n, fraction)
        width = width or window_of(n, k)
        while True:
            out = _drawn(spark, _sample(base, len(names), n, k, width, exact_limit), names, n_iter, seed)
            if out is not None:
                return out
            width *= 2


def _drawn(spark, sample: Sample, names: list[str], n_iter: int, seed: int) -> DataFrame | None:
    schema = ", ".join(["_b long", "positives long", *[f"tp_{m} long" for m in names]])
    at_once = max(1, LAID_OUT // max(1, len(sample.labels)))

    def part(batches):
        for pdf in batches:
            b = pdf["id"].to_numpy()
            for lo in range(0, len(b), at_once):
                some = b[lo:lo + at_once]
                got = sample.replicate(seed, some)
                if got is None:
                    raise ValueError(NARROW)
                hits, positives = got
                yield pd.DataFrame({"_b": some, "positives": positives, **{f"tp_{m}": hits[:, s] for s, m in enumerate(names)}})

    tasks = max(1, min(n_iter // 50, spark.sparkContext.defaultParallelism))
    out = spark.range(1, n_iter + 1, numPartitions=tasks).mapInPandas(part, schema)
    try:
        out = small_result(out)  # n_iter rows
    except Exception as e:
        if NARROW in str(e):
            return None
        raise
    kk, n = F.lit(sample.k), F.lit(sample.n)
    columns = {}
    for m in names:
        tp = F.col(f"tp_{m}")
        columns[f"precision_at_k_{m}"] = tp / kk
        columns[f"recall_at_k_{m}"] = F.when(F.col("positives") > 0, tp / F.col("positives")).otherwise(0.0)
        base_rate = F.col("positives") / n
        columns[f"lift_at_k_{m}"] = F.when(F.col("positives") > 0, tp / kk / base_rate).otherwise(0.0)
    return out.withColumns(columns)


NARROW = "a replicate's k-th row lies outside its window"


def point_values(df: DataFrame, y: str, score: str, rid: str, fraction: float, n: int | None = None) -> dict[str, float]:
    """The metrics of ``METRICS`` on the rows themselves."""
    from caprank.operators.metrics import topk_metrics

    row = topk_metrics(df, y, score, rid, fraction, n=n).first()
    return {m: row[m] for m in METRICS}


def interval(column, ci_level: float):
    """Both ends of a percentile interval (linear interpolation)."""
    a = 1.0 - ci_level
    return F.percentile(column, [a / 2, 1 - a / 2])


def metric_intervals(df: DataFrame, y: str, score: str, rid: str, fraction: float = 0.10, n_iter: int = 2000,
                     ci_level: float = 0.95, seed: int = 42, metrics: tuple[str, ...] = (*METRICS, "average_precision"),
                     n: int | None = None, **kw) -> DataFrame:
    """K5 for several metrics: one row ``metric, point, ci_low, ci_high, ci_level``
    for each.  Metrics at k share one set of replicates, those of the whole order another."""
    out = []
    with pinned(df.select(rid, y, score)) as base:
        n = base.count() if n is None else n
        at_k = [m for m in metrics if m in METRICS]
        if at_k:
            points = point_values(base, y, score, rid, fraction, n)
            reps = replicates(base, y, {"a": score}, rid, fraction, n_iter, seed, n, **kw)
            ends = reps.agg(*[interval(f"{m}_a", ci_level).alias(m) for m in at_k]).first()
            out += [(m, points[m], *ends[m], ci_level) for m in at_k]
        whole = [m for m in metrics if m not in METRICS]
        if whole:
            found = ladder_values(base, y, score, [LADDER_METRICS[m] for m in whole], n_iter, seed)
            out += [(m, point, *_percentiles(values, ci_level), ci_level) for m, (point, values) in zip(whole, found, strict=True)]
    order = {m: i for i, m in enumerate(metrics)}
    rows = [tuple(None if v is None else v if isinstance(v, str) else float(v) for v in r) for r in sorted(out, key=lambda r: order[r[0]])]
    return df.sparkSession.createDataFrame(rows, "metric string, point double, ci_low double, ci_high double, ci_level double")


# ---------------------------------------------------------------- whole-order metrics on a ladder
#: A metric of a ladder: (positives, rows) of each step in descending order, one row
#: of the arrays for each replicate -> one value for each replicate.  For a block, also
#: (positives, rows) above it and on the whole ladder, for each replicate: the share of
#: the block in the value, so that the blocks' values add up to that of the ladder.
LadderMetric = Callable[..., np.ndarray]


def _outside(positives, rows, above, whole):
    """(positives, rows) above these steps, as columns, and on the whole ladder."""
    above = [x[:, None] for x in above] if above is not None else (0, 0)
    return (*above, *(whole if whole is not None else (positives.sum(axis=1), rows.sum(axis=1))))


def average_precision_of(positives: np.ndarray, rows: np.ndarray, above=None, whole=None) -> np.ndarray:
    """Step-wise average precision; NaN without positives."""
    p, n, total, _ = _outside(positives, rows, above, whole)
    hits, seen = p + np.cumsum(positives, axis=1), n + np.cumsum(rows, axis=1)
    share = np.divide(hits, seen, out=np.zeros(hits.shape), where=seen > 0)
    return np.divide((positives * share).sum(axis=1), total, out=np.full(len(rows), np.nan), where=total > 0)


def auc_of(positives: np.ndarray, rows: np.ndarray, above=None, whole=None) -> np.ndarray:
    """Area under the ROC curve, ties half; NaN without both labels."""
    p, n, total, size = _outside(positives, rows, above, whole)
    negatives = rows - positives
    below = np.reshape(size - total, (-1, 1)) - (n - p) - np.cumsum(negatives, axis=1)
    wins = (positives * (below + negatives / 2)).sum(axis=1)
    pairs = total.astype(np.float64) * (size - total)
    return np.divide(wins, pairs, out=np.full(len(rows), np.nan), where=pairs > 0)


LADDER_METRICS: dict[str, LadderMetric] = {"average_precision": average_precision_of, "roc_auc": auc_of}


def distinct_scores(df: DataFrame, y: str, score: str) -> DataFrame:
    """(o, v, p, c): order value, positives and rows of each distinct score."""
    value = as_col(score).cast("double")
    rows = df.select(value.alias("v"), order_value(value).alias("o"), F.coalesce(F.col(y).cast("int"), F.lit(0)).alias("y"))
    return rows.groupBy("o", "v").agg(F.sum("y").cast("long").alias("p"), F.count("*").alias("c"))


def _collected(per: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(positives, rows) of a few steps (o, p, c and perhaps v), descending."""
    found = [r.asDict() for r in per.collect()]
    found.sort(key=lambda r: (-r["o"], -v if (v := r.get("v")) is not None and math.isfinite(v) else 0.0))
    return np.array([r["p"] for r in found], dtype=np.int64), np.array([r["c"] for r in found], dtype=np.int64)


def ladder(df: DataFrame, y: str, score: str, rid: str, steps: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positives, rows) of each step of the score order, descending, on the driver:
    all distinct scores; only if ``steps`` asks for a coarser ladder, for a plot say,
    about as many ranges of as many rows.  Resampling asks for none."""
    with pinned(distinct_scores(df, y, score)) as per:
        distinct = per.count()
        if steps is not None and distinct > steps:
            n = per.agg(F.sum("c")).first()[0]
            # a range starts below each score that holds a row round(i * n / steps), 0 < i < steps: a
            # score's range is the number of these rows above it, from the running total alone
            above = F.col("cum_c") - F.col("c")
            least = F.floor(above * F.lit(steps) / F.lit(n)).cast("long")
            passed = least + (F.rint((least + 1) * F.lit(n) / F.lit(steps)) <= above).cast("long")
            cum = running_totals(per.groupBy("o").agg(F.sum("p").alias("p"), F.sum("c").alias("c")), "o", ["c"], descending=True, n=distinct)
            per = cum.groupBy((-F.least(passed, F.lit(steps - 1))).alias("o")).agg(
                F.sum("p").cast("long").alias("p"), F.sum("c").cast("long").alias("c"))
        return _collected(per)


def spread(rng: np.random.Generator, n: int, cells: np.ndarray) -> np.ndarray:
    """``n`` draws over cells in proportion to their rows; none on a cell without."""
    out = np.zeros(len(cells), dtype=np.int64)
    some = np.flatnonzero(cells)
    if n and len(some):
        out[some] = rng.multinomial(n, cells[some] / cells.sum())
    return out


def ladder_replicates(df: DataFrame, y: str, score: str, rid: str, metric: LadderMetric, n_iter: int = 2000, seed: int = 42,
                      block: int = STEPS) -> tuple[float, np.ndarray]:
    """(the metric, its value in each replicate) over all distinct scores."""
    return ladder_values(df, y, score, [metric], n_iter, seed, block)[0]


def ladder_values(df: DataFrame, y: str, score: str, metrics: Sequence[LadderMetric], n_iter: int = 2000, seed: int = 42,
                  block: int = STEPS) -> list[tuple[float, np.ndarray]]:
    """(value, values in the replicates) of each metric, all from the same draws.  Up
    to ``block`` distinct scores are drawn at once and replicates are shared out over
    tasks; more of them are drawn in blocks of ``block``."""
    ship_package(df.sparkSession)
    with pinned(distinct_scores(df, y, score)) as per:
        distinct = per.count()
        if distinct > block:
            return _values_of_blocks(per, distinct, metrics, n_iter, seed, block)
        positives, rows = _collected(per)
    return _values_at_once(df.sparkSession, positives, rows, metrics, n_iter, seed)


def _schema(keys: str, metrics: Sequence[LadderMetric]) -> str:
    return ", ".join([keys, *[f"m{j} double" for j in range(len(metrics))]])


def _values_at_once(spark, positives: np.ndarray, rows: np.ndarray, metrics: Sequence[LadderMetric], n_iter: int, seed: int):
    n, cells = int(rows.sum()), np.concatenate((positives, rows - positives))
    at_once = max(1, LAID_OUT // max(1, 2 * len(rows)))

    def part(batches):
        for pdf in batches:
            b = pdf["id"].to_numpy()
            for lo in range(0, len(b), at_once):
                some = b[lo:lo + at_once]
                drawn = np.stack([spread(np.random.default_rng([seed, int(i)]), n, cells) for i in some])
                p, q = drawn[:, :len(rows)], drawn[:, len(rows):]
                yield pd.DataFrame({"_b": some} | {f"m{j}": f(p, p + q) for j, f in enumerate(metrics)})

    tasks = max(1, min(n_iter // 50, spark.sparkContext.defaultParallelism))
    values = spark.range(1, n_iter + 1, numPartitions=tasks).mapInPandas(part, _schema("_b long", metrics)).orderBy("_b").collect()
    return [(float(f(positives[None, :], rows[None, :])[0]), np.array([r[f"m{j}"] for r in values], dtype=np.float64))
            for j, f in enumerate(metrics)]


def in_blocks(per: DataFrame, distinct: int, block: int) -> DataFrame:
    """(block, o, v, p, c) of distinct scores: ``block`` consecutive ones to a block,
    numbered in descending order.  Scores of one order value stay together."""
    same = per.groupBy("o").agg(F.collect_list(F.struct("v", "p", "c")).alias("at"), F.count("*").alias("u"))
    cum = running_totals(same, "o", ["u"], descending=True, n=distinct)
    number = F.floor((F.col("cum_u") - F.col("u")) / F.lit(block)).cast("long")
    return cum.select(number.alias("block"), "o", F.explode("at").alias("x")).select("block", "o", "x.v", "x.p", "x.c")


def _added(structs: str, field: str):
    return F.aggregate(structs, F.lit(0.0), lambda total, x: total + x[field])


def _values_of_blocks(per: DataFrame, distinct: int, metrics: Sequence[LadderMetric], n_iter: int, seed: int, block: int):
    spark = per.sparkSession
    with pinned(in_blocks(per, distinct, block)) as steps:
        found = sorted(steps.groupBy("block").agg(F.sum("p").alias("p"), F.sum("c").alias("c")).collect(), key=lambda r: r["block"])
        numbers = np.array([r["block"] for r in found], dtype=np.int64)
        p0, c0 = np.array([r["p"] for r in found], dtype=np.int64), np.array([r["c"] for r in found], dtype=np.int64)
        n, m, cells = int(c0.sum()), len(found), np.concatenate((p0, c0 - p0))
        parallel = spark.sparkContext.defaultParallelism
        # few blocks: each is drawn in some parts of the replicates, so that all cores have work
        parts = max(1, min(-(-n_iter // 50), -(-4 * parallel // m)))
        tasks = min(m * parts, max(4 * parallel, -(-m * parts // 16)))

        def share_out(batches):
            """Rows of each (replicate, block, label); replicate 0 is the table itself."""
            some_at_once = max(1, LAID_OUT // (2 * m))
            for pdf in batches:
                ids = pdf["id"].to_numpy()
                for lo in range(0, len(ids), some_at_once):
                    b = ids[lo:lo + some_at_once]
                    drawn = np.stack([spread(np.random.default_rng([seed, int(i)]), n, cells) if i else cells for i in b])
                    p, q = drawn[:, :m], drawn[:, m:]
                    hits, seen = np.cumsum(p, axis=1), np.cumsum(p + q, axis=1)
                    yield pd.DataFrame({"block": np.tile(numbers, len(b)), "part": np.repeat(b % parts, m), "_b": np.repeat(b, m),
                                        "p": p.ravel(), "q": q.ravel(), "hits": (hits - p).ravel(), "seen": (seen - p - q).ravel(),
                                        "total": np.repeat(hits[:, -1], m)})

        def of_block(drawn: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            own, drawn, out = own.sort_values(["o", "v"], ascending=False), drawn.sort_values("_b"), []
            pos, neg = own["p"].to_numpy(np.int64), (own["c"] - own["p"]).to_numpy(np.int64)
            some_at_once = max(1, LAID_OUT // (4 * len(pos)))
            for lo in range(0, len(drawn), some_at_once):
                d = drawn.iloc[lo:lo + some_at_once]
                p, q = np.empty((2, len(d), len(pos)), dtype=np.int64)
                for i, (b, name, x, z) in enumerate(zip(d["_b"].tolist(), d["block"].tolist(), d["p"].tolist(), d["q"].tolist(), strict=True)):
                    rng = np.random.default_rng([seed, b, name + 1])
                    p[i], q[i] = (spread(rng, x, pos), spread(rng, z, neg)) if b else (pos, neg)
                above, whole = (d["hits"].to_numpy(), d["seen"].to_numpy()), (d["total"].to_numpy(), np.full(len(d), n))
                out.append(pd.DataFrame({"_b": d["_b"].to_numpy(), "block": d["block"].to_numpy()}
                                        | {f"m{j}": f(p, p + q, above, whole) for j, f in enumerate(metrics)}))
            return pd.concat(out) if out else pd.DataFrame({"_b": [], "block": []} | {f"m{j}": [] for j in range(len(metrics))})

        drawn = spark.range(0, n_iter + 1, numPartitions=max(1, min(n_iter // 50, parallel))).mapInPandas(
            share_out, "block long, part long, _b long, p long, q long, hits long, seen long, total long")
        own = steps.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        key = ("block", "part")
        found = (drawn.repartition(tasks, *key).groupBy(*key).cogroup(own.repartition(tasks, *key).groupBy(*key))
                 .applyInPandas(of_block, _schema("_b long, block long", metrics)))
        # added up in the order of the blocks, so that a run again gives the same last digit
        names = [f"m{j}" for j in range(len(metrics))]
        sums = found.groupBy("_b").agg(F.sort_array(F.collect_list(F.struct("block", *names))).alias("at"))
        values = sums.select("_b", *[_added("at", x).alias(x) for x in names]).orderBy("_b").collect()
    columns = [np.array([r[x] for r in values], dtype=np.float64) for x in names]  # null: NaN
    return [(float(x[0]), x[1:]) for x in columns]


def _percentiles(values: np.ndarray, ci_level: float) -> tuple[float | None, float | None]:
    good = values[~np.isnan(values)]
    a = 1.0 - ci_level
    return tuple(np.percentile(good, [100 * a / 2, 100 * (1 - a / 2)])) if len(good) else (None, None)


# ---------------------------------------------------------------- the same draws in SQL
def _sql_mix(x: str) -> str:
    steps = ", ".join(str((shift << 32) + factor) + "::UBIGINT" for shift, factor in MIX)
    return (f"list_reduce([{steps}], lambda v, t: xor(v, v >> (t >> 32)) * (t & {MASK}::UBIGINT) % {MASK + 1}::UBIGINT, "
            f"({x})::UBIGINT)")


def replicates_sql(scores: Mapping[str, str], n_iter: int = 2000, seed: int = 42, fraction: float = 0.1, src: str = "dv") -> str:
    """CTEs up to ``pb(b, positives, p_<name>, ...)``: DuckDB SQL of
    :func:`replicates` over ``src`` (id, y)."""
    names = list(scores)
    rank = ", ".join(f"row_number() OVER (ORDER BY s_{m} DESC NULLS LAST, id ASC) AS r_{m}" for m in names)
    side = ", ".join(f"CASE WHEN r_{m} <= greatest(0, k - w) THEN 1 WHEN r_{m} > least(n, k + w) THEN -1 ELSE 0 END AS w_{m}"
                     for m in names)
    inner = " OR ".join(f"w_{m} = 0" for m in names)
    cells = [(above, label) for above in _sides(len(names)) for label in (0, 1)]
    sql = [f"rs_base AS (SELECT id, CAST(y AS BIGINT) AS y, {', '.join(f'CAST({e} AS DOUBLE) AS s_{m}' for m, e in scores.items())} FROM {src})",
           f"rs_size AS (SELECT n, k, CAST(ceil({DEVIATIONS} * sqrt(k * (1 - CAST(k AS DOUBLE) / n))) AS BIGINT) + {DEVIATIONS} AS w "
           f"FROM (SELECT n, greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * n) AS BIGINT)) AS k FROM (SELECT count(*) AS n FROM rs_base)))",
           f"rs_rank AS (SELECT *, {rank} FROM rs_base)",
           f"rs_side AS (SELECT r.*, {side}, n, k FROM rs_rank r, rs_size)",
           f"rs_win AS (SELECT *, row_number() OVER (ORDER BY r_{names[0]}) - 1 AS i FROM rs_side WHERE {inner})"]
    sizes = ", ".join(
        "count(*) FILTER (" + " AND ".join([f"w_{m} = {1 if a else -1}" for m, a in zip(names, above, strict=True)] + [f"y = {label}"])
        + f") AS c{c}" for c, (above, label) in enumerate(cells))
    sql.append(f"rs_cells AS (SELECT any_value(n) AS n, any_value(k) AS k, {sizes} FROM rs_side)")
    sql.append(f"rs_own AS (SELECT b, {_sql_mix(f'xor({_sql_mix(str(seed))}, b::UBIGINT)')} AS own FROM range(1, {n_iter + 1}) t(b))")
    key = lambda node, half: _sql_mix(f"xor(own, {{node}} * 2 + {half})".replace("{node}", f"({node})::UBIGINT"))
    # cells without rows are not drawn, so that the number of a node is that of the cells with rows before it
    sql.append("rs_0 AS (SELECT b, own, n AS left_, n AS rest, 0::BIGINT AS node FROM rs_own, rs_cells)")
    carried = []
    for c in range(len(cells)):
        ka, kb = "ka", "kb"
        high = _sql_mix(f"xor({_sql_mix(f'xor({ka}, 0::UBIGINT)')}, {kb})")
        low = _sql_mix(f"xor({_sql_mix(f'xor({ka}, 1::UBIGINT)')}, {kb})")
        keep = "".join(f", x{i}" for i in carried)
        sql.append(f"""rs_k{c} AS (SELECT s.*, q.c{c} AS size, q.c{c} / CAST(s.rest AS DOUBLE) AS p, {key('node', 0)} AS ka, {key('node', 1)} AS kb
  FROM rs_{c} s, rs_cells q)""")
        sql.append(f"rs_u{c} AS (SELECT * EXCLUDE (ka, kb), CAST({high} * 2097152::UBIGINT + ({low} >> 11) AS DOUBLE) / 9007199254740992.0::DOUBLE AS u FROM rs_k{c})")
        sql.append(f"""rs_b{c} AS (SELECT b, u, x, sum(f) OVER (PARTITION BY b ORDER BY x) / sum(f) OVER (PARTITION BY b) AS cdf, hi FROM (
  SELECT b, u, hi, x, exp(lgamma(left_ + 1) - lgamma(x + 1) - lgamma(left_ - x + 1) + x * ln(p) + (left_ - x) * ln(1 - p)) AS f
  FROM (SELECT b, u, left_, p, hi, unnest(range(lo, hi + 1)) AS x FROM (
    SELECT b, u, left_, p, greatest(0, CAST(floor(left_ * p - {DEVIATIONS} * sqrt(left_ * p * (1 - p)) - 10) AS BIGINT)) AS lo,
      least(left_, CAST(ceil(left_ * p + {DEVIATIONS} * sqrt(left_ * p * (1 - p)) + 10) AS BIGINT)) AS hi
    FROM rs_u{c} WHERE size > 0 AND p < 1 AND left_ > 0))))""")
        sql.append(f"rs_x{c} AS (SELECT b, coalesce(min(x) FILTER (WHERE cdf > u), max(hi)) AS x FROM rs_b{c} GROUP BY b)")
        carried.append(c)
        sql.append(f"""rs_{c + 1} AS (SELECT s.b, s.own, s.left_ - v AS left_, s.rest - s.size AS rest, s.node + CASE WHEN s.size > 0 THEN 1 ELSE 0 END AS node{keep}, v AS x{c}
  FROM (SELECT s.*, coalesce(d.x, CASE WHEN s.p >= 1 THEN s.left_ ELSE 0 END) AS v FROM rs_u{c} s LEFT JOIN rs_x{c} d ON s.b = d.b) s)""")
    last = f"rs_{len(cells)}"
    sql.append(f"rs_key AS (SELECT b, left_, {key('node', 0)} AS ka, {key('node', 1)} AS kb FROM {last})")
    sql.append("rs_rows AS (SELECT count(*) AS rows FROM rs_win)")
    draw = _sql_mix(f"xor({_sql_mix('xor(ka, j::UBIGINT)')}, kb)")
    sql.append(f"""rs_cnt AS (SELECT b, i, count(*) AS c FROM (
  SELECT b, CAST(({draw} * rows::UBIGINT) >> 32 AS BIGINT) AS i FROM (SELECT b, ka, kb, unnest(range(0, left_)) AS j FROM rs_key), rs_rows) GROUP BY b, i)""")
    positive = " + ".join(f"x{c}" for c, (_, label) in enumerate(cells) if label)
    sql.append(f"""rs_pos AS (SELECT s.b, any_value({positive}) + coalesce(sum(t.c * w.y), 0) AS positives
  FROM {last} s LEFT JOIN rs_cnt t ON s.b = t.b LEFT JOIN rs_win w ON w.i = t.i GROUP BY s.b)""")
    for s, m in enumerate(names):
        above = " + ".join([f"x{c}" for c, (a, _) in enumerate(cells) if a[s]])
        hits = " + ".join([f"x{c}" for c, (a, label) in enumerate(cells) if a[s] and label])
        sql.append(f"""rs_tp_{m} AS (SELECT b, any_value(hits) + coalesce(sum(y * greatest(0, least(c, k - before))), 0) AS tp FROM (
  SELECT s.b, {hits} AS hits, w.y, t.c, q.k, {above} + sum(t.c) OVER (PARTITION BY s.b ORDER BY w.r_{m}) - t.c AS before
  FROM {last} s JOIN rs_cells q ON TRUE LEFT JOIN rs_cnt t ON s.b = t.b LEFT JOIN rs_win w ON w.i = t.i) GROUP BY b)""")
    tps = ", ".join(f"rs_tp_{m}.tp / CAST(q.k AS DOUBLE) AS p_{m}, rs_tp_{m}.tp AS tp_{m}" for m in names)
    joins = " ".join(f"JOIN rs_tp_{m} ON rs_tp_{m}.b = o.b" for m in names)
    sql.append(f"pb AS (SELECT o.b, o.positives, q.n, {tps} FROM rs_pos o {joins} JOIN rs_cells q ON TRUE)")
    return ",\n".join(sql)


def _sides(scorers: int) -> list[tuple[bool, ...]]:
    """All combinations of sides, False (below) first: the order of the cells."""
    out: list[tuple[bool, ...]] = [()]
    for _ in range(scorers):
        out = [(*s, x) for s in out for x in (False, True)]
    return sorted(out)
