"""Mixing sources to target weights along a time-varying curriculum.

Targets: the sources share ``share`` times all words by weight; a target stops at
``cap`` times its source, and the excess is shared again by weight.  That water
level has a closed form over the sources sorted by ``cap / weight``.

Positions: each source has a weight schedule over training time [0, 1], piecewise
linear.  Its integral is the source's cumulative demand; a copy of a document
that covers the words ``[c, c + taken)`` of the source's order gets the time at
which the demand reaches the middle of that span.  Copies are range-sorted by
that position.

The order of a source is a hash of (seed, epoch, doc_id), so reruns agree.  The
running word count of a source is a two-level sum: hash buckets, whose number
grows with the rows, then a window inside one (source, bucket).  A source with a
third of all rows is spread over all buckets.

Defined results: a null text has size 0 and is taken 0 times; a null source is a
source of its own, last; sources without words have target 0; repeated rows are
documents of their own, null ids too; very long texts count whole; equal hashes are
told apart by size and place in the scan; an empty table gives an empty mix; other
columns are ignored by the operator and kept by the stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caprank.llm.common import documents, unused, written

WEIGHTS = (5, 2, 1)
#: (time, relative weight) knots for each weight class: heavy sources lead the
#: first part of training, light ones the last.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
SHARE, CAP, SEED = 1.5, 2, 17
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 50_000


def when_reached(y: Column, knots) -> Column:
    """Time at which the integral of a piecewise linear schedule, scaled to 1
    over [0, 1], reaches ``y``."""
    pieces = [(t0, t1, a, b, (a + b) / 2 * (t1 - t0)) for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False)]
    total = sum(p[4] for p in pieces)
    out = F.lit(1.0)
    done = total
    for t0, t1, a, b, area in reversed(pieces):
        done -= area
        rest = F.greatest(y * total - done, F.lit(0.0))
        slope = (b - a) / (t1 - t0)
        t = rest / a if slope == 0 else (F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * rest, F.lit(0.0))) - a) / slope
        out = F.when(y * total >= done, F.least(t0 + t, F.lit(t1))).otherwise(out) if done > 0 else (
            F.when(y * total < pieces[0][4], t0 + t).otherwise(out))
    return out


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, class, target), one row per source."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("class") + 1)
    s = (total.withColumn("class", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
         .withColumns({"w": w, "most": F.col("source_size") * F.lit(float(cap))}))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("w"), "class", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share)))
    level = (F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    s = s.withColumn("full", F.col("most") / F.col("w") < level)
    left = F.col("all_words") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))
    free = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    return s.select("source", "source_size", "class",
                    F.when(F.col("full"), F.col("most")).otherwise(F.col("w") * left / free).alias("target"))


def mixed(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE, cap: float = CAP,
          seed: int = SEED, whole: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and copies
    (array<struct<copy, taken, position>>, only those taken) for each row.

    ``whole``: take a last copy whole if more than half of it fits, else cut it
    at the target."""
    sizes = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    n = sizes.count()
    digits = max(0, math.ceil(math.log(max(n, 1) / ROWS_PER_BUCKET, 16)))
    targets = written(source_targets(sizes, weights, share, cap), "targets")
    rows = sizes
    epochs = math.ceil(cap)
    for e in range(epochs):
        rows = rows.withColumn(f"k{e}", F.md5(F.concat(F.lit(f"{seed}:{e}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    for e in range(epochs):
        rows = rows.withColumn(f"b{e}", F.substring(f"k{e}", 1, digits) if digits else F.lit(""))
        totals = rows.groupBy(F.col("source").alias("s"), F.col(f"b{e}").alias("b")).agg(F.sum("size").alias("words"))
        earlier = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select("s", "b", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words"))
        inside = (Window.partitionBy("source", f"b{e}").orderBy(f"k{e}", "size", "row")
                  .rowsBetween(Window.unboundedPreceding, -1))
        rows = (rows.withColumn("c", F.coalesce(F.sum("size").over(inside), F.lit(0)))
                .join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col(f"b{e}") == F.col("b")))
                .withColumn(f"c{e}", F.col("c") + F.col("words")).drop("c", "s", "b", "words"))
    t = targets.withColumnRenamed("source", "s")
    rows = rows.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    copies = []
    for e in range(epochs):
        start = F.col(f"c{e}") + e * F.col("source_size")
        took = (F.when((F.col("size") > 0) & (start + F.col("size") / 2 < F.col("target")), F.col("size")).otherwise(F.lit(0)) if whole
                else F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.floor("target") - start)))
        y = F.try_divide(start + took / 2, F.col("target"))
        at = F.coalesce(*[F.when(F.col("class") == i, when_reached(y, k)) for i, k in enumerate(schedules)])
        copies.append(F.struct(F.lit(e).alias("copy"), took.cast("long").alias("taken"), F.least(at, F.lit(1.0)).alias("position")))
    rows = rows.withColumn("copies", F.filter(F.array(*copies), lambda x: x["taken"] > 0))
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x["taken"]).alias("taken"), "copies")


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes, and the training positions
    of its first and last copy (null if it takes none), in training order."""
    mix = mixed(documents(spark, sf_dir))
    at = F.transform("copies", lambda c: c["position"])
    mix = mix.withColumns({"first_position": F.array_min(at), "last_position": F.array_max(at)})
    return mix.orderBy(F.col("first_position").asc_nulls_last(), "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "first_position", "last_position")


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the copies that the mix takes, as whole documents,
    range-sorted by training position.  Rows that repeat a doc_id share one
    decision, that of the smallest size."""
    plan = mixed(docs, whole=True).groupBy("doc_id").agg(F.min_by("copies", "size").alias("copies"))
    key, copy = unused(docs, "plan_id"), unused(docs, "plan_copy")
    plan = plan.select(F.col("doc_id").alias(key), F.explode("copies").alias(copy))
    joined = docs.join(plan, docs["doc_id"].eqNullSafe(plan[key]))
    return joined.orderBy(f"{copy}.position", key, f"{copy}.copy").select(*[docs[c] for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
t AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS class,
        ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS w FROM t),
m AS (SELECT *, source_size * 2.0::DOUBLE AS most, CAST(SUM(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS all_words FROM s),
l AS (SELECT *, most / w < (all_words - COALESCE(SUM(most) OVER (ORDER BY most / w, w DESC, source ASC NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / SUM(w) OVER (ORDER BY most / w, w DESC, source ASC NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM m),
g AS (SELECT source, source_size, class, CASE WHEN is_full THEN most ELSE
        w * (all_words - COALESCE(SUM(CASE WHEN is_full THEN most END) OVER (), 0)) / SUM(CASE WHEN NOT is_full THEN w END) OVER () END AS target FROM l),
c AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.class,
        COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY md5('17:0:' || d.doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0,
        g.source_size + COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY md5('17:1:' || d.doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c1
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
k AS (SELECT *, greatest(0, least(size, floor(target) - c0)) AS k0, greatest(0, least(size, floor(target) - c1)) AS k1 FROM c),
y AS (SELECT *, (c0 + k0 / 2) / NULLIF(target, 0) AS y0, (c1 + k1 / 2) / NULLIF(target, 0) AS y1 FROM k),
-- a schedule that falls from 1.5 to 0.5, one that stays at 1, one that rises from 0.5 over 1 at half time to 1.5
p AS (SELECT *,
  CASE class WHEN 0 THEN 1.5 - sqrt(2.25 - 2 * y0) WHEN 1 THEN y0 ELSE
    CASE WHEN y0 < 0.375 THEN sqrt(0.25 + 2 * y0) - 0.5 ELSE 0.5 + sqrt(1 + 2 * (y0 - 0.375)) - 1 END END AS p0,
  CASE class WHEN 0 THEN 1.5 - sqrt(2.25 - 2 * y1) WHEN 1 THEN y1 ELSE
    CASE WHEN y1 < 0.375 THEN sqrt(0.25 + 2 * y1) - 0.5 ELSE 0.5 + sqrt(1 + 2 * (y1 - 0.375)) - 1 END END AS p1 FROM y)
SELECT doc_id, size, source_size, target, CAST(k0 + k1 AS BIGINT) AS taken,
  least(CASE WHEN k0 > 0 THEN p0 END, CASE WHEN k1 > 0 THEN p1 END) AS first_position,
  greatest(CASE WHEN k0 > 0 THEN p0 END, CASE WHEN k1 > 0 THEN p1 END) AS last_position FROM p
"""
