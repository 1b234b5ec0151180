"""Persisted reference profile (D1, D3-D5 and S7 without the reference rows).

A profile is what later cohorts are compared with: for each column on a line a KLL
quantile sketch with its count, sum and sum of squares, for each column of
categories the exact counts, and the frozen cut-off of each score with the share that
it flags.  Its rows carry the ``part`` of the reference that they come from (a day, a
file, ...), so a part is added or replaced on its own, and parts merge: sketches by
union, counts by addition.

A sketch is read as a *ladder*: ``LADDER`` quantiles at equal steps of rank, which
stand for the reference rows of a column in the same aggregates that the raw rows go
through.

Error: categories, shares and cut-offs are exact.  A rank on the ladder differs from
the true one by at most ``rank_error(k)`` of the rows with 99 % confidence (0.13 % for
the default sketch of 4096, and one step of the ladder, 0.02 %), and so does the KS
statistic.  A report says whether its verdict holds at both ends of that bound
(``certain``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caprank.operators.drift import _c, _on_line, chi2_of, is_ordered, jensen_shannon_of, ks_pvalue, proportion_z_of, volume_check
from caprank.operators.prefix import running_totals

SKETCH_K = 4096
LADDER = 5000


def rank_error(k: int = SKETCH_K) -> float:
    """Greatest error of a rank read from a sketch of size ``k`` (99 % confidence), as
    a share of the rows: that of the sketch and one step of the ladder."""
    return 2.296 / k ** 0.9021 + 1 / LADDER


@dataclass
class ReferenceProfile:
    """lines: part, column, n, total, squares, sketch.  categories: part, column,
    value, n.  cutoffs: part, score, cutoff, n_flagged, n_total."""

    lines: DataFrame
    categories: DataFrame
    cutoffs: DataFrame
    k: int = SKETCH_K

    TABLES = ("lines", "categories", "cutoffs")

    def merged_lines(self) -> DataFrame:
        """(column, n, mean, sd, sketch), one row a column."""
        m = self.lines.groupBy("column").agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("squares").alias("q"),
                                             F.kll_merge_agg_double("sketch", F.lit(self.k)).alias("sketch"))
        mean = F.col("t") / F.col("n")
        return m.select("column", "n", mean.alias("mean"),
                        F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)).alias("sd"), "sketch")

    def ladder(self, columns: Sequence[str]) -> DataFrame:
        """(column, value): ``LADDER`` quantiles of each column."""
        ranks = F.array(*[F.lit(i / LADDER) for i in range(1, LADDER + 1)])
        m = self.merged_lines().where(F.col("column").isin(*columns))
        return m.select("column", F.explode(F.kll_sketch_get_quantile_double("sketch", ranks)).alias("value"))

    def merged_categories(self) -> DataFrame:
        return self.categories.groupBy("column", "value").agg(F.sum("n").alias("n"))

    def write(self, path: str) -> str:
        """Store; the parts that the profile holds replace those stored before."""
        for name in self.TABLES:
            (getattr(self, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part")
             .parquet(f"{path}/{name}"))
        return path


SCHEMAS = {
    "lines": "column string, n long, total double, squares double, sketch binary, part string",
    "categories": "column string, value string, n long, part string",
    "cutoffs": "score string, cutoff double, n_flagged long, n_total long, part string",
}


def read_profile(spark: SparkSession, path: str, k: int = SKETCH_K) -> ReferenceProfile:
    return ReferenceProfile(*[spark.read.schema(SCHEMAS[t]).parquet(f"{path}/{t}") for t in ReferenceProfile.TABLES], k)


def build_profile(ref: DataFrame, columns: Sequence[str] | None = None, categorical: Sequence[str] = (),
                  cutoffs: dict[str, float] | None = None, part: str | Column = "all", k: int = SKETCH_K) -> ReferenceProfile:
    """Profile of some rows in one aggregate a table.  ``part``: a name, or a column that
    tells the parts apart; ``cutoffs``: frozen cut-off of each score column."""
    dtypes = dict(ref.dtypes)
    own = (F.lit(part) if isinstance(part, str) else part).cast("string")
    taken = set(cutoffs or {})
    columns = list(columns) if columns else [c for c in ref.columns if c not in taken]
    lines = [c for c in columns if is_ordered(dtypes[c]) and c not in categorical]
    cats = [c for c in columns if c not in lines]

    def long(cols, value):
        array = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in cols])
        return ref.select(own.alias("part"), F.explode(array).alias("r")).select("part", "r.*").where("value is not null")

    spark = ref.sparkSession
    empty = {t: spark.createDataFrame([], s) for t, s in SCHEMAS.items()}
    found = dict(empty)
    if lines:
        v = long(lines, lambda c: _on_line(_c(c), dtypes[c])).where(~F.isnan("value"))
        found["lines"] = v.groupBy("part", "column").agg(
            F.count("*").alias("n"), F.sum("value").alias("total"), F.sum(F.col("value") * F.col("value")).alias("squares"),
            F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))
    if cats:
        found["categories"] = long(cats, lambda c: _c(c).cast("string")).groupBy("part", "column", "value").agg(F.count("*").alias("n"))
    for score, cut in (cutoffs or {}).items():
        rows = ref.groupBy(own.alias("part")).agg(F.count_if(_c(score) >= F.lit(float(cut))).alias("n_flagged"), F.count("*").alias("n_total"))
        found["cutoffs"] = found["cutoffs"].unionByName(
            rows.select(F.lit(score).alias("score"), F.lit(float(cut)).alias("cutoff"), "n_flagged", "n_total", "part"))
    return ReferenceProfile(found["lines"], found["categories"], found["cutoffs"], k)


def _lines_of(cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    dtypes = dict(cur.dtypes)
    array = F.array(*[F.struct(F.lit(c).alias("column"), _on_line(_c(c), dtypes[c]).alias("value")) for c in cols])
    return cur.select(F.explode(array).alias("r")).select("r.*").where("value is not null and not isnan(value)")


def ks_from_profile(profile: ReferenceProfile, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, statistic, n_ref, n_cur, p_value, p_low, p_high)`` of the columns on a
    line; ``p_low`` and ``p_high`` are the p-values of the statistic plus and minus the
    rank error."""
    both = (profile.ladder(cols).withColumn("is_cur", F.lit(0)).unionByName(_lines_of(cur, cols).withColumn("is_cur", F.lit(1)))
            .groupBy("column", "value").agg(F.count_if(F.col("is_cur") == 0).alias("c_ref"), F.count_if(F.col("is_cur") == 1).alias("c_cur")))
    cum = running_totals(both, "value", ["c_ref", "c_cur"], partition_by=["column"])
    sizes = both.groupBy("column").agg(F.sum("c_cur").alias("n_cur"))
    ref = profile.merged_lines().select("column", F.col("n").alias("n_ref"))
    d = cum.join(F.broadcast(sizes), "column").groupBy("column", "n_cur").agg(
        F.max(F.abs(F.col("cum_c_ref") / F.lit(LADDER) - F.col("cum_c_cur") / F.col("n_cur"))).alias("statistic")).join(ref, "column")
    root = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")))
    error = F.lit(rank_error(profile.k))
    return d.select("column", "statistic", F.col("n_ref").cast("long"), F.col("n_cur").cast("long"),
                    ks_pvalue(F.col("statistic") * root).alias("p_value"),
                    ks_pvalue((F.col("statistic") + error) * root).alias("p_low"),
                    ks_pvalue(F.greatest(F.lit(0.0), F.col("statistic") - error) * root).alias("p_high"))


def counts_from_profile(profile: ReferenceProfile, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, o_ref, o_cur): stored counts beside the cohort's own."""
    array = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value")) for c in cols])
    own = (cur.select(F.explode(array).alias("r")).select("r.*").where("value is not null")
           .groupBy("column", "value").agg(F.count("*").alias("o_cur")))
    ref = profile.merged_categories().where(F.col("column").isin(*cols)).withColumnRenamed("n", "o_ref")
    return ref.join(own, ["column", "value"], "full_outer").fillna(0, ["o_ref", "o_cur"])


def psi_from_profile(profile: ReferenceProfile, cur: DataFrame, cols: Sequence[str], bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """``(column, psi)``: deciles and the reference's shares come from the ladder."""
    deciles = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = profile.merged_lines().where(F.col("column").isin(*cols)).select(
        "column", F.kll_sketch_get_quantile_double("sketch", deciles).alias("edges"))
    both = profile.ladder(cols).withColumn("is_cur", F.lit(0)).unionByName(_lines_of(cur, cols).withColumn("is_cur", F.lit(1)))
    counts = (both.join(F.broadcast(edges), "column")
              .groupBy("column", F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("bin"))
              .agg(F.count_if(F.col("is_cur") == 0).alias("r"), F.count_if(F.col("is_cur") == 1).alias("c")))
    of_column = Window.partitionBy("column")  # at most ``bins`` rows
    shares = counts.select("column", F.greatest(F.col("r") / F.sum("r").over(of_column), F.lit(floor)).alias("r"),
                           F.greatest(F.col("c") / F.sum("c").over(of_column), F.lit(floor)).alias("c"))
    return shares.groupBy("column").agg(F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).alias("psi"))


def report_from_profile(profile: ReferenceProfile, cur: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.05,
                        distance_threshold: float = 0.1, methods: dict[str, str] | None = None) -> DataFrame:
    """D1 against a profile: ``(column, method, statistic, p_value, drifted, certain)``.
    Columns on a line: ks; categories: chi2, or ``z`` / ``jensenshannon`` by ``methods``."""
    lines = {r["column"] for r in profile.lines.select("column").distinct().collect()}
    cats = {r["column"] for r in profile.categories.select("column").distinct().collect()}
    cols = [c for c in (columns or cur.columns) if c in lines | cats]
    methods = methods or {}
    sure = F.lit(True)
    parts = []
    ks = [c for c in cols if c in lines]
    if ks:
        p = F.lit(float(threshold))
        parts.append(ks_from_profile(profile, cur, ks).select(
            "column", F.lit("ks").alias("method"), "statistic", "p_value", (F.col("p_value") < p).alias("drifted"),
            ((F.col("p_low") < p) == (F.col("p_high") < p)).alias("certain")))
    for m, of in (("chi2", chi2_of), ("z", proportion_z_of), ("jensenshannon", jensen_shannon_of)):
        mine = [c for c in cols if c in cats and methods.get(c, "chi2") == m]
        if not mine:
            continue
        found = of(counts_from_profile(profile, cur, mine))
        p = F.col("p_value") if "p_value" in found.columns else F.lit(None).cast("double")
        over = F.col("statistic") >= F.lit(float(distance_threshold)) if m == "jensenshannon" else p < F.lit(float(threshold))
        parts.append(found.select("column", F.lit(m).alias("method"), "statistic", p.alias("p_value"),
                                  F.coalesce(over, F.lit(False)).alias("drifted"), sure.alias("certain")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def volume_from_profile(profile: ReferenceProfile, scored: DataFrame, score: str, tolerance: float, mode: str = "absolute") -> DataFrame:
    """D3: the share at or above the frozen cut-off against the profile's share."""
    row = profile.cutoffs.where(F.col("score") == score).groupBy("cutoff").agg(
        F.sum("n_flagged").alias("f"), F.sum("n_total").alias("n")).collect()
    if len(row) != 1:
        raise LookupError(f"the profile has {len(row)} cut-offs for {score!r}")
    return volume_check(scored, score, row[0]["cutoff"], row[0]["f"] / max(row[0]["n"], 1), tolerance, mode)

