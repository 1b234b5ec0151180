"""Registered queries of the lifecycle operators: sources and sinks, column
algebra, drift by distances and from a stored profile, ids of any type, champions,
search.  Same conventions as :mod:`caprank.plans.registered`, whose table they join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank import catalog as C
from caprank.functions.features import add_engineered_features, rule_score, safe_ratio
from caprank.operators.drift import (chi2_statistics, chosen_methods, drift_report, jensen_shannon, ks_statistics, proportion_z,
                                     wasserstein)
from caprank.operators.ranking import rank_rows
from caprank.plans.registered import (C_SPEC, ORACLE, SQL_C, SQL_E, SQL_HALVES, SQL_O, ap_sql, event_halves, fresh_folder, h_sql,
                                      ks_sql, model_cohort, register, replicates_sql, round_doubles, safe_ratio_sql, topk_sql)
from caprank.sources.readers import read_table
from caprank.sources.views import customer_cohort, orders_view

# ---------------------------------------------------------------- drift: distances, tests, the rule
HALVES = f"WITH {SQL_E}, {SQL_HALVES}"

SHARES = """
cnt AS (SELECT event_type AS v, count(*) FILTER (WHERE is_ref) AS o_ref, count(*) FILTER (WHERE NOT is_ref) AS o_cur
        FROM h GROUP BY 1),
tot AS (SELECT sum(o_ref) AS nr, sum(o_cur) AS nc, count(*) AS nv FROM cnt)
"""

CHI2_TAIL = """least(1.0, greatest(0.0, 1 - (SELECT sum(exp(-z + (a + i) * ln(z) - lgamma(a + i + 1))) FROM range(0, 400) r(i))))"""


def _area_sql(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", 'wasserstein' AS method,
       round(sum(abs(fr / nr - fc / nc) * (nxt - v)) / greatest(max(sd), 0.001), 6) AS statistic
FROM (SELECT v, lead(v) OVER (ORDER BY v) AS nxt, CAST(sum(cr) OVER (ORDER BY v) AS DOUBLE) AS fr,
             CAST(sum(cc) OVER (ORDER BY v) AS DOUBLE) AS fc, sum(cr) OVER () AS nr, sum(cc) OVER () AS nc
      FROM (SELECT CAST({column} AS DOUBLE) AS v, count(*) FILTER (WHERE is_ref) AS cr, count(*) FILTER (WHERE NOT is_ref) AS cc
            FROM h WHERE {column} IS NOT NULL GROUP BY 1)),
     (SELECT stddev_pop(CAST({column} AS DOUBLE)) AS sd FROM h WHERE is_ref)
WHERE nxt IS NOT NULL
"""


@register(
    "distance_drift",
    f"""{HALVES}, {SHARES}
{_area_sql('value')} UNION ALL {_area_sql('user_id')}
UNION ALL
SELECT 'event_type', 'jensenshannon', round(sqrt(sum(
         CASE WHEN o_ref > 0 THEN o_ref / nr * ln(o_ref / nr / ((o_ref / nr + o_cur / nc) / 2)) ELSE 0 END
       + CASE WHEN o_cur > 0 THEN o_cur / nc * ln(o_cur / nc / ((o_ref / nr + o_cur / nc) / 2)) ELSE 0 END) / 2), 6)
FROM cnt, (SELECT CAST(nr AS DOUBLE) AS nr, CAST(nc AS DOUBLE) AS nc FROM tot)
""",
)
def q_distance_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 by distances: Wasserstein of value and user_id, Jensen-Shannon of
    event_type between event halves."""
    ref, cur = event_halves(spark, sf_dir)
    w = wasserstein(ref, cur, ["value", "user_id"]).withColumn("method", F.lit("wasserstein"))
    j = jensen_shannon(ref, cur, ["event_type"]).withColumn("method", F.lit("jensenshannon"))
    return round_doubles(w.unionByName(j).select("column", "method", "statistic"))


@register(
    "proportion_drift",
    f"""{HALVES},
b AS (SELECT is_ref, CASE WHEN event_type = (SELECT min(event_type) FROM ev) THEN 1 ELSE 0 END AS x FROM h),
s AS (SELECT CAST(sum(x) FILTER (WHERE is_ref) AS DOUBLE) AS xr, CAST(sum(x) FILTER (WHERE NOT is_ref) AS DOUBLE) AS xc,
             CAST(count(*) FILTER (WHERE is_ref) AS DOUBLE) AS nr, CAST(count(*) FILTER (WHERE NOT is_ref) AS DOUBLE) AS nc FROM b),
t AS (SELECT (xc / nc - xr / nr) / sqrt((xr + xc) / (nr + nc) * (1 - (xr + xc) / (nr + nc)) * (1 / nr + 1 / nc)) AS stat FROM s),
u AS (SELECT stat, stat * stat / 2 AS z, 0.5::DOUBLE AS a FROM t)
SELECT 'is_first' AS "column", round(stat, 6) AS statistic, round({CHI2_TAIL}, 6) AS p_value FROM u
""",
)
def q_proportion_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 by proportions: z test of one event type's share between event halves."""
    ref, cur = event_halves(spark, sf_dir)
    first = read_table(spark, sf_dir, "events").agg(F.min("event_type")).first()[0]
    flag = F.when(F.col("event_type") == first, "yes").otherwise("no").alias("is_first")
    return round_doubles(proportion_z(ref.select(flag), cur.select(flag), ["is_first"]))


@register(
    "chi2_pvalue",
    f"""{HALVES}, {SHARES},
x AS (SELECT sum(power(o_ref - (o_ref + o_cur) * nr / (nr + nc), 2) / ((o_ref + o_cur) * nr / (nr + nc))
               + power(o_cur - (o_ref + o_cur) * nc / (nr + nc), 2) / ((o_ref + o_cur) * nc / (nr + nc))) AS stat,
             max(nv) - 1 AS dof FROM cnt, (SELECT CAST(nr AS DOUBLE) AS nr, CAST(nc AS DOUBLE) AS nc, nv FROM tot)),
u AS (SELECT stat, dof, stat / 2 AS z, dof / 2.0::DOUBLE AS a FROM x)
SELECT 'event_type' AS "column", round(stat, 6) AS statistic, CAST(dof AS BIGINT) AS dof, round({CHI2_TAIL}, 6) AS p_value FROM u
""",
)
def q_chi2_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 categorical with its p-value: chi-square of event_type between event halves."""
    ref, cur = event_halves(spark, sf_dir)
    return round_doubles(chi2_statistics(ref, cur, ["event_type"]))


@register(
    "drift_methods",
    f"""{HALVES},
n AS (SELECT count(*) FILTER (WHERE is_ref) <= 1000 AS small, count(DISTINCT value) AS d1, count(DISTINCT user_id) AS d2,
             count(DISTINCT event_type) AS d3 FROM h)
SELECT 'value' AS "column", CASE WHEN d1 > 5 THEN CASE WHEN small THEN 'ks' ELSE 'wasserstein' END
       WHEN NOT small THEN 'jensenshannon' WHEN d1 <= 2 THEN 'z' ELSE 'chi2' END AS method FROM n
UNION ALL SELECT 'user_id', CASE WHEN d2 > 5 THEN CASE WHEN small THEN 'ks' ELSE 'wasserstein' END
       WHEN NOT small THEN 'jensenshannon' WHEN d2 <= 2 THEN 'z' ELSE 'chi2' END FROM n
UNION ALL SELECT 'event_type', CASE WHEN NOT small THEN 'jensenshannon' WHEN d3 <= 2 THEN 'z' ELSE 'chi2' END FROM n
""",
)
def q_drift_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1, the rule: which statistic each column of the event halves gets."""
    ref, cur = event_halves(spark, sf_dir)
    found = chosen_methods(ref, cur, ["value", "user_id", "event_type"])
    return spark.createDataFrame(sorted(found.items()), "column string, method string")


@register("profile_drift")
def q_profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D3-D5 from a stored profile of the first event half, built in parts by user:
    the verdict of each column, and whether the statistic lies within the stated
    error of the one from the raw rows."""
    from caprank.operators.reference import build_profile, rank_error, read_profile, report_from_profile

    ref, cur = event_halves(spark, sf_dir)
    columns = ["value", "user_id", "event_type"]
    path = build_profile(ref, columns, part=F.concat(F.lit("u"), F.col("user_id") % 4)).write(fresh_folder(spark, "profile"))
    got = report_from_profile(read_profile(spark, path), cur, columns)
    exact = ks_statistics(ref, cur, columns[:2]).select("column", F.col("statistic").alias("exact")).unionByName(
        chi2_statistics(ref, cur, columns[2:]).select("column", F.col("statistic").alias("exact")))
    bound = F.when(F.col("method") == "ks", F.lit(rank_error())).otherwise(F.col("exact") * 1e-9)
    return got.join(exact, "column").select("column", "method", "drifted", (F.abs(F.col("statistic") - F.col("exact")) <= bound).alias("within_bound"))


ORACLE["profile_drift"] = f"""
{HALVES}, {SHARES},
ks AS (SELECT "column", 'ks' AS method, p_value < 0.05 AS drifted, TRUE AS within_bound FROM (WITH {ks_sql('h', ['value', 'user_id']).strip()})),
x AS (SELECT sum(power(o_ref - (o_ref + o_cur) * nr / (nr + nc), 2) / ((o_ref + o_cur) * nr / (nr + nc))
               + power(o_cur - (o_ref + o_cur) * nc / (nr + nc), 2) / ((o_ref + o_cur) * nc / (nr + nc))) AS stat,
             max(nv) - 1 AS dof FROM cnt, (SELECT CAST(nr AS DOUBLE) AS nr, CAST(nc AS DOUBLE) AS nc, nv FROM tot)),
u AS (SELECT stat / 2 AS z, dof / 2.0::DOUBLE AS a FROM x)
SELECT * FROM ks UNION ALL SELECT 'event_type', 'chi2', {CHI2_TAIL} < 0.05, TRUE FROM u
"""


# ---------------------------------------------------------------- ids of any type
@register(
    "text_id_ranks",
    """
SELECT 'O-' || printf('%012d', o_orderkey) AS id,
       CAST(row_number() OVER (ORDER BY length(o_orderpriority) DESC, 'O-' || printf('%012d', o_orderkey)) AS BIGINT) AS rank
FROM orders
""",
)
def q_text_id_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/R1 with text ids: exact ranks of all orders by a score of few values, so that
    ties are split by id.  The bound of rows that one task ranks is set to 2,000, so
    the distributed path runs at every scale."""
    o = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("id"),
        F.length("o_orderpriority").cast("double").alias("score"))
    return rank_rows(o, "score", "id", exact_limit=2_000, target_bucket_rows=500).select("id", "rank")


@register(
    "distributed_ranks",
    f"""
WITH {SQL_O}
SELECT id, CAST(row_number() OVER (ORDER BY score DESC, id) AS BIGINT) AS rank FROM od
""",
)
def q_distributed_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: exact ranks of all orders by price through the bucketed path (2,000 rows a
    task at most, whatever the scale)."""
    o = orders_view(spark, sf_dir)
    return rank_rows(o, "score", "id", exact_limit=2_000, target_bucket_rows=500).select("id", "rank")


# ---------------------------------------------------------------- ladder bundle, search
def _bundle_row(model: str, cte: str, p: str) -> str:
    return f"""
SELECT '{model}' AS model, tk.precision_at_k, ci.lo AS precision_at_k_ci_low, ci.hi AS precision_at_k_ci_high, tk.lift_at_k,
       tk.recall_at_k, ap.average_precision AS pr_auc, br.brier, tk.base_rate
FROM ({topk_sql(cte, 'C')}) tk, ({ap_sql(cte, 'C')}) ap, (SELECT round(avg(power(score - y, 2)), 6) AS brier FROM {cte}) br,
     (SELECT round(quantile_cont({p}, 0.025), 6) AS lo, round(quantile_cont({p}, 0.975), 6) AS hi FROM pb) ci
"""


@register(
    "rungs_bundle",
    f"""
WITH {SQL_C}, ra AS (SELECT id, y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS score FROM cohort),
rb AS (SELECT id, y, CAST(enrolled AS DOUBLE) / 100 AS score FROM cohort),
both_ AS (SELECT ra.id, ra.y, ra.score AS sa, rb.score AS sb FROM ra JOIN rb ON ra.id = rb.id),
{replicates_sql({'rule': 'sa', 'volume': 'sb'}, src='both_')}
{_bundle_row('rule', 'ra', 'p_rule')} UNION ALL {_bundle_row('volume', 'rb', 'p_volume')}
""",
)
def q_rungs_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + K10: the eight-number bundle of two scorers on the customer cohort, with
    the intervals from one set of 2,000 resamples."""
    from caprank.operators.metrics import evaluate_rungs

    c = customer_cohort(spark, sf_dir).withColumns(
        {"sa": rule_score("approved", "enrolled"), "sb": F.col("enrolled").cast("double") / 100})
    return round_doubles(evaluate_rungs(c, "y", "id", {"rule": "sa", "volume": "sb"}))


class BlendScorer:
    """The rule's score and the balance, mixed; a scorer that SQL can express."""

    name = "blend"

    def __init__(self, spec, weight: float, shift: int):
        self.spec, self.weight, self.shift = spec, weight, shift

    def fit(self, df: DataFrame) -> BlendScorer:
        return self

    def score(self, df: DataFrame, out: str) -> DataFrame:
        rule = F.lit(1.0) - safe_ratio("approved", "enrolled")
        return df.withColumn(out, F.lit(self.weight) * rule + F.lit(1 - self.weight) * (F.lit(float(self.shift)) - F.col("c_nationkey")) / 25)


def _blend_trials() -> tuple[dict, list[dict]]:
    from caprank.operators.search import Uniform, Whole, draw_trials

    space = {"weight": Uniform(0.0, 1.0), "shift": Whole(0, 25)}
    return space, draw_trials(space, 6, 11)


def _search_sql() -> str:
    import json

    _, trials = _blend_trials()
    rows = ", ".join(f"({i}, '{json.dumps(t, sort_keys=True)}', {t['weight']!r}::DOUBLE, {t['shift']})" for i, t in enumerate(trials))
    return f"""
WITH {SQL_C},
f AS (SELECT id, y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS s, c_nationkey,
             (row_number() OVER (PARTITION BY y ORDER BY {h_sql(5)}, id) - 1) % 3 AS fold FROM cohort),
t(trial, params, w, shift) AS (VALUES {rows}),
r AS (SELECT trial, fold, y, row_number() OVER (PARTITION BY trial, fold ORDER BY w * s + (1 - w) * (CAST(shift AS DOUBLE) - c_nationkey) / 25 DESC, id) AS rn,
             greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * count(*) OVER (PARTITION BY trial, fold)) AS BIGINT)) AS k FROM f, t),
p AS (SELECT trial, fold, sum(CASE WHEN rn <= k THEN y ELSE 0 END) / max(k) AS p FROM r GROUP BY ALL),
first_ AS (SELECT trial, row_number() OVER (ORDER BY p DESC, trial) AS place FROM p WHERE fold = 0),
g AS (SELECT p.trial, count(*) AS folds, avg(p.p) AS m FROM p JOIN first_ ON p.trial = first_.trial
      WHERE p.fold = 0 OR first_.place <= 2 GROUP BY ALL)
SELECT t.trial, t.params, CAST(g.folds AS INTEGER) AS folds, round(g.m, 6) AS precision_at_k,
       t.trial = (SELECT trial FROM g WHERE folds = 3 ORDER BY m DESC, trial LIMIT 1) AS best
FROM t JOIN g ON t.trial = g.trial
"""


@register("random_search_trials", _search_sql())
def q_random_search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: six seeded trials of a mixed score on three shared folds of the customer
    cohort; the two best of the first fold go on."""
    from caprank.operators.search import random_search

    space, _ = _blend_trials()
    return round_doubles(random_search(
        model_cohort(spark, sf_dir), C_SPEC, "blend", 6, 3, 0.10, seed=11, space=space, fold_seed=5,
        build=lambda name, spec, **params: BlendScorer(spec, **params[name])))


# ---------------------------------------------------------------- sources and sinks
@register(
    "csv_recombined",
    """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
""",
)
def q_csv_recombined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: features and outcome of all customers as two CSV files, read with an
    explicit schema and recombined on their key."""
    from caprank.sources.readers import read_csv, recombine

    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    root = fresh_folder(spark, "csv")
    parts = {"features": c.drop("c_acctbal"), "outcome": c.select("c_custkey", "c_acctbal")}
    for name, part in parts.items():
        part.write.option("header", True).csv(f"{root}/{name}")
    back = {name: read_csv(spark, f"{root}/{name}", part.schema) for name, part in parts.items()}
    return recombine(back["features"], back["outcome"], "c_custkey")


@register(
    "loaded_without_prefix",
    f"WITH {SQL_C} SELECT id, enrolled, approved, c_mktsegment FROM cohort",
)
def q_loaded_without_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S5 + S9 + P2: a fingerprinted snapshot of the cohort, loaded without the
    columns that begin with a prefix."""
    from caprank.sources.fingerprint import load_checked, write_snapshot

    c = customer_cohort(spark, sf_dir).select("id", "enrolled", "approved", "c_mktsegment", F.col("y").alias("later y"),
                                              F.col("c_acctbal").alias("later balance"))
    root = fresh_folder(spark, "snapshot")
    write_snapshot(c, f"{root}/data", f"{root}/manifest")
    return load_checked(spark, f"{root}/data", f"{root}/manifest", drop_prefix="later")


@register(
    "reference_and_current",
    f"""{HALVES}
SELECT id, value, is_ref AS is_reference FROM h
""",
)
def q_reference_and_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checked snapshot of the events without outcome, its first half by time as
    reference and the rest as current cohort."""
    from caprank.sources.fingerprint import load_reference_and_current, write_snapshot
    from caprank.sources.views import events_view

    root = fresh_folder(spark, "snapshot")
    e = events_view(spark, sf_dir).select("id", "ts", "value", F.lit(1).alias("Target"), F.lit(0).alias("dropout"), F.lit(2).alias("2nd x"))
    write_snapshot(e, f"{root}/data", f"{root}/manifest")
    ref, cur = load_reference_and_current(spark, f"{root}/data", f"{root}/manifest", "ts", "id", drop_prefix="2nd")
    both = ref.withColumn("is_reference", F.lit(True)).unionByName(cur.withColumn("is_reference", F.lit(False)))
    return both.drop("ts")


@register(
    "ingested_target",
    """
SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(o_orderstatus = 'F' AS INTEGER) AS fulfilled FROM orders
""",
)
def q_ingested_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + S2 + P1 + S9: prices and states of all orders recombined, with a binary
    target, as a snapshot that is read back."""
    from caprank.sources.fingerprint import ingest_snapshot

    o = read_table(spark, sf_dir, "orders")
    root = fresh_folder(spark, "snapshot")
    df, _ = ingest_snapshot(o.select("o_orderkey", "o_totalprice"), o.select("o_orderkey", "o_orderstatus"), "o_orderkey",
                            "o_orderstatus", "F", "fulfilled", f"{root}/data", f"{root}/manifest")
    return df.withColumn("fulfilled", F.col("fulfilled").cast("int"))


@register(
    "run_table_twice",
    f"""
WITH {SQL_C}
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives, 'run-2' AS run_id
FROM cohort GROUP BY 1
UNION ALL SELECT 'all', CAST(count(*) AS BIGINT), CAST(sum(y) AS BIGINT), 'run-1' FROM cohort
""",
)
def q_run_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tables of two runs, the second one written twice, read back: one
    copy of each committed run."""
    from caprank.operators.registry import read_run_table, write_run_table

    c = customer_cohort(spark, sf_dir)
    totals = [F.count("*").cast("long").alias("n"), F.sum("y").cast("long").alias("positives")]
    root = fresh_folder(spark, "runs")
    write_run_table(c.groupBy(F.lit("all").alias("c_mktsegment")).agg(*totals), root, "slices", "run-1")
    for _ in range(2):
        write_run_table(c.groupBy("c_mktsegment").agg(*totals), root, "slices", "run-2")
    c.limit(1).select("c_mktsegment").withColumns({"n": F.lit(1).cast("long"), "positives": F.lit(1).cast("long"), "run_id": F.lit("run-3")}).write.mode(
        "append").partitionBy("run_id").parquet(f"{root}/slices")  # a run that never committed
    return read_run_table(spark, root, "slices")


@register(
    "file_manifest",
    f"""
WITH {SQL_C}
SELECT 'c_mktsegment=' || replace(c_mktsegment, ' ', '%20') AS folder, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) > 0 AS differs
FROM cohort GROUP BY c_mktsegment
""",
)
def q_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S4 + S9 by file: rows of each partition's files from the manifest of the
    cohort, and whether the check names it after one partition's file was replaced."""
    from caprank.sources.manifest import differences, measured, read_manifest_table, write_by_folder, write_manifest_table

    c = customer_cohort(spark, sf_dir).select("id", "y", "enrolled", "c_mktsegment")
    root = fresh_folder(spark, "files")
    write_by_folder(c, "c_mktsegment", f"{root}/data")
    stored = read_manifest_table(spark, write_manifest_table(measured(spark, f"{root}/data"), f"{root}/manifest"))
    part = c.where("c_mktsegment = 'BUILDING'").withColumn("enrolled", F.col("enrolled") + 1)
    write_by_folder(part, "c_mktsegment", f"{root}/data", overwrite=True)
    folder = F.substring_index("file", "/", 1)
    bad = differences(spark, f"{root}/data", stored).select(folder.alias("f")).distinct()
    rows = stored.groupBy(folder.alias("folder")).agg(F.sum("n_rows").cast("long").alias("n_rows"))
    return rows.join(bad, F.col("folder") == F.col("f"), "left").select("folder", "n_rows", F.col("f").isNotNull().alias("differs"))


@register(
    "sketched_cardinality",
    """
SELECT 'o_custkey' AS "column", TRUE AS within_error, CAST(count(*) FILTER (WHERE o_custkey IS NULL) AS BIGINT) AS n_null FROM orders
UNION ALL SELECT 'o_orderdate', TRUE, CAST(count(*) FILTER (WHERE o_orderdate IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'o_orderpriority', TRUE, CAST(count(*) FILTER (WHERE o_orderpriority IS NULL) AS BIGINT) FROM orders
""",
)
def q_sketched_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3/Q4 from stored sketches of the orders by year, merged: whether each estimate
    lies within five standard errors of the exact count."""
    from caprank.operators.cardinality import estimated_cardinality, value_sketches
    from caprank.operators.profile import cardinality

    columns = ["o_custkey", "o_orderdate", "o_orderpriority"]
    o = read_table(spark, sf_dir, "orders").select(*columns)
    path = fresh_folder(spark, "sketches")
    value_sketches(o, columns, F.year("o_orderdate")).write.parquet(path)
    stored = spark.read.parquet(path)
    nulls = stored.groupBy("column").agg(F.sum("n_null").cast("long").alias("n_null"))
    exact = cardinality(o, columns).select("column", F.col("n_distinct").alias("exact"))
    got = estimated_cardinality(stored).join(exact, "column").join(nulls, "column")
    return got.select("column", (F.abs(F.col("n_distinct") / F.col("exact") - 1) <= 5 * F.col("relative_error")).alias("within_error"), "n_null")


# ---------------------------------------------------------------- columns, features, encoding, rules
@register(
    "column_algebra",
    f"WITH {SQL_C} SELECT c_mktsegment, c_nationkey, approved, CAST(0 AS BIGINT) AS enrolled FROM cohort WHERE c_mktsegment = 'BUILDING'",
)
def q_column_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2-P5 + P8 + P12 on the customer cohort: drop by prefix and outcome, align with
    another frame, select the model's inputs, constant out one, keep one group."""
    from caprank.operators.columns import align_common, constant_out, drop_outcomes, drop_prefix, members, select_model_inputs

    c = customer_cohort(spark, sf_dir).withColumns({"later a": F.lit(1), "later b": F.lit("x"), "Target": F.lit("t")})
    inputs = drop_outcomes(drop_prefix(c, "later"), ("Target", "y"))
    other = inputs.drop("avg_price", "c_acctbal").withColumn("unknown", F.lit(0))
    inputs, _ = align_common(inputs, other)
    return members(constant_out(select_model_inputs(inputs, ["c_mktsegment", "c_nationkey"], ["approved", "enrolled"]), "enrolled"),
                   "c_mktsegment", "BUILDING")


def _engineered_sql() -> str:
    return f"""
WITH {SQL_C}
SELECT id, round({safe_ratio_sql('approved', 'enrolled')}, 6) AS sem1_pass_rate, round({safe_ratio_sql('evaluations', 'enrolled')}, 6) AS sem1_eval_rate,
       round({safe_ratio_sql('without_eval', 'enrolled')}, 6) AS sem1_unevaluated_ratio, CAST(enrolled = 0 AS INTEGER) AS zero_enrolled_flag,
       round(CAST(avg_price AS DOUBLE) / {C.SEM1_GRADE_MAX!r}::DOUBLE - CAST(c_acctbal AS DOUBLE) / {C.ADMISSION_GRADE_MAX!r}::DOUBLE, 6) AS grade_delta,
       greatest(enrolled, approved) AS parents_max_qualification
FROM cohort
"""


@register("engineered_features", _engineered_sql())
def q_engineered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all six features added to the customer cohort, twice (it overwrites)."""
    names = {"enrolled": "enrolled", "approved": "approved", "evaluations": "evaluations", "without_eval": "without_eval",
             "sem1_grade": "avg_price", "admission_grade": "c_acctbal", "mother_qual": "enrolled", "father_qual": "approved"}
    c = customer_cohort(spark, sf_dir)
    out = add_engineered_features(add_engineered_features(c, **names), **names)
    return round_doubles(out.select("id", *C.ENGINEERED_COLUMNS))


@register(
    "unseen_categories",
    """
WITH k AS (SELECT c_mktsegment AS code FROM customer WHERE c_mktsegment <> 'BUILDING'
           GROUP BY 1 ORDER BY count(*) DESC, c_mktsegment DESC LIMIT 2)
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CASE WHEN c_mktsegment IN (SELECT code FROM k) THEN 1 ELSE 0 END) AS BIGINT) AS n_kept,
       CAST(sum(CASE WHEN c_mktsegment IN (SELECT code FROM k) THEN 0 ELSE 1 END) AS BIGINT) AS n_infrequent
FROM customer GROUP BY 1
""",
)
def q_unseen_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + X4: a capped one-hot encoding learnt without one market segment and applied
    to all: how many rows of each segment have a column of their own, or the bucket."""
    from caprank.operators.encode import CappedOneHotEncoder

    c = read_table(spark, sf_dir, "customer").select("c_mktsegment")
    model = CappedOneHotEncoder.create(["c_mktsegment"], 3).fit(c.where("c_mktsegment <> 'BUILDING'"))
    names = model.output_names()
    kept = sum((F.col(f"`{n}`") for n in names if not n.endswith("=infrequent")), F.lit(0.0))
    rest = sum((F.col(f"`{n}`") for n in names if n.endswith("=infrequent")), F.lit(0.0))
    return model.transform(c).groupBy("c_mktsegment").agg(
        F.count("*").cast("long").alias("n"), F.sum(kept).cast("long").alias("n_kept"), F.sum(rest).cast("long").alias("n_infrequent"))


@dataclass(frozen=True)
class _RowRule:
    table: str
    expected: int
    tolerance: float


ROW_RULES = (_RowRule("orders", 15_000, 0.05), _RowRule("lineitem", 1_000, 0.10), _RowRule("region", 5, 0.0))


@register(
    "row_count_rules",
    " UNION ALL ".join(
        f"""SELECT '{r.table}' AS "table", CAST(abs(count(*) - {r.expected}) > {r.tolerance} * {r.expected} AS BIGINT) AS n_violations,
        CAST(count(*) AS DOUBLE) AS value FROM {r.table}""" for r in ROW_RULES),
)
def q_row_count_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of rows of three tables against the expected one."""
    from caprank.operators.validate import Rules, validation_report

    out = None
    for r in ROW_RULES:
        rules = Rules(null_columns=[], expected_rows=r.expected, rows_tolerance=r.tolerance)
        got = validation_report(read_table(spark, sf_dir, r.table), rules).where("check = 'row_count'").select(
            F.lit(r.table).alias("table"), "n_violations", "value")
        out = got if out is None else out.unionByName(got)
    return out


@register(
    "duplicate_line_shapes",
    """
SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1
""",
)
def q_duplicate_line_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12 on whole rows of a projection of lineitem with many equal rows."""
    from caprank.operators.validate import duplicate_rows

    return duplicate_rows(read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"))


@register(
    "drift_by_rule",
    f"""{HALVES}, {SHARES},
w AS ({_area_sql('value')} UNION ALL {_area_sql('user_id')}),
j AS (SELECT sqrt(sum(
         CASE WHEN o_ref > 0 THEN o_ref / nr * ln(o_ref / nr / ((o_ref / nr + o_cur / nc) / 2)) ELSE 0 END
       + CASE WHEN o_cur > 0 THEN o_cur / nc * ln(o_cur / nc / ((o_ref / nr + o_cur / nc) / 2)) ELSE 0 END) / 2) AS s
      FROM cnt, (SELECT CAST(nr AS DOUBLE) AS nr, CAST(nc AS DOUBLE) AS nc FROM tot))
SELECT "column", method, statistic, statistic >= 0.1 AS drifted FROM w
UNION ALL SELECT 'event_type', 'jensenshannon', round(s, 6), s >= 0.1 FROM j
""",
)
def q_drift_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with the statistic that the rule picks for each column of the event halves
    (more than 1,000 reference rows: distances)."""
    ref, cur = event_halves(spark, sf_dir)
    rep = drift_report(ref, cur, ["value", "user_id", "event_type"], methods="auto")
    return round_doubles(rep.select("column", "method", "statistic", "drifted"))
