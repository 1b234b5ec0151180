"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query reads whole tables through :mod:`caprank.sources.views` and runs
the library operator on them; the oracle is an independent ANSI-SQL
formulation of the same result.  Doubles are rounded to 6 places and counts
cast to BIGINT on both sides so that value digests compare exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.functions.features import rule_score
from caprank.operators.ranking import rank_top_k
from caprank.session import cut_lineage, ensure_checkpoint_dir
from caprank.sources.views import customer_cohort

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- SQL views
SQL_C = """
c_urgent AS (
  SELECT o_custkey,
         count(*) AS enrolled,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS approved,
         count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS evaluations,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS without_eval,
         avg(o_totalprice) AS avg_price
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey),
cohort AS (
  SELECT c.c_custkey AS id,
         CAST(coalesce(u.enrolled, 0) AS BIGINT) AS enrolled,
         CAST(coalesce(u.approved, 0) AS BIGINT) AS approved,
         CAST(coalesce(u.evaluations, 0) AS BIGINT) AS evaluations,
         CAST(coalesce(u.without_eval, 0) AS BIGINT) AS without_eval,
         u.avg_price, c.c_acctbal, c.c_mktsegment, c.c_nationkey,
         CAST(c.c_acctbal < 3000 AS INTEGER) AS y
  FROM customer c LEFT JOIN c_urgent u ON c.c_custkey = u.o_custkey)
"""

SQL_E = """
ev AS (
  SELECT event_id AS id, ts, user_id, event_type, value,
         CAST(event_type = 'error' AS INTEGER) AS y, value AS score
  FROM events)
"""

SQL_O = """
od AS (
  SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_orderpriority,
         year(o_orderdate) AS order_year, o_totalprice,
         CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice AS score
  FROM orders)
"""

SQL_D = """
dv AS (
  SELECT d.doc_id AS id, d.n_chars, d.lang, d.source, l.toxic,
         CAST(1 - l.quality AS INTEGER) AS y
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""


def safe_ratio_sql(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} ELSE 0.0 END)"


# ---------------------------------------------------------------- flagship
@register(
    "rule_ranked_list",
    f"""
WITH {SQL_C},
scored AS (SELECT id, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS risk_score FROM cohort),
ranked AS (
  SELECT id, risk_score,
         row_number() OVER (ORDER BY risk_score DESC, id ASC) AS rnk,
         count(*) OVER () AS n
  FROM scored)
SELECT id AS student_id, round(risk_score, 6) AS risk_score, CAST(rnk AS BIGINT) AS rank
FROM ranked
WHERE rnk <= greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT))
""",
)
def rule_ranked_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + R1 on the customer cohort: the top 10 % by ``1 - pass_rate``."""
    c = customer_cohort(spark, sf_dir)
    scored = c.select("id", rule_score("approved", "enrolled").alias("risk_score"))
    top = rank_top_k(scored, "risk_score", "id", 0.10)
    return top.select(
        F.col("id").alias("student_id"), r6(F.col("risk_score")).alias("risk_score"), "rank"
    )


# ---------------------------------------------------------------- helpers
def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE column (value digests compare exactly)."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), places).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


def topk_sql(cte: str, label: str, fraction: float = 0.1) -> str:
    return f"""
SELECT '{label}' AS view, CAST(n AS BIGINT) AS n, CAST(pos AS BIGINT) AS positives,
       CAST(k AS BIGINT) AS k, CAST(tp AS BIGINT) AS tp_at_k,
       round(tp / k, 6) AS precision_at_k,
       round(CASE WHEN pos > 0 THEN tp / pos ELSE 0.0 END, 6) AS recall_at_k,
       round(CASE WHEN pos > 0 THEN (tp / k) / (pos / n) ELSE 0.0 END, 6) AS lift_at_k,
       round(pos / n, 6) AS base_rate,
       round(CASE WHEN pos > 0 THEN least(1.0, k / pos) END, 6) AS recall_ceiling
FROM (SELECT max(n) AS n, sum(y) AS pos, max(k) AS k,
             sum(CASE WHEN rn <= k THEN y ELSE 0 END) AS tp
      FROM (SELECT y, rn, n, greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * n) AS BIGINT)) AS k
            FROM (SELECT y, row_number() OVER (ORDER BY score DESC, id ASC) AS rn,
                         count(*) OVER () AS n FROM {cte})))
"""


def ap_sql(cte: str, label: str) -> str:
    return f"""
SELECT '{label}' AS view,
       round(CASE WHEN sum(p) > 0 THEN sum(p * (CAST(cp AS DOUBLE) / cc)) / sum(p) END, 6) AS average_precision
FROM (SELECT p, sum(c) OVER (ORDER BY score DESC) AS cc, sum(p) OVER (ORDER BY score DESC) AS cp
      FROM (SELECT score, count(*) AS c, sum(y) AS p FROM {cte} GROUP BY score))
"""


# ---------------------------------------------------------------- metrics
from caprank.operators.metrics import average_precision, brier, topk_metrics  # noqa: E402
from caprank.sources.views import documents_view, events_view, orders_view  # noqa: E402


@register(
    "topk_metrics",
    f"WITH {SQL_E}, {SQL_O} " + topk_sql("ev", "E") + " UNION ALL " + topk_sql("od", "O"),
)
def q_topk_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K4, K9, K11 on the events and orders views."""
    e = topk_metrics(events_view(spark, sf_dir), "y", "score", "id", 0.10)
    o = topk_metrics(orders_view(spark, sf_dir), "y", "score", "id", 0.10)
    return round_doubles(
        e.select(F.lit("E").alias("view"), "*").unionByName(o.select(F.lit("O").alias("view"), "*"))
    )


@register(
    "avg_precision",
    f"WITH {SQL_E}, {SQL_O} " + ap_sql("ev", "E") + " UNION ALL " + ap_sql("od", "O"),
)
def q_avg_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: step-wise average precision on E and O."""
    e = average_precision(events_view(spark, sf_dir), "y", "score")
    o = average_precision(orders_view(spark, sf_dir), "y", "score")
    return round_doubles(
        e.select(F.lit("E").alias("view"), "*").unionByName(o.select(F.lit("O").alias("view"), "*"))
    )


@register(
    "brier",
    f"""
WITH {SQL_C}, {SQL_O},
sc AS (SELECT y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS s FROM cohort),
so AS (SELECT y, (o_totalprice - (SELECT min(o_totalprice) FROM od))
                 / ((SELECT max(o_totalprice) FROM od) - (SELECT min(o_totalprice) FROM od)) AS s FROM od)
SELECT 'C' AS view, round(avg(power(s - y, 2)), 6) AS brier,
       CAST(count(*) FILTER (WHERE s < 0 OR s > 1) AS BIGINT) AS n_out_of_range FROM sc
UNION ALL
SELECT 'O', round(avg(power(s - y, 2)), 6), CAST(count(*) FILTER (WHERE s < 0 OR s > 1) AS BIGINT) FROM so
""",
)
def q_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: Brier score of the rule score on C and min-max scaled price on O."""
    c = customer_cohort(spark, sf_dir).withColumn("s", rule_score("approved", "enrolled"))
    o = orders_view(spark, sf_dir)
    mm = o.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    o = o.crossJoin(F.broadcast(mm)).withColumn(
        "s", (F.col("o_totalprice") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    )
    bc = brier(c, "y", "s").select(F.lit("C").alias("view"), "*")
    bo = brier(o, "y", "s").select(F.lit("O").alias("view"), "*")
    return round_doubles(bc.unionByName(bo))


# ---------------------------------------------------------------- slices
from caprank.operators.slices import slice_table  # noqa: E402


def slice_sql(cte: str, attrs: list[tuple[str, str]], fraction: float = 0.1) -> str:
    parts = []
    for name, expr in attrs:
        parts.append(
            f"SELECT '{name}' AS slice, CAST({expr} AS VARCHAR) AS level, count(*) AS gn, sum(y) AS pos,"
            f" sum(fl) AS nf, sum(fl * y) AS tp, max(k) AS k FROM f GROUP BY 2"
        )
    return f"""
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, id ASC) AS rn, count(*) OVER () AS n FROM {cte}),
f AS (SELECT *, greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * n) AS BIGINT)) AS k,
             CAST(rn <= greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * n) AS BIGINT)) AS INTEGER) AS fl
      FROM r),
s AS ({' UNION ALL '.join(parts)})
SELECT slice, level, CAST(gn AS BIGINT) AS group_n, round(pos / gn, 6) AS group_base_rate,
       CAST(nf AS BIGINT) AS n_flagged, round(nf / gn, 6) AS selection_rate,
       round(CASE WHEN nf > 0 THEN tp / nf END, 6) AS precision_in_group, gn < k AS small_slice
FROM s
"""


@register(
    "slice_table",
    f"WITH {SQL_O}, " + slice_sql("od", [("o_orderpriority", "o_orderpriority"), ("order_year", "order_year")]),
)
def q_slice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on orders: priority and order year, global top-10 % flag."""
    o = orders_view(spark, sf_dir)
    return round_doubles(slice_table(o, "y", "score", "id", ["o_orderpriority", "order_year"], 0.10))


@register(
    "slice_table_events",
    f"WITH {SQL_E}, ev2 AS (SELECT *, user_id % 5 AS user_bucket, hour(ts) AS hour_of_day FROM ev), "
    + slice_sql("ev2", [("user_bucket", "user_bucket"), ("hour_of_day", "hour_of_day")]),
)
def q_slice_table_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on events: user_id % 5 and hour of day."""
    e = events_view(spark, sf_dir).withColumns(
        {"user_bucket": F.col("user_id") % 5, "hour_of_day": F.hour("ts")}
    )
    return round_doubles(slice_table(e, "y", "score", "id", ["user_bucket", "hour_of_day"], 0.10))


# ---------------------------------------------------------------- splits
from caprank.operators.split import (  # noqa: E402
    ordered_half_split,
    stratified_folds,
    stratified_split,
)


def h_sql(seed: int, idcol: str = "id") -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', '{seed}', {idcol})), 1, 8)) AS BIGINT)"


def alloc_sql(cte: str, label: str, test_size: float) -> str:
    return f"""
cls AS (SELECT {label} AS c, count(*) AS nc FROM {cte} GROUP BY 1),
tot AS (SELECT sum(nc) AS n, CAST(ceil(CAST({test_size} AS DOUBLE) * sum(nc)) AS BIGINT) AS nt FROM cls),
ex AS (SELECT c, nc, nt, CAST(nt * nc AS DOUBLE) / n AS e, floor(CAST(nt * nc AS DOUBLE) / n) AS fl FROM cls, tot),
rk AS (SELECT c, fl, row_number() OVER (ORDER BY e - fl DESC, c) AS r,
              nt - sum(fl) OVER () AS rest FROM ex),
alloc AS (SELECT c, CAST(fl + CASE WHEN r <= rest THEN 1 ELSE 0 END AS BIGINT) AS ntest FROM rk)
"""


@register(
    "stratified_split",
    f"""
WITH {SQL_E}, {alloc_sql('ev', 'event_type', 0.2)},
o AS (SELECT id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {h_sql(42)}, id) AS rn FROM ev)
SELECT o.id, o.event_type, o.rn <= a.ntest AS is_test FROM o JOIN alloc a ON o.event_type = a.c
""",
)
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 20 % per event_type, md5 order."""
    e = events_view(spark, sf_dir).select("id", "event_type")
    return stratified_split(e, "event_type", "id", 0.20, seed=42)


@register(
    "kfold_sizes",
    f"""
WITH {SQL_O},
o AS (SELECT id, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY {h_sql(42)}, id) AS rn FROM od)
SELECT o_orderstatus, CAST((rn - 1) % 5 AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(id) AS BIGINT) AS id_sum
FROM o GROUP BY 1, 2
""",
)
def q_kfold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 stratified folds of orders by status (size and id checksum per fold)."""
    o = orders_view(spark, sf_dir).select("id", "o_orderstatus")
    f = stratified_folds(o, "o_orderstatus", "id", 5, seed=42)
    return f.groupBy("o_orderstatus", "fold").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"), F.sum("id").cast("long").alias("id_sum")
    )


@register(
    "half_split",
    f"""
WITH {SQL_E}
SELECT id, row_number() OVER (ORDER BY ts, id) <= (count(*) OVER ()) // 2 AS is_reference FROM ev
""",
)
def q_half_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: first half of events by (ts, event_id) is the reference cohort."""
    e = events_view(spark, sf_dir).select("id", "ts")
    return ordered_half_split(e, "ts", "id").select("id", "is_reference")


# ---------------------------------------------------------------- bootstrap
from caprank.operators.bootstrap import (  # noqa: E402
    bootstrap_difference,
    bootstrap_metric,
    poisson1_weight_sql,
)
from caprank.operators.resample import METRICS, metric_intervals, replicates, replicates_sql  # noqa: E402


def boot_sql(scores: dict[str, str], n_iter: int = 50, seed: int = 42, fraction: float = 0.1,
             src: str = "dv") -> str:
    """Replicate precision table ``pb(b, p_<name>)`` as SQL CTEs."""
    sel = ", ".join(f"CAST({e} AS DOUBLE) AS s_{m}" for m, e in scores.items())
    ctes = [
        f"base AS (SELECT id, y, {sel} FROM {src})",
        f"rep AS (SELECT t.b, id, y, {', '.join('s_' + m for m in scores)},"
        f" CAST(('0x' || substr(md5(concat_ws('|', '{seed}', t.b, id)), 1, 8)) AS BIGINT) AS h"
        f" FROM base, range(1, {n_iter + 1}) t(b))",
        f"wt AS (SELECT *, {poisson1_weight_sql('h')} AS w FROM rep)",
        "nb AS (SELECT b, sum(w) AS nw FROM wt GROUP BY b)",
    ]
    for m in scores:
        ctes.append(
            f"cum_{m} AS (SELECT wt.b, y, w, sum(w) OVER (PARTITION BY wt.b ORDER BY s_{m} DESC, id ASC"
            f" ROWS UNBOUNDED PRECEDING) AS cw,"
            f" greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * nb.nw) AS BIGINT)) AS kb"
            f" FROM wt JOIN nb ON wt.b = nb.b WHERE w > 0)"
        )
        ctes.append(
            f"pb_{m} AS (SELECT b, sum(y * greatest(0, least(w, kb - (cw - w)))) / max(kb) AS p_{m}"
            f" FROM cum_{m} GROUP BY b)"
        )
    return ",\n".join(ctes)


def point_sql(expr: str, fraction: float = 0.1, src: str = "dv") -> str:
    return f"""(SELECT sum(CASE WHEN rn <= greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * n) AS BIGINT))
                           THEN y ELSE 0 END) / max(greatest(1, CAST(ceil(CAST({fraction} AS DOUBLE) * n) AS BIGINT)))
           FROM (SELECT y, row_number() OVER (ORDER BY CAST({expr} AS DOUBLE) DESC, id ASC) AS rn,
                        count(*) OVER () AS n FROM {src}))"""


def ends_sql(expr: str) -> str:
    return f"SELECT quantile_cont({expr}, 0.025) AS lo, quantile_cont({expr}, 0.975) AS hi"


@register(
    "bootstrap_ci",
    f"""
WITH {SQL_D}, {replicates_sql({'a': '-n_chars'})},
q AS ({ends_sql('p_a')} FROM pb)
SELECT 'precision_at_k' AS metric, round({point_sql('-n_chars')}, 6) AS point,
       round(lo, 6) AS ci_low, round(hi, 6) AS ci_high, 0.95 AS ci_level
FROM q
""",
)
def q_bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: 95 % CI of P@10 % for the score -n_chars on documents, 2,000
    fixed-size resamples."""
    d = documents_view(spark, sf_dir).withColumn("s", -F.col("n_chars").cast("double"))
    return round_doubles(bootstrap_metric(d, "y", "s", "id", 0.10, seed=42))


@register(
    "bootstrap_diff",
    f"""
WITH {SQL_D}, {replicates_sql({'a': '-n_chars', 'b': 'toxic'})},
q AS ({ends_sql('p_a - p_b')} FROM pb)
SELECT round({point_sql('-n_chars')} - {point_sql('toxic')}, 6) AS point,
       round(lo, 6) AS ci_low, round(hi, 6) AS ci_high, 0.95 AS ci_level,
       (lo > 0 OR hi < 0) AS excludes_zero
FROM q
""",
)
def q_bootstrap_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: P@10 %(-n_chars) - P@10 %(toxic) on the same 2,000 resamples."""
    d = documents_view(spark, sf_dir).withColumns(
        {"sa": -F.col("n_chars").cast("double"), "sb": F.col("toxic").cast("double")}
    )
    return round_doubles(bootstrap_difference(d, "y", "sa", "sb", "id", 0.10, seed=42))


@register("bootstrap_replicates")
def q_bootstrap_replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 resamples themselves: positives, and those in the top 10 %."""
    d = documents_view(spark, sf_dir).withColumn("s", -F.col("n_chars").cast("double"))
    return replicates(d, "y", {"a": "s"}, "id").select("_b", "positives", "tp_a")


ORACLE["bootstrap_replicates"] = f"""
WITH {SQL_D}, {replicates_sql({'a': '-n_chars'})}
SELECT b AS "_b", CAST(positives AS BIGINT) AS positives, CAST(tp_a AS BIGINT) AS tp_a FROM pb
"""


def _metric_ci_sql() -> str:
    value = {"precision_at_k": "p_a", "recall_at_k": "CASE WHEN pb.positives > 0 THEN tp_a / CAST(pb.positives AS DOUBLE) ELSE 0 END",
             "lift_at_k": "CASE WHEN pb.positives > 0 THEN p_a / (CAST(pb.positives AS DOUBLE) / pb.n) ELSE 0 END"}
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, tk.{m} AS point, round(quantile_cont({v}, 0.025), 6) AS ci_low,"
        f" round(quantile_cont({v}, 0.975), 6) AS ci_high, 0.95 AS ci_level FROM pb, tk GROUP BY tk.{m}" for m, v in value.items())
    return f"""
WITH {SQL_D}, rc AS (SELECT id, y, CAST(-n_chars AS DOUBLE) AS score FROM dv),
{replicates_sql({'a': 'score'}, src='rc')}, tk AS ({topk_sql('rc', 'D')})
{rows}
"""


@register("resampled_metrics", _metric_ci_sql())
def q_resampled_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 with other metrics: 95 % CIs of precision, recall and lift at 10 % on the
    same 2,000 resamples."""
    d = documents_view(spark, sf_dir).withColumn("s", -F.col("n_chars").cast("double"))
    return round_doubles(metric_intervals(d, "y", "s", "id", metrics=METRICS))


@register("resampled_average_precision")
def q_resampled_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 with whole-order metrics: 95 % CIs of average precision and ROC area over
    2,000 resamples of the score ladder (multinomial draws, no SQL twin)."""
    d = documents_view(spark, sf_dir).withColumn("s", -F.col("n_chars").cast("double"))
    return round_doubles(metric_intervals(d, "y", "s", "id", metrics=("average_precision", "roc_auc")))


@register(
    "poisson_ci",
    f"""
WITH {SQL_D}, {boot_sql({'a': '-n_chars'})}
SELECT 'precision_at_k' AS metric, round({point_sql('-n_chars')}, 6) AS point,
       round(quantile_cont(p_a, 0.025), 6) AS ci_low, round(quantile_cont(p_a, 0.975), 6) AS ci_high,
       0.95 AS ci_level
FROM pb_a
""",
)
def q_poisson_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 by the Poisson bootstrap: 95 % CI of P@10 % for the score -n_chars."""
    d = documents_view(spark, sf_dir).withColumn("s", -F.col("n_chars").cast("double"))
    return round_doubles(bootstrap_metric(d, "y", "s", "id", 0.10, n_iter=50, seed=42, method="poisson"))


@register(
    "poisson_diff",
    f"""
WITH {SQL_D}, {boot_sql({'a': '-n_chars', 'b': 'toxic'})},
q AS (SELECT quantile_cont(p_a - p_b, 0.025) AS lo, quantile_cont(p_a - p_b, 0.975) AS hi
      FROM pb_a JOIN pb_b ON pb_a.b = pb_b.b)
SELECT round({point_sql('-n_chars')} - {point_sql('toxic')}, 6) AS point,
       round(lo, 6) AS ci_low, round(hi, 6) AS ci_high, 0.95 AS ci_level,
       (lo > 0 OR hi < 0) AS excludes_zero
FROM q
""",
)
def q_poisson_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 by the Poisson bootstrap: P@10 %(-n_chars) - P@10 %(toxic)."""
    d = documents_view(spark, sf_dir).withColumns(
        {"sa": -F.col("n_chars").cast("double"), "sb": F.col("toxic").cast("double")}
    )
    return round_doubles(bootstrap_difference(d, "y", "sa", "sb", "id", 0.10, n_iter=50, seed=42, method="poisson"))


# ---------------------------------------------------------------- validation
from caprank.operators.profile import (  # noqa: E402
    add_binary_target,
    cardinality,
    correlations,
    cutoff_inspection,
    distinct_values,
    group_stats,
    histogram,
    leakage_scan,
    null_counts,
    outcome_summary,
)
from caprank.operators.validate import (  # noqa: E402
    Rules,
    duplicate_rows,
    learn_categories,
    unknown_categories,
    validation_report,
)
from caprank.sources.readers import read_table  # noqa: E402

ORDER_RULES = Rules(
    required=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
    int_columns=["o_orderkey", "o_custkey"],
    float_columns=["o_totalprice"],
    # bounds and sets that part of the rows break, so that each count is put to the test
    ranges={"o_totalprice": (50000.0, 250000.0)},
    positive=["o_totalprice"],
    non_negative=["o_custkey"],
    allowed={"o_orderstatus": ["F", "O"],
             "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]},
    label="y",
    expected_base_rate=0.33,
    base_rate_tolerance=0.05,
)

COHORT_RULES = Rules(
    required=["id", "enrolled", "approved", "evaluations", "without_eval", "c_acctbal", "y"],
    int_columns=["enrolled", "approved", "evaluations", "without_eval", "y"],
    float_columns=["c_acctbal"],
    ranges={"c_acctbal": (-500.0, 9000.0), "enrolled": (0.0, 8.0)},
    positive=["approved", "c_acctbal"],
    non_negative=["enrolled", "approved", "evaluations", "without_eval", "c_acctbal"],
    allowed={"y": [0, 1]},
    label="y",
    expected_base_rate=0.36,
    base_rate_tolerance=0.05,
    null_columns=["id", "enrolled", "approved", "evaluations", "without_eval", "c_acctbal", "y"],
)


def _sql_checks(rules: Rules, dtypes: dict[str, str], columns: list[str]) -> list[tuple[str, str, str]]:
    out = []
    for c in (rules.null_columns if rules.null_columns is not None else columns):
        pred = f"{c} IS NULL" + (f" OR isnan({c})" if dtypes.get(c) == "double" else "")
        out.append(("null", c, pred))
    for c in rules.int_columns:
        d = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
        out.append(("coerce_int", c, f"{c} IS NOT NULL AND ({d} IS NULL OR {d} <> floor({d}))"))
    for c in rules.float_columns:
        d = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
        out.append(("coerce_float", c, f"{c} IS NOT NULL AND {d} IS NULL"))
    for c, (lo, hi) in rules.ranges.items():
        out.append(("in_range", c, f"NOT (CAST({c} AS DOUBLE) BETWEEN {lo} AND {hi})"))
    for c in rules.positive:
        out.append(("positive", c, f"NOT (CAST({c} AS DOUBLE) > 0)"))
    for c in rules.non_negative:
        out.append(("non_negative", c, f"NOT (CAST({c} AS DOUBLE) >= 0)"))
    for c, vals in rules.allowed.items():
        lits = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals)
        out.append(("allowed_values", c, f"NOT ({c} IN ({lits}))"))
    return out


def validation_sql(cte: str, label: str, rules: Rules, dtypes: dict[str, str], columns: list[str]) -> str:
    parts = []
    for chk, col, pred in _sql_checks(rules, dtypes, columns):
        parts.append(
            f"SELECT '{label}' AS view, '{chk}' AS \"check\", '{col}' AS \"column\","
            f" CAST(count(*) FILTER (WHERE coalesce({pred}, true)) AS BIGINT) AS n_violations,"
            f" CAST(NULL AS DOUBLE) AS value FROM {cte}"
        )
    for c in rules.required:
        parts.append(f"SELECT '{label}', 'required', '{c}', CAST({0 if c in columns else 1} AS BIGINT),"
                     f" CAST(NULL AS DOUBLE)")
    parts.append(
        f"SELECT '{label}', 'base_rate', '{rules.label}',"
        f" CAST(coalesce(abs(avg(CAST({rules.label} AS DOUBLE)) - {rules.expected_base_rate}) > "
        f"{rules.base_rate_tolerance}, true) AS BIGINT), round(avg(CAST({rules.label} AS DOUBLE)), 6) FROM {cte}"
    )
    parts.append(f"SELECT '{label}', 'row_count', '*', CAST(0 AS BIGINT), CAST(count(*) AS DOUBLE) FROM {cte}")
    return " UNION ALL ".join(parts)


_O_COLS = ["id", "o_custkey", "o_orderstatus", "o_orderpriority", "order_year", "o_totalprice", "y", "score"]
_O_SQL_VIEW = "odv AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority," \
              " CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders)"
_O_RAW_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "y"]
_C_COLS = ["id", "enrolled", "approved", "evaluations", "without_eval", "avg_price", "c_acctbal",
           "c_mktsegment", "c_nationkey", "y"]


@register(
    "validation_report",
    f"WITH {_O_SQL_VIEW}, {SQL_C} "
    + validation_sql("odv", "O", ORDER_RULES, {"o_totalprice": "double"}, _O_RAW_COLS)
    + " UNION ALL "
    + validation_sql("cohort", "C", COHORT_RULES, {"c_acctbal": "double"}, _C_COLS),
)
def q_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1-V11 fused: one aggregate per table, long report."""
    o = read_table(spark, sf_dir, "orders").select(*_O_RAW_COLS[:-1]).withColumn(
        "y", (F.col("o_orderstatus") == "F").cast("int"))
    c = customer_cohort(spark, sf_dir)
    ro = validation_report(o, ORDER_RULES).select(F.lit("O").alias("view"), "*")
    rc = validation_report(c, COHORT_RULES).select(F.lit("C").alias("view"), "*")
    return round_doubles(ro.unionByName(rc))


@register(
    "duplicate_rows",
    """
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""",
)
def q_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate (l_orderkey, l_linenumber) groups in lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    return duplicate_rows(li, ["l_orderkey", "l_linenumber"])


@register(
    "duplicate_full_rows",
    """
SELECT CAST(count(*) AS BIGINT) AS n_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY ALL_COLUMNS_PLACEHOLDER HAVING count(*) > 1)
""".replace(
        "ALL_COLUMNS_PLACEHOLDER",
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,"
        " l_returnflag, l_linestatus, l_shipdate",
    ),
)
def q_duplicate_full_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12 on whole lineitem rows: number of duplicate groups and their rows."""
    li = read_table(spark, sf_dir, "lineitem")
    d = duplicate_rows(li)
    return d.agg(F.count(F.lit(1)).cast("long").alias("n_groups"),
                  F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"))


@register(
    "unknown_categories",
    f"""
WITH {SQL_O},
r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey_ts, id) AS rn, count(*) OVER () AS n
      FROM (SELECT od.*, o.o_orderdate AS o_orderkey_ts FROM od JOIN orders o ON od.id = o.o_orderkey)),
train AS (SELECT * FROM r WHERE rn <= n // 2),
cur AS (SELECT * FROM r WHERE rn > n // 2),
known AS (SELECT DISTINCT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS code FROM train
          UNION SELECT DISTINCT 'o_orderpriority', CAST(o_orderpriority AS VARCHAR) FROM train),
codes AS (SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS code, count(*) AS n FROM cur GROUP BY 2
          UNION ALL SELECT 'o_orderpriority', CAST(o_orderpriority AS VARCHAR), count(*) FROM cur GROUP BY 2)
SELECT c."column", c.code, CAST(c.n AS BIGINT) AS n_rows FROM codes c
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k."column" = c."column" AND k.code = c.code)
""",
)
def q_unknown_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the later half of orders (by date) unseen in the earlier half."""
    o = orders_view(spark, sf_dir).join(
        read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate"), "id")
    halves = ordered_half_split(o, "o_orderdate", "id", flag_col="_train")
    cols = ["o_custkey", "o_orderpriority"]
    known = learn_categories(halves.filter("_train"), cols)
    return unknown_categories(halves.filter(~F.col("_train")), known, cols)


# ---------------------------------------------------------------- profiles
@register(
    "binary_target",
    """
SELECT o_orderkey AS id, o_orderstatus, CAST(o_orderstatus = 'F' AS INTEGER) AS is_finished FROM orders
""",
)
def q_binary_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary target from a multi-class column (orders status F)."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    return add_binary_target(o, "o_orderstatus", "F", "is_finished")


@register(
    "outcome_summary",
    """
WITH t AS (SELECT count(*) AS n_total, avg(CAST(o_orderstatus = 'F' AS DOUBLE)) AS base_rate FROM orders)
SELECT o_orderstatus AS class, CAST(count(*) AS BIGINT) AS n_rows, round(count(*) / max(t.n_total), 6) AS share,
       CAST(max(t.n_total) AS BIGINT) AS n_total, CAST(6 AS BIGINT) AS n_columns,
       round(max(t.base_rate), 6) AS base_rate,
       CASE WHEN max(t.base_rate) BETWEEN 0.28 AND 0.38 THEN 'OK' ELSE 'OUT OF RANGE' END AS status
FROM orders, t GROUP BY o_orderstatus
""",
)
def q_outcome_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: class counts, shares and base-rate status for orders."""
    o = read_table(spark, sf_dir, "orders")
    return round_doubles(outcome_summary(o, "o_orderstatus", "F", 0.28, 0.38))


def _null_sql(table: str, cols: list[tuple[str, str]], label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS view, '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR isnan({c})" if t == "double" else "")
        + f") AS BIGINT) AS n_null FROM {table}"
        for c, t in cols
    )


@register(
    "null_counts",
    f"WITH {SQL_D}, {SQL_C} "
    + _null_sql("dv", [("id", "x"), ("n_chars", "x"), ("lang", "x"), ("source", "x"), ("toxic", "x"), ("y", "x")], "D")
    + " UNION ALL "
    + _null_sql("cohort", [("id", "x"), ("enrolled", "x"), ("approved", "x"), ("evaluations", "x"),
                           ("without_eval", "x"), ("avg_price", "double"), ("c_acctbal", "double"),
                           ("c_mktsegment", "x"), ("c_nationkey", "x"), ("y", "x")], "C"),
)
def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2/V8: per-column null counts of the D and C views."""
    d = null_counts(documents_view(spark, sf_dir)).select(F.lit("D").alias("view"), "*")
    c = null_counts(customer_cohort(spark, sf_dir)).select(F.lit("C").alias("view"), "*")
    return d.unionByName(c)


def _card_sql(table: str, cols: list[str], label: str, cap: int = 10) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS view, '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct,"
        f" count(DISTINCT {c}) > {cap} AS is_high_cardinality,"
        f" CAST(least(count(DISTINCT {c}), {cap}) + CASE WHEN count(DISTINCT {c}) > {cap} THEN 1 ELSE 0 END"
        f" AS BIGINT) AS onehot_width FROM {table}"
        for c in cols
    )


@register(
    "cardinality",
    f"WITH {SQL_D}, {SQL_O} " + _card_sql("dv", ["lang", "source"], "D") + " UNION ALL "
    + _card_sql("od", ["o_orderstatus", "o_orderpriority", "o_custkey", "order_year"], "O"),
)
def q_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3/Q4: distinct counts, high/low split and capped one-hot width."""
    d = cardinality(documents_view(spark, sf_dir), ["lang", "source"]).select(F.lit("D").alias("view"), "*")
    o = cardinality(orders_view(spark, sf_dir),
                    ["o_orderstatus", "o_orderpriority", "o_custkey", "order_year"]).select(
        F.lit("O").alias("view"), "*")
    return d.unionByName(o)


@register(
    "onehot_width",
    f"""
WITH {SQL_D}, {SQL_O},
u AS (SELECT count(DISTINCT lang) AS a, count(DISTINCT source) AS b FROM dv),
v AS (SELECT count(DISTINCT o_orderstatus) AS a, count(DISTINCT o_orderpriority) AS b,
             count(DISTINCT o_custkey) AS c, count(DISTINCT order_year) AS d FROM od)
SELECT 'D' AS view, CAST(least(a, 10) + (a > 10)::INT + least(b, 10) + (b > 10)::INT AS BIGINT) AS design_width FROM u
UNION ALL
SELECT 'O', CAST(least(a, 10) + (a > 10)::INT + least(b, 10) + (b > 10)::INT + least(c, 10) + (c > 10)::INT
                 + least(d, 10) + (d > 10)::INT AS BIGINT) FROM v
""",
)
def q_onehot_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: design width of the capped one-hot encoding per view."""
    d = cardinality(documents_view(spark, sf_dir), ["lang", "source"]).agg(
        F.sum("onehot_width").cast("long").alias("design_width")).select(F.lit("D").alias("view"), "*")
    o = cardinality(orders_view(spark, sf_dir),
                    ["o_orderstatus", "o_orderpriority", "o_custkey", "order_year"]).agg(
        F.sum("onehot_width").cast("long").alias("design_width")).select(F.lit("O").alias("view"), "*")
    return d.unionByName(o)


@register(
    "distinct_values",
    f"""
WITH {SQL_D}, {SQL_O},
v AS (SELECT DISTINCT 'lang' AS "column", CAST(lang AS VARCHAR) AS value FROM dv
      UNION SELECT DISTINCT 'source', CAST(source AS VARCHAR) FROM dv
      UNION SELECT DISTINCT 'o_orderpriority', CAST(o_orderpriority AS VARCHAR) FROM od)
SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) AS BIGINT) AS position FROM v
""",
)
def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: sorted distinct values of categorical columns."""
    d = distinct_values(documents_view(spark, sf_dir), ["lang", "source"])
    o = distinct_values(orders_view(spark, sf_dir), ["o_orderpriority"])
    return d.unionByName(o)


@register(
    "group_stats",
    f"""
WITH {SQL_C},
f AS (SELECT y, {safe_ratio_sql('approved', 'enrolled')} AS pass_rate FROM cohort)
SELECT y AS "group", CAST(count(*) AS BIGINT) AS n, round(avg(pass_rate), 6) AS mean,
       round(median(pass_rate), 6) AS median, round(stddev_samp(pass_rate), 6) AS std,
       round((SELECT avg(pass_rate) FILTER (WHERE y = 1) - avg(pass_rate) FILTER (WHERE y = 0) FROM f), 6)
         AS mean_gap
FROM f GROUP BY y
""",
)
def q_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: pass-rate mean / median / sample std by label, and the mean gap."""
    from caprank.functions.features import safe_ratio

    c = customer_cohort(spark, sf_dir).withColumn("pass_rate", safe_ratio("approved", "enrolled"))
    return round_doubles(group_stats(c, "pass_rate", "y"))


@register(
    "histogram",
    f"""
WITH {SQL_E},
p AS (SELECT y, value FROM ev WHERE value IS NOT NULL AND NOT isnan(CAST(value AS DOUBLE))),
g AS (SELECT y, min(value) AS lo, max(value) AS hi, count(*) AS n FROM p GROUP BY y),
b AS (SELECT ev.y, g.lo, g.hi, g.n,
             CASE WHEN g.hi > g.lo THEN least(20, floor((value - g.lo) / (g.hi - g.lo) * 20) + 1) ELSE 1 END AS bin
      FROM p AS ev JOIN g ON ev.y = g.y)
SELECT y AS "group", CAST(bin AS INTEGER) AS bin, round(max(lo) + (bin - 1) * (max(hi) - max(lo)) / 20, 6) AS bin_lo,
       round(max(lo) + bin * (max(hi) - max(lo)) / 20, 6) AS bin_hi, CAST(count(*) AS BIGINT) AS n_rows,
       round(CASE WHEN max(hi) > max(lo) THEN count(*) / (max(n) * ((max(hi) - max(lo)) / 20)) END, 6) AS density
FROM b GROUP BY y, bin
""",
)
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: 20-bin density histogram of event value per label."""
    return round_doubles(histogram(events_view(spark, sf_dir), "value", "y", 20))


@register(
    "correlations",
    f"""
WITH {SQL_C},
f AS (SELECT CAST(y AS DOUBLE) AS y, {safe_ratio_sql('approved', 'enrolled')} AS pass_rate,
             {safe_ratio_sql('evaluations', 'enrolled')} AS eval_rate,
             {safe_ratio_sql('without_eval', 'enrolled')} AS unevaluated_ratio FROM cohort),
r AS (SELECT 'pass_rate' AS a, 'eval_rate' AS b, corr(pass_rate, eval_rate) AS r FROM f
      UNION ALL SELECT 'pass_rate', 'unevaluated_ratio', corr(pass_rate, unevaluated_ratio) FROM f
      UNION ALL SELECT 'pass_rate', 'y', corr(pass_rate, y) FROM f
      UNION ALL SELECT 'eval_rate', 'unevaluated_ratio', corr(eval_rate, unevaluated_ratio) FROM f
      UNION ALL SELECT 'eval_rate', 'y', corr(eval_rate, y) FROM f
      UNION ALL SELECT 'unevaluated_ratio', 'y', corr(unevaluated_ratio, y) FROM f)
SELECT a, b, round(r, 6) AS r, abs(r) > 0.9 AS above_threshold FROM r
""",
)
def q_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: Pearson correlations of the three ratios and the label."""
    from caprank.functions.features import safe_ratio

    c = customer_cohort(spark, sf_dir).select(
        F.col("y").cast("double").alias("y"),
        safe_ratio("approved", "enrolled").alias("pass_rate"),
        safe_ratio("evaluations", "enrolled").alias("eval_rate"),
        safe_ratio("without_eval", "enrolled").alias("unevaluated_ratio"),
    )
    return round_doubles(correlations(c, ["pass_rate", "eval_rate", "unevaluated_ratio", "y"]))


@register(
    "rule_preview",
    f"WITH {SQL_C}, rc AS (SELECT id, y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS score FROM cohort) "
    + topk_sql("rc", "C"),
)
def q_rule_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: rule-baseline P@10 %, lift and recall on the whole cohort."""
    c = customer_cohort(spark, sf_dir).withColumn("score", rule_score("approved", "enrolled"))
    return round_doubles(topk_metrics(c, "y", "score", "id", 0.10).select(F.lit("C").alias("view"), "*"))


_LEAK_FEATURES = ["enrolled", "approved", "evaluations", "without_eval", "avg_price", "c_acctbal", "c_nationkey"]


def _leak_sql() -> str:
    parts = []
    for f in _LEAK_FEATURES:
        for d, sgn in (("pos", 1), ("neg", -1)):
            parts.append(
                f"SELECT '{f}' AS feature, '{d}' AS direction, id, y,"
                f" coalesce(CAST({f} AS DOUBLE) * {sgn}, CAST('-inf' AS DOUBLE)) AS v FROM cohort"
            )
    return f"""
WITH {SQL_C},
l AS ({' UNION ALL '.join(parts)}),
r AS (SELECT feature, direction, y, row_number() OVER (PARTITION BY feature, direction ORDER BY v DESC, id) AS rn,
             count(*) OVER (PARTITION BY feature, direction) AS n FROM l),
p AS (SELECT feature, direction,
             sum(CASE WHEN rn <= greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT)) THEN y ELSE 0 END)
               / max(greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT))) AS p, avg(y) AS base
      FROM r GROUP BY 1, 2),
b AS (SELECT feature, max(p) FILTER (WHERE direction = 'pos') AS pp, max(p) FILTER (WHERE direction = 'neg') AS pn,
             max(base) AS base FROM p GROUP BY 1)
SELECT feature, CASE WHEN pp >= pn THEN 'pos' ELSE 'neg' END AS best_direction,
       round(greatest(pp, pn), 6) AS precision_at_k,
       round(CASE WHEN base > 0 THEN greatest(pp, pn) / base ELSE 0.0 END, 6) AS lift_at_k
FROM b
"""


@register("leakage_scan", _leak_sql())
def q_leakage_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: single-feature ranking scan over the cohort (finds the leak)."""
    c = customer_cohort(spark, sf_dir)
    return round_doubles(leakage_scan(c, "y", "id", _LEAK_FEATURES, 0.10))


@register(
    "cutoff_inspection",
    f"""
WITH {SQL_O},
r AS (SELECT y, score, row_number() OVER (ORDER BY score DESC, id) AS rn, count(*) OVER () AS n FROM od),
k AS (SELECT greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * max(n)) AS BIGINT)) AS k FROM r)
SELECT CAST(k.k AS BIGINT) AS k, CAST(sum(CASE WHEN rn <= k.k THEN y ELSE 0 END) AS BIGINT) AS positives_in_top,
       round(max(score), 6) AS max_score, round(min(score), 6) AS min_score,
       round(max(CASE WHEN rn = k.k THEN score END), 6) AS score_at_k,
       round(max(CASE WHEN rn = k.k + 1 THEN score END), 6) AS score_at_k_plus_1
FROM r, k GROUP BY k.k
""",
)
def q_cutoff_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: positives in the top k and the scores around the cut (orders)."""
    return round_doubles(cutoff_inspection(orders_view(spark, sf_dir), "y", "score", "id", 0.10))


# ---------------------------------------------------------------- drift
from caprank.operators.drift import (  # noqa: E402
    chi2_statistics,
    drift_report,
    drift_verdict,
    ks_statistics,
    psi,
    volume_check,
)


def event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference = first half of events by (ts, event_id), current = rest."""
    e = events_view(spark, sf_dir)
    h = ordered_half_split(e, "ts", "id", flag_col="_ref")
    return h.filter("_ref").drop("_ref"), h.filter(~F.col("_ref")).drop("_ref")


SQL_HALVES = """
h AS (SELECT *, row_number() OVER (ORDER BY ts, id) <= (count(*) OVER ()) // 2 AS is_ref FROM ev)
"""


def ks_sql(cte: str, cols: list[str]) -> str:
    st = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v, CASE WHEN is_ref THEN 0 ELSE 1 END AS cur FROM {cte}"
        for c in cols)
    return f"""
st AS ({st}),
g AS (SELECT col, v, count(*) FILTER (WHERE cur = 0) AS cr, count(*) FILTER (WHERE cur = 1) AS cc
      FROM st WHERE v IS NOT NULL GROUP BY 1, 2),
t AS (SELECT col, sum(cr) AS nr, sum(cc) AS nc FROM g GROUP BY 1),
cu AS (SELECT col, sum(cr) OVER (PARTITION BY col ORDER BY v) AS fr,
              sum(cc) OVER (PARTITION BY col ORDER BY v) AS fc FROM g),
d AS (SELECT cu.col, max(abs(fr / t.nr - fc / t.nc)) AS dd, max(t.nr) AS nr, max(t.nc) AS nc
      FROM cu JOIN t ON cu.col = t.col GROUP BY cu.col),
l AS (SELECT *, dd * sqrt(nr * nc / (nr + nc)) AS lam FROM d)
SELECT col AS "column", round(dd, 6) AS statistic, CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur,
       round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
         (SELECT sum(2.0 * power(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam)) FROM range(1, 101) r(j)))) END, 6)
         AS p_value
FROM l
"""


@register("ks_drift", f"WITH {SQL_E}, {SQL_HALVES}, " + ks_sql("h", ["value", "user_id"]))
def q_ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 numeric: two-sample KS of value and user_id between event halves."""
    ref, cur = event_halves(spark, sf_dir)
    return round_doubles(ks_statistics(ref, cur, ["value", "user_id"]))


@register(
    "chi2_drift",
    f"""
WITH {SQL_E}, {SQL_HALVES},
g AS (SELECT event_type AS v, count(*) FILTER (WHERE is_ref) AS o_ref, count(*) FILTER (WHERE NOT is_ref) AS o_cur
      FROM h GROUP BY 1),
t AS (SELECT sum(o_ref) AS nr, sum(o_cur) AS nc, count(*) AS nv FROM g)
SELECT 'event_type' AS "column",
       round(sum(power(o_ref - (o_ref + o_cur) * nr / (nr + nc), 2) / ((o_ref + o_cur) * nr / (nr + nc))
               + power(o_cur - (o_ref + o_cur) * nc / (nr + nc), 2) / ((o_ref + o_cur) * nc / (nr + nc))), 6)
         AS statistic,
       CAST(max(nv) - 1 AS BIGINT) AS dof
FROM g, t
""",
)
def q_chi2_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 categorical: chi-square of event_type between event halves."""
    ref, cur = event_halves(spark, sf_dir)
    return round_doubles(chi2_statistics(ref, cur, ["event_type"], with_pvalue=False))


@register(
    "psi_drift",
    f"""
WITH {SQL_E}, {SQL_HALVES},
e AS (SELECT quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM h WHERE is_ref),
b AS (SELECT is_ref, len(list_filter(e.edges, lambda x: x < value)) AS bin FROM h, e WHERE value IS NOT NULL),
c AS (SELECT bin, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS k FROM b GROUP BY 1),
s AS (SELECT greatest(r / sum(r) OVER (), 1e-4) AS pr, greatest(k / sum(k) OVER (), 1e-4) AS pk FROM c)
SELECT 'value' AS "column", round(sum((pk - pr) * ln(pk / pr)), 6) AS psi FROM s
""",
)
def q_psi_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of value between event halves on reference deciles."""
    ref, cur = event_halves(spark, sf_dir)
    return round_doubles(psi(ref, cur, ["value"], bins=10))


@register(
    "score_drift",
    f"""
WITH {SQL_O}, ho AS (SELECT od.*, row_number() OVER (ORDER BY o.o_orderdate, od.id) <= (count(*) OVER ()) // 2 AS is_ref
                      FROM od JOIN orders o ON od.id = o.o_orderkey), """
    + ks_sql("ho", ["score"]),
)
def q_score_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS drift of the order score between date halves."""
    o = orders_view(spark, sf_dir).join(
        read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate"), "id")
    h = ordered_half_split(o, "o_orderdate", "id", flag_col="_ref")
    return round_doubles(ks_statistics(h.filter("_ref"), h.filter(~F.col("_ref")), ["score"]))


@register(
    "volume_check",
    f"""
WITH {SQL_E}, {SQL_HALVES},
rr AS (SELECT value, row_number() OVER (ORDER BY value DESC, id) AS rn, count(*) OVER () AS n FROM h WHERE is_ref),
cut AS (SELECT max(value) FILTER (WHERE rn = greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT))) AS c FROM rr),
a AS (SELECT count(*) FILTER (WHERE value >= (SELECT c FROM cut)) AS nf, count(*) AS nt FROM h WHERE NOT is_ref)
SELECT CAST(nf AS BIGINT) AS n_flagged, CAST(nt AS BIGINT) AS n_total, round(nf / nt, 6) AS actual_rate,
       0.1 AS expected_rate, round(abs(nf / nt - 0.1), 6) AS deviation, abs(nf / nt - 0.1) > 0.3 AS alert
FROM a
""",
)
def q_volume_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: flagged share of the current half at the reference half's frozen
    top-10 % cut-off score (absolute tolerance 0.30)."""
    from caprank.operators.ranking import top_k_cut

    ref, cur = event_halves(spark, sf_dir)
    cut, _ = top_k_cut(ref, "value", "id", 0.10)
    v = volume_check(cur, "value", cut.score, 0.10, 0.30)
    return round_doubles(v.drop("message"))


@register(
    "drift_verdict",
    f"""
WITH {SQL_E}, {SQL_HALVES},
k AS (WITH """ + ks_sql("h", ["value", "user_id"]) + """),
c AS (WITH g2 AS (SELECT event_type AS v, count(*) FILTER (WHERE is_ref) AS o_ref, count(*) FILTER (WHERE NOT is_ref) AS o_cur
                  FROM h GROUP BY 1),
           t2 AS (SELECT sum(o_ref) AS nr, sum(o_cur) AS nc FROM g2)
      SELECT sum(power(o_ref - (o_ref + o_cur) * nr / (nr + nc), 2) / ((o_ref + o_cur) * nr / (nr + nc))
                 + power(o_cur - (o_ref + o_cur) * nc / (nr + nc), 2) / ((o_ref + o_cur) * nc / (nr + nc))) AS x FROM g2, t2),
-- five event types: 4 degrees of freedom, whose tail is exp(-x/2) (1 + x/2)
r AS (SELECT "column" AS col, p_value < 0.05 AS drifted FROM k
      UNION ALL SELECT 'event_type', exp(-x / 2) * (1 + x / 2) < 0.05 FROM c),
a AS (SELECT count(*) FILTER (WHERE drifted) AS n, count(*) AS m, string_agg(col, ',' ORDER BY col) FILTER (WHERE drifted) AS cols FROM r)
SELECT CAST(n AS BIGINT) AS drifted_count, round(n / m, 6) AS drifted_share, CAST(m AS BIGINT) AS n_columns_compared,
       n / m > 0.5 AS alert, coalesce(cols, '') AS drifted_columns,
       CASE WHEN n / m > 0.5 THEN printf('alert: the cohort differs in %d of %d columns (share %.2f)', n, m, n / m)
            ELSE printf('ok: the cohort differs in %d of %d columns', n, m) END AS message
FROM a
""",
)
def q_drift_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2 (+D6): per-column tests over value, user_id (ks) and
    event_type (chi2) between event halves, then the verdict row."""
    ref, cur = event_halves(spark, sf_dir)
    cols = ["value", "user_id", "event_type"]
    rep = drift_report(ref.select(*cols), cur.select(*cols))
    return round_doubles(drift_verdict(rep).withColumn("drifted_columns", F.array_join("drifted_columns", ",")))


# ---------------------------------------------------------------- gate
from caprank.operators.gate import promotion_decision  # noqa: E402


@register("gate_decision")
def q_gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + G2 on documents: candidate -n_chars vs baseline toxic,
    2,000 resamples, slices by lang and source; failing slices flattened to a count."""
    d = documents_view(spark, sf_dir).withColumns(
        {"sa": -F.col("n_chars").cast("double"), "sb": F.col("toxic").cast("double")})
    sl = slice_table(d, "y", "sa", "id", ["lang", "source"], 0.10)
    dec = promotion_decision(d, "y", "sa", "sb", "id", sl, 0.10, seed=42)
    return round_doubles(dec.withColumn("n_failing_slices", F.size("failing_slices").cast("long"))
                         .drop("failing_slices"))


def _gate_sql() -> str:
    sl = slice_sql("dvs", [("lang", "lang"), ("source", "source")])
    return f"""
WITH {SQL_D}, {replicates_sql({'a': '-n_chars', 'b': 'toxic'})},
q AS ({ends_sql('p_a - p_b')} FROM pb),
pt AS (SELECT {point_sql('-n_chars')} AS pa, {point_sql('toxic')} AS pb),
dvs AS (SELECT *, CAST(-n_chars AS DOUBLE) AS score FROM dv),
slices AS (SELECT * FROM (WITH {sl.strip()}) ),
fails AS (SELECT count(*) AS nf FROM slices, pt
          WHERE NOT small_slice AND precision_in_group IS NOT NULL AND precision_in_group < pt.pa - 0.2)
SELECT (pa > pb) AND (lo > 0 OR hi < 0) AND nf = 0 AS promote,
       round(pa, 6) AS candidate_precision_at_k, round(pb, 6) AS baseline_precision_at_k,
       round(pa - pb, 6) AS difference, round(lo, 6) AS difference_ci_low, round(hi, 6) AS difference_ci_high,
       (lo > 0 OR hi < 0) AS difference_excludes_zero, pa > pb AS beats_baseline,
       (lo > 0 OR hi < 0) AS ci_gate_passed, nf = 0 AS slice_gate_passed, CAST(nf AS BIGINT) AS n_failing_slices
FROM q, pt, fails
"""


ORACLE["gate_decision"] = _gate_sql()


# ---------------------------------------------------------------- fingerprint
from caprank.sources.fingerprint import table_fingerprint  # noqa: E402


@register(
    "table_fingerprint",
    """
SELECT 'region' AS "table", CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', r_regionkey, r_name)), 1, 8)) AS BIGINT)) AS VARCHAR)
         AS hash_sum,
       bit_xor(CAST(('0x' || substr(md5(concat_ws('|', r_regionkey, r_name)), 1, 8)) AS BIGINT)) AS hash_xor
FROM region
UNION ALL
SELECT 'nation', CAST(count(*) AS BIGINT),
       CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', n_nationkey, n_name, n_regionkey)), 1, 8)) AS BIGINT))
         AS VARCHAR),
       bit_xor(CAST(('0x' || substr(md5(concat_ws('|', n_nationkey, n_name, n_regionkey)), 1, 8)) AS BIGINT))
FROM nation
""",
)
def q_table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 (portable md5 variant) on region and nation."""
    r = table_fingerprint(read_table(spark, sf_dir, "region"), "md5").select(F.lit("region").alias("table"), "*")
    n = table_fingerprint(read_table(spark, sf_dir, "nation"), "md5").select(F.lit("nation").alias("table"), "*")
    return r.unionByName(n)


@register("table_fingerprint_xxhash")
def q_table_fingerprint_xxhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 default (xxhash64, Spark-only) on lineitem and orders."""
    li = table_fingerprint(read_table(spark, sf_dir, "lineitem")).select(F.lit("lineitem").alias("table"), "*")
    o = table_fingerprint(read_table(spark, sf_dir, "orders")).select(F.lit("orders").alias("table"), "*")
    return li.unionByName(o)


# ---------------------------------------------------------------- encoders
from caprank.operators.encode import PopulationScaler, capped_categories, class_weights  # noqa: E402


def capped_sql(cte: str, cols: list[str], cap: int = 11) -> str:
    un = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS code FROM {cte}" for c in cols)
    return f"""
u AS ({un}),
cn AS (SELECT col, code, count(*) AS n FROM u GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, code DESC) AS rk,
              count(*) OVER (PARTITION BY col) AS card FROM cn)
SELECT col AS "column", code, CAST(n AS BIGINT) AS n_rows, false AS is_infrequent FROM rk
WHERE card <= {cap} OR rk <= {cap - 1}
UNION ALL
SELECT col, 'infrequent', CAST(sum(n) AS BIGINT), true FROM rk WHERE card > {cap} AND rk > {cap - 1} GROUP BY col
"""


@register(
    "capped_categories",
    f"WITH {SQL_D}, {SQL_O}, dvo AS (SELECT d.lang, d.source FROM dv d), "
    + capped_sql("dvo", ["lang", "source"])
    + " UNION ALL (WITH "
    + SQL_O.strip()
    + ", "
    + capped_sql("od", ["o_orderpriority", "o_custkey"])
    + ")",
)
def q_capped_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept codes and infrequent buckets (cap 11) for D and O columns."""
    d = capped_categories(documents_view(spark, sf_dir), ["lang", "source"])
    o = capped_categories(orders_view(spark, sf_dir), ["o_orderpriority", "o_custkey"])
    return d.unionByName(o)


@register(
    "scaled_numerics",
    f"""
WITH {SQL_O}
SELECT id, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS o_totalprice__z,
       round((order_year - avg(order_year) OVER ()) / stddev_pop(order_year) OVER (), 6) AS order_year__z
FROM od
""",
)
def q_scaled_numerics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population-std standardisation fitted in one aggregate."""
    o = orders_view(spark, sf_dir)
    model = PopulationScaler.create(["o_totalprice", "order_year"]).fit(o)
    return round_doubles(model.transform(o).select("id", "o_totalprice__z", "order_year__z"))


@register(
    "class_weights",
    """
SELECT o_orderstatus AS label, CAST(count(*) AS BIGINT) AS n_class,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM orders GROUP BY 1
""",
)
def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: balanced class weights per order status."""
    return round_doubles(class_weights(read_table(spark, sf_dir, "orders"), "o_orderstatus"))


@register(
    "model_bundle",
    f"""
WITH {SQL_C},
rc AS (SELECT id, y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS score FROM cohort),
{replicates_sql({'a': 'score'}, src='rc')},
tk AS ({topk_sql('rc', 'C')}),
ap AS ({ap_sql('rc', 'C')}),
br AS (SELECT avg(power(score - y, 2)) AS brier FROM rc),
ci AS ({ends_sql('p_a')} FROM pb)
SELECT tk.precision_at_k, round(ci.lo, 6) AS precision_at_k_ci_low, round(ci.hi, 6) AS precision_at_k_ci_high,
       tk.lift_at_k, tk.recall_at_k, ap.average_precision AS pr_auc, round(br.brier, 6) AS brier, tk.base_rate
FROM tk, ap, br, ci
""",
)
def q_model_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight-number bundle (CI over 2,000 resamples) for the
    rule score on the customer cohort."""
    from caprank.operators.metrics import evaluate_model

    c = customer_cohort(spark, sf_dir).withColumn("score", rule_score("approved", "enrolled"))
    return round_doubles(evaluate_model(c, "y", "score", "id", 0.10, n_bootstrap=2000, seed=42))


# ---------------------------------------------------------------- models (rows-only checks)
from caprank.operators.scorers import CohortSpec, GBTScorer, LogisticScorer, score_ladder  # noqa: E402

C_SPEC = CohortSpec(
    id="id", label="y", categorical=["c_mktsegment", "c_nationkey"],
    numeric=["enrolled", "approved", "evaluations", "without_eval", "avg_price", "c_acctbal"],
    roles={"enrolled": "enrolled", "approved": "approved", "evaluations": "evaluations",
           "without_eval": "without_eval"},
)
GBT_PARAMS = {"max_iter": 300, "step_size": 0.1, "max_depth": 5, "min_instances": 20, "seed": 42}


def model_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_cohort(spark, sf_dir).withColumn("avg_price", F.coalesce("avg_price", F.lit(0.0)))


def cohort_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sp = cut_lineage(stratified_split(model_cohort(spark, sf_dir), "y", "id", 0.20, seed=42))
    return sp.filter(~F.col("is_test")).drop("is_test"), sp.filter("is_test").drop("is_test")


@register("ladder_metrics")
def q_ladder_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M0-M3 + M6: all four rungs fitted on the 80 % split and evaluated on
    the 20 % split in one grouped job (customer cohort)."""
    from caprank.operators.metrics import evaluate_ladder

    train, test = cohort_split(spark, sf_dir)
    wide, fitted = score_ladder(train, test, C_SPEC, gbt=GBT_PARAMS)
    return round_doubles(evaluate_ladder(wide, "y", "id", {m: f"score_{m}" for m in fitted}))


@register("logistic_scores")
def q_logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: logistic scores of the held-out customers with their top linear reason."""
    from caprank.operators.explain import linear_attributions, top_reasons

    train, test = cohort_split(spark, sf_dir)
    lr = LogisticScorer(C_SPEC).fit(train)
    scored = lr.score(test, "score")
    att = linear_attributions(lr, scored, train, ["id", "score"])
    return round_doubles(top_reasons(att, lr.feature_names, 1).select("id", "score", "reason_1", "reason_1_value"))


@register("gbt_ranked_reasons")
def q_gbt_ranked_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + R1 + E3/E4: boosted trees fitted on the 80 % split, the whole
    cohort ranked, top 10 % with three reasons each."""
    from caprank.operators.inference import rank_cohort

    train, _ = cohort_split(spark, sf_dir)
    gbt = GBTScorer(C_SPEC, **GBT_PARAMS).fit(train)
    return round_doubles(rank_cohort(gbt, model_cohort(spark, sf_dir), 0.10, "id", add_reasons=True))


@register("global_importance")
def q_global_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean |attribution| per model input on the held-out customers."""
    from caprank.operators.explain import global_importance, tree_attributions

    train, test = cohort_split(spark, sf_dir)
    gbt = GBTScorer(C_SPEC, **GBT_PARAMS).fit(train)
    att = tree_attributions(gbt, test, ["id"])
    return round_doubles(global_importance(att, gbt.feature_names))


@register("cv_precision")
def q_cv_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold stratified CV of P@10 % for the rule baseline and the
    boosted trees on the whole cohort."""
    from caprank.operators.crossval import cross_val_precision

    return round_doubles(cross_val_precision(model_cohort(spark, sf_dir), C_SPEC,
                                             ["passrate_baseline", "gbt"], 5, 0.10, gbt=GBT_PARAMS))


@register("ablation")
def q_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: CV with vs without c_acctbal (the leak the scan finds), per model."""
    from caprank.operators.crossval import ablation

    return round_doubles(ablation(model_cohort(spark, sf_dir), C_SPEC, "c_acctbal",
                                  ["passrate_baseline", "gbt"], 5, 0.10, gbt=GBT_PARAMS))


@register("train_test_gap")
def q_train_test_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: boosted-tree P@10 % on the training vs the held-out split."""
    from caprank.operators.crossval import train_test_gap

    train, test = cohort_split(spark, sf_dir)
    return round_doubles(train_test_gap(train, test, C_SPEC, "gbt", 0.10, gbt=GBT_PARAMS))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own on the shared storage of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("champion_resolution")
def q_champion_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 + G4 (+S15): gate the trees against the rule on the held-out split,
    save and register when promoted, then resolve the champion."""
    from caprank.operators.artifact import save_scorer
    from caprank.operators.gate import promotion_decision
    from caprank.operators.registry import alias_events, promote_if, resolution, versions

    root = fresh_folder(spark, "registry")
    train, test = cohort_split(spark, sf_dir)
    gbt = GBTScorer(C_SPEC, **GBT_PARAMS).fit(train)
    scored = gbt.score(test, "s_gbt").withColumn("s_rule", rule_score("approved", "enrolled"))
    sl = slice_table(scored, "y", "s_gbt", "id", ["c_mktsegment"], 0.10)
    dec = promotion_decision(scored, "y", "s_gbt", "s_rule", "id", sl, 0.10)
    path = save_scorer(spark, gbt, f"{root}/artifacts/gbt-1", train)
    promote_if(spark, root, dec, "cohort-ranker", path, run_id="run-1")
    return resolution(versions(spark, root), alias_events(spark, root), "cohort-ranker", "champion").select(
        "model_name", "version", "source")


@register("champion_rule_list")
def q_champion_rule_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S15 + G3 + G4 + R2 + S11 for the rule rung: its artifact is registered
    behind another rung's, the alias points to it, the champion ranks the cohort, and
    the written list is read back."""
    from caprank.operators.artifact import save_scorer
    from caprank.operators.registry import register_version, set_alias
    from caprank.operators.scorers import MajorityScorer, RuleScorer
    from caprank.plans.inference import inference_run

    root = fresh_folder(spark, "registry")
    cohort = model_cohort(spark, sf_dir)
    rungs = {"rule": RuleScorer(C_SPEC), "majority": MajorityScorer(C_SPEC).fit(cohort)}
    numbers = {m: register_version(spark, root, "cohort-ranker", save_scorer(spark, r, f"{root}/artifacts/{m}"), m)
               for m, r in rungs.items()}
    set_alias(spark, root, "cohort-ranker", "champion", numbers["majority"])
    set_alias(spark, root, "cohort-ranker", "champion", numbers["rule"])
    out = inference_run(spark, cohort, None, root, "cohort-ranker", f"{root}/list")
    return round_doubles(out.select(F.col("student_id").alias("id"), "risk_score", "rank", "reason_1"))


ORACLE["champion_rule_list"] = f"""
WITH {SQL_C}, r AS (SELECT id, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS s FROM cohort),
k AS (SELECT id, s, row_number() OVER (ORDER BY s DESC, id) AS rank, count(*) OVER () AS n FROM r)
SELECT id, round(s, 6) AS risk_score, CAST(rank AS BIGINT) AS rank, 'pass_rate' AS reason_1
FROM k WHERE rank <= greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT))
"""


# ---------------------------------------------------------------- features, ids, snapshots
from caprank.functions.features import row_max, safe_ratio, scaled_difference, zero_flag  # noqa: E402
from caprank.operators.columns import assign_row_id  # noqa: E402


@register(
    "cohort_features",
    f"""
WITH {SQL_C}
SELECT id,
       round({safe_ratio_sql('approved', 'enrolled')}, 6) AS sem1_pass_rate,
       round({safe_ratio_sql('evaluations', 'enrolled')}, 6) AS sem1_eval_rate,
       round({safe_ratio_sql('without_eval', 'enrolled')}, 6) AS sem1_unevaluated_ratio,
       CAST(enrolled = 0 AS INTEGER) AS zero_enrolled_flag,
       round(avg_price / 500000.0 - c_acctbal / 10000.0, 6) AS price_balance_delta,
       greatest(approved, without_eval) AS max_count
FROM cohort
""",
)
def q_cohort_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F0-F7 on the customer cohort: safe ratios with zero denominators, the
    zero flag, a scale-normalised difference and a null-skipping row max."""
    c = customer_cohort(spark, sf_dir)
    return round_doubles(c.select(
        "id",
        safe_ratio("approved", "enrolled").alias("sem1_pass_rate"),
        safe_ratio("evaluations", "enrolled").alias("sem1_eval_rate"),
        safe_ratio("without_eval", "enrolled").alias("sem1_unevaluated_ratio"),
        zero_flag("enrolled").alias("zero_enrolled_flag"),
        scaled_difference("avg_price", 500000.0, "c_acctbal", 10000.0).alias("price_balance_delta"),
        row_max("approved", "without_eval").alias("max_count"),
    ))


@register(
    "row_ids",
    """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_distinct_ids,
       CAST(0 AS BIGINT) AS min_id, CAST(count(*) - 1 AS BIGINT) AS max_id
FROM lineitem
""",
)
def q_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: dense 0..n-1 ids for lineitem, which has no unique key."""
    li = assign_row_id(read_table(spark, sf_dir, "lineitem"), "row_id")
    return li.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.count_distinct("row_id").cast("long").alias("n_distinct_ids"),
                  F.min("row_id").cast("long").alias("min_id"), F.max("row_id").cast("long").alias("max_id"))


@register("snapshot_roundtrip")
def q_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S4 + S5 + S9: write the customer cohort as a CSV snapshot into the
    checkpoint folder, fingerprint what was written, read it back with an
    explicit schema and verify the fingerprint."""
    import uuid

    from caprank.session import ensure_checkpoint_dir
    from caprank.sources.fingerprint import assert_fingerprint, write_snapshot
    from caprank.sources.readers import read_csv

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    c = customer_cohort(spark, sf_dir)
    fp = write_snapshot(c, f"{root}/cohort", f"{root}/manifest", fmt="csv")
    back = read_csv(spark, f"{root}/cohort", c.schema, mode="FAILFAST")
    verified = assert_fingerprint(spark, back, f"{root}/manifest") == fp
    return spark.createDataFrame([(fp["n_rows"], fp["hash_sum"], fp["hash_xor"], verified)],
                                 "n_rows long, hash_sum string, hash_xor long, verified boolean")


@register(
    "snapshot_loaded",
    f"""
WITH {SQL_C}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(enrolled) AS BIGINT) AS enrolled, CAST(sum(approved) AS BIGINT) AS approved,
       CAST(0 AS BIGINT) AS outcome_columns FROM cohort
""",
)
def q_snapshot_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4-S6 + S9: write the customer cohort as a Parquet snapshot, load it
    through the checked loader without its outcome, and sum what came back."""
    import uuid

    from caprank.session import ensure_checkpoint_dir
    from caprank.sources.fingerprint import load_checked, write_snapshot

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    write_snapshot(customer_cohort(spark, sf_dir), f"{root}/cohort", f"{root}/manifest")
    back = load_checked(spark, f"{root}/cohort", f"{root}/manifest", drop_outcomes=("y",))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("enrolled").cast("long").alias("enrolled"),
                    F.sum("approved").cast("long").alias("approved"),
                    F.lit(int("y" in back.columns)).cast("long").alias("outcome_columns"))


# ---------------------------------------------------------------- fit-free rungs with oracles
def _cohort_split_sql() -> str:
    return f"""
{alloc_sql('cohort', 'y', 0.2)},
ranked AS (SELECT cohort.*, row_number() OVER (PARTITION BY y ORDER BY {h_sql(42)}, id) AS rn FROM cohort),
sp AS (SELECT r.*, r.rn <= a.ntest AS is_test FROM ranked r JOIN alloc a ON r.y = a.c)
"""


def _rung_sql(model: str, rung: int, score_expr: str) -> str:
    return f"""
SELECT {rung} AS rung, '{model}' AS model, CAST(max(k) AS BIGINT) AS k,
       round(sum(CASE WHEN rn2 <= k THEN y ELSE 0 END) / max(k), 6) AS precision_at_k,
       round(CASE WHEN sum(y) > 0 THEN sum(CASE WHEN rn2 <= k THEN y ELSE 0 END) / sum(y) ELSE 0.0 END, 6)
         AS recall_at_k,
       round(CASE WHEN sum(y) > 0 THEN (sum(CASE WHEN rn2 <= k THEN y ELSE 0 END) / max(k)) / (sum(y) / count(*))
             ELSE 0.0 END, 6) AS lift_at_k,
       round(avg(power(s - y, 2)), 6) AS brier, round(avg(y), 6) AS base_rate
FROM (SELECT y, s, row_number() OVER (ORDER BY s DESC, id) AS rn2,
             greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * count(*) OVER ()) AS BIGINT)) AS k
      FROM (SELECT id, y, {score_expr} AS s FROM sp WHERE is_test))
"""


@register(
    "baseline_ladder",
    f"WITH {SQL_C}, {_cohort_split_sql()}, tr AS (SELECT avg(y) AS rate FROM sp WHERE NOT is_test) "
    + _rung_sql("majority_baseline", 0, "(SELECT rate FROM tr)")
    + " UNION ALL "
    + _rung_sql("passrate_baseline", 1, f"1.0 - {safe_ratio_sql('approved', 'enrolled')}"),
)
def q_baseline_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M0 + M1 + M6: the two fit-free rungs fitted on the exact 80 % split of
    the customer cohort and evaluated on the 20 % split in one grouped job."""
    from caprank.operators.metrics import evaluate_ladder

    train, test = cohort_split(spark, sf_dir)
    wide, fitted = score_ladder(train, test, C_SPEC, rungs=("majority_baseline", "passrate_baseline"))
    return round_doubles(evaluate_ladder(wide, "y", "id", {m: f"score_{m}" for m in fitted}))


@register(
    "cv_rule_baseline",
    f"""
WITH {SQL_C},
f AS (SELECT id, y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS s,
             (row_number() OVER (PARTITION BY y ORDER BY {h_sql(42)}, id) - 1) % 5 AS fold FROM cohort),
r AS (SELECT fold, y, row_number() OVER (PARTITION BY fold ORDER BY s DESC, id) AS rn,
             greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * count(*) OVER (PARTITION BY fold)) AS BIGINT)) AS k FROM f),
p AS (SELECT fold, sum(CASE WHEN rn <= k THEN y ELSE 0 END) / max(k) AS p FROM r GROUP BY fold)
SELECT 'passrate_baseline' AS model, round(avg(p), 6) AS cv_precision_at_k_mean,
       round(stddev_pop(p), 6) AS cv_precision_at_k_std, CAST(count(*) AS BIGINT) AS n_folds FROM p
""",
)
def q_cv_rule_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 for the rule rung: 5 stratified folds (md5 order), P@10 % per
    held-out fold, mean and population std."""
    from caprank.operators.crossval import cross_val_precision

    cv = cross_val_precision(model_cohort(spark, sf_dir), C_SPEC, ["passrate_baseline"], 5, 0.10)
    return round_doubles(cv.select("model", "cv_precision_at_k_mean", "cv_precision_at_k_std",
                                   F.size("cv_folds").cast("long").alias("n_folds")))


def _split_precision_sql(flag: str) -> str:
    return f"""(SELECT sum(CASE WHEN rn2 <= k THEN y ELSE 0 END) / max(k)
      FROM (SELECT y, row_number() OVER (ORDER BY s DESC, id) AS rn2,
                   greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * count(*) OVER ()) AS BIGINT)) AS k
            FROM (SELECT id, y, 1.0 - {safe_ratio_sql('approved', 'enrolled')} AS s FROM sp WHERE {flag})))"""


@register(
    "rule_train_test_gap",
    f"""
WITH {SQL_C}, {_cohort_split_sql()},
g AS (SELECT {_split_precision_sql('NOT is_test')} AS a, {_split_precision_sql('is_test')} AS b)
SELECT 'passrate_baseline' AS model, round(a, 6) AS train_precision_at_k, round(b, 6) AS test_precision_at_k,
       round(a - b, 6) AS gap FROM g
""",
)
def q_rule_train_test_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11 for the rule rung on the exact 80/20 split of the customer cohort."""
    from caprank.operators.crossval import train_test_gap

    train, test = cohort_split(spark, sf_dir)
    return round_doubles(train_test_gap(train, test, C_SPEC, "passrate_baseline", 0.10))
