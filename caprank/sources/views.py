"""Scored views over the driver's parquet tables.

Each view is a lazily built DataFrame with an explicit unique id, a 0/1 label
and (where meaningful) a score, so the same operators that run on a student
cohort run on the driver tables:

* ``events_view``   E: id=event_id, y = event_type = 'error', score = value
* ``orders_view``   O: id=o_orderkey, y = o_orderstatus = 'F', score = o_totalprice
* ``customer_cohort`` C: per customer, counts over its '1-URGENT' orders
  (left join, so customers without such orders get zero denominators)
* ``documents_view`` D: documents joined to labels, y = 1 - quality

Only the columns a view needs are selected, so the parquet scans read just
those columns (``ReadSchema``) and filters are pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.sources.readers import read_table

# fixed values: the enrolment columns of the cohort view, in the cohort's names
URGENT_PRIORITY = "1-URGENT"
ACCTBAL_RISK_THRESHOLD = 3000.0


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        (F.col("event_type") == "error").cast("int").alias("y"),
        F.col("value").alias("score"),
    )


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
        F.year("o_orderdate").alias("order_year"),
        F.col("o_totalprice"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.col("o_totalprice").alias("score"),
    )


def customer_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with enrolment-style counts (the C view).

    Orders are pre-aggregated per customer before the join (map-side partial
    aggregation, one shuffle on ``o_custkey``), and the customer side is
    joined by key, so a hot customer only ever produces one aggregated row.
    """
    o = read_table(spark, sf_dir, "orders")
    urgent = (
        o.filter(F.col("o_orderpriority") == URGENT_PRIORITY)
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("enrolled"),
            F.count_if(F.col("o_orderstatus") == "F").alias("approved"),
            F.count_if(F.col("o_orderstatus").isin("F", "O")).alias("evaluations"),
            F.count_if(F.col("o_orderstatus") == "P").alias("without_eval"),
            F.avg("o_totalprice").alias("avg_price"),
        )
    )
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    j = c.join(urgent, c.c_custkey == urgent.o_custkey, "left")
    return j.select(
        F.col("c_custkey").alias("id"),
        F.coalesce("enrolled", F.lit(0)).cast("long").alias("enrolled"),
        F.coalesce("approved", F.lit(0)).cast("long").alias("approved"),
        F.coalesce("evaluations", F.lit(0)).cast("long").alias("evaluations"),
        F.coalesce("without_eval", F.lit(0)).cast("long").alias("without_eval"),
        F.col("avg_price"),
        F.col("c_acctbal"),
        F.col("c_mktsegment"),
        F.col("c_nationkey"),
        (F.col("c_acctbal") < ACCTBAL_RISK_THRESHOLD).cast("int").alias("y"),
    )


def documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label (inner join on doc_id)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "inner")
    return j.select(
        F.col("doc_id").alias("id"),
        F.col("n_chars"),
        F.col("lang"),
        F.col("source"),
        F.col("toxic"),
        (F.lit(1) - F.col("quality")).cast("int").alias("y"),
    )
