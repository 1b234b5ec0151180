"""Fit/transform preprocessing stages (X1-X5) as Spark ML stages.

All stages are ``pyspark.ml`` Estimators / Transformers with JSON-string
params, so a whole fitted chain is one ``PipelineModel`` that saves and loads
(train/serve parity is structural).  Fitting touches the data once per
stage with a single aggregate; transforming is pure column expressions.

* :class:`FeatureEngineer` - the engineered features as a stage (by role).
* :class:`CappedOneHotEncoder` - top ``max_categories - 1`` codes by training
  frequency plus an infrequent bucket, the bucket only when a column has more
  than ``max_categories`` codes; unseen codes go to the bucket, or to the
  all-zero vector when there is none.  Ties: count DESC, code DESC.
* :class:`PopulationScaler` - ``(x - mean) / std_pop`` (std 0 -> divide by 1).
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def _c(name: str):
    return F.col(f"`{name}`")


class _JsonParams(Params):
    spec = Param(Params._dummy(), "spec", "JSON state of the stage", typeConverter=TypeConverters.toString)

    def _spec(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))


class FeatureEngineer(Transformer, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """X5/F7 as a pipeline stage: ``spec`` maps input roles (enrolled,
    approved, evaluations, without_eval, sem1_grade, admission_grade,
    mother_qual, father_qual) to column names; features whose inputs are not
    named are skipped, so the same stage serves any cohort table."""

    @keyword_only
    def __init__(self, spec: str = "{}"):
        super().__init__()
        self._setDefault(spec="{}")
        self._set(spec=spec)

    def _transform(self, df: DataFrame) -> DataFrame:
        from caprank.functions.features import row_max, safe_ratio, scaled_difference, zero_flag

        r = self._spec()
        out = {}
        if r.get("enrolled"):
            if r.get("approved"):
                out["sem1_pass_rate"] = safe_ratio(r["approved"], r["enrolled"])
            if r.get("evaluations"):
                out["sem1_eval_rate"] = safe_ratio(r["evaluations"], r["enrolled"])
            if r.get("without_eval"):
                out["sem1_unevaluated_ratio"] = safe_ratio(r["without_eval"], r["enrolled"])
            out["zero_enrolled_flag"] = zero_flag(r["enrolled"])
        if r.get("sem1_grade") and r.get("admission_grade"):
            out["grade_delta"] = scaled_difference(r["sem1_grade"], 20.0, r["admission_grade"], 200.0)
        if r.get("mother_qual") and r.get("father_qual"):
            out["parents_max_qualification"] = row_max(r["mother_qual"], r["father_qual"])
        return df.withColumns(out)


class CappedOneHotModel(Model, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, spec: str = "{}"):
        super().__init__()
        self._setDefault(spec="{}")
        self._set(spec=spec)

    def output_names(self) -> list[str]:
        s = self._spec()
        names = []
        for col in s["columns"]:
            kept = s["kept"][col]
            names += [f"{col}={v}" for v in kept]
            if s["bucket"][col]:
                names.append(f"{col}=infrequent")
        return names

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self._spec()
        out = {}
        for col in s["columns"]:
            code = _c(col).cast("string")
            kept = s["kept"][col]
            for v in kept:
                out[f"{col}={v}"] = F.coalesce((code == F.lit(v)).cast("double"), F.lit(0.0))
            if s["bucket"][col]:
                out[f"{col}=infrequent"] = F.coalesce((~code.isin(*kept)).cast("double"), F.lit(1.0))
        return df.withColumns(out)


class CappedOneHotEncoder(Estimator, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, spec: str = "{}"):
        super().__init__()
        self._setDefault(spec="{}")
        self._set(spec=spec)

    @staticmethod
    def create(columns: list[str], max_categories: int = 11) -> CappedOneHotEncoder:
        return CappedOneHotEncoder(spec=json.dumps({"columns": columns, "max_categories": max_categories}))

    def frequency_table(self, df: DataFrame) -> DataFrame:
        """``(column, code, n, rk, card, total)`` of the most frequent codes of each
        column (count DESC, code DESC), as many as an encoder can keep.  The
        counts are one grouped aggregate over the unpivoted categoricals; the
        rank is taken inside hash parts of a column first, so no task sees all
        codes of a column, and then among the leaders of its parts."""
        s = self._spec()
        cap = int(s.get("max_categories", 11))
        arr = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("code"))
                        for c in s["columns"]])
        counts = df.select(F.explode(arr).alias("r")).select("r.*").groupBy("column", "code").agg(
            F.count(F.lit(1)).alias("n"))
        counts = counts.withColumn("_part", F.pmod(F.xxhash64("code"), F.lit(64)))
        order = F.desc("n"), F.desc("code")
        lead = counts.withColumn("_rk", F.row_number().over(Window.partitionBy("column", "_part").orderBy(*order)))
        lead = lead.filter(F.col("_rk") <= cap).withColumn("rk", F.row_number().over(Window.partitionBy("column").orderBy(*order)))
        card = counts.groupBy("column").agg(F.count(F.lit(1)).alias("card"), F.sum("n").alias("total"))  # one row per column
        return (lead.filter(F.col("rk") <= cap).drop("_part", "_rk").join(F.broadcast(card), "column")
                .select("column", "code", "n", "rk", "card", "total"))

    def _fit(self, df: DataFrame) -> CappedOneHotModel:
        s = self._spec()
        cap = int(s.get("max_categories", 11))
        rows = self.frequency_table(df).filter(
            (F.col("card") <= cap) | (F.col("rk") <= cap - 1)).select("column", "code", "card").collect()
        kept: dict[str, list[str]] = {c: [] for c in s["columns"]}
        bucket: dict[str, bool] = {c: False for c in s["columns"]}
        for r in rows:
            if r["code"] is not None:
                kept[r["column"]].append(r["code"])
            bucket[r["column"]] = r["card"] > cap
        for c in kept:
            kept[c].sort(key=lambda v: (len(v), v) if v.lstrip("-").isdigit() else (10**9, v))
        return CappedOneHotModel(spec=json.dumps({"columns": s["columns"], "kept": kept, "bucket": bucket}))


class PopulationScalerModel(Model, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, spec: str = "{}"):
        super().__init__()
        self._setDefault(spec="{}")
        self._set(spec=spec)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self._spec()
        out = {}
        for c in s["columns"]:
            mean, std = s["mean"][c], s["std"][c]
            div = std if std and std > 0 else 1.0
            out[f"{c}__z"] = (_c(c).cast("double") - F.lit(float(mean or 0.0))) / F.lit(float(div))
        return df.withColumns(out)


class PopulationScaler(Estimator, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the *population* std in one aggregate."""

    @keyword_only
    def __init__(self, spec: str = "{}"):
        super().__init__()
        self._setDefault(spec="{}")
        self._set(spec=spec)

    @staticmethod
    def create(columns: list[str]) -> PopulationScaler:
        return PopulationScaler(spec=json.dumps({"columns": columns}))

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self._spec()["columns"]
        aggs = []
        for i, c in enumerate(cols):
            aggs += [F.avg(_c(c).cast("double")).alias(f"m{i}"), F.stddev_pop(_c(c).cast("double")).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        spec = {"columns": cols,
                "mean": {c: row[f"m{i}"] for i, c in enumerate(cols)},
                "std": {c: row[f"s{i}"] for i, c in enumerate(cols)}}
        return PopulationScalerModel(spec=json.dumps(spec))


def capped_categories(df: DataFrame, columns: list[str], max_categories: int = 11) -> DataFrame:
    """X2 as a table: per column the kept codes (``bucket = false``) and,
    when the column needs it, the infrequent bucket row."""
    enc = CappedOneHotEncoder.create(columns, max_categories)
    ft = enc.frequency_table(df)
    kept = ft.filter((F.col("card") <= max_categories) | (F.col("rk") <= max_categories - 1)).select(
        "column", "code", F.col("n").cast("long").alias("n_rows"), F.lit(False).alias("is_infrequent"))
    other = ft.filter((F.col("card") > max_categories) & (F.col("rk") <= max_categories - 1)).groupBy(
        "column").agg((F.first("total") - F.sum("n")).cast("long").alias("n_rows")).select(
        "column", F.lit("infrequent").alias("code"), "n_rows", F.lit(True).alias("is_infrequent"))
    return kept.unionByName(other)


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """M5: balanced weights ``n / (n_classes * n_class)`` per label."""
    g = df.groupBy(_c(y).alias("label")).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()
    return g.select(
        "label", F.col("n_class").cast("long").alias("n_class"),
        (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"),
    )
