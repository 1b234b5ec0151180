"""The scorer ladder (M0-M3, M5, M6): higher score = riskier.

Every rung exposes ``fit(df) -> self`` and ``score(df, out) -> DataFrame``.
Fitted rungs that learn anything are one ``PipelineModel`` (feature
engineering + encoding + classifier), so saving and loading the model keeps
train/serve parity.  Scoring is a projection: ``vector_to_array(probability)[1]``.

* M0 majority: constant ``avg(y)`` of the training rows.
* M1 rule: ``1 - approved / enrolled`` (no fitting).
* M2 logistic regression on capped one-hot + population-standardised
  numerics; ``regParam = 1 / (C * n)`` gives the same optimum as an
  inverse-strength ``C`` on the summed log-loss.
* M3 gradient-boosted trees on indexed categoricals (nominal metadata, so
  splits are categorical) + raw numerics; early stopping on a hashed 10 %
  validation indicator.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caprank.functions.features import rule_score
from caprank.operators.encode import CappedOneHotEncoder, FeatureEngineer, PopulationScaler, class_weights
from caprank.operators.split import hash_order
from caprank.session import pinned

ENGINEERED_BY_ROLE = {
    "sem1_pass_rate": ("enrolled", "approved"),
    "sem1_eval_rate": ("enrolled", "evaluations"),
    "sem1_unevaluated_ratio": ("enrolled", "without_eval"),
    "zero_enrolled_flag": ("enrolled",),
    "grade_delta": ("sem1_grade", "admission_grade"),
    "parents_max_qualification": ("mother_qual", "father_qual"),
}


@dataclass
class CohortSpec:
    """Column roles of a cohort table."""

    id: str
    label: str
    categorical: list[str]
    numeric: list[str]
    roles: dict[str, str] = field(default_factory=dict)
    use_engineered: bool = True

    def engineered(self) -> list[str]:
        if not self.use_engineered:
            return []
        return [f for f, need in ENGINEERED_BY_ROLE.items() if all(self.roles.get(r) for r in need)]

    def engineer(self) -> FeatureEngineer:
        import json

        return FeatureEngineer(spec=json.dumps(self.roles if self.use_engineered else {}))

    def numeric_inputs(self) -> list[str]:
        return list(self.numeric) + self.engineered()


#: Training rows of one task.  A fit runs thousands of short jobs over the same rows,
#: so their partitions follow the rows, not the shuffles the rows come from.
FIT_ROWS = 50_000


def for_fitting(df: DataFrame, rid: str) -> DataFrame:
    """The rows dealt out and sorted by id, ``FIT_ROWS`` a task: the same rows in the
    same places whatever partitions they come in, so that fits agree."""
    return df.repartition(max(1, math.ceil(df.count() / FIT_ROWS)), rid).sortWithinPartitions(rid)


def _prob1(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col("probability"))[1])


class MajorityScorer:
    name = "majority_baseline"

    def __init__(self, spec: CohortSpec):
        self.spec = spec
        self.rate = None

    def fit(self, df: DataFrame) -> MajorityScorer:
        self.rate = float(df.agg(F.avg(F.col(self.spec.label).cast("double"))).first()[0])
        return self

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return df.withColumn(out, F.lit(self.rate))


class RuleScorer:
    name = "passrate_baseline"

    def __init__(self, spec: CohortSpec):
        self.spec = spec

    def fit(self, df: DataFrame) -> RuleScorer:
        return self

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        r = self.spec.roles
        return df.withColumn(out, rule_score(r["approved"], r["enrolled"]))


def _weighted(df: DataFrame, label: str, class_weight: str | None) -> tuple[DataFrame, str | None]:
    if class_weight != "balanced":
        return df, None
    from caprank.session import broadcast_if_small

    w = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias("_cw"))
    return df.join(broadcast_if_small(w), label), "_cw"


class LogisticScorer:
    name = "logistic"

    def __init__(self, spec: CohortSpec, C: float = 1.0, max_iter: int = 2000,
                 class_weight: str | None = None, max_categories: int = 11):
        self.spec, self.C, self.max_iter = spec, C, max_iter
        self.class_weight, self.max_categories = class_weight, max_categories
        self.model: PipelineModel | None = None
        self.feature_names: list[str] = []

    def fit(self, df: DataFrame) -> LogisticScorer:
        with pinned(for_fitting(df, self.spec.id)) as rows:
            return self._fit(rows)

    def _fit(self, df: DataFrame) -> LogisticScorer:
        s = self.spec
        pre = Pipeline(stages=[
            s.engineer(),
            CappedOneHotEncoder.create(s.categorical, self.max_categories),
            PopulationScaler.create(s.numeric_inputs()),
        ]).fit(df)
        onehot = pre.stages[1].output_names()
        z = [f"{c}__z" for c in s.numeric_inputs()]
        self.feature_names = onehot + s.numeric_inputs()
        assembler = VectorAssembler(inputCols=onehot + z, outputCol="features", handleInvalid="keep")
        train = assembler.transform(pre.transform(df))
        train, wcol = _weighted(train, s.label, self.class_weight)
        n = train.count()
        lr = LogisticRegression(featuresCol="features", labelCol=s.label, maxIter=self.max_iter,
                                regParam=1.0 / (self.C * n), elasticNetParam=0.0, standardization=False)
        if wcol:
            lr.setWeightCol(wcol)
        lr_model = lr.fit(train.withColumn(s.label, F.col(s.label).cast("double")))
        self.model = PipelineModel(stages=list(pre.stages) + [assembler, lr_model])
        return self

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        t = self.model.transform(df)
        return _prob1(t, out).select(*df.columns, out)


class GBTScorer:
    name = "gbt"

    def __init__(self, spec: CohortSpec, max_iter: int = 300, step_size: float = 0.1, max_depth: int = 5,
                 min_instances: int = 20, seed: int = 42, early_stopping: bool = True,
                 class_weight: str | None = None):
        self.spec = spec
        self.params = dict(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth,
                           minInstancesPerNode=min_instances, seed=seed)
        self.early_stopping, self.class_weight, self.seed = early_stopping, class_weight, seed
        self.model: PipelineModel | None = None
        self.feature_names: list[str] = []
        self.categorical_slots: list[int] = []

    def fit(self, df: DataFrame) -> GBTScorer:
        with pinned(for_fitting(df, self.spec.id)) as rows:
            return self._fit(rows)

    def _fit(self, df: DataFrame) -> GBTScorer:
        s = self.spec
        idx = [f"{c}__idx" for c in s.categorical]
        pre = Pipeline(stages=[
            s.engineer(),
            StringIndexer(inputCols=s.categorical, outputCols=idx, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
        ]).fit(df)
        card = max([len(lbl) + 1 for lbl in pre.stages[1].labelsArray] + [2])
        self.feature_names = list(s.categorical) + s.numeric_inputs()
        self.categorical_slots = list(range(len(s.categorical)))
        assembler = VectorAssembler(inputCols=idx + s.numeric_inputs(), outputCol="features",
                                    handleInvalid="keep")
        train = assembler.transform(pre.transform(df)).withColumn(s.label, F.col(s.label).cast("double"))
        train, wcol = _weighted(train, s.label, self.class_weight)
        gbt = GBTClassifier(featuresCol="features", labelCol=s.label, maxBins=max(32, card),
                            featureSubsetStrategy="all", **self.params)
        if self.early_stopping:
            train = train.withColumn("_is_val", (hash_order(self.seed + 1, s.id) % 10) == 0)
            gbt.setValidationIndicatorCol("_is_val")
        if wcol:
            gbt.setWeightCol(wcol)
        self.model = PipelineModel(stages=list(pre.stages) + [assembler, gbt.fit(train)])
        return self

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        t = self.model.transform(df)
        return _prob1(t, out).select(*df.columns, out)


LADDER = ("majority_baseline", "passrate_baseline", "logistic", "gbt")


def build_scorer(name: str, spec: CohortSpec, **params):
    """Scorer by rung name (M6 factory)."""
    if name == "majority_baseline":
        return MajorityScorer(spec)
    if name == "passrate_baseline":
        return RuleScorer(spec)
    if name == "logistic":
        return LogisticScorer(spec, **params.get("logistic", {}))
    if name == "gbt":
        return GBTScorer(spec, **params.get("gbt", {}))
    raise ValueError(f"unknown scorer {name!r}")


def score_ladder(train: DataFrame, test: DataFrame, spec: CohortSpec, rungs=LADDER, parallel: bool = True,
                 **params):
    """M6: fit each rung on ``train`` and score ``test`` into ONE wide
    DataFrame with a ``score_<rung>`` column per rung (checkpointed, since every
    metric, slice and bootstrap job reads it).  The fits are independent jobs and
    are submitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    from caprank.session import cut_lineage

    def fit(name: str):
        return name, build_scorer(name, spec, **params).fit(train)

    if parallel:
        with ThreadPoolExecutor(max_workers=len(rungs)) as pool:
            fitted = dict(pool.map(fit, rungs))
    else:
        fitted = dict(fit(name) for name in rungs)
    wide = test
    for name in rungs:
        wide = fitted[name].score(wide, f"score_{name}")
    return cut_lineage(wide), {name: fitted[name] for name in rungs}
