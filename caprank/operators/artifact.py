"""Champion artifacts of any rung.

An artifact is a folder: ``scorer.json`` says which rung it is, with its spec,
parameters, feature names and whatever the rung has learnt besides a Spark ML model
(the constant of the majority rung, the background means of the logistic rung), and
``model`` holds the fitted pipeline of the rungs that have one.  ``scorer.json`` is
published last, so a folder without it is not an artifact.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.operators.registry import _folder, publish
from caprank.operators.scorers import CohortSpec, build_scorer

FORMAT = 1


class ArtifactError(ValueError):
    pass


def save_scorer(spark: SparkSession, scorer, path: str, background: DataFrame | None = None) -> str:
    """Write a fitted scorer.  ``background``: the training rows; their feature means
    are kept, so that a linear scorer can give reasons later."""
    body = {"format": FORMAT, "kind": scorer.name, "spec": asdict(scorer.spec),
            "feature_names": list(getattr(scorer, "feature_names", [])),
            "categorical_slots": list(getattr(scorer, "categorical_slots", []))}
    if getattr(scorer, "rate", None) is not None:
        body["rate"] = scorer.rate
    if getattr(scorer, "model", None) is not None:
        scorer.model.write().overwrite().save(f"{path}/model")
        body["model"] = "model"
    if scorer.name == "logistic" and background is not None:
        from caprank.operators.explain import feature_means

        body["background"] = feature_means(scorer, background)
    if not publish(spark, f"{path}/scorer.json", json.dumps(body, sort_keys=True) + "\n"):
        raise ArtifactError(f"{path} holds an artifact already")
    return path


def load_scorer(spark: SparkSession, path: str):
    """The fitted scorer of an artifact, ready to score."""
    fs, file = _folder(spark, f"{path}/scorer.json")
    if not fs.exists(file):
        raise ArtifactError(f"no artifact in {path}")
    body = json.loads("".join(r[0] for r in spark.read.text(f"{path}/scorer.json").collect()))
    if body["format"] != FORMAT:
        raise ArtifactError(f"{path} has format {body['format']}")
    scorer = build_scorer(body["kind"], CohortSpec(**body["spec"]))
    if "rate" in body:
        scorer.rate = body["rate"]
    if "model" in body:
        scorer.model = PipelineModel.load(f"{path}/{body['model']}")
    scorer.feature_names = body["feature_names"]
    if body["categorical_slots"] or body["kind"] == "gbt":
        scorer.categorical_slots = body["categorical_slots"]
    scorer.background = body.get("background")
    return scorer


def attributions(scorer, df: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """(``keep`` columns with base_value and attributions, feature names) for a
    scorer of any rung: exact tree values, closed form for the linear rung, and the
    one input of the rule; a constant has none."""
    from caprank.operators.explain import linear_attributions, tree_attributions

    if hasattr(scorer, "categorical_slots"):
        return tree_attributions(scorer, df, keep), scorer.feature_names
    if scorer.name == "logistic":
        if not getattr(scorer, "background", None):
            raise ValueError("reasons of a linear scorer need the means of its training rows")
        return linear_attributions(scorer, df, scorer.background, keep), scorer.feature_names
    if scorer.name == "passrate_baseline":
        # the rule has one input: all of its score is due to it
        own = scorer.score(df, "_rule")
        return own.select(*keep, F.lit(0.0).alias("base_value"), F.array("_rule").alias("attributions")), ["pass_rate"]
    raise ValueError(f"the rung {scorer.name!r} has no reasons to give")
