"""Per-row attributions, global importance and reasons.

Tree ensembles (E4): exact *path-dependent* Shapley values (the TreeSHAP
value function of Lundberg et al., 2020).  For one tree the value of a
coalition S is ``sum_leaves v_leaf * prod_{d on path} (d in S ? o_d : z_d)``
with ``o_d`` = 1 when the row follows the leaf's path at every split on
feature d, and ``z_d`` the product of cover ratios of those splits.  Each
leaf term is a product game, whose Shapley value for feature i is
``v * (o_i - z_i) * T_i[pattern of o over the other path features]`` where
the table ``T_i`` (at most 2^(depth-1) entries) depends only on the tree.
So a batch of rows is explained with a few numpy gathers per (leaf,
feature) - no per-row recursion.

The trees are read from the saved model's node table (a tiny parquet read:
nodes, not data), shipped to executors once as a broadcast, and the work
runs in ``mapInPandas`` over the rows to explain.  Callers explain only
the k selected rows ("limit before explain").  Values are in log-odds
(twice the boosting margin).  Linear models use the closed form
``beta_j * (x_j - mean_j)`` as plain column expressions.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caprank.session import ensure_checkpoint_dir, ship_package


# ------------------------------------------------------------ tree reading
def read_trees(spark: SparkSession, gbt_model) -> list[dict]:
    """Node arrays of every tree: feature, threshold/categories, children,
    prediction, cover (rawCount).  Saved under the checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/gbt-{uuid.uuid4().hex}"
    gbt_model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
        "nodeData.split.numCategories",
    ).collect()
    weights = list(gbt_model.treeWeights)
    trees: dict[int, dict] = {}
    for r in rows:
        t = trees.setdefault(r["treeID"], {"nodes": {}, "weight": weights[r["treeID"]]})
        t["nodes"][r["id"]] = {
            "pred": float(r["prediction"]), "cover": float(r["rawCount"]),
            "left": int(r["leftChild"]), "right": int(r["rightChild"]),
            "feature": int(r["featureIndex"]),
            "split": list(r["leftCategoriesOrThreshold"] or []), "ncat": int(r["numCategories"]),
        }
    return [_compile_tree(trees[i]) for i in sorted(trees)]


def _compile_tree(tree: dict) -> dict:
    nodes = tree["nodes"]
    root = min(nodes)  # the root has the smallest id in the saved layout
    leaves = []

    def walk(nid: int, path: list[tuple[int, bool]]):
        nd = nodes[nid]
        if nd["left"] < 0:
            leaves.append((nid, list(path)))
            return
        walk(nd["left"], path + [(nid, True)])
        walk(nd["right"], path + [(nid, False)])

    walk(root, [])
    total = nodes[root]["cover"]
    expected = sum(nodes[lf]["pred"] * nodes[lf]["cover"] for lf, _ in leaves) / total
    compiled_leaves = []
    for lf, path in leaves:
        feats: dict[int, dict] = {}
        for nid, left in path:
            nd = nodes[nid]
            child = nd["left"] if left else nd["right"]
            f = feats.setdefault(nd["feature"], {"splits": [], "z": 1.0})
            f["splits"].append((nid, left))
            f["z"] *= nodes[child]["cover"] / nd["cover"]
        order = sorted(feats)
        m = len(order)
        tables = {}
        for i in order:
            others = [d for d in order if d != i]
            tables[i] = _product_game_table(others, [feats[d]["z"] for d in others], m)
        compiled_leaves.append({
            "value": nodes[lf]["pred"], "features": order,
            "splits": {d: feats[d]["splits"] for d in order},
            "z": {d: feats[d]["z"] for d in order}, "tables": tables,
        })
    internal = {nid: (nd["feature"], nd["split"], nd["ncat"]) for nid, nd in nodes.items() if nd["left"] >= 0}
    return {"weight": tree["weight"], "expected": expected, "leaves": compiled_leaves, "internal": internal}


def _product_game_table(others: list[int], z: list[float], m: int) -> np.ndarray:
    """``T[A] = sum_{S subset A} |S|!(m-|S|-1)!/m! * prod_{d in others \\ S} z_d``
    for every subset A of ``others`` encoded as a bit pattern."""
    q = len(others)
    table = np.zeros(1 << q)
    for a in range(1 << q):
        members = [j for j in range(q) if a >> j & 1]
        acc = 0.0
        for s in range(len(members) + 1):
            wgt = math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m)
            for sub in combinations(members, s):
                prod = 1.0
                for j in range(q):
                    if j not in sub:
                        prod *= z[j]
                acc += wgt * prod
        table[a] = acc
    return table


def tree_shap(trees: list[dict], X: np.ndarray) -> tuple[np.ndarray, float]:
    """Exact path-dependent Shapley values (margin units) and base value."""
    n, p = X.shape
    phi = np.zeros((n, p))
    base = 0.0
    for t in trees:
        w = t["weight"]
        base += w * t["expected"]
        go_left = {}
        for nid, (f, split, ncat) in t["internal"].items():
            x = X[:, f]
            go_left[nid] = x <= split[0] if ncat < 0 else np.isin(x, np.asarray(split, dtype=float))
        for leaf in t["leaves"]:
            feats = leaf["features"]
            if not feats:
                continue
            o = {}
            for d in feats:
                ok = np.ones(n, dtype=bool)
                for nid, left in leaf["splits"][d]:
                    ok &= go_left[nid] if left else ~go_left[nid]
                o[d] = ok
            v = w * leaf["value"]
            for i in feats:
                code = np.zeros(n, dtype=np.int64)
                for j, d in enumerate(d for d in feats if d != i):
                    code |= o[d].astype(np.int64) << j
                phi[:, i] += v * (o[i].astype(float) - leaf["z"][i]) * leaf["tables"][i][code]
    return phi, base


def margin(trees: list[dict], X: np.ndarray) -> np.ndarray:
    """Boosting margin rebuilt from the node table (cross-check)."""
    out = np.zeros(X.shape[0])
    for t in trees:
        go_left = {}
        for nid, (f, split, ncat) in t["internal"].items():
            x = X[:, f]
            go_left[nid] = x <= split[0] if ncat < 0 else np.isin(x, np.asarray(split, dtype=float))
        for leaf in t["leaves"]:
            mask = np.ones(X.shape[0], dtype=bool)
            for d, splits in leaf["splits"].items():
                for nid, left in splits:
                    mask &= go_left[nid] if left else ~go_left[nid]
            out[mask] += t["weight"] * leaf["value"]
    return out


# ------------------------------------------------------------ Spark side
def model_matrix(scorer, df: DataFrame) -> DataFrame:
    """The matrix the classifier sees (all stages but the last)."""
    from pyspark.ml import PipelineModel

    pre = PipelineModel(stages=scorer.model.stages[:-1])
    return pre.transform(df).withColumn("_x", vector_to_array(F.col("features")))


def tree_attributions(
    scorer, df: DataFrame, keep: Sequence[str], out: str = "attributions"
) -> DataFrame:
    """``keep`` columns + ``base_value`` + ``attributions`` (log-odds),
    one array slot per model input (names in ``scorer.feature_names``)."""
    spark = df.sparkSession
    ship_package(spark)
    trees = read_trees(spark, scorer.model.stages[-1])
    bc = spark.sparkContext.broadcast(trees)
    mat = model_matrix(scorer, df).select(*keep, "_x")
    schema = T.StructType(
        [f for f in mat.schema.fields if f.name in keep]
        + [T.StructField("base_value", T.DoubleType()), T.StructField(out, T.ArrayType(T.DoubleType()))]
    )

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tr = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            X = np.vstack(pdf["_x"].to_numpy()).astype(float)
            phi, base = tree_shap(tr, X)
            res = pdf[list(keep)].copy()
            res["base_value"] = 2.0 * base
            res[out] = list(2.0 * phi)
            yield res

    return mat.mapInPandas(explain, schema)


def feature_means(scorer, background: DataFrame) -> list[float]:
    """Mean of each model input over some rows (one Summarizer pass)."""
    mat = model_matrix(scorer, background)
    return [float(x) for x in mat.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()]


def linear_attributions(scorer, df: DataFrame, background: DataFrame | Sequence[float], keep: Sequence[str],
                        out: str = "attributions") -> DataFrame:
    """Closed form for the logistic rung: ``beta_j * (x_j - mean_j)`` with
    means over ``background`` (rows, or their means); pure column math."""
    lr = scorer.model.stages[-1]
    beta = [float(b) for b in lr.coefficients.toArray()]
    mean = feature_means(scorer, background) if isinstance(background, DataFrame) else background
    mat = model_matrix(scorer, df)
    b = F.array(*[F.lit(x) for x in beta])
    mu = F.array(*[F.lit(float(x)) for x in mean])
    att = F.transform(F.arrays_zip(F.col("_x").alias("x"), b.alias("b"), mu.alias("m")),
                      lambda s: s["b"] * (s["x"] - s["m"]))
    base = float(lr.intercept) + sum(bj * mj for bj, mj in zip(beta, mean))
    return mat.select(*keep, F.lit(base).alias("base_value"), att.alias(out))


def global_importance(attr: DataFrame, names: Sequence[str], col: str = "attributions") -> DataFrame:
    """Mean |attribution| per feature, descending.  Summed as one
    vector aggregate (no row-per-feature blow-up)."""
    from pyspark.ml.functions import array_to_vector

    m = attr.select(array_to_vector(F.transform(col, lambda v: F.abs(v))).alias("v")).select(
        Summarizer.mean(F.col("v")).alias("m")).first()["m"].toArray()
    spark = attr.sparkSession
    pdf = pd.DataFrame({"feature": list(names), "mean_abs_attribution": [float(x) for x in m]})
    return spark.createDataFrame(pdf).orderBy(F.desc("mean_abs_attribution"), F.asc("feature"))


def top_reasons(attr: DataFrame, names: Sequence[str], top_n: int = 3, col: str = "attributions") -> DataFrame:
    """The ``top_n`` most positive attributions per row (signed), ties by
    feature position; adds reason_i / reason_i_value columns."""
    nm = F.array(*[F.lit(n) for n in names])
    pos = F.sequence(F.lit(0), F.size(col) - 1)
    z = F.arrays_zip(F.col(col).alias("v"), pos.alias("i"), nm.alias("n"))
    srt = F.array_sort(z, lambda a, b: F.when(a["v"] > b["v"], -1).when(a["v"] < b["v"], 1)
                       .otherwise(F.when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).otherwise(0)))
    top = F.slice(srt, 1, top_n)
    out = attr.withColumn("_top", top)
    for j in range(top_n):
        out = out.withColumn(f"reason_{j + 1}", F.col("_top")[j]["n"]).withColumn(
            f"reason_{j + 1}_value", F.col("_top")[j]["v"])
    return out.drop("_top")
