import tempfile

from pyspark.sql import functions as F

from caprank.operators.registry import alias_events, resolve_champion, set_alias, versions
from caprank.plans.inference import inference_run
from caprank.plans.training import TrainingConfig, training_run
from caprank.streaming.arrivals import watch_cohorts
from fixtures import cohort_spec, model_frame


def test_train_promote_then_rank(spark):
    root = tempfile.mkdtemp(prefix="caprank-reg-")
    df = model_frame(spark, 1000, seed=31, planted=True)
    cfg = TrainingConfig(spec=cohort_spec(), registry_root=root, n_bootstrap=100, cv_folds=3,
                         slice_columns=["Gender", "Debtor"], require_ci_excludes_zero=False,
                         slice_tolerance=1.0, model_params={"gbt": {"max_iter": 30}}, run_cv=True)
    out = training_run(spark, df, cfg)
    assert out["metrics"].count() == 4 and out["cv"].count() == 2
    dec = out["decision"].first()
    if dec["promote"]:
        v, path = resolve_champion(spark, root, cfg.model_name)
        assert v == out["version"]
        ranked = inference_run(spark, df.drop("dropout"), cfg.spec, root, cfg.model_name, f"{root}/list")
        assert ranked.count() == 100
        # rollback is one more alias event; fallback to newest without alias
        set_alias(spark, root, cfg.model_name, "champion", v)
        assert alias_events(spark, root).count() == 2
    assert spark.read.parquet(f"{root}/run_metrics").count() > 0
    assert versions(spark, root).count() == (1 if dec["promote"] else 0)


def test_resolution_fallbacks(spark):
    import datetime as dt

    from caprank.operators.registry import NoModelError, register_version

    root = tempfile.mkdtemp(prefix="caprank-reg-")
    try:
        resolve_champion(spark, root, "m")
        raise AssertionError("expected NoModelError")
    except NoModelError:
        pass
    register_version(spark, root, "m", "/a", "r1")
    register_version(spark, root, "m", "/b", "r2")
    assert resolve_champion(spark, root, "m") == (2, "/b")  # newest
    set_alias(spark, root, "m", "champion", 2, dt.datetime(2024, 1, 1))
    set_alias(spark, root, "m", "champion", 1, dt.datetime(2024, 2, 1))  # rollback
    assert resolve_champion(spark, root, "m") == (1, "/a")


def test_stream_hands_batches_to_plan(spark):
    land = tempfile.mkdtemp(prefix="caprank-land-")
    df = model_frame(spark, 200, seed=2)
    df.filter("id < 100").write.mode("append").parquet(land)
    df.filter("id >= 100").write.mode("append").parquet(land)
    seen = []
    q = watch_cohorts(spark, land, df.schema, lambda b, i: seen.append(b.count()), name=f"t{len(land)}")
    q.awaitTermination(120)
    assert sum(seen) == 200
    assert F is not None
