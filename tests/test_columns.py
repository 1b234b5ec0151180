from pyspark.sql import functions as F

from caprank.operators.columns import (
    align_common,
    assign_row_id,
    constant_out,
    drop_outcomes,
    drop_prefix,
    members,
    select_model_inputs,
)


def test_column_algebra(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 1, 0)], "x int, `Curricular units 2nd sem (x)` double, c string, "
                                                        "dropout int, Target int")
    assert drop_prefix(df, "Curricular units 2nd sem").columns == ["x", "c", "dropout", "Target"]
    assert drop_outcomes(df).columns == ["x", "Curricular units 2nd sem (x)", "c"]
    ref, cur = align_common(df.select("c", "x", "dropout"), df.select("x", "c"))
    assert ref.columns == ["c", "x"] and cur.columns == ["c", "x"]
    assert select_model_inputs(df, ["c"], ["x"]).columns == ["c", "x"]
    out = constant_out(df, "x", 0)
    assert out.first()["x"] == 0 and dict(out.dtypes)["x"] == "int"
    assert members(df, "c", "a").count() == 1 and members(df, "c", "b").count() == 0


def test_row_ids_dense_and_stable(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).repartition(5)
    ids = assign_row_id(df, "row_id")
    got = sorted(r["row_id"] for r in ids.collect())
    assert got == list(range(1000))
    # recomputation gives the same ids (partitions are fixed by the checkpoint)
    a = {tuple(r) for r in ids.select("row_id", "k").collect()}
    b = {tuple(r) for r in ids.select("row_id", "k").collect()}
    assert a == b
    keyed = assign_row_id(spark.range(3).withColumnRenamed("id", "key"), "row_id", key="key")
    assert [r["row_id"] for r in keyed.orderBy("key").collect()] == [0, 1, 2]
