from pyspark.sql import functions as F

from caprank import catalog as C
from caprank.operators.encode import CappedOneHotEncoder, PopulationScaler, capped_categories
from fixtures import model_frame


def test_capped_width_and_bucket(spark):
    df = model_frame(spark, 300)
    enc = CappedOneHotEncoder.create(list(C.CATEGORICAL_COLUMNS), 11).fit(df)
    names = enc.output_names()
    assert len(names) < 200
    spec = enc._spec()
    for c in C.CATEGORICAL_COLUMNS:
        card = df.select(F.countDistinct(F.col(f"`{c}`"))).first()[0]
        width = len(spec["kept"][c]) + int(spec["bucket"][c])
        assert width == (min(card, 10) + 1 if card > 11 else card)


def test_unseen_code_goes_to_bucket(spark):
    df = model_frame(spark, 300)
    enc = CappedOneHotEncoder.create(["Course", "Gender"], 11).fit(df)
    new = df.limit(1).withColumns({"Course": F.lit(999), "Gender": F.lit(7)})
    row = enc.transform(new).first()
    assert row["Course=infrequent"] == 1.0
    assert all(row[n] == 0.0 for n in enc.output_names() if n.startswith("Gender="))  # no bucket: all zero


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double").withColumn("k", F.lit(5.0))
    m = PopulationScaler.create(["x", "k"]).fit(df)
    out = m.transform(df).agg(F.avg("x__z"), F.stddev_pop("x__z"), F.max(F.abs("k__z"))).first()
    assert abs(out[0]) < 1e-12 and abs(out[1] - 1.0) < 1e-12 and out[2] == 0.0


def test_capped_table_sums(spark):
    df = model_frame(spark, 300)
    t = capped_categories(df, ["Mother's occupation"], 11)
    assert t.agg(F.sum("n_rows")).first()[0] == 300
    assert t.filter("is_infrequent").count() == 1
