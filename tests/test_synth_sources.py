import datetime as dt

import pytest
from pyspark.sql import functions as F

from relearn.operators import synth
from relearn.operators.ordered import global_rank
from relearn.sources import files, objectstore


def test_generator_shape_and_classes(spark):
    as_of = dt.datetime(2024, 2, 1)
    df = synth.generate_transactions(spark, 5000, 0.05, "42", as_of, num_partitions=4)
    assert df.columns == synth.COLUMNS
    r = df.agg(F.count("*").alias("n"), F.sum("fraud").alias("f"), F.countDistinct("transaction_id").alias("ids"),
               F.min("transaction_id").alias("lo"), F.max("transaction_id").alias("hi"),
               F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
               F.min("hour_of_day").alias("h0"), F.max("hour_of_day").alias("h1")).first()
    assert r.n == 5000 and r.f == 250 and r.ids == 5000
    assert r.lo == "tx_00000000" and r.hi == "tx_00004999"
    assert as_of - dt.timedelta(minutes=43199) <= r.t0 and r.t1 <= as_of - dt.timedelta(minutes=1)
    assert (r.h0, r.h1) == (0, 23)
    means = df.groupBy("fraud").agg(F.avg("used_chip").alias("chip"), F.avg("online_order").alias("on")).collect()
    m = {x.fraud: x for x in means}
    assert m[0].chip == pytest.approx(0.9, abs=0.03) and m[1].chip == pytest.approx(0.2, abs=0.08)


def test_generator_repeatable_across_partitioning(spark):
    as_of = dt.datetime(2024, 2, 1)
    a = synth.generate_transactions(spark, 2000, as_of=as_of, num_partitions=2)
    b = synth.generate_transactions(spark, 2000, as_of=as_of, num_partitions=7)
    assert a.exceptAll(b).count() == 0


def test_global_rank_matches_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 3000).withColumn("k", (F.col("id") * 7919) % 3001).withColumn("g", F.col("id") % 3)
    ours = global_rank(df, ["k"], "r", num_parts=5)
    ref = df.withColumn("r2", F.row_number().over(Window.orderBy("k")) - 1)
    assert ours.join(ref, ["id"]).filter("r != r2").count() == 0
    grouped = global_rank(df, ["k"], "r", ["g"], num_parts=4)
    ref_g = df.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert grouped.join(ref_g, ["id"]).filter("r != r2").count() == 0


def test_csv_round_trip_and_literal_rows(spark, scratch):
    smoke = files.literal_rows(spark, [(1, "test"), (2, "example")], ["id", "value"])
    assert smoke.count() == 2
    files.write_csv(smoke, scratch + "/smoke.csv")
    back = files.read_csv(spark, scratch + "/smoke.csv", "id int, value string")
    assert sorted(map(tuple, back.collect())) == [(1, "test"), (2, "example")]
    inferred = files.read_csv(spark, scratch + "/smoke.csv")
    assert dict(inferred.dtypes)["id"] == "int"


def test_json_sink(spark, scratch):
    df = spark.createDataFrame([(1, (0.5, 2))], "id int, m struct<auc:double,n:int>")
    files.write_json(df, scratch + "/out")
    assert spark.read.json(scratch + "/out").first().m.auc == 0.5


def test_object_store_settings_mask_secrets():
    s = objectstore.s3a_settings("https://storage.example", "AK", "SK")
    assert s["spark.hadoop.fs.s3a.endpoint"] == "https://storage.example"
    shown = objectstore.describe(s)
    assert "SK" not in shown.values() and "AK" not in shown.values()
