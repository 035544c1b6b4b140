from pyspark.sql import functions as F

from conftest import SF_SMALL
from relearn.operators import metrics, scorers
from relearn.sources.tables import LABEL, transactions
from relearn.streaming.retrain import retrain_on_arrival, run_until_done


def test_new_partitions_trained_once(spark, scratch):
    tx = transactions(spark, SF_SMALL).withColumn("year", F.year("tx_timestamp"))
    years = sorted(r.year for r in tx.select("year").distinct().collect())
    src = scratch + "/days"
    schema = tx.drop("year").schema
    seen = []

    def train_batch(batch, batch_id):
        m = metrics.score_metrics(batch.select(LABEL, scorers.candidate_score().alias("s"),
                                               scorers.candidate_prediction().alias("p")), LABEL, "s", "p")
        seen.append((batch_id, batch.count(), m.first().sample_size))

    tx.filter(F.col("year") == years[0]).drop("year").write.mode("append").parquet(src)
    ck = scratch + "/ck"
    run_until_done(retrain_on_arrival(spark, src, schema, train_batch, ck), 120)
    first = list(seen)
    assert len(first) == 1 and first[0][1] == first[0][2] > 0
    # a new partition arrives; only it is trained on by the next run
    tx.filter(F.col("year") == years[1]).drop("year").write.mode("append").parquet(src)
    run_until_done(retrain_on_arrival(spark, src, schema, train_batch, ck), 120)
    assert len(seen) == 2
    n_second = tx.filter(F.col("year") == years[1]).count()
    assert seen[1][1] == n_second
    # nothing new: nothing trained
    run_until_done(retrain_on_arrival(spark, src, schema, train_batch, ck), 120)
    assert len(seen) == 2


def test_a_day_that_failed_after_registration_is_finished_once(spark, scratch, monkeypatch):
    from relearn.operators.registry import Registry
    from relearn.streaming.retrain import retrain_days
    tx = transactions(spark, SF_SMALL).select("l_orderkey", "l_quantity", "l_discount", "l_tax", "tx_timestamp", LABEL)
    tx = tx.withColumn("dt", F.concat(F.lit("day"), (F.year("tx_timestamp") % 2).cast("string")))
    src, root = scratch + "/days", scratch + "/reg"
    tx.write.partitionBy("dt").parquet(src)
    calls, plain = [], Registry.set_alias

    def fails_once(self, *a, **k):
        calls.append(a)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return plain(self, *a, **k)
    monkeypatch.setattr(Registry, "set_alias", fails_once)

    def run():
        return retrain_days(spark, src, tx.schema, scratch + "/models", root, checkpoint=scratch + "/ck", key_cols=["l_orderkey"],
                            split_weights=(0.8, 0.2), partitions=2)
    try:
        run_until_done(run(), 300)
        raise AssertionError("the first run must fail")
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    run_until_done(run(), 300)
    run_until_done(run(), 300)
    reg = Registry(spark, root)
    versions = reg.table("model_versions").collect()
    assert sorted(v.version for v in versions) == [1, 2] and len({v.run_id for v in versions}) == 2
    assert reg.table("runs").count() == 2 and reg.table("alias_events").count() == 2 and reg.resolve("fraud_detection_model") is not None


def test_late_files_make_one_new_version_of_their_day(spark, scratch, caplog):
    """Two days; a late file for the first; a batch that is repeated; files without a day."""
    from relearn.operators.registry import Registry
    from relearn.streaming import retrain
    schema = "a long, dt string"
    src, root, trained = scratch + "/da ys", scratch + "/reg", []

    def arrive(ids, day):
        spark.createDataFrame([(i, day) for i in ids], schema).coalesce(1).write.mode("append").partitionBy("dt").parquet(src)

    def train(spark, input_path, output_path, registry_root, run_id, input_df, **_):
        trained.append((input_path.rsplit("=", 1)[1], sorted(r.a for r in input_df.collect())))
        Registry(spark, registry_root).compare_and_register("m", run_id, output_path, 0.5)

    def run(checkpoint=scratch + "/ck"):
        run_until_done(retrain.retrain_days(spark, src, schema, scratch + "/out", root, experiment="e", checkpoint=checkpoint, train=train), 300)
    arrive([1, 2], "2024-01-01")
    arrive([3], "2024-01-02")
    run()
    assert sorted(trained) == [("2024-01-01", [1, 2]), ("2024-01-02", [3])]
    trained.clear()
    run()
    assert not trained
    arrive([4], "2024-01-01")                    # late: the whole day again, once
    arrive([5, 6], None)
    with caplog.at_level("WARNING"):
        run()
    assert trained == [("2024-01-01", [1, 2, 4])] and "1 files without a dt" in caplog.text
    trained.clear()
    # progress lost: every file comes again in one batch; each day's set of files is known
    run(scratch + "/other")
    assert not trained
    reg = Registry(spark, root)
    assert reg.table("model_versions").count() == 3
    listed = retrain.day_files(reg, "e").collect()
    assert sorted(str(r.day) for r in listed) == ["2024-01-01", "2024-01-01", "2024-01-02", "None"]
