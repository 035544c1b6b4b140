import datetime as dt

import pytest
from pyspark.sql import functions as F

from relearn.operators import profile, registry
from relearn.operators.registry import Registry


def test_first_model_promoted_then_tie_keeps_champion(spark, scratch):
    reg = Registry(spark, scratch + "/reg")
    for run, auc in (("r1", 0.80), ("r2", 0.80), ("r3", 0.90)):
        reg.log_metrics(run, {"auc": auc, "accuracy": 0.9, "f1": 0.5})
    d1 = reg.compare_and_register("m", "r1", "/p1", 0.80)
    assert d1["promoted"] and d1["alias"] == "champion" and d1["version"] == 1
    d2 = reg.compare_and_register("m", "r2", "/p2", 0.80)
    assert not d2["promoted"] and d2["alias"] == "challenger" and d2["version"] == 2
    d3 = reg.compare_and_register("m", "r3", "/p3", 0.90)
    assert d3["promoted"] and d3["gain_pct"] == pytest.approx(12.5)
    assert reg.resolve("m").version == 3 and reg.resolve("m", "challenger").version == 2


def test_champion_without_stored_auc_is_replaced(spark, scratch):
    reg = Registry(spark, scratch + "/reg")
    reg.compare_and_register("m", "r1", "/p1", 0.80)   # no metrics logged for r1
    assert reg.compare_and_register("m", "r2", "/p2", 0.99)["promoted"]


@pytest.mark.parametrize("history, promoted", [((None, .9, .95), [True, True, True]), ((.7, None, .8), [True, False, True]),
                                               ((None, None, .5, .4), [True, True, True, False])])
def test_replay_with_unknown_metrics(spark, history, promoted):
    import datetime
    rows = [("m", f"r{i}", datetime.datetime(2024, 1, i + 1), v) for i, v in enumerate(history)]
    runs = spark.createDataFrame(rows, "model string, run_id string, ts timestamp, auc double")
    out = registry.replay_promotions(runs).orderBy("version").collect()
    assert [r.promoted for r in out] == promoted


def test_null_counts_of_odd_names(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "`it's` int, `a.b` int")
    assert {r.column_name: r.null_count for r in profile.null_counts(df).collect()} == {"it's": 1, "a.b": 1}


def test_champion_metrics_follow_alias(spark, scratch):
    reg = Registry(spark, scratch + "/reg")
    reg.log_metrics("r1", {"auc": 0.7, "accuracy": 0.9, "f1": 0.5})
    reg.register_version("m", "r1", "/p1")
    assert reg.champion_metrics("m") is None
    reg.set_alias("m", 1, "champion")
    assert reg.champion_metrics("m")["auc"] == pytest.approx(0.7)


def test_experiment_get_or_create_is_idempotent(spark, scratch):
    reg = Registry(spark, scratch + "/reg")
    reg.get_or_create_experiment("e")
    reg.get_or_create_experiment("e")
    assert reg.table("experiments").count() == 1


def test_stage_alias_and_descriptions(spark, scratch):
    df = spark.createDataFrame([("Production",), ("Staging",), ("Archived",), ("Canary",)], "stage string")
    assert [r[0] for r in df.select(registry.stage_alias("stage")).collect()] == \
        ["champion", "challenger", "archived", "canary"]
    reg = Registry(spark, scratch + "/reg")
    v = reg.register_version("m", "r1", "/p", "first")
    assert reg.transition_stage("m", v, "Production", "promoted by hand") == "champion"
    desc = registry.current_descriptions(reg.table("model_versions"), reg.table("description_events")).first()
    assert desc.description == "promoted by hand"


def test_replay_equals_sequential_rule(spark):
    aucs = [0.7, 0.65, 0.72, 0.72, None, 0.8, 0.79]
    base = dt.datetime(2024, 1, 1)
    rows = [("m", f"r{i}", base + dt.timedelta(days=i), a) for i, a in enumerate(aucs)]
    runs = spark.createDataFrame(rows, "model string, run_id string, ts timestamp, auc double")
    got = [r.promoted for r in registry.replay_promotions(runs).orderBy("version").collect()]
    champ, expect = None, []
    for i, a in enumerate(aucs):
        p = i == 0 or (champ is not None and a is not None and a > champ)
        if p:
            champ = a
        expect.append(p)
    assert got == expect


def test_next_versions_numbering(spark):
    existing = spark.createDataFrame([("m", 3, "r", "/p", "", dt.datetime(2024, 1, 1))],
                                     registry.SCHEMAS["model_versions"])
    cand = spark.createDataFrame([("m", "a", dt.datetime(2024, 2, 1)), ("m", "b", dt.datetime(2024, 3, 1)),
                                  ("n", "c", dt.datetime(2024, 1, 1))], "model string, run_id string, ts timestamp")
    got = {r.run_id: r.version for r in registry.next_versions(existing, cand).collect()}
    assert got == {"a": 4, "b": 5, "c": 1}


def test_null_counts_one_pass(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (3, 2.0, None)], "a int, b double, c string")
    got = {r.column_name: r.null_count for r in profile.null_counts(df).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}
    full = profile.null_counts(spark.createDataFrame([(1,)], "a int"), only_nonzero=False).collect()
    assert [(r.column_name, r.null_count) for r in full] == [("a", 0)]


def test_feature_columns_types_and_excludes(spark):
    df = spark.createDataFrame([(1, 2.0, "s", True, dt.datetime(2024, 1, 1), 0)],
                               "id long, x double, s string, b boolean, ts timestamp, y int")
    assert profile.feature_columns(df, exclude=["id", "y"]) == ["x", "b"]


def test_schema_report_and_first_rows(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string")
    rep = profile.schema_report(df).collect()
    assert [(r.column_name, r.data_type) for r in rep] == [("id", "int"), ("v", "string")]
    assert [r.id for r in profile.first_rows(df, 2, ["id"]).collect()] == [1, 2]
    s = profile.label_summary(spark.createDataFrame([(1,), (0,), (0,), (1,)], "y int"), "y").first()
    assert (s.n_rows, s.positives, s.positive_rate_pct) == (4, 2, 50.0)


def test_rows_and_nulls_by_group_one_pass(spark):
    df = spark.createDataFrame([("train", 1, None), ("train", None, "x"), ("train", 3, None), ("test", 4, "y")],
                               "split string, a int, b string")
    got = {r["split"]: r.asDict() for r in profile.rows_and_nulls_by(df, "split").collect()}
    assert got["train"] == {"split": "train", "n_rows": 3, "a": 1, "b": 2}
    assert got["test"] == {"split": "test", "n_rows": 1, "a": 0, "b": 0}


def test_tag_fallback(spark, scratch):
    reg = Registry(spark, scratch + "/reg")
    for model in ("m", "n"):
        reg.register_version(model, model + "1", "/p1")
        reg.register_version(model, model + "2", "/p2")
    reg.set_tag("m", 2, "alias", "champion")
    assert reg.resolve("m").version == 2 and reg.resolve("n") is None
    reg.set_alias("m", 1, "champion")
    assert reg.resolve("m").version == 1          # the alias goes first
    assert reg.register_version("m", "m2", "/again") == 2


def test_settings_are_checked_against_the_job():
    from relearn.cli import job
    from relearn.plans import jobs
    got = job.settings_of(jobs.run_training, {"input_path": "i", "output_path": "o", "parallelism": 2}, ["parallelism=8", "auto_register=true", "key_cols=[\"a\", \"b\"]", "experiment=e=x"])
    assert got == {"input_path": "i", "output_path": "o", "parallelism": 8, "auto_register": True, "key_cols": ["a", "b"], "experiment": "e=x"}
    for given, pairs in (({}, ["input_path=i"]), ({"input_path": "i", "output_path": "o"}, ["colour=red"]), ({"input_path": "i", "output_path": "o"}, ["spark=1"]), ({}, ["word"])):
        with pytest.raises(ValueError):
            job.settings_of(jobs.run_training, given, pairs)
    assert job.settings_of(jobs.run_ab_test, {}, ["alpha=0.05"]) == {"alpha": 0.05}


def test_jobs_run_from_the_command_line(spark, scratch, monkeypatch):
    import json
    from relearn.cli import job
    seen = []
    monkeypatch.setattr(job, "JOBS", {"train": job.JOBS["train"], "compare": lambda spark, data, registry_root, alpha=0.01, n_iter=5: seen.append((data.columns, data.count(), registry_root, alpha, n_iter))})
    monkeypatch.setattr(job, "_session", lambda name: spark)
    spark.createDataFrame([("u1", "bad"), ("u2", "good")], "url string, label string").coalesce(1).write.option("header", True).csv(scratch + "/urls")
    with open(scratch + "/settings.json", "w") as f:
        json.dump({"alpha": 0.2, "n_iter": 1}, f)
    job.main(["compare", "--registry", "r", "--data", scratch + "/urls", "--settings", scratch + "/settings.json", "--set", "n_iter=7"])
    assert seen == [(["url", "label"], 2, "r", 0.2, 7)]


def test_month_scan_reads_the_months_it_needs(spark):
    from relearn.plans import queries
    table, folder = queries.months(spark, "/root/testdata/sf0.001")
    some = table.where((F.col("month") >= queries.PRUNED_FROM) & (F.col("month") < queries.PRUNED_TO))
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line).split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in filters and queries.PRUNED_FROM in filters
    read = {r[0].rsplit("/", 2)[1] for r in some.select(F.col("_metadata.file_path")).distinct().collect()}
    assert read == {"month=1995-03", "month=1995-04", "month=1995-05"}
    # a day that comes later is a new folder, and the only one that its training reads
    assert len(table.inputFiles()) > 60 and folder


# -- commits that race -------------------------------------------------------------

def together(monkeypatch, *calls):
    """Runs the calls in threads; each one's first commit waits until all have built theirs from the same state."""
    import threading
    from relearn.operators.commits import CommitLog
    barrier, waited, put = threading.Barrier(len(calls)), threading.local(), CommitLog.put

    def late(self, number, events):
        if not getattr(waited, "done", False):
            waited.done = True
            barrier.wait(60)
        return put(self, number, events)
    monkeypatch.setattr(CommitLog, "put", late)
    out = [None] * len(calls)

    def work(i):
        out[i] = calls[i]()
    threads = [threading.Thread(target=work, args=(i,)) for i in range(len(calls))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    monkeypatch.setattr(CommitLog, "put", put)
    return out


def test_versions_registered_at_once_are_numbered(spark, scratch, monkeypatch):
    regs = [registry.Registry(spark, scratch + "/reg") for _ in range(3)]
    got = together(monkeypatch, *[lambda r=r, i=i: r.register_version("m", f"run{i}", "p") for i, r in enumerate(regs)])
    assert sorted(got) == [1, 2, 3] and sorted(r.version for r in regs[0].table("model_versions").collect()) == [1, 2, 3]
    # the same run from two writers, as after a failure: one version
    assert together(monkeypatch, *[lambda r=r: r.register_version("m", "same", "p") for r in regs[:2]]) == [4, 4]
    assert regs[0].table("model_versions").count() == 4


def test_experiments_and_runs_created_at_once_exist_once(spark, scratch, monkeypatch):
    reg = registry.Registry(spark, scratch + "/reg")
    together(monkeypatch, *[lambda: reg.get_or_create_experiment("e")] * 2)
    together(monkeypatch, *[lambda: reg.start_run("e", "n", "id")] * 2)
    assert reg.table("experiments").count() == 1 and reg.table("runs").count() == 1


def test_the_better_of_two_champions_stays(spark, scratch, monkeypatch):
    """Both beat the old champion; whichever commits later is compared with the other one."""
    reg = registry.Registry(spark, scratch + "/reg")
    for run, auc in (("old", 0.6), ("good", 0.9), ("better", 0.95)):
        reg.log_metrics(run, {"auc": auc})
    reg.compare_and_register("m", "old", "p", 0.6)
    v = {run: reg.register_version("m", run, "p") for run in ("good", "better")}
    got = together(monkeypatch, *[lambda run=run, auc=auc: reg.compare_and_register("m", run, "p", auc) for run, auc in (("good", 0.9), ("better", 0.95))])
    assert reg.resolve("m")["version"] == v["better"] and got[1]["alias"] == "champion"
    events = reg.table("alias_events").orderBy("ts").collect()
    assert len(events) == 3 and len({e.ts for e in events}) == 3


def test_a_commit_number_is_claimed_once(spark, scratch):
    from relearn.operators.commits import CommitLog
    log = CommitLog(spark, scratch + "/log")
    row = {"experiment": "e", "ts": None}
    assert log.head() == 0 and log.put(1, [("experiments", row)]) and not log.put(1, [("experiments", row)]) and log.head() == 1
    # by renaming, as on file systems without hard links
    log._claim = lambda written, number: log._rename(written, log._path(f"{number:012d}.json"))
    assert not log.put(1, [("experiments", row)]) and log.put(2, [("experiments", row)]) and log.head() == 2
    assert log.table("experiments", registry.SCHEMAS["experiments"]).count() == 2 and log.commit(lambda: []) == 0
