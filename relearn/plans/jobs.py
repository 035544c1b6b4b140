"""Composite jobs (J1, J2, J4): the only place that writes.

* ``run_training`` (J1/J3): profile, split, cross-validate a forest, score the
  test part, save the model, optionally A/B it against the champion, log the
  run and apply the promotion rule.
* ``run_ab_test`` (J2): champion versus a randomly searched candidate on a
  text table: metrics, paired bootstrap, t-test, deploy rule, registration.
* ``generate_demo`` (J4): synthetic transactions, 80/20 split, CSV sink.

Inputs that are read more than once (the training set during CV, scored test
rows during metrics) are persisted and released at the end; everything else
stays lazy.  All random choices are hash-based, so recomputing a lost
partition on another executor gives the same rows.
"""

from __future__ import annotations

import datetime as _dt
import logging
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relearn.operators import (abtest, bootstrap, metrics, profile, sampling, stats, synth,
                               training)
from relearn.operators.registry import Registry
from relearn.session import checkpoint_path
from relearn.sources import files
from relearn.sources.tables import DEFAULT_SPLIT, load_data

log = logging.getLogger("relearn")


@dataclass
class TrainResult:
    model: PipelineModel
    feature_cols: list[str]
    best: dict
    cv_metric: float
    metrics: dict
    summary: DataFrame
    grid: DataFrame
    folds: DataFrame
    best_index: int


def train_with_cv(train: DataFrame, test: DataFrame, label: str, exclude: Sequence[str],
                  key_cols: Sequence[str], folds: int = training.CV_FOLDS, parallelism: int = 4,
                  model_type: str = "rf", handle_invalid: str = "error",
                  fold_seed: str = "fold", partitions: int = training.FIT_PARTITIONS, folded: DataFrame | None = None) -> TrainResult:
    """M1-M8: feature selection, 2 x 2 grid, k hash folds on AUC, refit, test metrics.

    ``folded``: the training rows with their folds, where the caller has cached them already."""
    spark = train.sparkSession
    feats = profile.feature_columns(train, exclude)
    pipe = training.numeric_pipeline(feats, label, model_type, handle_invalid, on_cells=True)
    grid = training.forest_grid(pipe.getStages()[-1])
    needed = list(dict.fromkeys([*key_cols, label, *feats]))
    own = None
    if folded is None:
        folded = own = training.cache_for_fitting(training.add_folds(train.select(*needed), folds, fold_seed, key_cols), key_cols, partitions,
                                                        keep=[label, *feats, "fold"])
    try:
        cvm = training.cross_validate(pipe, grid, training.auc_evaluator(label), folded, folds,
                                      parallelism=parallelism, share_depths=True)
    finally:
        if own is not None:
            own.unpersist()
    best_model = cvm.best_model
    best = training.best_params(best_model)
    cv_auc = cvm.avg_metrics[cvm.best_index]
    scored = training.score(best_model, test).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        m = metrics.score_metrics(scored, label, "score", "prediction").first().asDict()
    finally:
        scored.unpersist()
    values = {"auc": m["auc_score"], "accuracy": m["accuracy"], "f1": m["f1_weighted"],
              "sample_size": m["sample_size"]}
    summary = spark.createDataFrame(
        [(int(best["numTrees"]), int(best["maxDepth"]), cv_auc, values["auc"], values["accuracy"],
          values["f1"], int(values["sample_size"]))],
        "best_num_trees int, best_max_depth int, cv_auc double, auc_score double, accuracy double, "
        "f1_weighted double, sample_size bigint")
    return TrainResult(best_model, feats, best, cv_auc, values, summary, training.cv_table(spark, cvm, "avg_auc"), training.fold_table(spark, cvm),
                       cvm.best_index)


def _key_columns(df: DataFrame, label: str, key_cols: Sequence[str] | None) -> tuple[list[str], list[str]]:
    """Columns that the row hashes read, and those of them that name a row and so aren't features."""
    if key_cols:
        return list(key_cols), list(key_cols)
    if "transaction_id" in df.columns:
        return ["transaction_id"], ["transaction_id"]
    # no declared key: hash every column except the label (equal rows share a split); all of them may be features
    return [c for c in df.columns if c != label], []


def run_training(spark: SparkSession, input_path: str, output_path: str, registry_root: str,
                 experiment: str = "fraud_detection", model_type: str = "rf",
                 run_name: str | None = None, run_id: str | None = None, auto_register: bool = False,
                 ab_testing: bool = False, ab_traffic_split: float = 0.5,
                 label: str = "tx_fraud", timestamp: str = "tx_timestamp",
                 key_cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                 split_weights: Sequence[float] = DEFAULT_SPLIT, sample_fraction: float | None = None,
                 require_ab_win: bool = False, parallelism: int = 4, handle_invalid: str = "error",
                 partitions: int = training.FIT_PARTITIONS, input_df: DataFrame | None = None) -> dict:
    """Train, evaluate, save, A/B and promote, as the reference's training job.

    ``split_weights`` are normalised (the reference's 0.005 : 0.0001 keeps all
    rows, 98 % / 2 %); ``sample_fraction`` subsamples first.  Promotion follows
    the reference: by test AUC against the champion's stored AUC, whatever the
    A/B winner, unless ``require_ab_win``.  ``handle_invalid`` is the null policy
    of the features ("error", "skip" or "keep"), ``partitions`` the layout of the
    cached training set (logged: the trees depend on it).
    """
    if model_type not in training.MODEL_TYPES:
        raise ValueError(f"model_type {model_type!r} is not supported")
    reg = Registry(spark, registry_root)
    reg.get_or_create_experiment(experiment)
    model_name = f"{experiment}_model"

    df = input_df if input_df is not None else load_data(spark, input_path)
    keys, not_features = _key_columns(df, label, key_cols)
    key = [F.col(c) for c in keys]
    if sample_fraction is not None:
        df = sampling.sample_rows(df, sample_fraction, "sample", key)
    split = sampling.weighted_split(df, split_weights, "split", key)
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    # The test split (a few % of the rows) is scored by the new model and, in
    # the A/B step, by both arms: cache it so the input is not scanned again.
    test = test.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # split sizes and null counts of the training part from one scan (one row per split)
        by_split = {r["split"]: r.asDict() for r in profile.rows_and_nulls_by(split, "split").collect()}
        sizes = {k: v["n_rows"] for k, v in by_split.items()}
        train_row = by_split.get("train", {})
        nulls = [(c, train_row[c]) for c in train.columns if train_row.get(c)]
        for col, n in nulls:
            log.warning("column %s has %d nulls in the training part", col, n)

        champion = None
        if ab_testing:
            row = reg.resolve(model_name)
            champion = files.load_model(row["path"]) if row is not None else None

        name = run_name or f"fraud_detection_{model_type}_{os.path.basename(input_path.rstrip('/'))}"
        run_id = reg.start_run(experiment, name, run_id)
        reg.log_params(run_id, {"numTrees_options": list(training.GRID_NUM_TREES),
                                "maxDepth_options": list(training.GRID_MAX_DEPTH),
                                "fit_partitions": partitions})
        exclude_all = [label, timestamp, *not_features, *exclude]
        result = train_with_cv(train, test, label, exclude_all, keys, parallelism=parallelism,
                               model_type=model_type, handle_invalid=handle_invalid, partitions=partitions)
        reg.log_metrics(run_id, {k: result.metrics[k] for k in ("auc", "accuracy", "f1")})
        reg.log_params(run_id, {"best_numTrees": result.best["numTrees"],
                                "best_maxDepth": result.best["maxDepth"]})
        files.save_model(result.model, output_path)

        ab = None
        if ab_testing and champion is not None:
            arms = sampling.assign_arms(test, ab_traffic_split, "arm", key)
            scored = abtest.score_by_arm(arms, champion, result.model, keep=[label])
            compared = abtest.compare_arms(abtest.arm_metrics(scored, label)).persist()
            ab_run = reg.start_run(experiment, f"ab_test_{_dt.datetime.now():%Y%m%d_%H%M%S}")
            record = abtest.result_record(compared, ab_traffic_split)
            told = record.select("timestamp", "winner", "improvement_message").first()
            reg.log_params(ab_run, {"ab_traffic_split": ab_traffic_split, "ab_test_timestamp": told[0], "winner": told[1],
                                    "improvement_message": told[2]})
            reg.log_metrics(ab_run, abtest.metric_rows(compared, ab_run))
            files.write_json(record, output_path.rstrip("/") + "_ab_test_results")
            ab = compared.first().asDict()
            compared.unpersist()

        decision = None
        if auto_register and (not require_ab_win or ab is None or ab["winner"] == "challenger"):
            decision = reg.compare_and_register(model_name, run_id, output_path, result.metrics["auc"])
        return {"run_id": run_id, "split_sizes": sizes, "null_columns": nulls,
                "features": result.feature_cols, "best": result.best, "cv_auc": result.cv_metric,
                "metrics": result.metrics, "ab": ab, "decision": decision}
    finally:
        test.unpersist()


# -- J2 ----------------------------------------------------------------------------

def _search(train: DataFrame, text_col: str, label: str, key_cols: Sequence[str], n_iter: int, folds: int, parallelism: int, seed: str, watch=None):
    spark = train.sparkSession
    pipe = training.text_pipeline(text_col, label)
    rf = pipe.getStages()[-1]
    candidates = training.draw_candidates(training.search_grid(spark), n_iter, seed)
    maps = training.param_maps(rf, candidates)
    needed = list(dict.fromkeys([*key_cols, label, text_col]))
    folded = training.cache_for_fitting(training.add_folds(train.select(*needed), folds, "fold", key_cols, label=label),
                                        key_cols)
    try:
        return candidates, maps, training.cross_validate(pipe, maps, training.f1_class1_evaluator(label), folded, folds,
                                                         parallelism=parallelism, watch=watch)
    finally:
        folded.unpersist()


def random_search(train: DataFrame, text_col: str, label: str, key_cols: Sequence[str],
                  n_iter: int = training.SEARCH_ITERATIONS, folds: int = training.SEARCH_FOLDS,
                  parallelism: int = 4, seed: str = "search"):
    """M11 + M12: draw grid points, stratified k-fold CV on class-1 F1, refit."""
    _, maps, cvm = _search(train, text_col, label, key_cols, n_iter, folds, parallelism, seed)
    return cvm.best_model, training.param_names(maps[cvm.best_index]), cvm.avg_metrics[cvm.best_index]


def search_scores(train: DataFrame, text_col: str, label: str, key_cols: Sequence[str], n_iter: int = training.SEARCH_ITERATIONS,
                  folds: int = training.SEARCH_FOLDS, parallelism: int = 4, seed: str = "search") -> DataFrame:
    """M11 as a table: one row per drawn grid point and fold with its parameters, the search's metric and the counts,
    precision, recall and F1 (E4) of the held-out rows that the metric was taken from.

    Each evaluation writes its four counts to the shared checkpoint folder; nothing else is kept of the scored rows."""
    spark = train.sparkSession
    folder = checkpoint_path(spark, f"search/{uuid.uuid4().hex}")

    def watch(fold: int, candidate: int, scored: DataFrame) -> None:
        counts = metrics.evaluate_models(scored.withColumn("prediction", F.col("prediction").cast("int")), label, {"candidate": "prediction"})
        counts.coalesce(1).write.parquet(f"{folder}/fold={fold}/candidate={candidate}")
    candidates, _, cvm = _search(train, text_col, label, key_cols, n_iter, folds, parallelism, seed, watch)
    drawn = candidates.withColumn("candidate", F.row_number().over(Window.orderBy("grid_id")) - 1)       # the grid's rows
    counts = spark.read.parquet(folder).select("fold", "candidate", "tp", "fp", "fn", "tn", F.col("n").alias("n_rows"), (F.col("tp") + F.col("fn")).alias("positives"),
                                               "precision", "recall", F.col("f1_binary").alias("f1"))
    return drawn.join(training.fold_table(spark, cvm), "candidate").join(counts, ["fold", "candidate"])


def predict_both(df: DataFrame, champion: PipelineModel, candidate: PipelineModel,
                 keep: Sequence[str]) -> DataFrame:
    """Both models' 0/1 predictions on the same rows, side by side (no join)."""
    base = champion.transform(df).select(*df.columns, F.col("prediction").cast("int").alias("pred_base"))
    return candidate.transform(base).select(*keep, "pred_base",
                                            F.col("prediction").cast("int").alias("pred_candidate"))


def run_ab_test(spark: SparkSession, data: DataFrame, registry_root: str, text_col: str = "url",
                label_col: str = "label", key_cols: Sequence[str] = ("url",),
                label_map: dict | None = sampling.URL_LABEL_MAP, model_name: str = "url_classifier",
                n_iter: int = training.SEARCH_ITERATIONS, cv: int = training.SEARCH_FOLDS,
                sample_frac: float = 0.1, test_size: float = 0.3, bootstrap_iterations: int = 100,
                alpha: float = 0.01, auto_deploy: bool = False, bootstrap_method: str = "multinomial",
                parallelism: int = 4) -> dict | None:
    """Champion versus an optimised candidate on a labelled text table.

    Returns None when there is no champion (as the reference does).
    """
    reg = Registry(spark, registry_root)
    reg.get_or_create_experiment("url_classification")
    key = [F.col(c) for c in key_cols]
    df = sampling.sample_rows(data, sample_frac, "sample", key)
    label = "label_enc"
    if label_map is not None:
        df = sampling.encode_labels(df, label_col, label_map, label)
    else:
        df = df.withColumn(label, F.col(label_col).cast("int"))
    df = df.filter(F.col(label).isNotNull())
    split = sampling.weighted_split(df, (1 - test_size, test_size), "split", key)
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")

    row = reg.resolve(model_name)
    if row is None:
        log.warning("model %s has no champion version: nothing to compare with", model_name)
        return None
    champion = files.load_model(row["path"])
    candidate, best, cv_f1 = random_search(train, text_col, label, list(key_cols), n_iter, cv, parallelism)

    preds = predict_both(test, champion, candidate, [*key_cols, label]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model_metrics = {r["model"]: r.asDict() for r in metrics.evaluate_models(
            preds, label, {"production": "pred_base", "candidate": "pred_candidate"}).collect()}
        scores = bootstrap.paired_bootstrap(preds, label, "pred_base", "pred_candidate",
                                            bootstrap_iterations, "boot", bootstrap_method)
        comparison = stats.compare_scores(scores, stats.DEFAULT_METRICS, alpha).persist()
        decision = stats.deploy_decision(comparison).first().asDict()
        comparison_rows = [r.asDict() for r in comparison.collect()]
        comparison.unpersist()
    finally:
        preds.unpersist()

    path = f"{registry_root.rstrip('/')}/models/{model_name}/{_dt.datetime.now():%Y%m%d%H%M%S%f}"
    files.save_model(candidate, path)
    cand = model_metrics["candidate"]
    run_id = reg.start_run("url_classification", f"{model_name}_candidate")
    reg.log_metrics(run_id, {"precision": cand["precision"], "recall": cand["recall"],
                             "f1_score": cand["f1_binary"], "auc": cand["auc_label"]})
    description = f"Random search, F1 over the folds {cv_f1:.4f}, parameters {best}"
    version = reg.register_version(model_name, run_id, path, description)
    deployed = bool(decision["should_deploy"]) and auto_deploy
    if deployed:
        f1_gain = next(r["improvement"] for r in comparison_rows if r["metric"] == "f1")
        reg.set_alias(model_name, version, "champion",
                      f"Champion since its paired bootstrap test, F1 change {f1_gain:+.4f}")
    return {"should_deploy": bool(decision["should_deploy"]), "deployed": deployed, "version": version,
            "best_params": best, "cv_f1": cv_f1, "metrics": model_metrics, "comparison": comparison_rows}


# -- J4 ----------------------------------------------------------------------------

def generate_demo(spark: SparkSession, output_dir: str, n: int = synth.NUM_SAMPLES,
                  fraud_rate: float = synth.FRAUD_RATE, seed: str = synth.SEED,
                  as_of: _dt.datetime | None = None) -> dict:
    """Generate, split 80/20 by transaction id, write the training part as CSV."""
    df = synth.generate_transactions(spark, n, fraud_rate, seed, as_of)
    train, _test = synth.demo_split(df)
    files.write_csv(train, output_dir.rstrip("/") + "/train.csv")
    summary = profile.label_summary(df, "fraud").first().asDict()
    return {"train_path": output_dir.rstrip("/") + "/train.csv", **summary}
