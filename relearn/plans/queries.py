"""Registered queries: one per operator of the inventory that reads the tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Doubles are rounded to 6 places and integers cast to ``bigint`` so
the results can be compared value by value with the SQL in
``relearn.plans.oracle``; column names are the same on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.operators import (abtest, bootstrap, metrics, profile, registry, sampling, scorers,
                               stats, training, trees)
from relearn.session import checkpoint_path, ensure_checkpoint_dir
from relearn.sources.tables import DEFAULT_SPLIT, LABEL, TIMESTAMP, load_data, read_table, transactions, tx_key

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SPLIT_WEIGHTS = DEFAULT_SPLIT
# Fixed values of the reference job: seed purpose strings.
SPLIT_SEED = "split"
ARM_SEED = "arm"
TRAFFIC_SPLIT = 0.5
DECIMALS = 6
FLAGSHIP = "model_metrics"


def register(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every double column (for engine-independent comparison)."""
    cols = [F.round(F.col(f.name), decimals).alias(f.name) if f.dataType.typeName() in ("double", "float")
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def split_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the reference's train/test split (98.04 % / 1.96 %)."""
    return sampling.weighted_split(transactions(spark, sf_dir), SPLIT_WEIGHTS, SPLIT_SEED, tx_key())


def test_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_transactions(spark, sf_dir).filter(F.col("split") == "test")


# -- first slice: scan -> split -> rule scorers -> metric set ---------------

@register("model_metrics")
def q_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary P/R/F1, label AUC, accuracy and weighted F1 of two rule models on the test split."""
    scored = scorers.score_rules(test_part(spark, sf_dir))
    out = metrics.evaluate_models(scored, LABEL, {"base": "pred_base", "candidate": "pred_candidate"})
    return rounded(out.select("model", "tp", "fp", "fn", "tn", "n", "precision", "recall",
                              "f1_binary", "auc_label", "accuracy", "f1_weighted"))


# -- profiling (P2-P4, P10, P11) ---------------------------------------------

TX_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TX_KEY_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_qty_key"]
SAMPLE_FRACTION = 0.1      # share of the URL data the A/B job works on
DEMO_TRAIN_FRACTION = 0.8  # 80/20 split of the demo data


def _tx_out(df: DataFrame) -> DataFrame:
    """Transactions with the event time as text (engine-independent format)."""
    return df.withColumn("tx_timestamp", F.date_format("tx_timestamp", "yyyy-MM-dd HH:mm:ss"))


@register("row_count")
def q_row_count(spark, sf_dir):
    """Rows of the input table."""
    return profile.row_count(transactions(spark, sf_dir))


@register("first_rows")
def q_first_rows(spark, sf_dir):
    """The first 5 transactions by key."""
    return _tx_out(profile.first_rows(transactions(spark, sf_dir), 5, TX_KEY_COLS))


@register("null_counts")
def q_null_counts(spark, sf_dir):
    """Null count of every column of the training part, one pass."""
    train = split_transactions(spark, sf_dir).filter(F.col("split") == "train").drop("split")
    return profile.null_counts(train, only_nonzero=False)


@register("label_summary")
def q_label_summary(spark, sf_dir):
    """Rows, positives and positive rate of the label."""
    return rounded(profile.label_summary(transactions(spark, sf_dir), LABEL))


# -- label map, sampling, splits (P6-P10, P12) ----------------------------------

ORDER_STATUS_MAP = {"F": 1, "O": 0}


@register("label_encoding")
def q_label_encoding(spark, sf_dir):
    """Status mapped to 1/0, any other value to null."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.encode_labels(orders, "o_orderstatus", ORDER_STATUS_MAP)


@register("sample_rows")
def q_sample_rows(spark, sf_dir):
    """10 % of orders, without replacement, keyed by order."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_rows(orders, SAMPLE_FRACTION, "sample", [F.col("o_orderkey")])


@register("sample_exact")
def q_sample_exact(spark, sf_dir):
    """P7 with an exact size: a tenth of the transactions, to the row."""
    return sampling.sample_exact(transactions(spark, sf_dir).select(*TX_KEY_COLS), SAMPLE_FRACTION, "sample", TX_KEY_COLS)


@register("sample_complement")
def q_sample_complement(spark, sf_dir):
    """The orders an 80 % sample leaves out (the demo data's test part)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_complement(orders, DEMO_TRAIN_FRACTION, "demo_split", [F.col("o_orderkey")])


@register("split_assign")
def q_split_assign(spark, sf_dir):
    """Split of every transaction (normalised weights 0.005 : 0.0001)."""
    return split_transactions(spark, sf_dir).select(*TX_KEY_COLS, "split")


@register("split_sizes")
def q_split_sizes(spark, sf_dir):
    """Rows per split."""
    return sampling.split_sizes(split_transactions(spark, sf_dir))


@register("url_sample")
def q_url_sample(spark, sf_dir):
    """P7 + P10: sample of the URL table, URL column only (plus its key)."""
    pages = read_table(spark, sf_dir, "pages")
    return profile.select_columns(
        sampling.sample_rows(pages, SAMPLE_FRACTION, "sample", [F.col("page_id")]), ["page_id", "url"])


# -- A/B on one table (A1-A3, A5, A6) -------------------------------------------

def ab_table(spark, sf_dir):
    """Test part of the transactions with an arm per row."""
    return sampling.assign_arms(test_part(spark, sf_dir), TRAFFIC_SPLIT, ARM_SEED, tx_key())


@register("ab_assign")
def q_ab_assign(spark, sf_dir):
    """A1: arm of each test transaction."""
    return ab_table(spark, sf_dir).select(*TX_KEY_COLS, "ab_group")


@register("ab_arm_sizes")
def q_ab_arm_sizes(spark, sf_dir):
    """A2: both arm sizes (0 for an empty arm)."""
    return sampling.arm_sizes(ab_table(spark, sf_dir))


@register("ab_arm_rows")
def q_ab_arm_rows(spark, sf_dir):
    """A3: rows of the challenger arm."""
    return _tx_out(sampling.arm_rows(ab_table(spark, sf_dir), "challenger")
                   .select(*TX_KEY_COLS, *TX_FEATURES, "tx_timestamp", LABEL))


@register("ab_arm_metrics")
def q_ab_arm_metrics(spark, sf_dir):
    """A4 + A5: each arm scored by its rule model; AUC, accuracy, F1, size per arm."""
    scored = scorers.score_arms(ab_table(spark, sf_dir))
    return rounded(abtest.arm_metrics(scored, LABEL))


@register("ab_compare")
def q_ab_compare(spark, sf_dir):
    """Arms side by side, improvements and the winner."""
    scored = scorers.score_arms(ab_table(spark, sf_dir))
    return rounded(abtest.compare_arms(abtest.arm_metrics(scored, LABEL)))


@register("ab_record")
def q_ab_record(spark, sf_dir):
    """A7 + A8 + R2: the record of the comparison and its metrics, written to the run tables and read back."""
    compared = abtest.compare_arms(abtest.arm_metrics(scorers.score_arms(ab_table(spark, sf_dir)), LABEL))
    ensure_checkpoint_dir(spark)
    compared = compared.checkpoint()
    reg, run_id = registry.Registry(spark, checkpoint_path(spark, f"registry-{uuid.uuid4().hex}")), "ab"
    record = abtest.result_record(compared, TRAFFIC_SPLIT)
    told = record.select("traffic_split", "winner", "improvement_message", F.col("champion_metrics.sample_size").alias("champion_rows"),
                         F.col("challenger_metrics.sample_size").alias("challenger_rows")).first().asDict()
    reg.log_params(run_id, told)
    reg.log_metrics(run_id, abtest.metric_rows(compared, run_id))
    texts = reg.table("run_params").select("key", "value", F.lit(None).cast("double").alias("number"))
    numbers = reg.table("run_metrics").select("key", F.lit(None).cast("string").alias("value"), F.col("value").alias("number"))
    return rounded(texts.unionByName(numbers))


# -- score metrics (E1-E3) ------------------------------------------------------

def stacked_scores(df: DataFrame) -> DataFrame:
    """(model, label, score, prediction) rows for both rule models."""
    s = scorers.score_rules(df)
    rows = F.array(
        F.struct(F.lit("base").alias("model"), F.col("score_base").alias("score"),
                 F.col("pred_base").alias("prediction")),
        F.struct(F.lit("candidate").alias("model"), F.col("score_candidate").alias("score"),
                 F.col("pred_candidate").alias("prediction")))
    return s.select(LABEL, F.explode(rows).alias("m")).select(LABEL, "m.*")


@register("auc_exact")
def q_auc_exact(spark, sf_dir):
    """Exact ROC AUC of both rule scores over all transactions."""
    return rounded(metrics.roc_auc(stacked_scores(transactions(spark, sf_dir)), LABEL, "score", ["model"]))


@register("score_metrics")
def q_score_metrics(spark, sf_dir):
    """AUC, accuracy and label-weighted F1 of both rule models on the test split."""
    return rounded(metrics.score_metrics(stacked_scores(test_part(spark, sf_dir)), LABEL, "score",
                                         "prediction", ["model"]))


# -- paired bootstrap and t-test (E7-E11) -----------------------------------------

#: How far under the rule scorer's AUC a fitted forest's may be; standard errors of a bootstrap mean.
AUC_MARGIN, STANDARD_ERRORS = 0.1, 5.0
BOOT_ITERATIONS = 100
BOOT_SEED = "boot"
ALPHA = 0.01


def test_cells(spark, sf_dir):
    """Joint (label, base, candidate) cell counts of the test split."""
    scored = scorers.score_rules(test_part(spark, sf_dir))
    return bootstrap.joint_cells(scored, LABEL, "pred_base", "pred_candidate")


def boot_counts(spark, sf_dir, method="draws"):
    return bootstrap.resample(spark, test_cells(spark, sf_dir), BOOT_ITERATIONS, BOOT_SEED, method)


@register("bootstrap_cells")
def q_bootstrap_cells(spark, sf_dir):
    """Per-iteration cell counts of the paired resamples (hash draws)."""
    return boot_counts(spark, sf_dir)


@register("bootstrap_multinomial_cells")
def q_bootstrap_multinomial_cells(spark, sf_dir):
    """Per-iteration cell counts as multinomial draws, over all transactions."""
    scored = scorers.score_rules(transactions(spark, sf_dir))
    return bootstrap.resample(spark, bootstrap.joint_cells(scored, LABEL, "pred_base", "pred_candidate"), BOOT_ITERATIONS, BOOT_SEED, "multinomial")


@register("bootstrap_scores")
def q_bootstrap_scores(spark, sf_dir):
    """F1, precision, recall, label AUC per iteration and model."""
    return rounded(bootstrap.bootstrap_scores(boot_counts(spark, sf_dir)))


@register("bootstrap_ttest")
def q_bootstrap_ttest(spark, sf_dir):
    """T-test, p-value, Cohen's d and improvement for F1 and precision."""
    scores = bootstrap.bootstrap_scores(boot_counts(spark, sf_dir))
    return rounded(stats.compare_scores(scores, stats.DEFAULT_METRICS, ALPHA))


@register("deploy_decision")
def q_deploy_decision(spark, sf_dir):
    """Deploy iff F1 is significantly better."""
    scores = bootstrap.bootstrap_scores(boot_counts(spark, sf_dir))
    return rounded(stats.deploy_decision(stats.compare_scores(scores, stats.DEFAULT_METRICS, ALPHA)))


@register("bootstrap_multinomial_ttest")
def q_bootstrap_multinomial_ttest(spark, sf_dir):
    """E7-E10 on all transactions with exact multinomial resamples (cost O(B), any n)."""
    scored = scorers.score_rules(transactions(spark, sf_dir))
    cells = bootstrap.joint_cells(scored, LABEL, "pred_base", "pred_candidate").withColumnsRenamed(
        {f"c{i}": f"k{i}" for i in range(bootstrap.N_CELLS)})
    drawn = bootstrap.resample(spark, bootstrap.joint_cells(scored, LABEL, "pred_base", "pred_candidate"), BOOT_ITERATIONS, BOOT_SEED, "multinomial")
    whole = bootstrap.bootstrap_scores(cells.withColumn("iteration", F.lit(0)))
    names = ("f1", "precision", "recall", "auc")
    means = bootstrap.bootstrap_scores(drawn).groupBy("model").agg(
        *[F.avg(m).alias(f"mean_{m}") for m in names], *[F.stddev_samp(m).alias(f"sd_{m}") for m in names])
    total = drawn.agg(sum((F.sum(f"k{i}") for i in range(bootstrap.N_CELLS)), F.lit(0)).cast("bigint").alias("drawn"), F.count("*").alias("iterations"))
    near = [(F.abs(F.col(f"mean_{m}") - F.col(m)) <= STANDARD_ERRORS * F.col(f"sd_{m}") / F.sqrt(F.lit(float(BOOT_ITERATIONS))) + 1e-6).alias(f"{m}_near") for m in names]
    return rounded(whole.join(means, "model").crossJoin(total).select("model", "iterations", "drawn", *names, *near))     # two rows, one row


# -- model training (M1-M8): rows-only checks -----------------------------------------

MODEL_NAME = "fraud_detection_model"
FEATURE_EXCLUDE = [LABEL, "tx_timestamp", *TX_KEY_COLS, "split"]


def train_test(spark, sf_dir):
    split = split_transactions(spark, sf_dir)
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


@register("forest_fit_score")
def q_forest_fit_score(spark, sf_dir):
    """M1-M3, M6, M7: one forest (10 trees, depth 5) fitted on train, test scored; E1-E3."""
    train, test = train_test(spark, sf_dir)
    feats = profile.feature_columns(train, FEATURE_EXCLUDE)
    cached = training.cache_for_fitting(train.select(*TX_KEY_COLS, LABEL, *feats), TX_KEY_COLS)
    try:
        model = training.numeric_pipeline(feats, LABEL).fit(cached)
    finally:
        cached.unpersist()
    scored = training.score(model, test).withColumn("rule", scorers.candidate_score())
    fitted = metrics.score_metrics(scored, LABEL, "score", "prediction").select("sample_size", F.col("auc_score").alias("auc"))
    rule = metrics.roc_auc(scored, LABEL, "rule").select(F.col("auc_score").alias("rule_auc"))
    positives = scored.agg(F.sum(LABEL).cast("bigint").alias("positives"))
    return (fitted.crossJoin(rule).crossJoin(positives)      # one row each
            .select("sample_size", "positives", F.lit(len(feats)).cast("bigint").alias("n_features"),
                    F.lit(training.FOREST_NUM_TREES).cast("bigint").alias("n_trees"),
                    (F.col("auc") > F.col("rule_auc") - AUC_MARGIN).alias("near_rule_auc")))


@register("forest_cv")
def q_forest_cv(spark, sf_dir):
    """M4, M5, M8: 2 x 2 grid, 3 hash folds, AUC; best parameters and test metrics.

    The best point's fold 0 is fitted again by itself and its held-out rows scored by the exact AUC (E1)."""
    from relearn.plans.jobs import train_with_cv
    train, test = train_test(spark, sf_dir)
    test = test.persist()
    feats = profile.feature_columns(train, FEATURE_EXCLUDE)
    folds = training.add_folds(train.select(*TX_KEY_COLS, LABEL, *feats), training.CV_FOLDS, "fold", TX_KEY_COLS)
    folds = training.cache_for_fitting(folds, TX_KEY_COLS, keep=[LABEL, *feats, "fold"])
    result = train_with_cv(train, test, LABEL, FEATURE_EXCLUDE, TX_KEY_COLS, folded=folds)
    pipe = training.numeric_pipeline(result.feature_cols, LABEL, on_cells=True, num_trees=result.best["numTrees"], max_depth=result.best["maxDepth"])
    held = training.score(pipe.fit(folds.where("fold <> 0")), folds.where("fold = 0"))
    again = metrics.roc_auc(held, LABEL, "score").select(F.col("auc_score").alias("again")).checkpoint()
    folds.unpersist()
    best = result.folds.where(F.col("candidate") == result.best_index).agg(
        F.max(F.when(F.col("fold") == 0, F.col("metric"))).alias("fold_auc"), F.avg("metric").alias("mean_of_folds"))
    rule = metrics.roc_auc(test.withColumn("rule", scorers.candidate_score()), LABEL, "rule").select(F.col("auc_score").alias("rule_auc")).checkpoint()
    test.unpersist()
    grid = result.grid.agg(F.count(F.lit(1)).cast("bigint").alias("grid_size"), F.max("avg_auc").alias("best"))
    return (result.summary.crossJoin(rule).crossJoin(grid).crossJoin(again).crossJoin(best)      # one row each
            .select("sample_size", "grid_size", F.lit(training.CV_FOLDS).cast("bigint").alias("folds"),
                    F.lit(len(result.feature_cols)).cast("bigint").alias("n_features"),
                    (F.abs(F.col("again") - F.col("fold_auc")) < 1e-9).alias("fold_agrees"),
                    ((F.col("best") == F.col("cv_auc")) & (F.abs(F.col("mean_of_folds") - F.col("cv_auc")) < 1e-12)).alias("best_is_largest"),
                    (F.col("auc_score") > F.col("rule_auc") - AUC_MARGIN).alias("near_rule_auc")))


@register("standardized_features")
def q_standardized_features(spark, sf_dir):
    """M1 + M2: the pipeline's fitted assembler and scaler applied to the training part."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    train, _ = train_test(spark, sf_dir)
    feats = profile.feature_columns(train, FEATURE_EXCLUDE)
    prep = Pipeline(stages=training.numeric_pipeline(feats, LABEL).getStages()[:2]).fit(train)
    z = vector_to_array(F.col("features"))
    return rounded(prep.transform(train).select(
        *TX_KEY_COLS, *[z.getItem(i).alias(f"z_{c}") for i, c in enumerate(feats)]))


@register("fold_sizes")
def q_fold_sizes(spark, sf_dir):
    """M5: rows per (kind, fold, label) of the training part, hash and stratified folds."""
    train, _ = train_test(spark, sf_dir)
    both = training.add_folds(training.add_folds(train, training.CV_FOLDS, "fold", TX_KEY_COLS, col="hash"), training.CV_FOLDS, "fold", TX_KEY_COLS,
                              label=LABEL, col="stratified")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("fold")) for k in ("hash", "stratified")])
    return (both.select(LABEL, F.inline(kinds)).groupBy("kind", "fold", LABEL)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


# -- trees as tables (M3, M6, M7, M12), the search (M11) ------------------------------------

TREE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
TREE_DEPTH, TREE_BINS = 2, 64


def tree_rows(spark, sf_dir) -> DataFrame:
    """Label and features with few distinct values of the training part, written once."""
    train, _ = train_test(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    return train.select(*[F.col(c).cast("double").alias(c) for c in TREE_FEATURES], LABEL).checkpoint()


@register("forest_exact_tree")
def q_forest_exact_tree(spark, sf_dir):
    """M1, M3, M6: a forest of one tree, without bootstrap, on all features, as its nodes."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    rows = tree_rows(spark, sf_dir)
    one = training.forest(LABEL, num_trees=1, max_depth=TREE_DEPTH, bootstrap=False, featureSubsetStrategy="all", maxBins=TREE_BINS)
    model = Pipeline(stages=[VectorAssembler(inputCols=TREE_FEATURES, outputCol="features"), one]).fit(rows)
    nodes = trees.forest_nodes(model.stages[-1], spark, TREE_FEATURES)
    return rounded(nodes.select("place", "depth", "feature", "threshold", "n", F.get("stats", F.lit(1)).cast("bigint").alias("positives"), "gain"))


@register("tree_split_search")
def q_tree_split_search(spark, sf_dir):
    """M3: the same tree, its splits searched by aggregations."""
    return rounded(trees.grow_tree(tree_rows(spark, sf_dir), TREE_FEATURES, LABEL, TREE_DEPTH, TREE_BINS))


@register("forest_pruned")
def q_forest_pruned(spark, sf_dir):
    """That tree under a limit on splitting (a share of the rows), and the test rows that each leaf scores."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    rows = tree_rows(spark, sf_dir)
    limit = max(2, rows.count() // 10)
    one = training.forest(LABEL, num_trees=1, max_depth=TREE_DEPTH, bootstrap=False, featureSubsetStrategy="all", maxBins=TREE_BINS)
    assembler = VectorAssembler(inputCols=TREE_FEATURES, outputCol="features")
    pruned = trees.prune_forest(Pipeline(stages=[assembler, one]).fit(rows).stages[-1], spark, limit)
    _, test = train_test(spark, sf_dir)
    scored = training.score(pruned, assembler.transform(test.select(*[F.col(c).cast("double").alias(c) for c in TREE_FEATURES], LABEL)))
    return rounded(scored.groupBy("score", "prediction").agg(F.count("*").alias("n_rows"), F.sum(LABEL).cast("bigint").alias("positives")))


SEARCH_DRAWN, SEARCH_CV = 3, 3


@register("search_folds")
def q_search_folds(spark, sf_dir):
    """Grid points drawn from all 48 and their folds: held-out rows, and whether the search's F1 is that of the rows it scored."""
    from relearn.plans.jobs import search_scores
    scores = search_scores(labelled_docs(spark, sf_dir), "text", "quality", ["doc_id"], SEARCH_DRAWN, SEARCH_CV)
    names = list(training.SEARCH_SPACE)
    return scores.select("grid_id", *names, "fold", "n_rows", "positives", (F.abs(F.col("f1") - F.col("metric")) < 1e-9).alias("f1_agrees"))


# -- registry replay (R3-R7, E12) ---------------------------------------------------------

def monthly_runs(spark, sf_dir):
    """One retraining run per month of data: the candidate rule's metrics on that month."""
    tx = transactions(spark, sf_dir).withColumn("month", F.date_format("tx_timestamp", "yyyy-MM"))
    scored = tx.select("month", LABEL, scorers.candidate_score().alias("score"),
                       scorers.candidate_prediction().alias("prediction"))
    m = metrics.score_metrics(scored, LABEL, "score", "prediction", ["month"])
    return m.select(F.lit(MODEL_NAME).alias("model"),
                    F.concat(F.lit("run_"), F.col("month")).alias("run_id"),
                    F.to_timestamp(F.concat(F.col("month"), F.lit("-01"))).alias("ts"),
                    F.col("auc_score").alias("auc"), "accuracy", F.col("f1_weighted").alias("f1"))


@register("registry_replay")
def q_registry_replay(spark, sf_dir):
    """R3 + R7 + E12 over monthly retrains: version, champion AUC so far, promotion, gain."""
    replay = registry.replay_promotions(monthly_runs(spark, sf_dir))
    return rounded(replay.select("run_id", "version", "auc", "accuracy", "f1", "champion_auc",
                                 "promoted", "alias", "gain_pct"))


@register("champion_lookup")
def q_champion_lookup(spark, sf_dir):
    """R4 + R5 + R6: alias events of the replay -> current champion/challenger -> run metrics."""
    # The replay (one row per run) feeds four branches: materialise it once in
    # the shared checkpoint folder instead of re-reading the transactions.
    ensure_checkpoint_dir(spark)
    replay = registry.replay_promotions(monthly_runs(spark, sf_dir)).checkpoint(eager=True)
    # a second model as an older registry keeps it: the same versions, named by tags only
    older = F.lit("tagged_model").alias("model")
    events = replay.select("model", "version", "alias", "ts")
    tags = replay.select(older, "version", F.lit("alias").alias("key"), F.col("alias").alias("value"), "ts")
    versions = replay.select("model", "version", "run_id").unionByName(replay.select(older, "version", "run_id"))
    run_metrics = replay.select("run_id", F.expr("stack(3, 'auc', auc, 'accuracy', accuracy, 'f1', f1) "
                                                 "AS (key, value)"), "ts")
    aliases = registry.resolved_aliases(events, tags)
    out = registry.alias_metrics(aliases, versions, run_metrics, registry.CHAMPION).unionByName(
        registry.alias_metrics(aliases, versions, run_metrics, registry.CHALLENGER))
    return rounded(out)


@register("model_round_trip")
def q_model_round_trip(spark, sf_dir):
    """A fitted pipeline saved, registered, found by its alias, loaded, and its test scores against those of the fitted one."""
    from relearn.sources import files
    train, test = train_test(spark, sf_dir)
    root = checkpoint_path(spark, f"registry-{uuid.uuid4().hex}")
    reg = registry.Registry(spark, root)
    feats = profile.feature_columns(train, FEATURE_EXCLUDE)
    cached = training.cache_for_fitting(train.select(*TX_KEY_COLS, LABEL, *feats), TX_KEY_COLS)
    try:
        model = training.numeric_pipeline(feats, LABEL, num_trees=3, max_depth=4).fit(cached)
    finally:
        cached.unpersist()
    run_id = reg.start_run(reg.get_or_create_experiment("round_trip"), "fit")
    reg.compare_and_register(MODEL_NAME, run_id, files.save_model(model, f"{root}/models/{run_id}"), 0.5)
    found = reg.resolve(MODEL_NAME)
    again = files.load_model(found["path"])
    scored = training.score(model, test).select(LABEL, *feats, F.col("score").alias("fitted"), F.col("prediction").alias("fitted_prediction"))
    both = training.score(again, scored)
    different = (F.col("score") != F.col("fitted")) | (F.col("prediction") != F.col("fitted_prediction"))
    return both.agg(F.count("*").alias("n_rows"), F.count_if(different).alias("n_different"), F.sum(LABEL).cast("bigint").alias("positives")).select(
        F.lit(found["version"]).cast("bigint").alias("version"), "n_rows", "positives", "n_different")


# -- partitioned input (S1, J3) ---------------------------------------------------------------

PRUNED_FROM, PRUNED_TO = "1995-03", "1995-06"


def months(spark, sf_dir) -> tuple[DataFrame, str]:
    """Transactions laid out by month under the checkpoint folder, as a scan of that layout; and its folder."""
    folder = checkpoint_path(spark, f"months-{uuid.uuid4().hex}")
    tx = transactions(spark, sf_dir).withColumn("month", F.date_format(TIMESTAMP, "yyyy-MM"))
    tx.repartition("month").write.partitionBy("month").parquet(folder)
    return load_data(spark, folder), folder


@register("month_scan")
def q_month_scan(spark, sf_dir):
    """Some months of a table that is laid out by month; the other months' files are not read."""
    table, _ = months(spark, sf_dir)
    month = F.date_format("month", "yyyy-MM") if dict(table.dtypes)["month"] != "string" else F.col("month")
    some = table.where((F.col("month") >= PRUNED_FROM) & (F.col("month") < PRUNED_TO))
    return some.groupBy(month.alias("month")).agg(F.count("*").alias("n_rows"), F.sum(LABEL).cast("bigint").alias("positives"),
                                                  F.countDistinct(F.col("_metadata.file_path")).alias("n_files"))


# -- text: character counts and the text forest (M9, M10) ---------------------------------

def char_count_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """M9: (id, ch, n) for every character of every text, counted as they stream by (a few dozen rows a text)."""
    chars = df.select(id_col, F.explode(training.char_tokens(text_col)).alias("ch"))
    return chars.groupBy(id_col, "ch").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("url_char_counts")
def q_url_char_counts(spark, sf_dir):
    """M9: character 1-gram counts of every URL."""
    return char_count_rows(read_table(spark, sf_dir, "pages"), "page_id", "url")


@register("doc_char_counts")
def q_doc_char_counts(spark, sf_dir):
    """M9 on whole documents: character counts of every document."""
    return char_count_rows(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def labelled_docs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.join(read_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@register("text_forest_fit")
def q_text_forest_fit(spark, sf_dir):
    """M10 + E6: char-count forest (35 trees, depth 9) on a 70/30 split of labelled documents."""
    split = sampling.weighted_split(labelled_docs(spark, sf_dir), (0.7, 0.3), "split", [F.col("doc_id")])
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    cached = training.cache_for_fitting(train, ["doc_id"])
    try:
        model = training.text_pipeline("text", "quality").fit(cached)
    finally:
        cached.unpersist()
    preds = model.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
    out = metrics.evaluate_models(preds, "quality", {"candidate": "prediction"})
    n = preds.agg(F.count("*").alias("n_test"), F.sum("quality").cast("bigint").alias("positives"))
    return (out.crossJoin(n)      # one row each
            .select("n_test", "positives", F.lit(training.URL_NUM_TREES).cast("bigint").alias("n_trees"),
                    # a constant has 0.5
                    (F.col("auc_label") >= 0.5 + AUC_MARGIN).alias("beats_constant")))


# -- profile and registry functions on table data (P1, P4, P5, R1, R2, R8, R9) -------------

@register("column_profile")
def q_column_profile(spark, sf_dir):
    """P1 + P4 + P5: type, whether a feature, and null count of every column of lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    feats = profile.feature_columns(li, ["l_orderkey", "l_partkey", "l_suppkey"])
    types = spark.createDataFrame([(f.name, f.dataType.simpleString(), f.name in feats) for f in li.schema.fields],
                                  "column_name string, type string, is_feature boolean")
    rows = li.agg(F.count("*").alias("n_rows"))
    return profile.null_counts(li, only_nonzero=False).join(types, "column_name").crossJoin(rows)     # a row per column


@register("stage_aliases")
def q_stage_aliases(spark, sf_dir):
    """Statuses and event types read as stages of an older registry, with their aliases and rows."""
    stages = read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging").otherwise(F.col("o_orderstatus")).alias("stage"))
    stages = stages.unionByName(read_table(spark, sf_dir, "events").select(F.initcap("event_type").alias("stage")))
    return stages.groupBy("stage").agg(F.count("*").alias("n_rows")).withColumn("alias", registry.stage_alias("stage"))


@register("version_descriptions")
def q_version_descriptions(spark, sf_dir):
    """Every order as a version, described by its priority or the latest event with its number."""
    orders, events = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "events")
    versions = orders.select(F.lit("m").alias("model"), F.col("o_orderkey").alias("version"), F.col("o_orderpriority").alias("description"))
    updates = events.select(F.lit("m").alias("model"), F.col("user_id").alias("version"), F.col("event_type").alias("description"), "ts")
    out = registry.current_descriptions(versions, updates)
    return out.groupBy("description").agg(F.count("*").alias("n_versions"), F.sum("version").cast("bigint").alias("versions"))


@register("new_runs")
def q_new_runs(spark, sf_dir):
    """R1 + R2 + R3 + R7: months without a run become runs: numbered after the existing versions, decided against the champion.

    Months before 1998 are the existing table (their promotions replayed), the later ones are new.
    """
    ensure_checkpoint_dir(spark)
    runs = monthly_runs(spark, sf_dir).checkpoint(eager=True)
    old = registry.replay_promotions(runs.where(F.year("ts") < 1998))
    new = runs.where(F.year("ts") >= 1998).join(old.select("run_id"), "run_id", "left_anti")
    numbered = registry.next_versions(old.select("model", "version"), new)
    champion = old.where("promoted").groupBy("model").agg(F.max_by("auc", "version").alias("auc"))
    out = registry.promotion_decision(numbered, champion)
    return rounded(out.select("run_id", "version", "auc", "champion_auc", "promoted", "alias", "gain_pct"))
