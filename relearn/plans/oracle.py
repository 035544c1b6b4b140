"""Oracle SQL: the registered queries written as plain SQL for DuckDB.

The driver runs each string against views named after the test tables and
compares rows, column names and values with the Spark result.  The SQL is an
independent formulation (CTEs, window functions), not generated from the
Spark plans; a few repeated fragments (the hash uniform, the transactions
view) are shared through the helpers below.
"""

from __future__ import annotations

from relearn.operators import bootstrap, scorers, training
from relearn.plans import queries as Q
from relearn.sources import tables as T

ORACLE: dict[str, str] = {}

TX_KEY_SQL = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, "
              "CAST(l_quantity AS INTEGER)")


def dbl(x: float) -> str:
    """A double literal that parses to exactly the Python float."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def U(seed: str, keys: str) -> str:
    """Hash uniform: first 32 bits of md5('seed|k1|k2..') / 2^32."""
    cast_keys = ", ".join(f"coalesce(CAST({k.strip()} AS VARCHAR), chr(1))" for k in _split_keys(keys))
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', '{seed}', {cast_keys})), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")


def _split_keys(keys: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in keys:
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur += ch
    out.append(cur)
    return [k for k in out if k.strip()]


def r6(expr: str) -> str:
    return f"round({expr}, {Q.DECIMALS})"


TX_SQL = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(l_quantity AS INTEGER) AS l_qty_key,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate AS tx_timestamp,
       CAST(((l_quantity >= {T.FRAUD_MIN_QUANTITY} AND l_discount >= {dbl(T.FRAUD_MIN_DISCOUNT)})
             <> ({U('noise', TX_KEY_SQL)} < {dbl(T.LABEL_NOISE)})) AS INTEGER) AS tx_fraud
FROM lineitem"""

_w = Q.SPLIT_WEIGHTS
SPLIT_SQL = f"""
SELECT *, CASE WHEN {U(Q.SPLIT_SEED, TX_KEY_SQL)} < {dbl(_w[0] / (_w[0] + _w[1]))}
               THEN 'train' ELSE 'test' END AS split
FROM ({TX_SQL})"""

PRED_BASE = f"CAST(l_quantity >= {scorers.BASE_MIN_QUANTITY} AS INTEGER)"
PRED_CAND = (f"CAST(l_quantity >= {scorers.CANDIDATE_MIN_QUANTITY} "
             f"AND l_discount >= {dbl(scorers.CANDIDATE_MIN_DISCOUNT)} AS INTEGER)")
SCORE_BASE = "CAST(l_quantity AS DOUBLE)"
SCORE_CAND = f"round(l_quantity * l_discount, {scorers.SCORE_DECIMALS})"


def counts_sql(y: str, p: str) -> str:
    return (f"CAST(count_if({y} = 1 AND {p} = 1) AS BIGINT) AS tp, "
            f"CAST(count_if({y} = 0 AND {p} = 1) AS BIGINT) AS fp, "
            f"CAST(count_if({y} = 1 AND {p} = 0) AS BIGINT) AS fn, "
            f"CAST(count_if({y} = 0 AND {p} = 0) AS BIGINT) AS tn")


def ratio0(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0.0)"


def label_metrics_sql(src: str, keys: str) -> str:
    """Metric columns from a relation with tp, fp, fn, tn (keys kept)."""
    k = f"{keys}, " if keys else ""
    return f"""
SELECT {k}tp, fp, fn, tn, tp + fp + fn + tn AS n,
       {r6(ratio0('tp', 'tp + fp'))} AS precision,
       {r6(ratio0('tp', 'tp + fn'))} AS recall,
       {r6(ratio0('2 * tp', '2 * tp + fp + fn'))} AS f1_binary,
       {r6("(CAST(tp AS DOUBLE) / nullif(tp + fn, 0) + CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) / 2")} AS auc_label,
       {r6(ratio0('tp + tn', 'tp + fp + fn + tn'))} AS accuracy,
       {r6(f1_weighted_sql())} AS f1_weighted
FROM ({src})"""


def f1_weighted_sql() -> str:
    p1, r1 = ratio0("tp", "tp + fp"), ratio0("tp", "tp + fn")
    p0, r0 = ratio0("tn", "tn + fn"), ratio0("tn", "tn + fp")

    def fm(p, r):
        return f"(CASE WHEN {p} + {r} = 0 THEN 0.0 ELSE 2 * {p} * {r} / ({p} + {r}) END)"
    n = "CAST(tp + fp + fn + tn AS DOUBLE)"
    return (f"CASE WHEN {n} > 0 THEN {fm(p1, r1)} * (tp + fn) / {n} + {fm(p0, r0)} * (tn + fp) / {n} "
            f"ELSE 0.0 END")


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


register("model_metrics", label_metrics_sql(f"""
SELECT 'base' AS model, {counts_sql('tx_fraud', PRED_BASE)} FROM ({SPLIT_SQL}) WHERE split = 'test'
UNION ALL
SELECT 'candidate' AS model, {counts_sql('tx_fraud', PRED_CAND)} FROM ({SPLIT_SQL}) WHERE split = 'test'
""", "model"))


# -- profiling ------------------------------------------------------------------

TX_KEY_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_qty_key"
TX_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_qty_key", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
           "tx_timestamp", "tx_fraud"]
TS_TEXT = "strftime(tx_timestamp, '%Y-%m-%d %H:%M:%S') AS tx_timestamp"

register("row_count", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem")

register("first_rows", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_qty_key, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, {TS_TEXT}, tx_fraud
FROM ({TX_SQL}) ORDER BY {TX_KEY_COLS} LIMIT 5""")

register("null_counts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count "
    f"FROM ({SPLIT_SQL}) WHERE split = 'train'" for c in TX_COLS))

register("label_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(tx_fraud) AS BIGINT) AS positives,
       {r6('avg(CAST(tx_fraud AS DOUBLE)) * 100')} AS positive_rate_pct
FROM ({TX_SQL})""")

# -- label map, sampling, splits --------------------------------------------------

register("label_encoding", """
SELECT o_orderkey, o_orderstatus,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS INTEGER) AS label_enc
FROM orders""")

register("sample_rows", f"""
SELECT o_orderkey, o_totalprice FROM orders
WHERE {U('sample', 'o_orderkey')} < {dbl(Q.SAMPLE_FRACTION)}""")

register("sample_complement", f"""
SELECT o_orderkey, o_totalprice FROM orders
WHERE {U('demo_split', 'o_orderkey')} >= {dbl(Q.DEMO_TRAIN_FRACTION)}""")

register("split_assign", f"SELECT {TX_KEY_COLS}, split FROM ({SPLIT_SQL})")

register("split_sizes", f"SELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM ({SPLIT_SQL}) GROUP BY split")

register("url_sample", f"""
SELECT page_id, url FROM pages WHERE {U('sample', 'page_id')} < {dbl(Q.SAMPLE_FRACTION)}""")

# -- A/B on one table -------------------------------------------------------------

AB_SQL = f"""
SELECT *, CASE WHEN {U(Q.ARM_SEED, TX_KEY_SQL)} < {dbl(Q.TRAFFIC_SPLIT)}
               THEN 'challenger' ELSE 'champion' END AS ab_group
FROM ({SPLIT_SQL}) WHERE split = 'test'"""

AB_SCORED_SQL = f"""
SELECT *, CASE WHEN ab_group = 'challenger' THEN {SCORE_CAND} ELSE {SCORE_BASE} END AS score,
          CASE WHEN ab_group = 'challenger' THEN {PRED_CAND} ELSE {PRED_BASE} END AS prediction
FROM ({AB_SQL})"""


def auc_sql(src: str, group: str, y: str = "tx_fraud") -> str:
    """Exact ROC AUC per group: running sum of negatives below each distinct score."""
    return f"""
SELECT {group}, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
       CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
            CAST(sum(CAST(pos AS HUGEINT) * (2 * below + neg)) AS DOUBLE)
            / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc_score
FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY score
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {group}, score, count_if({y} = 1) AS pos, count_if({y} = 0) AS neg
            FROM ({src}) WHERE score IS NOT NULL GROUP BY {group}, score))
GROUP BY {group}"""


def score_metrics_sql(src: str, group: str, y: str = "tx_fraud") -> str:
    """auc_score, accuracy, f1_weighted, sample_size per group (unrounded)."""
    return f"""
SELECT c.{group}, a.auc_score,
       {ratio0('tp + tn', 'tp + fp + fn + tn')} AS accuracy,
       {f1_weighted_sql()} AS f1_weighted,
       tp + fp + fn + tn AS sample_size
FROM (SELECT {group}, {counts_sql(y, 'prediction')} FROM ({src}) WHERE score IS NOT NULL GROUP BY {group}) c
LEFT JOIN ({auc_sql(src, group, y)}) a ON c.{group} = a.{group}"""


register("ab_assign", f"SELECT {TX_KEY_COLS}, ab_group FROM ({AB_SQL})")

register("ab_arm_sizes", f"""
SELECT CAST(count_if(ab_group = 'champion') AS BIGINT) AS champion_count,
       CAST(count_if(ab_group = 'challenger') AS BIGINT) AS challenger_count
FROM ({AB_SQL})""")

register("ab_arm_rows", f"""
SELECT {TX_KEY_COLS}, l_quantity, l_extendedprice, l_discount, l_tax, {TS_TEXT}, tx_fraud
FROM ({AB_SQL}) WHERE ab_group = 'challenger'""")

ARM_METRICS_SQL = f"""
SELECT ab_group, auc_score AS auc, accuracy, f1_weighted AS f1, sample_size
FROM ({score_metrics_sql(AB_SCORED_SQL, 'ab_group')})"""

register("ab_arm_metrics", f"""
SELECT ab_group, {r6('auc')} AS auc, {r6('accuracy')} AS accuracy, {r6('f1')} AS f1, sample_size
FROM ({ARM_METRICS_SQL})""")


def _arm(a: str, m: str) -> str:
    return f"max(CASE WHEN ab_group = '{a}' THEN {m} END)"


register("ab_compare", f"""
SELECT {r6('ch_auc')} AS champion_auc, {r6('ch_accuracy')} AS champion_accuracy,
       {r6('ch_f1')} AS champion_f1, CAST(coalesce(ch_n, 0) AS BIGINT) AS champion_sample_size,
       {r6('cl_auc')} AS challenger_auc, {r6('cl_accuracy')} AS challenger_accuracy,
       {r6('cl_f1')} AS challenger_f1, CAST(coalesce(cl_n, 0) AS BIGINT) AS challenger_sample_size,
       {r6('cl_auc - ch_auc')} AS auc_improvement,
       {r6('cl_accuracy - ch_accuracy')} AS accuracy_improvement,
       {r6('cl_f1 - ch_f1')} AS f1_improvement,
       CASE WHEN cl_auc - ch_auc > 0 THEN 'challenger' ELSE 'champion' END AS winner
FROM (SELECT {_arm('champion', 'auc')} AS ch_auc, {_arm('champion', 'accuracy')} AS ch_accuracy,
             {_arm('champion', 'f1')} AS ch_f1, {_arm('champion', 'sample_size')} AS ch_n,
             {_arm('challenger', 'auc')} AS cl_auc, {_arm('challenger', 'accuracy')} AS cl_accuracy,
             {_arm('challenger', 'f1')} AS cl_f1, {_arm('challenger', 'sample_size')} AS cl_n
      FROM ({ARM_METRICS_SQL}))""")

_sides = {"champion": "ch", "challenger": "cl"}
_AB_VALUES = {f"{a}_{m}": f"{p}_{m}" for a, p in _sides.items() for m in ("auc", "accuracy", "f1")}
_AB_VALUES |= {f"{a}_sample_size": f"CAST(coalesce({p}_n, 0) AS DOUBLE)" for a, p in _sides.items()}
_AB_VALUES |= {f"{m}_improvement": f"cl_{m} - ch_{m}" for m in ("auc", "accuracy", "f1")}
_AB_TEXTS = {"traffic_split": f"'{Q.TRAFFIC_SPLIT}'", "winner": "CASE WHEN cl_auc - ch_auc > 0 THEN 'challenger' ELSE 'champion' END",
             "champion_rows": "CAST(coalesce(ch_n, 0) AS BIGINT)", "challenger_rows": "CAST(coalesce(cl_n, 0) AS BIGINT)",
             "improvement_message": "CASE WHEN cl_auc - ch_auc > 0 THEN printf('challenger better by %.4f AUC', cl_auc - ch_auc) "
                                    "ELSE printf('champion better by %.4f AUC', coalesce(ch_auc - cl_auc, 0)) END"}
register("ab_record", f"""
WITH c AS (SELECT {', '.join(f"{_arm(a, m if m != 'n' else 'sample_size')} AS {p}_{m}" for a, p in _sides.items() for m in ("auc", "accuracy", "f1", "n"))}
           FROM ({ARM_METRICS_SQL}))
""" + " UNION ALL ".join([f"SELECT '{k}' AS key, NULL AS value, {r6(v)} AS number FROM c" for k, v in _AB_VALUES.items()]
                         + [f"SELECT '{k}', CAST({v} AS VARCHAR), NULL FROM c" for k, v in _AB_TEXTS.items()]))

# -- score metrics ----------------------------------------------------------------


def stacked_sql(src: str) -> str:
    return f"""
SELECT 'base' AS model, tx_fraud, {SCORE_BASE} AS score, {PRED_BASE} AS prediction FROM ({src})
UNION ALL
SELECT 'candidate' AS model, tx_fraud, {SCORE_CAND} AS score, {PRED_CAND} AS prediction FROM ({src})"""


register("auc_exact", f"""
SELECT model, pos, neg, {r6('auc_score')} AS auc_score FROM ({auc_sql(stacked_sql(TX_SQL), 'model')})""")

register("score_metrics", f"""
SELECT model, {r6('auc_score')} AS auc_score, {r6('accuracy')} AS accuracy,
       {r6('f1_weighted')} AS f1_weighted, sample_size
FROM ({score_metrics_sql(stacked_sql(f"SELECT * FROM ({SPLIT_SQL}) WHERE split = 'test'"), 'model')})""")


# -- paired bootstrap and t-test ---------------------------------------------------

CELLS_SQL = f"""
SELECT {', '.join(f'CAST(count_if(cell = {i}) AS BIGINT) AS c{i}' for i in range(8))}
FROM (SELECT tx_fraud * 4 + {PRED_BASE} * 2 + {PRED_CAND} AS cell
      FROM ({SPLIT_SQL}) WHERE split = 'test')"""

_cum = ["c0"]
for _i in range(1, 7):
    _cum.append(_cum[-1] + f" + c{_i}")
BOOT_CASE = "CASE " + " ".join(f"WHEN pos < q{i} THEN {i}" for i in range(7)) + " ELSE 7 END"

BOOT_COUNTS_SQL = f"""
SELECT CAST(iteration AS BIGINT) AS iteration,
       {', '.join(f'CAST(count_if(cell = {i}) AS BIGINT) AS k{i}' for i in range(8))}
FROM (SELECT id // n AS iteration, {BOOT_CASE} AS cell
      FROM (SELECT t.id, q.*,
                   CAST(CAST(('0x' || substr(md5(concat_ws('|', '{Q.BOOT_SEED}', CAST(t.id AS VARCHAR))), 1, 15))
                             AS BIGINT)::HUGEINT * n // 1152921504606846976 AS BIGINT) AS pos
            FROM (SELECT c0 + c1 + c2 + c3 + c4 + c5 + c6 + c7 AS n,
                         {', '.join(f'{e} AS q{i}' for i, e in enumerate(_cum))}
                  FROM ({CELLS_SQL})) q,
                 range(0, {Q.BOOT_ITERATIONS} * q.n) t(id)))
GROUP BY iteration"""

register("bootstrap_cells", BOOT_COUNTS_SQL)


def _model_counts(model: str) -> str:
    from relearn.operators.bootstrap import MODEL_CELLS
    cells = MODEL_CELLS[model]
    return ", ".join(f"{' + '.join(f'k{i}' for i in idx)} AS {name}" for name, idx in cells.items())


BOOT_SCORES_SQL = f"""
SELECT iteration, model,
       {ratio0('2 * tp', '2 * tp + fp + fn')} AS f1,
       {ratio0('tp', 'tp + fp')} AS precision,
       {ratio0('tp', 'tp + fn')} AS recall,
       (CAST(tp AS DOUBLE) / nullif(tp + fn, 0) + CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) / 2 AS auc
FROM (SELECT iteration, 'base' AS model, {_model_counts('base')} FROM ({BOOT_COUNTS_SQL})
      UNION ALL
      SELECT iteration, 'candidate' AS model, {_model_counts('candidate')} FROM ({BOOT_COUNTS_SQL}))"""

register("bootstrap_scores", f"""
SELECT iteration, model, {r6('f1')} AS f1, {r6('precision')} AS precision, {r6('recall')} AS recall,
       {r6('auc')} AS auc
FROM ({BOOT_SCORES_SQL})""")


def p_even_sql(t: str, dof: str) -> str:
    """Two-sided t p-value for even dof (A&S 26.7.4, coefficients by lgamma)."""
    dof = f"CAST({dof} AS BIGINT)"
    theta = f"atan(abs({t}) / sqrt({dof}))"
    series = (f"list_sum(list_transform(range(0, ({dof} - 2) // 2 + 1), lambda k: "
              f"exp(lgamma(2 * k + 1) - 2 * lgamma(k + 1) - k * ln(4)) * pow(cos({theta}), 2 * k)))")
    return f"greatest(0.0, least(1.0, 1 - sin({theta}) * {series}))"


def ttest_sql(scores: str, metrics, alpha: float) -> str:
    unpivot = "\nUNION ALL\n".join(
        f"SELECT model, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({scores})" for m in metrics)
    return f"""
SELECT metric, t AS t_statistic, p AS p_value, d AS effect_size,
       coalesce(p < {dbl(alpha)}, false) AS is_significant,
       base_mean, candidate_mean, candidate_mean - base_mean AS improvement
FROM (SELECT *, CASE WHEN t IS NULL THEN NULL WHEN isinf(t) THEN 0.0
                     ELSE {p_even_sql('t', 'n_base + n_candidate - 2')} END AS p
      FROM (SELECT *,
                   CASE WHEN se > 0 THEN (base_mean - candidate_mean) / se
                        WHEN se = 0 AND base_mean > candidate_mean THEN CAST('inf' AS DOUBLE)
                        WHEN se = 0 AND base_mean < candidate_mean THEN CAST('-inf' AS DOUBLE) END AS t,
                   CASE WHEN sqrt((var_base + var_candidate) / 2) > 0
                        THEN abs(candidate_mean - base_mean) / sqrt((var_base + var_candidate) / 2) END AS d
            FROM (SELECT *, sqrt(((n_base - 1) * var_base + (n_candidate - 1) * var_candidate)
                                 / (n_base + n_candidate - 2) * (1 / n_base + 1 / n_candidate)) AS se
                  FROM (SELECT metric,
                               CAST(count(value) FILTER (WHERE model = 'base') AS DOUBLE) AS n_base,
                               avg(value) FILTER (WHERE model = 'base') AS base_mean,
                               var_samp(value) FILTER (WHERE model = 'base') AS var_base,
                               CAST(count(value) FILTER (WHERE model = 'candidate') AS DOUBLE) AS n_candidate,
                               avg(value) FILTER (WHERE model = 'candidate') AS candidate_mean,
                               var_samp(value) FILTER (WHERE model = 'candidate') AS var_candidate
                        FROM ({unpivot}) GROUP BY metric))))"""


TTEST_SQL = ttest_sql(BOOT_SCORES_SQL, ("f1", "precision"), Q.ALPHA)

register("bootstrap_ttest", f"""
SELECT metric, {r6('t_statistic')} AS t_statistic, {r6('p_value')} AS p_value,
       {r6('effect_size')} AS effect_size, is_significant, {r6('base_mean')} AS base_mean,
       {r6('candidate_mean')} AS candidate_mean, {r6('improvement')} AS improvement
FROM ({TTEST_SQL})""")

register("deploy_decision", f"""
SELECT is_significant AND coalesce(improvement > 0, false) AS should_deploy,
       is_significant AS f1_significant, {r6('improvement')} AS f1_improvement,
       {r6('p_value')} AS f1_p_value
FROM ({TTEST_SQL}) WHERE metric = 'f1'""")


# -- registry replay ------------------------------------------------------------------

MONTH_RUNS_SQL = f"""
SELECT 'run_' || month AS run_id, month, auc_score AS auc, accuracy, f1_weighted AS f1
FROM ({score_metrics_sql(f'''SELECT strftime(tx_timestamp, '%Y-%m') AS month, tx_fraud,
                                    {SCORE_CAND} AS score, {PRED_CAND} AS prediction FROM ({TX_SQL})''',
                         'month')})"""

REPLAY_SQL = f"""
SELECT run_id, CAST(version AS INTEGER) AS version, auc, accuracy, f1, champion_auc,
       (champion_auc IS NULL OR coalesce(auc > champion_auc, false)) AS promoted,
       (auc - champion_auc) / nullif(champion_auc, 0) * 100 AS gain_pct
FROM (SELECT *, row_number() OVER (ORDER BY month, run_id) AS version,
             max(auc) OVER (ORDER BY month, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_auc
      FROM ({MONTH_RUNS_SQL}))"""

TRAIN_SQL = f"SELECT * FROM ({SPLIT_SQL}) WHERE split = 'train'"
_FEATS = Q.TX_FEATURES
_z = ",\n       ".join(
    f"{r6(f'CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) * (1.0 / s_{c}) END')} AS z_{c}" for c in _FEATS)
_moments = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _FEATS)
register("standardized_features", f"""
WITH t AS ({TRAIN_SQL}),
     s AS (SELECT {_moments} FROM t)
SELECT {TX_KEY_COLS},
       {_z}
FROM t CROSS JOIN s""")

_FOLD_U = U("fold", TX_KEY_COLS)
_K = training.CV_FOLDS
register("fold_sizes", f"""
WITH t AS ({TRAIN_SQL}),
     f AS (SELECT 'hash' AS kind, CAST(least(floor({_FOLD_U} * {_K}), {_K - 1}) AS INTEGER) AS fold, tx_fraud FROM t
           UNION ALL
           SELECT 'stratified' AS kind,
                  CAST((row_number() OVER (PARTITION BY tx_fraud ORDER BY {_FOLD_U}, {TX_KEY_COLS}) - 1) % {_K}
                       AS INTEGER) AS fold, tx_fraud
           FROM t)
SELECT kind, fold, tx_fraud, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY kind, fold, tx_fraud""")

register("registry_replay", f"""
SELECT run_id, version, {r6('auc')} AS auc, {r6('accuracy')} AS accuracy, {r6('f1')} AS f1,
       {r6('champion_auc')} AS champion_auc, promoted,
       CASE WHEN promoted THEN 'champion' ELSE 'challenger' END AS alias, {r6('gain_pct')} AS gain_pct
FROM ({REPLAY_SQL})""")

register("champion_lookup", f"""
SELECT model, alias, version, run_id, {r6('auc')} AS auc,
       {r6('accuracy')} AS accuracy, {r6('f1')} AS f1
FROM (SELECT *, CASE WHEN promoted THEN 'champion' ELSE 'challenger' END AS alias,
             row_number() OVER (PARTITION BY promoted ORDER BY version DESC) AS rn
      FROM ({REPLAY_SQL})),
     (VALUES ('fraud_detection_model'), ('tagged_model')) m(model)
WHERE rn = 1""")


register("model_round_trip", f"""
SELECT CAST(1 AS BIGINT) AS version, count(*) AS n_rows, CAST(sum(tx_fraud) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS n_different
FROM ({SPLIT_SQL}) WHERE split = 'test'""")

register("month_scan", f"""
SELECT strftime(tx_timestamp, '%Y-%m') AS month, count(*) AS n_rows, CAST(sum(tx_fraud) AS BIGINT) AS positives, CAST(1 AS BIGINT) AS n_files
FROM ({TX_SQL}) WHERE strftime(tx_timestamp, '%Y-%m') >= '{Q.PRUNED_FROM}' AND strftime(tx_timestamp, '%Y-%m') < '{Q.PRUNED_TO}' GROUP BY 1""")

# -- text ---------------------------------------------------------------------------------


def char_counts_sql(src: str, id_col: str, text_col: str) -> str:
    return f"""
SELECT {id_col}, ch, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {id_col}, unnest(string_split(regexp_replace(lower({text_col}), '\\s\\s+', ' ', 'g'), '')) AS ch
      FROM ({src}))
WHERE ch <> ''
GROUP BY {id_col}, ch"""


register("url_char_counts", char_counts_sql("SELECT * FROM pages", "page_id", "url"))
register("doc_char_counts", char_counts_sql("SELECT * FROM documents", "doc_id", "text"))


# -- trees and the search -------------------------------------------------------------------

_TF = Q.TREE_FEATURES


def splits_sql(src: str) -> str:
    """Best split per place of ``src`` (place, features, y): every threshold between distinct values of the training part."""
    gini = lambda n, p: f"(1 - pow({p} / {n}, 2) - pow(({n} - {p}) / {n}, 2))"
    return f"""
SELECT place, feature, threshold, gain FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY gain DESC, feature_no, threshold) AS best FROM (
    SELECT place, feature, feature_no, threshold,
           {gini('a', 'ap')} - l / a * {gini('l', 'lp')} - (a - l) / a * {gini('(a - l)', '(ap - lp)')} AS gain
    FROM (SELECT c.place, c.feature, list_position({_TF!r}, c.feature) AS feature_no, cuts.threshold,
                 CAST(sum(n) OVER w AS DOUBLE) AS l, CAST(sum(pos) OVER w AS DOUBLE) AS lp,
                 CAST(sum(n) OVER (PARTITION BY place, c.feature) AS DOUBLE) AS a, CAST(sum(pos) OVER (PARTITION BY place, c.feature) AS DOUBLE) AS ap
          FROM (SELECT place, feature, value, count(*) AS n, sum(y) AS pos
                FROM (SELECT place, y, feature, value FROM ({src}) UNPIVOT (value FOR feature IN ({', '.join(_TF)}))) GROUP BY place, feature, value) c
          JOIN cuts ON c.feature = cuts.feature AND c.value = cuts.value
          WINDOW w AS (PARTITION BY place, c.feature ORDER BY c.value))
    WHERE threshold IS NOT NULL AND a > l) WHERE gain > 0) WHERE best = 1"""


def tree_sql(limit: str = "2") -> str:
    """CTEs t (training part), cuts, and the levels' rows r0, r1, r2 and splits s0, s1; places with fewer than ``limit`` rows aren't split."""
    value = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in _TF) + " END"
    ctes = [f"t AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _TF)}, tx_fraud AS y FROM ({TRAIN_SQL}))",
            f"""cuts AS (SELECT feature, value, (value + lead(value) OVER (PARTITION BY feature ORDER BY value)) / 2 AS threshold
                  FROM (SELECT DISTINCT feature, value FROM (SELECT {', '.join(_TF)} FROM t) UNPIVOT (value FOR feature IN ({', '.join(_TF)}))))""",
            "r0 AS (SELECT *, CAST(1 AS BIGINT) AS place FROM t)"]
    for d in range(Q.TREE_DEPTH):
        ctes.append(f"s{d} AS ({splits_sql(f'SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY place) AS size FROM r{d}) WHERE size >= {limit}')})")
        ctes.append(f"r{d + 1} AS (SELECT {', '.join(_TF)}, y, 2 * place + CASE WHEN {value} <= threshold THEN 0 ELSE 1 END AS place FROM r{d} JOIN s{d} USING (place))")
    return ",\n     ".join(ctes)


def levels_sql(first: str = "s0", second: str = "s1", within: str = "true") -> str:
    """Nodes of the tree with the splits of the relations given; ``within`` says which places of r1 and r2 are nodes."""
    parts = []
    for d, splits in ((0, first), (1, second), (2, None)):
        split = f"LEFT JOIN {splits} USING (place)" if splits else "CROSS JOIN (SELECT NULL AS feature, NULL AS threshold, NULL AS gain)"
        parts.append(f"SELECT place, CAST({d} AS INTEGER) AS depth, feature, threshold, gain, n, positives FROM "
                     f"(SELECT place, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM r{d} GROUP BY place) {split} WHERE {within if d else 'true'}")
    return (f"SELECT place, depth, CAST(feature AS VARCHAR) AS feature, {r6('CAST(threshold AS DOUBLE)')} AS threshold, n, positives, "
            f"{r6('CAST(gain AS DOUBLE)')} AS gain FROM ({' UNION ALL '.join(parts)})")


register("tree_split_search", f"WITH {tree_sql()} {levels_sql()}")

# MLlib joins sibling leaves that predict the same class: k0 and k1 are the splits that stay.
_MERGED = f"""{tree_sql()},
     p AS (SELECT place, count(*) AS n, avg(y) AS p, 2 * sum(y) > count(*) AS c FROM (SELECT place, y FROM r0 UNION ALL SELECT place, y FROM r1 UNION ALL SELECT place, y FROM r2) GROUP BY place),
     k1 AS (SELECT s1.* FROM s1 JOIN p a ON a.place = 2 * s1.place JOIN p b ON b.place = 2 * s1.place + 1 WHERE a.c <> b.c),
     k0 AS (SELECT s0.* FROM s0 JOIN p a ON a.place = 2 JOIN p b ON b.place = 3 WHERE a.c <> b.c OR EXISTS (SELECT 1 FROM k1))"""
register("forest_exact_tree", f"WITH {_MERGED} {levels_sql('k0', 'k1', 'place // 2 IN (SELECT place FROM k0 UNION ALL SELECT place FROM k1)')}")

_GOES = [f"CASE WHEN (CASE {s}.feature " + " ".join(f"WHEN '{c}' THEN x.{c}" for c in _TF) + f" END) <= {s}.threshold THEN 0 ELSE 1 END" for s in ("q0", "q1")]
register("forest_pruned", f"""
WITH {_MERGED}, q0 AS (SELECT k0.* FROM k0 JOIN p USING (place) WHERE n >= (SELECT greatest(2, count(*) // 10) FROM t)),
     q1 AS (SELECT k1.* FROM k1 JOIN p USING (place) WHERE n >= (SELECT greatest(2, count(*) // 10) FROM t) AND EXISTS (SELECT 1 FROM q0)),
     x AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _TF)}, tx_fraud AS y FROM ({SPLIT_SQL}) WHERE split = 'test'),
     one AS (SELECT x.*, CASE WHEN q0.place IS NULL THEN 1 ELSE 2 + {_GOES[0]} END AS place FROM x LEFT JOIN q0 ON true),
     two AS (SELECT x.y, CASE WHEN q1.place IS NULL THEN x.place ELSE 2 * x.place + {_GOES[1]} END AS place FROM one x LEFT JOIN q1 ON x.place = q1.place)
SELECT {r6('p')} AS score, CAST(p > 0.5 AS INTEGER) AS prediction, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS positives
FROM two JOIN p USING (place) GROUP BY p""")

_space = {n: [str(v) for v in vs] for n, vs in training.SEARCH_SPACE.items()}
_grid = " CROSS JOIN ".join(f"(SELECT unnest({vs!r}) AS {n}, unnest(range({len(vs)})) AS i{k})" for k, (n, vs) in enumerate(_space.items()))
_place = "0"
for _k, _vs in enumerate(_space.values()):
    _place = f"({_place} * {len(_vs)} + i{_k})"
register("search_folds", f"""
WITH g AS (SELECT CAST({_place} AS INTEGER) AS grid_id, {', '.join(_space)} FROM {_grid}),
     drawn AS (SELECT * FROM g ORDER BY {U('search', 'grid_id')}, grid_id LIMIT {Q.SEARCH_DRAWN}),
     f AS (SELECT quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY {U('fold', 'doc_id')}, doc_id) - 1) % {Q.SEARCH_CV} AS INTEGER) AS fold
           FROM documents JOIN labels USING (doc_id)),
     s AS (SELECT fold, count(*) AS n_rows, CAST(sum(quality) AS BIGINT) AS positives FROM f GROUP BY fold)
SELECT grid_id, {', '.join(_space)}, fold, n_rows, positives, true AS f1_agrees FROM drawn CROSS JOIN s""")

register("sample_exact", f"""
SELECT {TX_KEY_COLS} FROM (SELECT *, row_number() OVER (ORDER BY {U('sample', TX_KEY_COLS)}, {TX_KEY_COLS}) AS place, count(*) OVER () AS n FROM ({TX_SQL}))
WHERE place <= round_even({dbl(Q.SAMPLE_FRACTION)} * n, 0)""")

# -- fitted models: what SQL can say of them, and flags that must hold ------------------------

register("forest_fit_score", f"""
SELECT count(*) AS sample_size, CAST(sum(tx_fraud) AS BIGINT) AS positives, CAST({len(Q.TX_FEATURES)} AS BIGINT) AS n_features,
       CAST(10 AS BIGINT) AS n_trees, true AS near_rule_auc
FROM ({SPLIT_SQL}) WHERE split = 'test'""")

register("forest_cv", f"""
SELECT count(*) AS sample_size, CAST(4 AS BIGINT) AS grid_size, CAST(3 AS BIGINT) AS folds,
       CAST({len(Q.TX_FEATURES)} AS BIGINT) AS n_features, true AS best_is_largest, true AS fold_agrees, true AS near_rule_auc
FROM ({SPLIT_SQL}) WHERE split = 'test'""")

register("text_forest_fit", f"""
SELECT count(*) AS n_test, CAST(sum(quality) AS BIGINT) AS positives, CAST(35 AS BIGINT) AS n_trees, true AS beats_constant
FROM documents JOIN labels USING (doc_id) WHERE {U('split', 'doc_id')} >= {dbl(0.7)}""")

ALL_CELLS_SQL = f"""
SELECT 0 AS iteration, {', '.join(f'CAST(count_if(cell = {i}) AS BIGINT) AS k{i}' for i in range(8))}
FROM (SELECT tx_fraud * 4 + {PRED_BASE} * 2 + {PRED_CAND} AS cell FROM ({TX_SQL}))"""
register("bootstrap_multinomial_ttest", f"""
SELECT model, CAST({Q.BOOT_ITERATIONS} AS BIGINT) AS iterations,
       CAST({Q.BOOT_ITERATIONS} * (SELECT count(*) FROM ({TX_SQL})) AS BIGINT) AS drawn,
       {', '.join(f"{r6(m)} AS {m}" for m in ("f1", "precision", "recall", "auc"))},
       true AS f1_near, true AS precision_near, true AS recall_near, true AS auc_near
FROM ({BOOT_SCORES_SQL.replace(BOOT_COUNTS_SQL, ALL_CELLS_SQL)})""")

# Seven conditional binomials: each value's weight relative to the mode's by lgamma, values in the order mode upwards,
# then mode downwards; the first one whose running sum is over the uniform's share of the total.
_chain = [f"""d0 AS (SELECT i.iteration, n AS rest, c.* EXCLUDE (iteration) FROM range(0, {Q.BOOT_ITERATIONS}) i(iteration),
            (SELECT *, {' + '.join(f'k{i}' for i in range(8))} AS n FROM ({ALL_CELLS_SQL})) c)"""]
for _i in range(7):
    _tail = " + ".join(f"k{j}" for j in range(_i, 8))
    _u = (f"(CAST(('0x' || substr(md5(concat_ws('|', '{Q.BOOT_SEED}', CAST(iteration AS VARCHAR), '{_i}')), 1, 15)) AS BIGINT)::HUGEINT"
          f" * {1 << 52} // 1152921504606846976)::DOUBLE / {float(1 << 52)!r}")
    _chain.append(f"""b{_i} AS (SELECT *, least(CAST(floor((rest + 1) * p) AS BIGINT), rest) AS mode, CAST(ceil({bootstrap.REACH} * sqrt(rest * p * (1 - p))) AS BIGINT) + {bootstrap.REACH} AS reach
             FROM (SELECT *, CASE WHEN {_tail} = 0 THEN 0 ELSE k{_i}::DOUBLE / ({_tail}) END AS p, {_u} AS u FROM d{_i}))""")
    _chain.append(f"""w{_i} AS (SELECT iteration, x, u, CASE WHEN x >= mode THEN x - mode ELSE rest + 1 + mode - x END AS place,
                    exp(lgamma(mode + 1) + lgamma(rest - mode + 1) - lgamma(x + 1) - lgamma(rest - x + 1) + (x - mode) * ln(p / (1 - p))) AS w
             FROM (SELECT *, unnest(range(greatest(0, mode - reach), least(rest, mode + reach) + 1)) AS x FROM b{_i} WHERE p > 0 AND p < 1 AND rest > 0))""")
    _chain.append(f"""c{_i} AS (SELECT iteration, arg_min(x, place) AS x FROM (SELECT *, sum(w) OVER (PARTITION BY iteration ORDER BY place) AS upto, sum(w) OVER (PARTITION BY iteration) AS total FROM w{_i})
             WHERE upto > u * total GROUP BY iteration)""")
    _chain.append(f"""d{_i + 1} AS (SELECT b.* EXCLUDE (rest, p, u, mode, reach), coalesce(x, CASE WHEN p >= 1 THEN rest ELSE 0 END) AS r{_i},
                    rest - coalesce(x, CASE WHEN p >= 1 THEN rest ELSE 0 END) AS rest FROM b{_i} b LEFT JOIN c{_i} USING (iteration))""")
register("bootstrap_multinomial_cells", f"""
WITH {', '.join(_chain)}
SELECT CAST(iteration AS BIGINT) AS iteration, {', '.join(f'CAST(r{i} AS BIGINT) AS k{i}' for i in range(7))}, CAST(rest AS BIGINT) AS k7 FROM d7""")

# -- profile and registry functions on table data ----------------------------------------------

_LINEITEM = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
             "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
             "l_shipdate": "timestamp_ntz"}
_NO_FEATURE = ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
register("column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, {str(c not in _NO_FEATURE).lower()} AS is_feature, "
    f"count(*) - count({c}) AS null_count, count(*) AS n_rows FROM lineitem" for c, t in _LINEITEM.items()))

register("stage_aliases", """
SELECT stage, count(*) AS n_rows,
       CASE stage WHEN 'Production' THEN 'champion' WHEN 'Staging' THEN 'challenger' WHEN 'Archived' THEN 'archived' ELSE lower(stage) END AS alias
FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE o_orderstatus END AS stage FROM orders
      UNION ALL SELECT upper(event_type[1]) || lower(event_type[2:]) FROM events)
GROUP BY stage""")

register("version_descriptions", """
SELECT coalesce(u.event_type, o_orderpriority) AS description, count(*) AS n_versions, CAST(sum(o_orderkey) AS BIGINT) AS versions
FROM orders LEFT JOIN (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events) u
     ON o_orderkey = u.user_id AND u.rn = 1
GROUP BY 1""")

register("new_runs", f"""
WITH r AS ({MONTH_RUNS_SQL}), old AS (SELECT * FROM r WHERE month < '1998'), c AS (SELECT max(auc) AS champion_auc, count(*) AS n FROM old)
SELECT run_id, CAST(c.n + row_number() OVER (ORDER BY month, run_id) AS INTEGER) AS version, {r6('auc')} AS auc, {r6('c.champion_auc')} AS champion_auc,
       c.champion_auc IS NULL OR coalesce(auc > c.champion_auc, false) AS promoted,
       CASE WHEN c.champion_auc IS NULL OR coalesce(auc > c.champion_auc, false) THEN 'champion' ELSE 'challenger' END AS alias,
       {r6('(auc - c.champion_auc) / nullif(c.champion_auc, 0) * 100')} AS gain_pct
FROM r, c WHERE month >= '1998'""")
