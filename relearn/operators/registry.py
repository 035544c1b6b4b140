"""Run history and champion registry as append-only tables.

The reference keeps runs, metrics, model versions and aliases in a tracking
server.  Here they are Parquet tables under one root folder; every change is
an appended row, and the current state is a query:

* experiments(experiment, ts)
* runs(run_id, experiment, run_name, ts)
* run_params(run_id, key, value string, ts) / run_metrics(run_id, key, value double, ts)
* model_versions(model, version, run_id, path, description, ts)
* alias_events(model, version, alias, ts)       -- latest event per (model, alias) wins
* description_events(model, version, description, ts)

* day_files(experiment, day, file, ts)            -- what each day's training has seen; a null day was not trained on

The state functions are DataFrame -> DataFrame and run the same on a replay
of many runs.  Events that are decided from the state (``COMMITTED``) go
through an optimistic commit log, so several jobs may register, promote and
create at once; parameters, metrics and file lists are plain Parquet appends.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relearn.operators.commits import CommitLog
from relearn.operators.stats import relative_gain_pct

SCHEMAS = {
    "experiments": "experiment string, ts timestamp",
    "runs": "run_id string, experiment string, run_name string, ts timestamp",
    "run_params": "run_id string, key string, value string, ts timestamp",
    "run_metrics": "run_id string, key string, value double, ts timestamp",
    "model_versions": "model string, version int, run_id string, path string, description string, ts timestamp",
    "alias_events": "model string, version int, alias string, ts timestamp",
    "version_tags": "model string, version int, key string, value string, ts timestamp",
    "description_events": "model string, version int, description string, ts timestamp",
    "day_files": "experiment string, day string, file string, ts timestamp",
}

#: Tables whose rows are commits.
COMMITTED = ("experiments", "runs", "model_versions", "alias_events", "version_tags", "description_events")

# Stage names of older registries and the alias each maps to;
# any other stage becomes its lower-case name.
STAGE_TO_ALIAS = {"Production": "champion", "Staging": "challenger", "Archived": "archived"}
CHAMPION, CHALLENGER = "champion", "challenger"
PROMOTION_METRIC = "auc"


def now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


# -- pure state functions (DataFrame -> DataFrame) ---------------------------------

def current_aliases(alias_events: DataFrame) -> DataFrame:
    """The version each (model, alias) points at: its latest event.

    Ties on ``ts`` are broken by the larger version.
    """
    w = Window.partitionBy("model", "alias").orderBy(F.col("ts").desc(), F.col("version").desc())
    return (alias_events.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def resolved_aliases(alias_events: DataFrame, version_tags: DataFrame) -> DataFrame:
    """R5 with the fallback of older registries: (model, alias, version), the alias first, else the tag ``alias``.

    A tag's latest value counts per version; of several versions tagged alike the latest tag wins.
    """
    w = Window.partitionBy("model", "version").orderBy(F.col("ts").desc(), F.col("value").desc())
    tags = (version_tags.filter(F.col("key") == "alias").withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).groupBy("model", F.col("value").alias("alias"))
            .agg(F.max(F.struct("ts", "version")).alias("__t")).select("model", "alias", F.col("__t.version").alias("tagged")))
    named = current_aliases(alias_events).select("model", "alias", F.col("version").alias("named"))
    return (named.join(tags, ["model", "alias"], "full")
            .select("model", "alias", F.coalesce("named", "tagged").alias("version")))


def next_versions(model_versions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Number new (model, run_id) rows after the largest existing version.

    ``candidates`` holds ``model, run_id`` (and optionally ``ts``); several new
    rows of one model get consecutive versions in ``ts, run_id`` order.
    """
    last = model_versions.groupBy("model").agg(F.max("version").alias("__last"))
    order = [F.col("ts"), F.col("run_id")] if "ts" in candidates.columns else [F.col("run_id")]
    w = Window.partitionBy("model").orderBy(*order)
    return (candidates.join(last, "model", "left")
            .withColumn("version", (F.coalesce(F.col("__last"), F.lit(0)) + F.row_number().over(w)).cast("int"))
            .drop("__last"))


def run_metric_table(run_metrics: DataFrame, keys=("auc", "accuracy", "f1")) -> DataFrame:
    """Latest value of each metric key per run, one column per key."""
    w = Window.partitionBy("run_id", "key").orderBy(F.col("ts").desc(), F.col("value").desc())
    latest = (run_metrics.filter(F.col("key").isin(list(keys)))
              .withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1))
    return latest.groupBy("run_id").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k)
                                          for k in keys])


def alias_metrics(aliases: DataFrame, model_versions: DataFrame, run_metrics: DataFrame,
                  alias: str = CHAMPION) -> DataFrame:
    """Metrics of the run behind an alias (one row per model that has it)."""
    pointed = aliases.filter(F.col("alias") == alias).select("model", "version", "alias")
    versions = model_versions.select("model", "version", "run_id")
    return (pointed.join(versions, ["model", "version"])
            .join(run_metric_table(run_metrics), "run_id", "left")
            .select("model", "alias", "version", "run_id", "auc", "accuracy", "f1"))


def promotion_decision(new_runs: DataFrame, champions: DataFrame,
                       metric: str = PROMOTION_METRIC) -> DataFrame:
    """R7 + E12: champion when there is none, when its metric is unknown, or the new metric is strictly larger.

    ``new_runs``: model, version, run_id, <metric>.  ``champions``: model,
    <metric> of the current champion.  Ties keep the old champion.
    """
    best = champions.select("model", F.col(metric).alias("__best"))
    joined = new_runs.join(best, "model", "left")
    promote = F.col("__best").isNull() | F.coalesce(F.col(metric) > F.col("__best"), F.lit(False))
    return (joined.withColumn("promoted", promote)
            .withColumn("alias", F.when(promote, F.lit(CHAMPION)).otherwise(F.lit(CHALLENGER)))
            .withColumn("gain_pct", relative_gain_pct(F.col(metric), F.col("__best")))
            .withColumnRenamed("__best", f"champion_{metric}"))


def replay_promotions(runs: DataFrame, metric: str = PROMOTION_METRIC) -> DataFrame:
    """R3 + R7 over a whole history of runs, as one query.

    ``runs``: model, run_id, ts, <metric>, one row per training run in time
    order.  Applying R7 run after run, a version is promoted iff no earlier
    version of its model has a metric, or its own is strictly larger than every
    earlier one (the champion holds the running maximum as soon as there is
    one).  The window spans one row per run of a model.
    """
    w_all = Window.partitionBy("model").orderBy("ts", "run_id")
    w_prev = w_all.rowsBetween(Window.unboundedPreceding, -1)
    numbered = runs.withColumn("version", F.row_number().over(w_all).cast("int"))
    best_before = F.max(F.col(metric)).over(w_prev)
    promoted = best_before.isNull() | F.coalesce(F.col(metric) > best_before, F.lit(False))
    return (numbered.withColumn(f"champion_{metric}", best_before)
            .withColumn("promoted", promoted)
            .withColumn("alias", F.when(F.col("promoted"), F.lit(CHAMPION)).otherwise(F.lit(CHALLENGER)))
            .withColumn("gain_pct", relative_gain_pct(F.col(metric), F.col(f"champion_{metric}"))))


def stage_alias(stage_col) -> "F.Column":
    """Production/Staging/Archived -> champion/challenger/archived, else lower case."""
    c = F.col(stage_col) if isinstance(stage_col, str) else stage_col
    expr = None
    for stage, alias in STAGE_TO_ALIAS.items():
        expr = F.when(c == stage, F.lit(alias)) if expr is None else expr.when(c == stage, F.lit(alias))
    return expr.otherwise(F.lower(c))


def current_descriptions(model_versions: DataFrame, description_events: DataFrame) -> DataFrame:
    """Description of each version: its latest update, else the one it was registered with."""
    w = Window.partitionBy("model", "version").orderBy(F.col("ts").desc(), F.col("description").desc())
    latest = (description_events.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).select("model", "version", F.col("description").alias("__upd")))
    return (model_versions.join(latest, ["model", "version"], "left")
            .withColumn("description", F.coalesce(F.col("__upd"), F.col("description"))).drop("__upd"))


# -- the tables on storage ---------------------------------------------------------

class Registry:
    """Append-only registry tables under ``root`` (a shared folder or object-store URI)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        """The table, or an empty one with its schema before the first write."""
        if name in COMMITTED:
            return self.log.table(name, SCHEMAS[name])
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        except Exception as e:  # noqa: BLE001 - missing path
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return self.spark.createDataFrame([], SCHEMAS[name])
            raise

    def append(self, name: str, df: DataFrame) -> None:
        """Appends rows as they are; those of a committed table (a few events) as one commit."""
        cols = [c.strip().split(" ")[0] for c in SCHEMAS[name].split(",")]
        if name in COMMITTED:
            events = [(name, r.asDict()) for r in df.select(*cols).collect()]
            self.log.commit(lambda: events)
            return
        df.select(*cols).write.mode("append").parquet(self.path(name))

    def _rows(self, name: str, rows: list[tuple]) -> DataFrame:
        return self.spark.createDataFrame(rows, SCHEMAS[name])

    # R1
    def get_or_create_experiment(self, experiment: str) -> str:
        def build():
            new = self._rows("experiments", [(experiment, now())]).join(self.table("experiments").select("experiment"), "experiment", "left_anti")
            return [("experiments", r.asDict()) for r in new.collect()]
        self.log.commit(build)
        return experiment

    # R2
    def start_run(self, experiment: str, run_name: str, run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex

        def build():
            there = not self.table("runs").filter(F.col("run_id") == run_id).isEmpty()
            return [] if there else [("runs", {"run_id": run_id, "experiment": experiment, "run_name": run_name, "ts": now()})]
        self.log.commit(build)
        return run_id

    def log_params(self, run_id: str, params: Mapping[str, object]) -> None:
        ts = now()
        self.append("run_params", self._rows("run_params", [(run_id, k, str(v), ts) for k, v in params.items()]))

    def log_metrics(self, run_id: str, values: Mapping[str, float] | DataFrame) -> None:
        if isinstance(values, DataFrame):  # (run_id, key, value, ts) rows built by Spark
            self.append("run_metrics", values)
            return
        ts = now()
        rows = [(run_id, k, None if v is None else float(v), ts) for k, v in values.items()]
        self.append("run_metrics", self._rows("run_metrics", rows))

    # R3
    def version_of(self, model: str, run_id: str) -> int | None:
        same = (F.col("model") == model) & (F.col("run_id") == run_id)
        return self.table("model_versions").filter(same).agg(F.min("version")).first()[0]

    def register_version(self, model: str, run_id: str, path: str, description: str = "") -> int:
        """The version of a run, the next number if it has none: registering it again is a repeat after a failure."""
        def build():
            if self.version_of(model, run_id) is not None:
                return []
            cand = self.spark.createDataFrame([(model, run_id, path, description, now())],
                                              "model string, run_id string, path string, description string, ts timestamp")
            return [("model_versions", next_versions(self.table("model_versions"), cand).first().asDict())]
        self.log.commit(build)
        return int(self.version_of(model, run_id))

    # R4
    def set_alias(self, model: str, version: int, alias: str | Callable[[], str], description: str = "") -> None:
        """Points an alias at a version; ``alias`` may be a function of the state, which is asked again if another
        commit comes in between.  Times of one registry's aliases never go back."""
        def build():
            last = self.table("alias_events").agg(F.max("ts")).first()[0]
            ts = now() if last is None else max(now(), last + _dt.timedelta(microseconds=1))
            return [("alias_events", {"model": model, "version": int(version), "alias": alias if isinstance(alias, str) else alias(), "ts": ts})]
        self.log.commit(build)
        if description:
            self.update_description(model, version, description)

    # R8
    def transition_stage(self, model: str, version: int, stage: str, description: str = "") -> str:
        alias = STAGE_TO_ALIAS.get(stage, stage.lower())
        self.set_alias(model, version, alias, description)
        return alias

    # R9
    def update_description(self, model: str, version: int, description: str) -> None:
        self.append("description_events",
                    self._rows("description_events", [(model, int(version), description, now())]))

    # R5
    def aliases(self) -> DataFrame:
        return resolved_aliases(self.table("alias_events"), self.table("version_tags"))

    def set_tag(self, model: str, version: int, key: str, value: str) -> None:
        self.append("version_tags", self._rows("version_tags", [(model, int(version), key, value, now())]))

    def has_run(self, run_id: str) -> bool:
        """Whether this run is finished: its version is registered and has an alias."""
        versions = self.table("model_versions").filter(F.col("run_id") == run_id).select("model", "version")
        return not versions.join(self.table("alias_events"), ["model", "version"], "left_semi").isEmpty()

    def resolve(self, model: str, alias: str = CHAMPION):
        """Version row an alias points at, or None."""
        rows = (self.aliases().filter((F.col("model") == model) & (F.col("alias") == alias))
                .join(self.table("model_versions").select("model", "version", "run_id", "path"),
                      ["model", "version"]).collect())
        return rows[0] if rows else None

    # R6
    def champion_metrics(self, model: str):
        rows = (alias_metrics(self.aliases(), self.table("model_versions"), self.table("run_metrics"))
                .filter(F.col("model") == model).collect())
        return rows[0].asDict() if rows else None

    # R7
    def compare_and_register(self, model: str, run_id: str, path: str, new_auc: float | None,
                             description: str = "") -> dict:
        """Register the new version and point ``champion`` or ``challenger`` at it.

        The comparison is made with the champion as of the commit that sets the alias."""
        version = self.register_version(model, run_id, path, description)
        decided = {}

        def alias() -> str:
            champion = self.resolve(model)
            best = None if champion is not None and champion["run_id"] == run_id else self.champion_metrics(model)
            new = self.spark.createDataFrame([(model, version, run_id, new_auc)],
                                             "model string, version int, run_id string, auc double")
            champs = self.spark.createDataFrame([] if best is None else [(model, best["auc"])],
                                                "model string, auc double")
            decided.update(promotion_decision(new, champs).first().asDict())
            return decided["alias"]
        self.set_alias(model, version, alias)
        return decided
