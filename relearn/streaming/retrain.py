"""Retrain on each new day's data.

The reference retrains from a scheduler on a fixed day path.  Here the
scheduler only has to start this job: a Structured Streaming file source over
the day partitions finds the files not yet trained on, and ``foreachBatch``
runs the training job on them.  The streaming checkpoint (in the shared
checkpoint folder) records which files were consumed.  A batch that failed is
run again, so its function must bear repeats; ``retrain_days`` does.  ``availableNow`` processes what
has arrived and stops, which suits a timer.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relearn.operators.registry import SCHEMAS, Registry
from relearn.operators.registry import now as registry_now
from relearn.plans import jobs
from relearn.session import checkpoint_path

log = logging.getLogger("relearn")


def retrain_on_arrival(spark: SparkSession, input_dir: str, schema,
                       train_batch: Callable[[DataFrame, int], None],
                       checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                       query_name: str = "retrain_on_arrival", files: bool = False) -> StreamingQuery:
    """Start (and return) a run that trains on every not-yet-seen input file.

    ``train_batch(batch_df, batch_id)`` receives the new rows of one trigger;
    typically it calls ``relearn.plans.jobs.run_training(..., input_df=batch_df)``.
    With ``max_files_per_trigger`` each trigger takes at most that many files
    (e.g. one day file per training run).  ``files`` adds each row's file as the column ``FILE``.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(input_dir)
    if files:
        stream = stream.withColumn(FILE, F.col("_metadata.file_path"))
    location = checkpoint or checkpoint_path(spark, f"streams/{query_name}")
    return (stream.writeStream.queryName(query_name)
            .foreachBatch(train_batch)
            .option("checkpointLocation", location)
            .trigger(availableNow=True)
            .start())


FILE = "__file"


def day_run_id(experiment: str, day, files: Iterable[str]) -> str:
    """The run id of an experiment's training on one day: a function of the day's files, whatever their order."""
    return hashlib.md5("|".join([experiment, str(day), *sorted(set(files))]).encode()).hexdigest()


def day_files(registry: Registry, experiment: str) -> DataFrame:
    """``(day, file)`` of what the experiment's days have been trained on; a null day names files that were left out."""
    return registry.table("day_files").filter(F.col("experiment") == experiment).select("day", "file").distinct()


def _path(spark: SparkSession, file: str) -> str:
    """A file's name as readers take it; the metadata column gives it as a URI, with escapes."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).toString()


def retrain_days(spark: SparkSession, input_dir: str, schema, output_root: str, registry_root: str,
                 experiment: str = "fraud_detection", day_col: str = "dt", checkpoint: str | None = None,
                 max_files_per_trigger: int | None = None, train: Callable[..., dict] = jobs.run_training, **options) -> StreamingQuery:
    """J3 with J1: one ``run_training`` per day that has new files (``schema`` holds ``day_col``).

    A day is trained on all of its files so far, the new ones and those in the registry's list (``day_files``), and its
    run id follows from that set.  Files that arrive later for a finished day thus make one new version of it, while a
    repeated batch (``foreachBatch`` may repeat one after a failure) finds the run finished, its version with an alias,
    and only does what is missing.  The list is written after the training.  Files whose day is null can't be assigned:
    they are not trained on, a warning names their number and the list keeps them with a null day.
    ``options`` go to ``run_training``.
    """
    def batch(df: DataFrame, _batch_id: int) -> None:
        registry = Registry(spark, registry_root)
        new = {(r[0], r[1]) for r in df.select(F.col(day_col).cast("string"), FILE).distinct().collect()}       # a trigger's files
        seen = {(r.day, r.file) for r in day_files(registry, experiment).collect()} if new else set()
        lost = sorted(f for day, f in new if day is None)
        if lost:
            log.warning("%d files without a %s are left out of %s, the first is %s", len(lost), day_col, experiment, lost[0])
        for day in sorted({day for day, _ in new if day is not None}):
            files = sorted({f for d, f in new | seen if d == day})
            run_id = day_run_id(experiment, day, files)
            if not registry.has_run(run_id):
                rows = spark.read.schema(schema).option("basePath", input_dir).parquet(*[_path(spark, f) for f in files])
                train(spark, f"{input_dir.rstrip('/')}/{day_col}={day}", f"{output_root.rstrip('/')}/{run_id}", registry_root,
                      experiment=experiment, run_name=f"{experiment}_{day}", run_id=run_id, auto_register=True,
                      input_df=rows.filter(F.col(day_col).cast("string") == F.lit(day)).drop(day_col), **options)
        rows = [(experiment, day, f, registry_now()) for day, f in sorted(new - seen, key=str)]
        if rows:
            registry.append("day_files", spark.createDataFrame(rows, SCHEMAS["day_files"]))
    return retrain_on_arrival(spark, input_dir, schema, batch, checkpoint, max_files_per_trigger, f"retrain_{experiment}", files=True)


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` run to finish (raises if it failed)."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
