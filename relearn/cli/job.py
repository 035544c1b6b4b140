"""``spark-submit relearn/cli/job.py JOB --registry FOLDER [--settings FILE] [--set NAME=VALUE ...]``: jobs J1 and J2.

What can be set, and every default, is the signature of the job's function (``relearn.plans.jobs``): a JSON file and
``--set`` name its parameters, values are JSON, or plain text where they are none.  A name that the function lacks is an error.

    job.py train   --registry s3a://b/registry --set input_path=s3a://b/tx --set output_path=s3a://b/m --set auto_register=true
    job.py compare --registry s3a://b/registry --data s3a://b/urls.csv --set n_iter=10 --set auto_deploy=true

Object-store keys come from RELEARN_S3_ENDPOINT, RELEARN_S3_ACCESS_KEY and RELEARN_S3_SECRET_KEY only: they are set on the
session, never named on the command line and never logged.
"""

from __future__ import annotations

import argparse
import inspect
import json
import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from relearn.plans import jobs
from relearn.sources import files, objectstore

JOBS: dict[str, Callable] = {"train": jobs.run_training, "compare": jobs.run_ab_test}
#: Parameters that the command fills itself.
OWN = ("spark", "registry_root", "data", "input_df")


def settings_of(job: Callable, given: Mapping[str, object], pairs: Sequence[str]) -> dict:
    """Settings from a file's object and ``NAME=VALUE`` pairs, the later ones first; checked against the job's signature."""
    out = dict(given)
    for pair in pairs:
        name, there, text = pair.partition("=")
        if not there:
            raise ValueError(f"{pair!r} is not NAME=VALUE")
        try:
            out[name] = json.loads(text)
        except ValueError:
            out[name] = text
    known = [p for p in inspect.signature(job).parameters.values() if p.name not in OWN]
    unknown = sorted(set(out) - {p.name for p in known})
    if unknown:
        raise ValueError(f"{job.__name__} has no {', '.join(unknown)}; it has {', '.join(p.name for p in known)}")
    missing = [p.name for p in known if p.default is p.empty and p.name not in out]
    if missing:
        raise ValueError(f"{job.__name__} needs {', '.join(missing)}")
    return out


def _session(name: str) -> SparkSession:
    env = [os.environ.get(f"RELEARN_S3_{k}") for k in ("ENDPOINT", "ACCESS_KEY", "SECRET_KEY")]
    return objectstore.apply(SparkSession.builder.appName(f"relearn-{name}"), objectstore.s3a_settings(*env) if all(env) else None).getOrCreate()


def main(argv: Sequence[str] | None = None) -> dict | None:
    p = argparse.ArgumentParser(description="Run a retraining job")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--registry", required=True, help="folder of the registry tables")
    p.add_argument("--data", help="CSV with a header (compare)")
    p.add_argument("--schema", default=files.URL_SCHEMA, help="columns of that CSV")
    p.add_argument("--settings", help="JSON file of settings")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", dest="pairs")
    args = p.parse_args(argv)
    given = {}
    if args.settings:
        with open(args.settings, encoding="utf-8") as f:
            given = json.load(f)
    job = JOBS[args.job]
    settings = settings_of(job, given, args.pairs)
    spark = _session(args.job)
    if args.job == "compare":
        if not args.data:
            p.error("compare needs --data")
        return job(spark, files.read_csv(spark, args.data, args.schema), args.registry, **settings)
    return job(spark, registry_root=args.registry, **settings)


if __name__ == "__main__":
    main()
