"""Command line: python -m creditloom <command> (use spark-submit on a cluster)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from creditloom import constants as K
from creditloom.operators import snapshots as S
from creditloom.plans import etl, monitoring, training
from creditloom.session import configure
from creditloom.sources import readers


def _etl(spark, a):
    if a.layer in ("bronze", "all"):
        etl.build_bronze(spark, a.data, a.root)
    if a.layer in ("silver", "all"):
        etl.build_silver(spark, a.root)
    if a.layer in ("gold", "all"):
        etl.build_gold(spark, a.root)


def _baseline(spark, a):
    print(etl.extract_baseline(spark, a.root, a.baselinepath, a.mode))


def _features(spark, path):
    if path.endswith(".csv"):
        return readers.read_csv(spark, path, K.CLICKSTREAM_SCHEMA)
    return spark.read.parquet(path)


def _train(spark, a):
    labels = readers.read_files(spark, a.labeldir)
    record = training.train_snapshot(
        spark, _features(spark, a.featurepath), labels, a.modeltype, a.snapshotdate, a.modeldir, a.runs
    )
    print(record or "no training rows")


def _select(spark, a):
    training.select_models(spark, a.runs, a.candidatedir, a.out, a.startdate, a.enddate, a.pastyears).show(
        truncate=False
    )


def _infer(spark, a):
    if a.snapshotdate:
        months = spark.range(1).select(readers.as_date(a.snapshotdate).alias("snapshot_date"))
    else:
        months = S.backfill_range(spark)
    summary = monitoring.infer(
        spark,
        _features(spark, a.featurepath),
        readers.read_baseline(spark, a.baselinepath),
        training.list_artifacts(spark, a.modeldir),
        a.modeldir,
        months,
        a.root,
        a.runs,
    )
    summary.orderBy("snapshot_date").show(truncate=False)
    monitoring.overall(summary).show(truncate=False)


def _export(spark, a):
    print(*monitoring.export_run_metrics(spark, a.runs, a.outdir))


def _report(spark, a):
    monitoring.build_report(spark, a.metrics, a.outdir, a.quality)


def _alert(spark, a):
    monitoring.alert(readers.read_runs(spark, a.runs), a.threshold).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="creditloom", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name, action, *options, **kwargs):
        sub = commands.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        for option, settings in kwargs.items():
            sub.add_argument(f"--{option}", **settings)
        sub.set_defaults(action=action)

    command("etl", _etl, "data", "root", layer=dict(choices=["bronze", "silver", "gold", "all"], default="all"))
    command("baseline", _baseline, "root", "baselinepath", mode=dict(choices=["all", "latest"], default="all"))
    command(
        "train",
        _train,
        "featurepath",
        "labeldir",
        "modeldir",
        "snapshotdate",
        modeltype=dict(choices=sorted(training.M.TRAINERS), required=True),
        runs=dict(),
    )
    command(
        "select", _select, "runs", "candidatedir", "out", "startdate", "enddate", pastyears=dict(type=int, default=3)
    )
    command(
        "infer", _infer, "featurepath", "baselinepath", "modeldir", "root", snapshotdate=dict(), runs=dict()
    )
    command("export-metrics", _export, "runs", "outdir")
    command("report", _report, "metrics", "outdir", quality=dict())
    command("alert", _alert, "runs", threshold=dict(type=float, default=K.PSI_THRESHOLD))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("creditloom").getOrCreate())
    args.action(spark, args)


if __name__ == "__main__":
    main()
