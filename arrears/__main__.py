"""Command line: ``spark-submit arrears/__main__.py ingest | train | score ...``."""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from arrears.operators.train import positive_probability
from arrears.plans import workflow
from arrears.session import build_session, clear_work
from arrears.sources import archives


def ingest(spark, args) -> None:
    """Zipped files to one Parquet table by year and quarter; problems beside it."""
    table, problems = archives.ingest(spark, args.folder, args.output)
    problems.write.mode("overwrite").parquet(args.problems)
    print(f"{table.count()} rows, {spark.read.parquet(args.problems).count()} problems")


def train(spark, args) -> None:
    outcome = workflow.run(
        spark.read.parquet(args.table), args.key, args.target, exclude=args.exclude, balancing=args.balancing,
        folds=args.folds, output=args.output, impute=args.impute, encoding=args.encoding,
    )
    print(f"champion {outcome.champion} {outcome.params}; fold scores {outcome.fold_scores}; run {outcome.run_id}")
    print(f"rows left out {outcome.left_out}; columns not used {outcome.unused}")


def score(spark, args) -> None:
    """New rows through the saved preparation and champion."""
    fitted = PipelineModel(stages=[PipelineModel.load(f"{args.model}/preparation"), workflow.load_champion(spark, args.model)])
    scored = positive_probability(fitted.transform(spark.read.parquet(args.table)))
    scored.select(args.key, "prediction", F.col("score")).write.mode("overwrite").parquet(args.output)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description="Ingest debt files, train and register classifiers, score new debts.")
    out.add_argument("--master", default=None)
    commands = out.add_subparsers(required=True)
    one = commands.add_parser("ingest")
    one.add_argument("folder", help="folder with zip archives")
    one.add_argument("output", help="folder of the table")
    one.add_argument("problems", help="folder of the table of unreadable archives and members")
    one.set_defaults(work=ingest)
    two = commands.add_parser("train")
    two.add_argument("table", help="Parquet path")
    two.add_argument("output", help="folder for model, report and registry")
    two.add_argument("--key", default="numero_inscricao")
    two.add_argument("--target", default="target")
    two.add_argument("--exclude", nargs="*", default=[])
    two.add_argument("--balancing", choices=workflow.BALANCING, default="smote")
    two.add_argument("--folds", type=int, default=5)
    two.add_argument("--impute", action="store_true", help="fill missing values instead of leaving rows out")
    two.add_argument("--encoding", choices=("one_hot", "ordinal", "categorise"), default="one_hot")
    two.set_defaults(work=train)
    three = commands.add_parser("score")
    three.add_argument("model", help="the output folder of train")
    three.add_argument("table", help="Parquet path of new rows")
    three.add_argument("output", help="folder of the scores")
    three.add_argument("--key", default="numero_inscricao")
    three.set_defaults(work=score)
    return out


def main(given: list[str] | None = None) -> None:
    args = parser().parse_args(given)
    spark = build_session("arrears", args.master)
    try:
        args.work(spark, args)
    finally:
        clear_work(spark)


if __name__ == "__main__":
    main()
