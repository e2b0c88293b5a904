"""Run registry and model report, as plain tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession

from arrears.operators.train import Search, importances

RUNS = "run_id string, parent_run_id string, run_name string, experiment string, started timestamp"
PARAMS = "run_id string, key string, value string"
METRICS = "run_id string, key string, value double"
ARTIFACTS = "run_id string, key string, path string"


class RunRegistry:
    """Append-only Parquet tables below one folder: runs, params, metrics, artifacts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        if rows:
            frame = self.spark.createDataFrame(rows, schema).coalesce(1)
            frame.write.mode("append").parquet(f"{self.folder}/{name}")

    def log(
        self,
        run_name: str,
        params: Mapping[str, object] | None = None,
        metrics: Mapping[str, float] | None = None,
        artifacts: Mapping[str, str] | None = None,
        experiment: str = "default",
        parent: str | None = None,
    ) -> str:
        return self.log_many([(run_name, params or {}, metrics or {}, artifacts or {})], experiment, parent)[0]

    def log_many(self, runs: list[tuple], experiment: str = "default", parent: str | None = None) -> list[str]:
        """Several runs in one append per table."""
        from datetime import datetime, timezone

        now = datetime.now(timezone.utc)
        ids = [uuid.uuid4().hex for _ in runs]
        self._append("runs", [(i, parent, r[0], experiment, now) for i, r in zip(ids, runs)], RUNS)
        self._append("params", [(i, k, str(v)) for i, r in zip(ids, runs) for k, v in r[1].items()], PARAMS)
        self._append("metrics", [(i, k, float(v)) for i, r in zip(ids, runs) for k, v in r[2].items()], METRICS)
        self._append("artifacts", [(i, k, v) for i, r in zip(ids, runs) for k, v in r[3].items()], ARTIFACTS)
        return ids

    def log_search(self, run_name: str, search: Search, experiment: str = "default") -> str:
        """The best point as a run, every point of the grid as a run below it."""
        top = self.log(run_name, search.best_params, {"best_score": search.best_score}, experiment=experiment)
        self.log_many(
            [
                (
                    f"point_{r['point']}",
                    r["params"],
                    {
                        "mean_test_score": r["mean_score"],
                        "std_test_score": r["std_score"],
                        "std_fit_time": r["std_fit_time"],
                        "rank_test_score": r["rank"],
                    },
                    {},
                )
                for r in search.table
            ],
            experiment,
            top,
        )
        return top

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def model_params(model: Model) -> dict[str, object]:
    last = model.stages[-1] if hasattr(model, "stages") else model
    return {p.name: v for p, v in last.extractParamMap().items()}


def report(spark: SparkSession, model: Model, names: list[str], metrics: DataFrame, classes: DataFrame, matrix: DataFrame, searched: Mapping[str, object] | None = None) -> DataFrame:
    """(section, name, value): metrics, matrix, per-class lines, parameters and importances.

    ``searched`` adds parameters that are not Spark's own, such as ``min_samples_split``.
    """
    from pyspark.sql import functions as F

    def long(df: DataFrame, section: str, prefix) -> DataFrame:
        numbers = [c for c, t in df.dtypes if t in ("double", "bigint", "int") and c not in ("label", "class")]
        entries = F.array(
            *[F.struct(F.concat(prefix, F.lit(c)).alias("name"), F.col(c).cast("double").cast("string").alias("value")) for c in numbers]
        )
        return df.select(F.lit(section).alias("section"), F.inline(entries))

    cells = matrix.select(
        F.lit("confusion_matrix").alias("section"),
        F.concat_ws("->", F.col("label").cast("string"), F.col("prediction").cast("string")).alias("name"),
        F.col("n").cast("string").alias("value"),
    )
    small = [("params", k, str(v)) for k, v in (model_params(model) | dict(searched or {})).items()]
    small += [("importance", n, repr(v)) for n, v in importances(model, names)]
    listed = spark.createDataFrame(small, "section string, name string, value string")
    return (
        long(metrics, "metrics", F.lit(""))
        .unionByName(cells)
        .unionByName(long(classes, "classes", F.concat(F.col("row"), F.lit(": "))))
        .unionByName(listed)
    )
