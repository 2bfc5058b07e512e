"""Run log: parameters, metrics and tags of training runs in an append-only table."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

RUNS = ("run_id string, experiment string, name string, at timestamp, params map<string,string>, "
        "metrics map<string,double>, tags map<string,string>, model_path string, input_schema string, example string, registered string")


class RunLog:
    """Runs kept as parquet files in a shared folder; each run appends one row."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self, experiment: str, name: str, params: dict | None = None, metrics: dict | None = None, tags: dict | None = None,
            model=None, sample: DataFrame | None = None, registered: str | None = None) -> str:
        """Append a run. The model is saved next to the log, the sample gives input schema and one example row."""
        run = uuid.uuid4().hex
        model_path = None
        if model is not None:
            model_path = f"{self.path}/models/{run}"
            model.write().overwrite().save(model_path)
        example = None
        if sample is not None:
            first = sample.limit(1).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sample.columns])).alias("j")).first()
            example = first["j"] if first else None
        row = [(run, experiment, name, {k: str(v) for k, v in (params or {}).items()},
                {k: float(v) for k, v in (metrics or {}).items()}, {k: str(v) for k, v in (tags or {}).items()},
                model_path, sample.schema.json() if sample is not None else None, example, registered)]
        schema = RUNS.replace("at timestamp, ", "")
        one = self.spark.createDataFrame(row, schema).withColumn("at", F.current_timestamp())
        one.coalesce(1).write.mode("append").parquet(f"{self.path}/runs")
        return run

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(f"{self.path}/runs")

    def search(self, experiment: str | None = None, metric: str | None = None, larger_is_better: bool = True, limit: int | None = None) -> DataFrame:
        """Runs of an experiment ordered by a metric."""
        out = self.runs()
        if experiment is not None:
            out = out.where(F.col("experiment") == experiment)
        if metric is not None:
            value = F.element_at("metrics", metric)
            out = out.orderBy(value.desc_nulls_last() if larger_is_better else value.asc_nulls_last(), "at")
        return out if limit is None else out.limit(limit)

    def registered_model(self, name: str) -> str:
        """Path of the newest model stored under a registered name."""
        hit = self.runs().where((F.col("registered") == name) & F.col("model_path").isNotNull()).orderBy(F.desc("at")).first()
        if hit is None:
            raise KeyError(name)
        return hit["model_path"]


def params_of(model) -> dict[str, str]:
    """Parameter values of a fitted step as text."""
    return {p.name: json.dumps(v, default=str) for p, v in model.extractParamMap().items()}
