"""Grid search whose fits are finished one by one, so that a restarted driver goes on.

Every fold of every grid point is a stage of its own under one root: a folder
with one row, its metric, that counts as finished by its ``_SUCCESS`` marker. A
run reads what is finished and fits the rest; the folder's name is a digest of
the estimator's class, its parameters, the point's, the fold and the metric, so
a changed grid or estimator never takes another's numbers. The caller gives the
same root for the same training table only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.operators.models import LABEL, PREDICTION
from keysieve.sources.io import has_success_marker

SCHEMA = "point int, fold int, parameters string, metric double, rows bigint"


@dataclass(frozen=True)
class Fit:
    point: int
    fold: int
    path: str


def described(estimator, point: dict) -> str:
    """The estimator with the point's parameters, as text in a fixed order."""
    params = {p.name: str(v) for p, v in estimator.extractParamMap(point).items()}
    return json.dumps([type(estimator).__name__, sorted(params.items())])


def fits(estimator, grid: list[dict], folds: Iterable[int], root: str, metric: str) -> list[Fit]:
    out = []
    for k, point in enumerate(grid):
        for fold in folds:
            digest = hashlib.sha256(f"{described(estimator, point)}|{fold}|{metric}".encode()).hexdigest()[:24]
            out.append(Fit(k, fold, f"{root.rstrip('/')}/{digest}"))
    return out


def _run(train: DataFrame, estimator, grid: list[dict], fit: Fit, label_col: str, fold_col: str, metric: str) -> None:
    model = estimator.fit(train.where(F.col(fold_col) != fit.fold), grid[fit.point])
    held = model.transform(train.where(F.col(fold_col) == fit.fold))
    value = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=PREDICTION, metricName=metric).evaluate(held)
    row = (fit.point, fit.fold, json.dumps({p.name: str(v) for p, v in grid[fit.point].items()}), value, held.count())
    # Overwrites what a run that died has left of this fit.
    train.sparkSession.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(fit.path)


def search(train: DataFrame, estimator, grid: list[dict], root: str, folds: Iterable[int], label_col: str = LABEL,
           fold_col: str = "fold", metric: str = "accuracy", parallelism: int = 4) -> tuple[DataFrame, int]:
    """``(point, fold, parameters, metric, rows)`` of every fit, and how many
    were fitted now; the others had been finished under ``root``. ``train`` (with
    features and a ``fold`` column) is read by every fit: pass a table."""
    spark = train.sparkSession
    every = fits(estimator, grid, folds, root, metric)
    left = [f for f in every if not has_success_marker(spark, f.path)]
    with ThreadPoolExecutor(parallelism) as pool:
        # A fit that fails stops the search; the finished ones stay.
        for _ in pool.map(lambda f: _run(train, estimator, grid, f, label_col, fold_col, metric), left):
            pass
    numbers = spark.createDataFrame([(f.path.rsplit("/", 1)[1], f.point) for f in every], "name string, at int")
    done = spark.read.schema(SCHEMA).parquet(*(f.path for f in every)).withColumn(
        "name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    # The number of a point may have changed since it was fitted.
    return done.join(F.broadcast(numbers), "name").select(F.col("at").alias("point"), "fold", "parameters", "metric", "rows"), len(left)


def mean_scores(scores: DataFrame) -> DataFrame:
    """``point, parameters, metric`` (mean over folds), ``folds``."""
    return scores.groupBy("point", "parameters").agg(F.avg("metric").alias("metric"), F.count(F.lit(1)).alias("folds"))


def best_point(scores: DataFrame) -> int:
    """Number of the point with the best mean (ties: the first)."""
    return mean_scores(scores).orderBy(F.desc("metric"), "point").first()["point"]
