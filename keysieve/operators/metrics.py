"""Classification metrics computed as Spark aggregations.

Predictions never reach the driver: the confusion matrix is a ``groupBy`` over
(true, predicted) with map-side combine, and every report is a further
aggregation over those (classes x classes) cells. Ratios with a zero
denominator are 0; ratios are rounded to 6 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.functions.charclass import CLASS_ORDER

TRUE_COL = "true_label"
PRED_COL = "predicted_label"


def _ratio(num, den) -> F.Column:
    return F.round(F.when(den == 0, F.lit(0.0)).otherwise(num / den), 6)


def rule_baseline(df: DataFrame, length_col: str = "length", out: str = PRED_COL,
                  medium_from: int = 8, strong_from: int = 12) -> DataFrame:
    """A length-only predictor: < 8 weak, < 12 medium, else Strong."""
    ln = F.col(length_col)
    return df.withColumn(out, F.when(ln < medium_from, "weak")
                         .when(ln < strong_from, "medium").otherwise("Strong"))


def confusion_long(pred: DataFrame, true_col: str = TRUE_COL,
                   pred_col: str = PRED_COL) -> DataFrame:
    """(true_label, predicted_label, n) for every non-empty cell."""
    return (pred.groupBy(F.col(true_col).alias(TRUE_COL), F.col(pred_col).alias(PRED_COL))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_pivot(cells: DataFrame, classes: list[str] = CLASS_ORDER,
                    other: bool = True) -> DataFrame:
    """Rows = true class, one BIGINT column per predicted class (0 filled).

    Written as conditional sums rather than ``pivot`` so no extra job is
    fired to discover the pivot values. Predictions of a class that isn't named
    are in the column ``other``, unless ``other=False`` leaves it out."""
    return (cells.groupBy(TRUE_COL)
            .agg(*[F.sum(F.when(F.col(PRED_COL) == c, F.col("n")).otherwise(0))
                   .cast("bigint").alias(c) for c in classes],
                 *[F.sum(F.when(F.col(PRED_COL).isin(classes), 0).otherwise(F.col("n")))
                   .cast("bigint").alias("other")] * other))


def classification_report(cells: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro avg and
    weighted avg rows (the layout of a classic classification report).

    ``cells`` is ``(true_label, predicted_label, n)``; the work is a handful of
    aggregates over at most classes^2 rows. The report covers every class that
    occurs as truth or prediction, a null label as the class ``null``;
    ``classes`` adds names (a model's labels) that are listed even if they
    don't occur. They never take a row away."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (TRUE_COL, PRED_COL)]
    hit = F.when(F.col(TRUE_COL).eqNullSafe(F.col(PRED_COL)), F.col("n")).otherwise(0)
    # A cell adds to its true class and to its predicted class.
    sides = F.array(F.struct(named[0].alias("class"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).alias("predicted")),
                    F.struct(named[1].alias("class"), F.lit(0).alias("tp"), F.lit(0).alias("support"), F.col("n").alias("predicted")))
    sides = cells.select(F.explode(sides).alias("s")).select("s.*")
    if classes:
        extra = cells.agg(F.lit(0).cast("bigint").alias("z")).select(F.explode(F.array(*map(F.lit, classes))).alias("class"), "z")
        sides = sides.unionByName(extra.select("class", *(F.col("z").alias(c) for c in ("tp", "support", "predicted"))))
    per = sides.groupBy("class").agg(*(F.sum(c).alias(c) for c in ("tp", "support", "predicted")))
    per = per.select("class", "tp", "support",
                     F.when(F.col("predicted") == 0, 0.0)
                     .otherwise(F.col("tp") / F.col("predicted")).alias("p"),
                     F.when(F.col("support") == 0, 0.0)
                     .otherwise(F.col("tp") / F.col("support")).alias("r"))
    per = per.withColumn("f", F.when(F.col("p") + F.col("r") == 0, 0.0)
                         .otherwise(2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))))

    def row(name, p, r, f, support) -> F.Column:
        return F.struct(name.alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.cast("bigint").alias("support"))

    # One aggregate over the per-class rows (one per class, so the collected
    # list is bounded by the class count) yields every output row; a single
    # branch, so the confusion cells are computed once.
    tot = per.agg(
        F.collect_list(row(F.col("class"), F.round("p", 6), F.round("r", 6), F.round("f", 6),
                           F.col("support"))).alias("per_class"),
        F.sum("tp").alias("tp"), F.sum("support").alias("total"),
        F.avg("p").alias("mp"), F.avg("r").alias("mr"), F.avg("f").alias("mf"),
        F.sum(F.col("p") * F.col("support")).alias("wp"),
        F.sum(F.col("r") * F.col("support")).alias("wr"),
        F.sum(F.col("f") * F.col("support")).alias("wf"))
    total = F.col("total")
    acc = _ratio(F.col("tp"), total)
    summary = F.array(
        row(F.lit("accuracy"), acc, acc, acc, total),
        row(F.lit("macro avg"), F.round("mp", 6), F.round("mr", 6), F.round("mf", 6), total),
        row(F.lit("weighted avg"), _ratio(F.col("wp"), total), _ratio(F.col("wr"), total),
            _ratio(F.col("wf"), total), total))
    return (tot.select(F.explode(F.concat("per_class", summary)).alias("s"))
            .select("s.*"))


def accuracy(pred: DataFrame, true_col: str = TRUE_COL, pred_col: str = PRED_COL,
             by: list[str] | None = None) -> DataFrame:
    """Share of rows with ``true == predicted`` (overall or per ``by`` group)."""
    hit = (F.col(true_col) == F.col(pred_col)).cast("double")
    aggs = [F.round(F.avg(hit), 6).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)


def binary_confusion(pred: DataFrame, truth: str, prediction: str) -> DataFrame:
    """TP/TN/FP/FN counts and their percentage of all rows, in one pass."""
    t, p = F.col(truth) == 1, F.col(prediction) == 1
    cnt = pred.agg(F.count_if(p & t).alias("tp"), F.count_if(~p & ~t).alias("tn"),
                   F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"))
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return cnt.select("tp", "tn", "fp", "fn",
                      *[_ratio(F.col(c) * 100.0, total).alias(f"{c}_pct")
                        for c in ("tp", "tn", "fp", "fn")])


def weighted_metrics(cells: DataFrame) -> DataFrame:
    """The four numbers of ``MulticlassClassificationEvaluator`` (accuracy,
    f1, weightedPrecision, weightedRecall) from the confusion cells."""
    rep = classification_report(cells)

    def pick(row: str, col: str) -> F.Column:
        return F.max(F.when(F.col("class") == row, F.col(col)))

    return rep.agg(pick("accuracy", "precision").alias("accuracy"),
                   pick("weighted avg", "f1").alias("f1"),
                   pick("weighted avg", "precision").alias("weightedPrecision"),
                   pick("weighted avg", "recall").alias("weightedRecall"))


def cells_from_matrix(spark, matrix: list[list[int]], classes: list[str] = CLASS_ORDER) -> DataFrame:
    """Confusion cells from a small literal matrix (rows = true class)."""
    rows = [(classes[i], classes[j], int(matrix[i][j]))
            for i in range(len(classes)) for j in range(len(classes))]
    return spark.createDataFrame(rows, f"{TRUE_COL} string, {PRED_COL} string, n bigint")
