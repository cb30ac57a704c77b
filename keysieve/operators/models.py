"""Spark ML models for strength classification.

Everything trains on executors through ``pyspark.ml``; predictions stay
distributed and are turned into metrics by :mod:`keysieve.operators.metrics`.
Indexers are fitted on the training rows only (labels strict, bands ``keep``), and
report class names come from the fitted indexer, not from a hard-coded order.

Leakage note: the label is a fixed rule over ``has_upper``, ``has_lower``,
``has_digits``, ``has_special_characters`` and ``length``. Trees that see those
columns reproduce the rule, so near-perfect scores there show leakage, not
skill. Models over the sequence encoding, which is case-folded, must learn the
label from evidence that does not spell it out.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysieve.functions import sequence
from keysieve.operators.metrics import PRED_COL, TRUE_COL

# Columns of the three feature vectors, in order.
LETTER_DIGIT_FEATURES = ["is_lower", "is_upper", "is_digit", "has_digits",
                         "has_symbols", "has_spaces", "has_special_characters", "length"]
STRENGTH_FEATURES = ["is_lower", "is_upper", "is_digit", "has_digits", "has_upper",
                     "has_lower", "has_symbols", "has_spaces", "has_special_characters",
                     "length"]
STRENGTH_FEATURES_BAND = STRENGTH_FEATURES + ["common_or_rare_index"]

LABEL = "label"
FEATURES = "features"
PREDICTION = "prediction"


def assembler(cols: list[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def assembled(df: DataFrame, cols: list[str], out: str = FEATURES) -> DataFrame:
    return assembler(cols, out).transform(df)


def features_as_array(df: DataFrame, col: str = FEATURES) -> DataFrame:
    """Vector column -> ARRAY<DOUBLE> (for export or SQL comparison)."""
    return df.withColumn(col, vector_to_array(F.col(col)))


def fit_indexer(train: DataFrame, input_cols: list[str], output_cols: list[str],
                handle_invalid: str = "keep"):
    """StringIndexer(s), frequency descending (ties alphabetical), fitted on
    ``train`` only. Feature columns use ``keep`` (unseen values get an extra
    index); label columns use ``error`` so the class count stays exact."""
    return StringIndexer(inputCols=input_cols, outputCols=output_cols,
                         stringOrderType="frequencyDesc",
                         handleInvalid=handle_invalid).fit(train)


def random_forest(num_trees: int = 10, max_depth: int = 5, impurity: str = "gini",
                  seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=LABEL, featuresCol=FEATURES, numTrees=num_trees,
                                  maxDepth=max_depth, impurity=impurity, seed=seed)


def decision_tree(label_col: str = LABEL, max_depth: int = 5,
                  seed: int = 42) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label_col, featuresCol=FEATURES,
                                  maxDepth=max_depth, seed=seed)


def boosted_one_vs_rest(max_iter: int = 10, max_depth: int = 6, seed: int = 42) -> OneVsRest:
    """Multi-class boosted trees: one binary GBT per class."""
    gbt = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=seed)
    return OneVsRest(classifier=gbt, labelCol=LABEL, featuresCol=FEATURES)


def fit_strength_model(train: DataFrame, estimator, feature_cols: list[str],
                       label_col: str = "password_strength",
                       band_col: str | None = None) -> PipelineModel:
    """Index label (and band), assemble features, fit ``estimator``, and map
    predictions back to class names. Returns a single PipelineModel. ``train``
    is read many times: pass a table."""
    lab = fit_indexer(train, [label_col], [LABEL], handle_invalid="error")
    stages = [lab]
    if band_col:
        stages.append(fit_indexer(train, [band_col], [band_col + "_index"]))
    fitted = Pipeline(stages=stages + [assembler(feature_cols), estimator]).fit(train)
    back = IndexToString(inputCol=PREDICTION, outputCol=PRED_COL, labels=lab.labelsArray[0])
    return PipelineModel(stages=fitted.stages + [back])


def predict(model: PipelineModel, df: DataFrame,
            label_col: str = "password_strength") -> DataFrame:
    """Scored rows with ``true_label`` and ``predicted_label`` (lazy; the test
    set is scored partition by partition, nothing is collected)."""
    return model.transform(df).withColumn(TRUE_COL, F.col(label_col))


def sequence_columns(df: DataFrame, col: str = "password",
                     width: int = sequence.WIDTH) -> tuple[DataFrame, list[str]]:
    """One INT column per position of the sequence encoding."""
    names = [f"pos_{i:02d}" for i in range(width)]
    return df.withColumns({n: sequence.position(col, i) for i, n in enumerate(names)}), names


def _one_hot(pos: list[str]) -> OneHotEncoder:
    return OneHotEncoder(inputCols=pos, outputCols=[p + "_oh" for p in pos],
                         dropLast=False, handleInvalid="keep")


def fit_sequence_model(train: DataFrame, pos: list[str], label_col: str = "password_strength",
                       max_iter: int = 50, reg: float = 0.0, hidden: int | None = None,
                       seed: int = 42) -> PipelineModel:
    """Classifier over one-hot (position, character) columns ``pos``: the
    distributed stand-in for a small recurrent model over the same encoding.
    Multinomial logistic regression, or with ``hidden`` a perceptron with one
    hidden layer of that size. Sees only the case-folded sequence."""
    idx = fit_indexer(train, [label_col], [LABEL], handle_invalid="error")
    onehot = _one_hot(pos).fit(train)
    vectors = assembler([p + "_oh" for p in pos])
    if hidden is None:
        est = LogisticRegression(labelCol=LABEL, featuresCol=FEATURES, family="multinomial",
                                 maxIter=max_iter, regParam=reg)
    else:
        # "keep" gives every position one place more than its categories.
        width = sum(n + 1 for n in onehot.categorySizes)
        est = MultilayerPerceptronClassifier(
            labelCol=LABEL, featuresCol=FEATURES, maxIter=max_iter, seed=seed,
            layers=[width, hidden, len(idx.labelsArray[0])])
    fitted = Pipeline(stages=[idx, onehot, vectors, est]).fit(train)
    back = IndexToString(inputCol=PREDICTION, outputCol=PRED_COL, labels=idx.labelsArray[0])
    return PipelineModel(stages=fitted.stages + [back])


def fit_ngram_model(train: DataFrame, col: str = "grams", label_col: str = "password_strength", buckets: int = 1 << 12,
                    max_iter: int = 50, reg: float = 1e-4) -> PipelineModel:
    """Multinomial logistic regression over the counts of hashed n-grams
    (``functions.ngrams.buckets``), as sparse vectors of ``buckets`` places.
    Sees which character sequences occur, not where."""
    idx = fit_indexer(train, [label_col], [LABEL], handle_invalid="error")
    counts = HashingTF(inputCol=col, outputCol=FEATURES, numFeatures=buckets)
    est = LogisticRegression(labelCol=LABEL, featuresCol=FEATURES, family="multinomial", maxIter=max_iter, regParam=reg)
    fitted = Pipeline(stages=[idx, counts, est]).fit(train)
    back = IndexToString(inputCol=PREDICTION, outputCol=PRED_COL, labels=idx.labelsArray[0])
    return PipelineModel(stages=fitted.stages + [back])


def cross_validate(train: DataFrame, estimator, grid, label_col: str = LABEL,
                   fold_col: str = "fold", parallelism: int = 2,
                   metric: str = "accuracy") -> CrossValidatorModel:
    """Grid search over deterministic folds (``fold_col`` from
    :func:`keysieve.operators.sampling.kfold`); returns the fitted model.
    ``train`` is read once per fit: pass a table."""
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=PREDICTION,
                                           metricName=metric)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev,
                        foldCol=fold_col, parallelism=parallelism, seed=42)
    return cv.fit(train)


def depth_impurity_grid(est, depths=(2, 4, 6), impurities=("gini", "entropy")):
    return (ParamGridBuilder().addGrid(est.maxDepth, list(depths))
            .addGrid(est.impurity, list(impurities)).build())


def tune(train: DataFrame, estimator, grid, feature_cols: list[str],
         label_col: str = "password_strength", band_col: str | None = None,
         fold_col: str = "fold", parallelism: int = 4) -> tuple[PipelineModel, list[float]]:
    """Grid search, then one pipeline: index, assemble, the best model, and
    label (and band) decoded to text. Also the grid points' mean accuracies."""
    stages = [fit_indexer(train, [label_col], [LABEL], handle_invalid="error")]
    if band_col:
        stages.append(fit_indexer(train, [band_col], [band_col + "_index"]))
    stages.append(assembler(feature_cols))
    cv = cross_validate(PipelineModel(stages=stages).transform(train), estimator, grid,
                        fold_col=fold_col, parallelism=parallelism)
    stages += [cv.bestModel, IndexToString(inputCol=PREDICTION, outputCol=PRED_COL,
                                           labels=stages[0].labelsArray[0])]
    if band_col:
        stages.append(IndexToString(inputCol=band_col + "_index", outputCol=band_col + "_decoded",
                                    labels=stages[1].labelsArray[0] + ["__unknown"]))
    return PipelineModel(stages=stages), cv.avgMetrics


def feature_importance(spark: SparkSession, importances, names: list[str]) -> DataFrame:
    """(feature, importance) ordered by importance, from a fitted tree model's
    ``featureImportances`` (a vector with one entry per feature)."""
    values = importances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))
