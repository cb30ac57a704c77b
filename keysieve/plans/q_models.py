"""Queries: Spark ML feature stages and models.

Stages with a deterministic result (assembler, indexers) have SQL twins. A
fitted model's numbers can't come from SQL, so the model queries return what
must hold of them and can: rows trained on and scored, classes covered, whether
the held-out macro F1 is over the query's floor and most rows of every class
are found (a predictor of one class, or of shuffled labels, fails both), and
whether a saved model scores like the fitted one. ``<name>_report`` queries
return classification reports; ``REPORTS`` has one for each model query.

The labelled, matched candidates are staged once, without their plaintext: the
hash bits that sampling needs, features, label, band and encoded sequence.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keysieve.config import scratch_path
from keysieve.functions import ngrams
from keysieve.operators import breach as B
from keysieve.operators import features
from keysieve.operators import grid as G
from keysieve.operators import metrics as M
from keysieve.operators import models as ML
from keysieve.operators import sampling as S
from keysieve.operators.importance import permutation_importance
from keysieve.operators.lineage import materialize
from keysieve.plans.oracle import md5_bits, sql
from keysieve.plans.q_sampling import BALANCED_CTES as _BAL
from keysieve.plans.q_sampling import PER_CLASS
from keysieve.plans.registry import query
from keysieve.sources import io
from keysieve.sources import tables as T

FOLDS, PARTS, TRAIN_FRACTION = 3, 10, 0.8
HIDDEN = 32


def exposure(spark, d):
    """Labelled candidates with breach count (0 when unexposed) and band."""
    m = B.match_breach(T.labelled(spark, d), T.breach(spark, d), how="left")
    return features.with_frequency_band(m)


def staged(spark, d, with_sequence: bool = False, with_id: bool = False, with_grams: bool = False) -> DataFrame:
    """What the models need of every candidate, as a table without plaintext;
    the encoded sequence or the grams' buckets only for the models that read
    them, the digest only where rows are given out."""
    ex, pos = ML.sequence_columns(exposure(spark, d)) if with_sequence else (exposure(spark, d), [])
    return materialize(ex.select(
        *ML.STRENGTH_FEATURES, "has_letter_and_digit", "password_strength", "common_or_rare", *pos, *["sha1"] * with_id, *[ngrams.buckets("password").alias("grams")] * with_grams,
        S.hash_bits("password", S.SALT_BALANCE).alias("balance_bits"),
        S.below_fraction(S.hash_bits("password", S.SALT_SPLIT), TRAIN_FRACTION).alias("in_train"),
        (S.hash_bits("password", S.SALT_FOLD) % FOLDS).cast("int").alias("fold"),
        (S.hash_bits("password", S.SALT_PARTS) % PARTS).cast("int").alias("split_id")), "model-input")


POSITIONS = [f"pos_{i:02d}" for i in range(20)]


def balanced(spark, d, **with_columns: bool):
    """(train, test) of the balanced split. The training side (about PER_CLASS
    rows per class) is read by many fit passes, so it is staged too; the
    held-out side is scored in one pass."""
    tagged = S.balanced_flags(staged(spark, d, **with_columns).drop("in_train"), PER_CLASS,
                              out="in_train", bits="balance_bits")
    return (materialize(tagged.where("in_train"), "train"), tagged.where(~F.col("in_train")))


def raw_split(spark, d):
    """(train, test) of the raw class mix, 80/20."""
    tagged = staged(spark, d)
    return tagged.where("in_train"), tagged.where(~F.col("in_train"))


def report(pred, model: PipelineModel | None = None):
    """Classification report; the class names are the model's and the data's."""
    labels = list(model.stages[-1].getLabels()) if model is not None else None
    return M.classification_report(M.confusion_long(pred), labels)


#: Macro F1 on held-out rows that a model must reach.
TREE_FLOOR, SEQUENCE_FLOOR, NGRAM_FLOOR = 0.95, 0.78, 0.65


def quality(pred: DataFrame, floor: float) -> DataFrame:
    """One row: ``test_rows, classes`` (that occur as truth), ``macro_f1_ok``
    (at least ``floor``) and ``recall_ok`` (over half the rows of every class)."""
    summary = F.col("class").isin("accuracy", "macro avg", "weighted avg")
    one = F.when(~summary & (F.col("support") > 0), F.col("recall"))
    return M.classification_report(M.confusion_long(pred)).agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("support"))).alias("test_rows"), F.count(one).alias("classes"),
        (F.max(F.when(F.col("class") == "macro avg", F.col("f1"))) >= floor).alias("macro_f1_ok"),
        (F.min(one) > 0.5).alias("recall_ok"))


def held(train: DataFrame, pred: DataFrame, floor: float) -> DataFrame:
    """:func:`quality` of the held-out rows, and ``train_rows``."""
    n = train.agg(F.count(F.lit(1)).alias("train_rows"))
    both = quality(pred, floor).unionByName(n, allowMissingColumns=True)  # a row each
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def held_sql(ctes: str, tagged: str, extra: str = "") -> str:
    return sql(f"""
SELECT count(*) FILTER (WHERE in_train) AS train_rows, count(*) FILTER (WHERE NOT in_train) AS test_rows,
       count(DISTINCT password_strength) FILTER (WHERE NOT in_train) AS classes,
       true AS macro_f1_ok, true AS recall_ok{extra} FROM {tagged}""", ctes)


_RAW = f"""rawtag AS (
  SELECT *, {md5_bits('password', S.SALT_SPLIT)} < {TRAIN_FRACTION} * 4294967296 AS in_train FROM labelled)"""

#: Classification report of a model query: name -> (spark, sf_dir) -> DataFrame.
REPORTS = {}


def model_query(name: str, oracle: str, floor: float = TREE_FLOOR, with_report: bool = False):
    """Registers ``fn(spark, d) -> (train, model, predictions)``, if asked with its report."""
    def register(fn):
        def checks(spark, d):
            train, _, pred = fn(spark, d)
            return held(train, pred, floor)

        def full(spark, d):
            _, model, pred = fn(spark, d)
            return report(pred, model)

        checks.__doc__ = full.__doc__ = fn.__doc__
        REPORTS[name] = full
        query(name, oracle)(checks)
        if with_report:
            query(f"{name}_report")(full)
        return fn
    return register


_FEATURE_ARRAY = "[" + ", ".join(f"{c}::DOUBLE" for c in ML.STRENGTH_FEATURES) + "]"


@query("assembled_features",
       sql(f"SELECT password, {_FEATURE_ARRAY} AS features FROM feats"))
def assembled_features(spark, d):
    f = features.with_features(T.candidates(spark, d))
    return ML.features_as_array(ML.assembled(f, ML.STRENGTH_FEATURES)).select(
        "password", "features")


_LD_ARRAY = "[" + ", ".join(f"{c}::DOUBLE" for c in ML.LETTER_DIGIT_FEATURES) + "]"


@query("assembled_letter_digit",
       sql(f"SELECT password, has_letter_and_digit, {_LD_ARRAY} AS features FROM feats"))
def assembled_letter_digit(spark, d):
    """The 8-column vector of the letter-and-digit tree."""
    f = features.with_features(T.candidates(spark, d))
    return ML.features_as_array(ML.assembled(f, ML.LETTER_DIGIT_FEATURES)).select(
        "password", "has_letter_and_digit", "features")


_BAND_ARRAY = ("[" + ", ".join(f"{c}::DOUBLE" for c in ML.STRENGTH_FEATURES)
               + ", band_index]")
_BAND = """banded AS (
  SELECT *, CASE WHEN breach_count >= 10 THEN 'common' ELSE 'rare' END AS common_or_rare
  FROM exposure),
band_ranks AS (
  SELECT common_or_rare,
         (row_number() OVER (ORDER BY count(*) DESC, common_or_rare) - 1)::DOUBLE AS band_index
  FROM banded GROUP BY common_or_rare)"""


@query("assembled_band", sql(f"""
SELECT b.password, b.common_or_rare, {_BAND_ARRAY} AS features
FROM banded b JOIN band_ranks r ON b.common_or_rare = r.common_or_rare""", _BAND))
def assembled_band(spark, d):
    """The 11-column vector: ten features plus the indexed breach band."""
    ex = exposure(spark, d)
    band = ML.fit_indexer(ex, ["common_or_rare"], ["common_or_rare_index"])
    return ML.features_as_array(ML.assembled(band.transform(ex), ML.STRENGTH_FEATURES_BAND)
                                ).select("password", "common_or_rare", "features")


_RANK = """ranks AS (
  SELECT password_strength,
         (row_number() OVER (ORDER BY count(*) DESC, password_strength) - 1)::DOUBLE AS label
  FROM labelled GROUP BY password_strength)"""


@query("label_index", sql("""
SELECT l.password, l.password_strength, r.label
FROM labelled l JOIN ranks r ON l.password_strength = r.password_strength""", _RANK))
def label_index(spark, d):
    lab = T.labelled(spark, d)
    idx = ML.fit_indexer(lab, ["password_strength"], ["label"], handle_invalid="error")
    return idx.transform(lab).select("password", "password_strength", "label")


@query("index_to_string", sql("""
SELECT l.password, r.label, l.password_strength AS decoded
FROM labelled l JOIN ranks r ON l.password_strength = r.password_strength""", _RANK))
def index_to_string(spark, d):
    lab = T.labelled(spark, d)
    idx = ML.fit_indexer(lab, ["password_strength"], ["label"], handle_invalid="error")
    back = IndexToString(inputCol="label", outputCol="decoded", labels=idx.labelsArray[0])
    return back.transform(idx.transform(lab)).select("password", "label", "decoded")


_LD = f"""ldtag AS (
  SELECT *, {md5_bits('password', S.SALT_SPLIT)} < {TRAIN_FRACTION} * 4294967296 AS in_train FROM feats)"""


def letter_digit(spark, d):
    """Decision tree for ``has_letter_and_digit`` (8 features), depth x
    impurity grid over 3 deterministic folds: (best model, test predictions)."""
    f = staged(spark, d).withColumn("has_letter_and_digit_d", F.col("has_letter_and_digit").cast("double"))
    f = ML.assembled(f, ML.LETTER_DIGIT_FEATURES)
    train, test = f.where("in_train"), f.where(~F.col("in_train"))
    dt = ML.decision_tree(label_col="has_letter_and_digit_d")
    cv = ML.cross_validate(train, dt, ML.depth_impurity_grid(dt),
                           label_col="has_letter_and_digit_d", fold_col="fold")
    return cv.bestModel, cv.bestModel.transform(test).withColumn("prediction", F.col("prediction").cast("int"))


@query("dt_letter_digit", sql("""
SELECT count(*) AS test_rows, sum(has_letter_and_digit)::BIGINT AS positives, true AS beats_has_digit,
       1.0::DOUBLE AS importance_total, 8::INT AS features FROM ldtag WHERE NOT in_train""", _LD))
def dt_letter_digit(spark, d):
    """The tuned tree on the 20 % split: TP/TN/FP/FN add up, it is as accurate
    as the rule "has a digit", and its importances add up to one."""
    model, pred = letter_digit(spark, d)
    importances = model.featureImportances.toArray()
    truth = F.col("has_letter_and_digit")
    right = pred.select(truth.alias("t"), (F.col("prediction") == truth).cast("int").alias("hit"),
                        (F.col("has_digits") == truth).cast("int").alias("rule"))
    return right.agg(F.count(F.lit(1)).alias("test_rows"), F.sum("t").alias("positives"),
                     (F.sum("hit") >= F.sum("rule")).alias("beats_has_digit"),
                     F.lit(round(float(importances.sum()), 6)).alias("importance_total"),
                     F.lit(len(importances)).alias("features"))


def dt_metrics(spark, d):
    """TP/TN/FP/FN with percentages, and the four weighted metrics, of the tree."""
    _, pred = letter_digit(spark, d)
    cells = M.confusion_long(pred.select(F.col("has_letter_and_digit").cast("string").alias(M.TRUE_COL),
                                         F.col("prediction").cast("string").alias(M.PRED_COL)))
    return (M.binary_confusion(pred, truth="has_letter_and_digit", prediction="prediction"),
            M.weighted_metrics(cells))


@model_query("rf_strength", held_sql(_RAW, "rawtag"), with_report=True)
def rf_strength(spark, d):
    """Random forest (10 trees) on the raw class mix, 80/20 split."""
    train, test = raw_split(spark, d)
    model = ML.fit_strength_model(train, ML.random_forest(), ML.STRENGTH_FEATURES)
    return train, model, ML.predict(model, test)


@model_query("rf_balanced", held_sql(_BAL, "baltag"), with_report=True)
def rf_balanced(spark, d):
    """Random forest on the balanced set with the breach band as 11th feature."""
    train, test = balanced(spark, d)
    model = ML.fit_strength_model(train, ML.random_forest(), ML.STRENGTH_FEATURES_BAND,
                                  band_col="common_or_rare")
    return train, model, ML.predict(model, test)


@model_query("gbt_strength", held_sql(_BAL, "baltag"))
def gbt_strength(spark, d):
    """Boosted trees (10 rounds, depth 6), one-vs-rest over the 3 classes."""
    train, test = balanced(spark, d)
    model = ML.fit_strength_model(train, ML.boosted_one_vs_rest(), ML.STRENGTH_FEATURES_BAND,
                                  band_col="common_or_rare")
    return train, model, ML.predict(model, test)


@model_query("seq_classifier", held_sql(_BAL, "baltag"), SEQUENCE_FLOOR, with_report=True)
def seq_classifier(spark, d):
    """Sequence model: logistic regression over one-hot (position, char)."""
    train, test = balanced(spark, d, with_sequence=True)
    model = ML.fit_sequence_model(train, POSITIONS)
    return train, model, ML.predict(model, test)


@model_query("seq_perceptron", held_sql(_BAL, "baltag"), SEQUENCE_FLOOR)
def seq_perceptron(spark, d):
    """Sequence model: a perceptron with one hidden layer over the same input."""
    train, test = balanced(spark, d, with_sequence=True)
    model = ML.fit_sequence_model(train, POSITIONS, hidden=HIDDEN, max_iter=60)
    return train, model, ML.predict(model, test)


@model_query("seq_ngrams", held_sql(_BAL, "baltag"), NGRAM_FLOOR)
def seq_ngrams(spark, d):
    """Sequence model: logistic regression over hashed character n-grams, which
    sees neither places nor length, so it is weaker than the positional ones."""
    train, test = balanced(spark, d, with_grams=True)
    model = ML.fit_ngram_model(train)
    return train, model, ML.predict(model, test)


_GRID = """grid AS (SELECT unnest([2, 4, 6])::INT AS max_depth, imp AS impurity
                    FROM (SELECT unnest(['gini', 'entropy']) AS imp))"""


def tuned(train: DataFrame, feature_cols, band_col=None):
    """The 18-fit grid (3 depths x 2 impurities x 3 folds) and refit."""
    rf = ML.random_forest()
    grid = ML.depth_impurity_grid(rf)
    model, scores = ML.tune(train, rf, grid, feature_cols, band_col=band_col)
    return model, [(int(g[rf.maxDepth]), str(g[rf.impurity]), float(m)) for g, m in zip(grid, scores)]


@query("cv_grid", sql("SELECT max_depth, impurity, true AS is_share, true AS best_beats_rule FROM grid", _GRID))
def cv_grid(spark, d):
    """Grid search of a random forest on the balanced set, one row per grid
    point: its mean accuracy is a share, and the best point's is at least that
    of the length rule on the same rows (``cv_scores`` has the numbers)."""
    train, rows = cv_scores(spark, d)
    rule = M.accuracy(M.rule_baseline(train), true_col="password_strength").first()["accuracy"]
    best = max(r[2] for r in rows) >= rule
    return spark.createDataFrame([(a, b, 0 <= m <= 1, best) for a, b, m in rows],
                                 "max_depth int, impurity string, is_share boolean, best_beats_rule boolean")


def cv_scores(spark, d):
    """(training table, [(depth, impurity, mean accuracy)]) of the grid."""
    train, _ = balanced(spark, d)
    return train, tuned(train, ML.STRENGTH_FEATURES_BAND, "common_or_rare")[1]


def tuning_flow(spark, train: DataFrame, test: DataFrame) -> DataFrame:
    """Tune, score the held-out rows with the best model, decode label and
    band, write the scored rows, save the pipeline, load it and score again."""
    model, _ = tuned(train, ML.STRENGTH_FEATURES_BAND, "common_or_rare")
    cols = ["length", "common_or_rare", "common_or_rare_decoded", M.TRUE_COL, M.PRED_COL, "prediction"]
    pred = materialize(ML.predict(model, test).select(*cols), "scored")
    path = scratch_path(spark, "tuned-model")
    model.write().overwrite().save(path)
    again = ML.predict(PipelineModel.load(path), test).select(*cols)
    differing = pred.exceptAll(again).count() + again.exceptAll(pred).count()
    checks = held(train, pred, TREE_FLOOR)
    decoded = pred.agg(F.count_if(F.col("common_or_rare") != F.col("common_or_rare_decoded"))).first()[0]
    return checks.select("*", F.lit(differing).cast("bigint").alias("differing_rows"),
                         F.lit(decoded).cast("bigint").alias("wrong_bands"))


def _flow_sql(ctes, tagged):
    return held_sql(ctes, tagged, ", 0::BIGINT AS differing_rows, 0::BIGINT AS wrong_bands")


@query("rf_raw_tuned", _flow_sql(_RAW, "rawtag"))
def rf_raw_tuned(spark, d):
    """Tuned forest on the raw class mix, eleven features with the band."""
    return tuning_flow(spark, *raw_split(spark, d))


@query("rf_balanced_tuned", _flow_sql(_BAL, "baltag"))
def rf_balanced_tuned(spark, d):
    """Tuned forest on the balanced set, eleven features with the band."""
    return tuning_flow(spark, *balanced(spark, d))


@query("cv_grid_resumed", sql(f"""
SELECT max_depth, impurity, {FOLDS}::BIGINT AS folds, true AS is_share, {3 * FOLDS}::INT AS fitted_first, {3 * FOLDS}::INT AS fitted_then
FROM grid""", _GRID))
def cv_grid_resumed(spark, d):
    """The grid search of ``cv_grid`` as finished stages: a first run over half
    of the points, then one over all, which fits only what was left."""
    train, _ = balanced(spark, d)
    lab = ML.fit_indexer(train, ["password_strength"], [ML.LABEL], handle_invalid="error")
    table = ML.assembled(lab.transform(train), ML.STRENGTH_FEATURES)
    rf, root = ML.random_forest(), scratch_path(spark, "grid")
    grid = ML.depth_impurity_grid(rf)
    _, first = G.search(table, rf, grid[:3], root, range(FOLDS))
    scores, then = G.search(table, rf, grid, root, range(FOLDS))
    point = F.from_json("parameters", "maxDepth string, impurity string")
    return G.mean_scores(scores).select(
        point["maxDepth"].cast("int").alias("max_depth"), point["impurity"].alias("impurity"), "folds",
        F.col("metric").between(0, 1).alias("is_share"), F.lit(first).alias("fitted_first"), F.lit(then).alias("fitted_then"))


@query("feature_importance", sql(
    "SELECT unnest(" + str(ML.STRENGTH_FEATURES_BAND) + ") AS feature, true AS is_share, 1.0::DOUBLE AS total"))
def feature_importance(spark, d):
    """Per feature of the balanced forest: its importance is a share, and all
    add up to one (``importances`` has them in order)."""
    imp = importances(spark, d)
    total = F.round(F.sum("importance").over(Window.partitionBy(F.lit(1))), 6)
    return imp.select("feature", F.col("importance").between(0, 1).alias("is_share"), total.alias("total"))


def importances(spark, d):
    """(feature, importance) of the balanced forest, most important first."""
    train, _ = balanced(spark, d)
    model = ML.fit_strength_model(train, ML.random_forest(), ML.STRENGTH_FEATURES_BAND,
                                  band_col="common_or_rare")
    return ML.feature_importance(spark, model.stages[-2].featureImportances,
                                 ML.STRENGTH_FEATURES_BAND)


def permuted_importances(spark, d, seed: int = 0):
    """Permutation importances of the balanced forest on the held-out rows,
    with a constant as one more feature of the model."""
    train, test = (df.withColumn("constant", F.lit(1)) for df in balanced(spark, d, with_id=True))
    names = [*ML.STRENGTH_FEATURES, "constant"]
    model = ML.fit_strength_model(train, ML.random_forest(), names)
    rows = materialize(test.select("sha1", "password_strength", *names), "held-out")
    hit = (F.col(M.TRUE_COL) == F.col(M.PRED_COL)).cast("double")
    return permutation_importance(lambda x: ML.predict(model, x), rows, names, "sha1", hit, seed)


@query("permutation_importance", sql(f"""
SELECT feature, count(*) AS rows, true AS in_bounds, feature = 'constant' AS is_constant, feature = 'length' AS matters
FROM baltag, (SELECT unnest({[*ML.STRENGTH_FEATURES, "constant"]}) AS feature) WHERE NOT in_train GROUP BY feature""", _BAL))
def permutation_importance_checks(spark, d):
    """Per feature: rows scored, importance within a share's bounds, nothing for
    the constant, and over a twentieth of the accuracy for the length, which the
    label depends on most."""
    imp = F.col("importance")
    return permuted_importances(spark, d).select(
        "feature", "rows", imp.between(-0.01, 1).alias("in_bounds"),
        ((F.col("feature") == "constant") & (imp == 0)).alias("is_constant"),
        ((F.col("feature") == "length") & (imp > 0.05)).alias("matters"))


@query("score_full", sql(f"""
SELECT ({md5_bits('password', S.SALT_PARTS)} % {PARTS})::INT AS split_id, count(*) AS n, true AS balanced_accuracy_ok
FROM baltag WHERE NOT in_train GROUP BY 1""", _BAL))
def score_full(spark, d):
    """Score every held-out row with the balanced forest; rows per part, and
    whether the mean of the classes' recalls there is over the floor."""
    train, test = balanced(spark, d)
    model = ML.fit_strength_model(train, ML.random_forest(), ML.STRENGTH_FEATURES)
    hit = F.col(M.TRUE_COL) == F.col(M.PRED_COL)
    per = ML.predict(model, test).groupBy("split_id", M.TRUE_COL).agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("recall"))
    return per.groupBy("split_id").agg(F.sum("n").alias("n"), (F.avg("recall") >= TREE_FLOOR).alias("balanced_accuracy_ok"))


@query("scored_set")
def scored_set(spark, d):
    """The held-out rows scored by the balanced forest, written and read again:
    ``sha1`` instead of the string, true and predicted label, band."""
    train, test = balanced(spark, d, with_id=True)
    model = ML.fit_strength_model(train, ML.random_forest(), ML.STRENGTH_FEATURES_BAND, band_col="common_or_rare")
    path = scratch_path(spark, "scored-set")
    io.write_parquet(ML.predict(model, test).select("sha1", M.TRUE_COL, M.PRED_COL, "common_or_rare", "split_id"), path)
    return io.read_parquet(spark, path)


@query("model_roundtrip", sql("""
SELECT count(*) FILTER (WHERE NOT in_train) AS test_rows, 0::BIGINT AS differing_rows FROM baltag""", _BAL))
def model_roundtrip(spark, d):
    """Save the fitted pipeline under the checkpoint dir, load it, score every
    held-out row with both and count where they differ."""
    train, test = balanced(spark, d)
    model = ML.fit_strength_model(train, ML.random_forest(), ML.STRENGTH_FEATURES)
    path = scratch_path(spark, "rf-model")
    model.write().overwrite().save(path)
    first = ML.predict(model, test).withColumnRenamed(M.PRED_COL, "first_label")
    both = PipelineModel.load(path).transform(
        first.drop(*(c for c in first.columns if c in ("label", "features", "rawPrediction", "probability", "prediction"))))
    return both.agg(F.count(F.lit(1)).alias("test_rows"),
                    F.count_if(F.col("first_label") != F.col(M.PRED_COL)).alias("differing_rows"))
