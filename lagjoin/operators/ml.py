"""Spark ML helpers: encoding, validation, random-forest training and
metrics (M1 - M10).  Everything runs through Spark ML estimators and
DataFrame aggregates; fitted forests, metric scalars and the values of the
label reach the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

from lagjoin.functions import scalar as S
from lagjoin.operators.columns import select_columns
from lagjoin.operators.dictionary import fit_dictionary
from lagjoin.session import written

# Metric names reported after training and the model defaults.
METRIC_NAMES = ("accuracy", "f1Score", "recall", "precision", "numTrees", "maxDepth")
EVALUATOR_METRICS = {"accuracy": "accuracy", "f1Score": "f1", "recall": "weightedRecall",
                     "precision": "weightedPrecision"}
NUM_TREES, MAX_DEPTH = 20, 5

#: Categories of a text feature, and the most that a forest takes.
MAX_CATEGORIES, MAX_BINS = 64, 10_000


# --- M1 / M2 -----------------------------------------------------------------

def index_strings(df: DataFrame, cols: Sequence[str], handle_invalid: str = "error") -> DataFrame:
    """M1: replace each string column by its frequency-rank index (double,
    most frequent = 0, ties alphabetical), by a distributed dictionary of all
    columns.  A NULL value is an error unless the caller chooses 'keep' (an
    index of its own) or 'skip' (the row goes)."""
    cols = list(cols)
    return fit_dictionary(df, cols).transform(df, handle_invalid) if cols else df


def dates_to_epoch(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M2: date/timestamp columns -> epoch seconds (double).  Wall-clock
    types (DATE, TIMESTAMP_NTZ) are read as UTC wall time, independent of
    the session zone; zoned timestamps give their instant."""
    exprs = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        t, col = types[c], F.col(c)
        if isinstance(t, DateType):
            exprs[c] = (F.unix_date(col).cast("long") * 86400).cast("double")
        elif isinstance(t, TimestampNTZType):
            secs = (F.unix_date(col.cast("date")).cast("long") * 86400 + F.hour(col) * 3600
                    + F.minute(col) * 60 + F.second(col))
            exprs[c] = secs.cast("double")
        else:
            exprs[c] = F.unix_timestamp(col).cast("double")
    return df.withColumns(exprs) if exprs else df


# --- M3 -----------------------------------------------------------------------

def validate_inputs(df: DataFrame, label_col: str, feature_cols: Sequence[str],
                    num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
                    folds: int | None = None) -> None:
    """M3: argument checks and label validation (numeric, non-negative, no
    NULL), in one aggregate."""
    if not label_col:
        raise ValueError("label_col: name the label column")
    if not feature_cols:
        raise ValueError("feature_cols: at least one column is needed, got none")
    if num_trees <= 0 or max_depth <= 0:
        raise ValueError(f"num_trees and max_depth must be 1 or more, got {num_trees} and {max_depth}")
    if folds is not None and folds <= 1:
        raise ValueError(f"folds must be 2 or more, got {folds}")
    t = df.schema[label_col].dataType
    if not S.is_numeric(t):
        raise ValueError(f"label {label_col!r} is {t.simpleString()}; a numeric type is needed")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.min(label_col).alias("lo"),
               F.count_if(F.col(label_col).isNull()).alias("nulls")).first()
    if r["n"] == 0:
        raise ValueError("nothing to train on: the frame has no rows")
    if r["nulls"] or r["lo"] < 0:
        raise ValueError(f"label {label_col!r} has {r['nulls']} NULLs and minimum {r['lo']}; 0 or more is needed")


# --- M4 / M5 ------------------------------------------------------------------

def label_indexer(label_col: str, out: str = "indexedLabel") -> StringIndexer:
    """M4: label -> index (frequency order)."""
    return StringIndexer(inputCol=label_col, outputCol=out)


def assembler(feature_cols: Sequence[str], out: str = "indexedFeatures",
              handle_invalid: str = "error") -> VectorAssembler:
    """M5: feature vector; ``handle_invalid`` decides what NULL features do
    ('skip' drops the row, 'keep' keeps NaN, 'error' raises)."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out,
                           handleInvalid=handle_invalid)


def feature_columns(df: DataFrame, label_col: str, exclude: Sequence[str] = ()) -> list[str]:
    """Feature candidates: every numeric column except the label and the
    excluded ones (keys, text timestamps)."""
    skip = {label_col, *exclude}
    return [f.name for f in df.schema.fields if f.name not in skip and S.is_numeric(f.dataType)]


def prepare_features(df: DataFrame, label_col: str, handle_invalid: str = "error",
                     max_categories: int = MAX_CATEGORIES, fit_on: DataFrame | None = None) -> DataFrame:
    """M1 + M2 on every string / temporal column of ``df``.  The dictionary
    comes from ``fit_on`` (a train part; default ``df`` itself) and has at
    most ``max_categories`` categories a column: rare, unknown and NULL
    values share the last one ('keep')."""
    strings = [f.name for f in df.schema.fields
               if isinstance(f.dataType, StringType) and f.name != label_col]
    temporal = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]
    if strings:
        known = fit_dictionary(df if fit_on is None else fit_on, strings, max_categories)
        df = known.transform(df, handle_invalid)
    return dates_to_epoch(df, temporal)


# --- M6 / M7 / M8 / M10 ----------------------------------------------------------

def _categories(df: DataFrame, cols: Sequence[str]) -> int:
    """Most categories of a nominal column."""
    attrs = [df.schema[c].metadata.get("ml_attr", {}) for c in cols]
    return max((a.get("num_vals", len(a.get("vals", []))) for a in attrs), default=0)


def forest_pipeline(df: DataFrame, label_col: str, feature_cols: Sequence[str], num_trees: int = NUM_TREES,
                    max_depth: int = MAX_DEPTH, seed: int = 42, handle_invalid: str = "error",
                    feature_subset: str = "auto") -> Pipeline:
    """M4 + M5 + M6 as one pipeline for frames like ``df``."""
    categories = _categories(df, feature_cols)
    if categories > MAX_BINS:
        raise ValueError(f"a feature has {categories} categories, {MAX_BINS} at most; group rare values (max_categories)")
    rf = RandomForestClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", numTrees=num_trees,
                                maxDepth=max_depth, maxBins=max(32, categories + 1), seed=seed,
                                featureSubsetStrategy=feature_subset)
    return Pipeline(stages=[label_indexer(label_col), assembler(feature_cols, handle_invalid=handle_invalid), rf])


def predict(model: PipelineModel, df: DataFrame, label_col: str, out: str = "predicted") -> DataFrame:
    """M7: the model's rows for ``df``, with the prediction as a label value
    (``out``) beside its index; rows left without either are an error."""
    pred = model.transform(df)
    labels = F.array(*[F.lit(x) for x in model.stages[0].labels])
    own = F.when(F.col("indexedLabel").isNull() | F.col("prediction").isNull(),
                 F.raise_error(F.lit("a row was left without a label index or a prediction"))).otherwise(
        F.element_at(labels, F.col("prediction").cast("int") + 1))
    return pred.withColumn(out, own.cast(df.schema[label_col].dataType))


def train_random_forest(train: DataFrame, test: DataFrame, label_col: str,
                        feature_cols: Sequence[str], num_trees: int = NUM_TREES,
                        max_depth: int = MAX_DEPTH, folds: int | None = None, seed: int = 42,
                        handle_invalid: str = "error", keep: Sequence[str] = (),
                        fold_keys: Sequence[str] | None = None, feature_subset: str = "auto"
                        ) -> tuple[PipelineModel, DataFrame, dict[str, float]]:
    """M6 - M8 (+ M10 when ``folds``): fit label indexer + assembler +
    random forest on ``train``, predict ``test`` and report accuracy, f1,
    weighted recall and precision (one confusion-matrix pass; equal to
    Spark's evaluator) plus the forest size.  Errors propagate.

    Both parts are cut to label, features, ``keep`` and ``fold_keys`` (P18)
    and written once, so no pass of the training computes them again.  With
    ``folds`` the averaged accuracy over the folds is reported as
    ``foldAccuracy``; see :func:`cross_validate`."""
    others = [*feature_cols, *keep, *(fold_keys or ())]
    train = written(select_columns(train, label_col, others), "train")
    test = written(select_columns(test, label_col, others), "test")
    validate_inputs(train, label_col, feature_cols, num_trees, max_depth, folds)
    options = dict(num_trees=num_trees, max_depth=max_depth, seed=seed, handle_invalid=handle_invalid,
                   feature_subset=feature_subset)
    model = forest_pipeline(train, label_col, feature_cols, **options).fit(train)
    pred = predict(model, test, label_col)
    # all four metrics from one confusion-matrix aggregate (one pass)
    row = confusion_metrics(pred, "indexedLabel", "prediction").first().asDict()
    if row["accuracy"] is None:
        raise ValueError("the test part is empty: no metrics")
    metrics = {k: float(v) for k, v in row.items()}
    forest = model.stages[-1]
    metrics["numTrees"] = float(forest.getNumTrees)
    metrics["maxDepth"] = float(forest.getMaxDepth())
    if folds:
        _, scores = cross_validate(train, label_col, feature_cols, folds, fold_keys, **options)
        metrics["foldAccuracy"] = sum(scores) / len(scores)
    return model, pred, metrics


def cross_validate(df: DataFrame, label_col: str, feature_cols: Sequence[str], folds: int,
                   key_cols: Sequence[str] | None = None, fold_col: str = "fold", **options
                   ) -> tuple[DataFrame, list[float]]:
    """(out-of-fold predictions, accuracy by fold).  A row's fold is the
    md5 bucket of its key (of the whole row without one), so all lag rows of a
    fact lie in one fold and folds are the same in every run.  Each fold is
    predicted (``predicted``) by the forest of the others."""
    if folds < 2:
        raise ValueError(f"folds must be 2 or more, got {folds}")
    key = key_cols if key_cols else df.columns
    one = written(df.withColumn(fold_col, S.md5_bucket(*key, buckets=folds) if key_cols else
                                F.pmod(F.conv(F.substring(S.md5_row(*key), 1, 8), 16, 10).cast("long"),
                                       F.lit(folds)).cast("int")), "folds")
    pipe = forest_pipeline(one, label_col, feature_cols, **options)
    ev = MulticlassClassificationEvaluator(labelCol="indexedLabel", predictionCol="prediction", metricName="accuracy")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev,
                        numFolds=folds, foldCol=fold_col, collectSubModels=True)
    models = [m[0] for m in cv.fit(one).subModels]
    parts = [predict(m, one.where(F.col(fold_col) == k), label_col) for k, m in enumerate(models)]
    out = parts[0].select(*one.columns, "predicted")
    for p in parts[1:]:
        out = out.unionByName(p.select(*one.columns, "predicted"))
    by_fold = out.groupBy(fold_col).agg(F.avg((F.col(label_col) == F.col("predicted")).cast("double")).alias("a"))
    return out, [r["a"] for r in by_fold.orderBy(fold_col).collect()]


def random_forest(df: DataFrame, label_col: str, feature_cols: Sequence[str],
                  num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
                  folds: int | None = None, train_fraction: float = 0.8, seed: int = 42,
                  handle_invalid: str = "error") -> dict[str, float]:
    """M6 with the original single-frame signature: a seeded 80/20 random
    split, string columns indexed (M1, dictionary of the train part), dates
    and timestamps to epoch seconds (M2), fit, predict, metrics."""
    raw_train, raw_test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    train, test = (prepare_features(part, label_col, handle_invalid, fit_on=raw_train) for part in (raw_train, raw_test))
    return train_random_forest(train, test, label_col, feature_cols, num_trees, max_depth,
                               folds, seed, handle_invalid)[2]


def classification_metrics(pred: DataFrame, label_col: str, prediction_col: str = "prediction"
                           ) -> dict[str, float]:
    """M8: accuracy, f1, weighted recall and precision, from one pass."""
    return {k: float(v) for k, v in confusion_metrics(pred, label_col, prediction_col).first().asDict().items()}


def confusion_metrics(pred: DataFrame, label_col: str, prediction_col: str = "prediction"
                      ) -> DataFrame:
    """M8 as a DataFrame: the same four metrics from the confusion matrix
    (classes x classes counts) -- one grouped count, then per-class
    precision/recall weighted by class frequency."""
    cm = pred.groupBy(F.col(label_col).cast("double").alias("l"),
                      F.col(prediction_col).cast("double").alias("p")).agg(F.count(F.lit(1)).alias("c"))
    by_label = cm.groupBy("l").agg(F.sum("c").alias("n_l"),
                                   F.sum(F.when(F.col("l") == F.col("p"), F.col("c")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("p").alias("l")).agg(F.sum("c").alias("n_p"))
    per = by_label.join(by_pred, "l", "left").fillna(0, ["n_p"])
    prec = F.when(F.col("n_p") > 0, F.col("tp") / F.col("n_p")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("n_l")
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    # class-frequency weights: sum(n_l * x) / sum(n_l) -- no total to join in
    n = F.sum("n_l")
    return per.agg((F.sum("tp") / n).alias("accuracy"),
                   (F.sum(F.col("n_l") * f1) / n).alias("f1Score"),
                   (F.sum(F.col("n_l") * rec) / n).alias("recall"),
                   (F.sum(F.col("n_l") * prec) / n).alias("precision"))


# --- M9 -----------------------------------------------------------------------

def area_under_roc(pred: DataFrame, label_col: str = "label",
                   score_col: str = "rawPrediction") -> float:
    """M9: area under ROC from a score column (exact: no curve
    down-sampling).  The score should be the raw score / probability, not
    the hard prediction."""
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=score_col,
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(pred))


# --- S15 ------------------------------------------------------------------------

def metrics_frame(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    """Metric map -> (metric, value) rows."""
    schema = StructType([StructField("metric", StringType(), False),
                         StructField("value", DoubleType(), True)])
    return spark.createDataFrame([(k, float(v)) for k, v in metrics.items()], schema)
