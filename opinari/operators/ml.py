"""Model jobs over tables (M1–M5, M9, M10) and the metric tables.

Training runs on the executors with Spark ML; the driver only keeps model
coefficients and one-row metric tables. The reference fine-tunes a
transformer on a GPU; here the classifier is re-aimed as a TF-IDF +
logistic-regression pipeline, and any Python model plugs in through the
scoring UDF of ``operators.sentiment``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (IDF, HashingTF, OneHotEncoder, RegexTokenizer, StringIndexer,
                                VectorAssembler)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.config import DEFAULT_THRESHOLDS
from opinari.functions import text as tx
from opinari.operators.base import join_hot, written


def split_bucket(id_col: str) -> Column:
    """M1: stable bucket 0–99 from the MD5 of the id (not ``randomSplit``,
    which depends on partitioning and changes on recomputation)."""
    h = F.conv(F.substr(F.md5(F.col(id_col).cast("string")), F.lit(1), F.lit(8)), 16, 10)
    return (h.cast("long") % 100).cast("int")


def assign_split(df: DataFrame, id_col: str, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """M1: train / validation / test by bucket (0.8 / 0.1 / rest)."""
    b = split_bucket(id_col)
    t, v = int(round(train * 100)), int(round((train + validation) * 100))
    return df.withColumn("split", F.when(b < t, "train").when(b < v, "validation").otherwise("test"))


def text_features(num_features: int = 1 << 16, text_col: str = "text") -> list:
    """M2: tokens (word runs) → hashed term counts → IDF weights."""
    return [RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern=rf"[^{tx.WORD}]+", gaps=True),
            HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
            IDF(inputCol="tf", outputCol="features")]


def classifier_pipeline(reg_param: float = 0.0, max_iter: int = 20, num_features: int = 1 << 16,
                        text_col: str = "text", label_col: str = "label") -> Pipeline:
    """M3: the two-class text classifier."""
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, regParam=reg_param,
                            maxIter=max_iter)
    return Pipeline(stages=[*text_features(num_features, text_col), lr])


def train_classifier(train: DataFrame, reg_param: float = 0.0, max_iter: int = 20) -> PipelineModel:
    """M3 fitted. The term counts are written once: both the weights and the regression are fitted on them, so texts are
    read, joined and cut into tokens once."""
    *counting, idf, lr = classifier_pipeline(reg_param, max_iter).getStages()
    counts = written(PipelineModel(stages=counting).transform(train).select(lr.getLabelCol(), "tf"), "term-counts")
    weights = idf.fit(counts)
    return PipelineModel(stages=[*counting, weights, lr.fit(weights.transform(counts))])


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
              groups: tuple[str, ...] = ()) -> DataFrame:
    """Confusion counts: a partial aggregate to ``#groups x k^2`` rows."""
    return df.groupBy(*groups, F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def weighted_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                     groups: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 over the
    classes seen in labels or predictions; a zero division gives 0."""
    conf = confusion(df, label_col, pred_col, groups)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label").cast("double").alias("c"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p"),
                 hit.cast("long").alias("tp")),
        F.struct(F.col("prediction").cast("double").alias("c"), F.lit(0).cast("long").alias("t"),
                 F.col("n").alias("p"), F.lit(0).cast("long").alias("tp")))
    per_class = (conf.select(*groups, F.explode(sides).alias("s")).select(*groups, "s.*")
                 .groupBy(*groups, "c").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"),
                                            F.sum("tp").alias("tp")))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    pc = per_class.select(*groups, "support", "tp", prec.alias("pr"), rec.alias("re"), f1.alias("f1"))
    tot = F.sum("support")
    return pc.groupBy(*groups).agg(
        F.try_divide(F.sum("tp"), tot).cast("double").alias("accuracy"),
        F.try_divide(F.sum(F.col("support") * F.col("pr")), tot).cast("double").alias("precision"),
        F.try_divide(F.sum(F.col("support") * F.col("re")), tot).cast("double").alias("recall"),
        F.try_divide(F.sum(F.col("support") * F.col("f1")), tot).cast("double").alias("f1_score"),
        tot.alias("samples"))


def evaluate(model: PipelineModel, test: DataFrame, label_col: str = "label") -> DataFrame:
    """M5: predictions on held-out data → A17 metrics (one row)."""
    return weighted_metrics(model.transform(test), label_col, "prediction")


def select_model(train: DataFrame, validation: DataFrame, reg_params=(0.0, 0.01, 0.1),
                 max_iter: int = 20) -> tuple[PipelineModel, DataFrame]:
    """M4: the features are fitted once; one regression per candidate is fitted on
    them and scored on the validation split by weighted F1. Returns the best
    model (highest F1, then smallest regParam) as a pipeline from raw text, and
    one metric row per candidate with ``is_best``. One row per candidate
    reaches the driver."""
    features = Pipeline(stages=text_features()).fit(train)
    seen, held = features.transform(train), features.transform(validation)
    best, rows = None, []
    for rp in sorted(reg_params):
        lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=rp, maxIter=max_iter).fit(seen)
        m = weighted_metrics(lr.transform(held)).withColumn("reg_param", F.lit(float(rp)))
        rows.append((m.schema, m.first()))
        if best is None or (rows[-1][1]["f1_score"] or 0.0) > (best[1]["f1_score"] or 0.0):
            best = (lr, rows[-1][1])
    spark = train.sparkSession
    metrics = spark.createDataFrame([r for _, r in rows], rows[0][0]) \
        .withColumn("is_best", F.col("reg_param") == float(best[1]["reg_param"]))
    return PipelineModel(stages=[*features.stages, best[0]]), metrics


def tfidf_rows(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """M2 as a relation: ``(id, term, tf, idf)`` with Spark ML's weights,
    ``idf = ln((rows + 1) / (rows with the term + 1))``, over plain terms instead
    of hashed ones. The document frequencies are a partial aggregate; hot terms
    meet them by broadcast."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), rf"[^{tx.WORD}]+"), lambda t: t != "")
    terms = df.select(id_col, F.explode(tokens).alias("term")).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    freq = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n, total = df.count(), terms.count()
    weights = freq.select("term", "df", F.log((F.lit(float(n)) + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    return join_hot(terms, weights, "term", "df", total).select(id_col, "term", "tf", "idf")


def with_updated(metrics: DataFrame) -> DataFrame:
    """A22's ``last_updated``, set when the metrics are written."""
    return metrics.withColumn("last_updated", F.current_timestamp())


def aspect_training_rows(df: DataFrame, aspects_col: str = "detected_aspects") -> DataFrame:
    """M9 input: one row per (text, aspect)."""
    return df.select("*", F.explode(aspects_col).alias("aspect"))


def aspect_classifier_pipeline(reg_param: float = 0.0, max_iter: int = 20,
                               num_features: int = 1 << 16) -> Pipeline:
    """M9: text features plus the aspect as a one-hot feature."""
    return Pipeline(stages=[
        *text_features(num_features),
        StringIndexer(inputCol="aspect", outputCol="aspect_idx", handleInvalid="keep"),
        OneHotEncoder(inputCol="aspect_idx", outputCol="aspect_vec"),
        VectorAssembler(inputCols=["features", "aspect_vec"], outputCol="all_features"),
        LogisticRegression(featuresCol="all_features", labelCol="label", regParam=reg_param,
                           maxIter=max_iter)])


def release_gate(metrics: DataFrame, min_accuracy: float = DEFAULT_THRESHOLDS.release_min_accuracy) -> DataFrame:
    """One verdict row — all models at or above the accuracy floor? —
    with the failing models listed (bounded by the number of models)."""
    name = F.concat_ws(":", "model_name", "model_version")
    return metrics.agg(
        F.min("accuracy").alias("min_accuracy"),
        (F.min("accuracy") >= min_accuracy).alias("passed"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("accuracy") < min_accuracy, name))), ",")
        .alias("failing_models"))
