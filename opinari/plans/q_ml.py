"""Model queries: M1–M6, M9, M10, A17, A22.

Labelled text = documents joined with labels (label = ``quality``). Metric
queries with an SQL oracle use fixed prediction rules so that DuckDB needs no
model; the fitted-model queries are checked by row count and by unit tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinari.config import FIXTURE_LEXICON
from opinari.functions import text as tx
from opinari.operators import aspects as A
from opinari.operators import filters
from opinari.operators import ml
from opinari.operators.sentiment import score_ml
from opinari.plans import sqlfrag as S
from opinari.plans.q_quality import round_doubles
from opinari.plans.registry import query
from opinari.sources.tables import comments, labelled_text

# Fixed prediction rules standing in for two model versions.
RULE_MODELS = (("length_rule", "v1", 500), ("length_rule", "v2", 2000))

_BUCKET_SQL = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER)"
_SPLIT_SQL = (f"CASE WHEN {_BUCKET_SQL} < 80 THEN 'train' WHEN {_BUCKET_SQL} < 90 THEN 'validation' "
              f"ELSE 'test' END")
_LT = f"""lt AS (SELECT doc_id, text, label, n_chars, {_SPLIT_SQL} AS split FROM
        (SELECT d.doc_id, d.text, l.quality AS label, d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id))"""


def _metrics_sql(src: str, groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    return f"""conf AS (SELECT {g}label, prediction, count(*) AS n FROM {src} GROUP BY ALL),
sides AS (SELECT {g}label AS c, n AS t, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM conf
          UNION ALL SELECT {g}prediction, 0, n, 0 FROM conf),
pc AS (SELECT {g}c, sum(t) AS support, sum(p) AS predicted, sum(tp) AS tp FROM sides GROUP BY ALL),
mm AS (SELECT {g}support, tp, coalesce(tp / nullif(predicted, 0), 0.0) AS pr,
              coalesce(tp / nullif(support, 0), 0.0) AS re FROM pc),
ff AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END AS f1 FROM mm),
met AS (SELECT {g}round(sum(tp) / sum(support), 6) AS accuracy,
  round(sum(support * pr) / sum(support), 6) AS precision, round(sum(support * re) / sum(support), 6) AS recall,
  round(sum(support * f1) / sum(support), 6) AS f1_score, sum(support) AS samples FROM ff GROUP BY ALL)"""


def labelled(spark, sf) -> DataFrame:
    return ml.assign_split(labelled_text(spark, sf), "doc_id")


@query("split_assign", f"""SELECT doc_id, {_BUCKET_SQL} AS bucket, {_SPLIT_SQL} AS split FROM documents""")
def split_assign(spark, sf):
    """M1 over all documents."""
    from opinari.sources.tables import read_table
    d = read_table(spark, sf, "documents").select("doc_id")
    return ml.assign_split(d, "doc_id").select("doc_id", ml.split_bucket("doc_id").alias("bucket"), "split")


@query("weighted_metrics", f"""WITH {_LT},
pr AS (SELECT label, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS prediction FROM lt),
{_metrics_sql('pr')}
SELECT accuracy, precision, recall, f1_score, samples FROM met""")
def weighted_metrics(spark, sf):
    """A17 with the fixed rule ``prediction = n_chars > 500``."""
    d = labelled(spark, sf).withColumn("prediction", (F.col("n_chars") > 500).cast("int"))
    return round_doubles(ml.weighted_metrics(d, "label", "prediction"))


def _rule_predictions(spark, sf) -> DataFrame:
    d = labelled(spark, sf)
    parts = [d.select("label", "split", F.lit(n).alias("model_name"), F.lit(v).alias("model_version"),
                      (F.col("n_chars") > t).cast("int").alias("prediction"))
             for n, v, t in RULE_MODELS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rules_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT label, split, '{n}' AS model_name, '{v}' AS model_version, "
        f"CASE WHEN n_chars > {t} THEN 1 ELSE 0 END AS prediction FROM lt" for n, v, t in RULE_MODELS)


_MODEL_METRICS_SQL = f"""WITH {_LT},
allp AS ({_rules_sql()}),
held AS (SELECT * FROM allp WHERE split <> 'train'),
{_metrics_sql('held', 'model_name, model_version')},
counts AS (SELECT model_name, model_version, count_if(split = 'train') AS training_samples,
  count_if(split <> 'train') AS validation_samples FROM allp GROUP BY ALL),
mmet AS (SELECT met.model_name, met.model_version, accuracy, precision, recall, f1_score,
  training_samples, validation_samples FROM met JOIN counts USING (model_name, model_version))"""


def model_metrics_table(spark, sf) -> DataFrame:
    p = _rule_predictions(spark, sf)
    groups = ("model_name", "model_version")
    met = ml.weighted_metrics(p.filter(F.col("split") != "train"), "label", "prediction", groups)
    counts = p.groupBy(*groups).agg(F.count_if(F.col("split") == "train").alias("training_samples"),
                                    F.count_if(F.col("split") != "train").alias("validation_samples"))
    return met.join(counts, list(groups)).select(
        *groups, "accuracy", "precision", "recall", "f1_score", "training_samples", "validation_samples")


@query("model_metrics", f"{_MODEL_METRICS_SQL}\nSELECT * FROM mmet")
def model_metrics(spark, sf):
    """Metric row per model and version on held-out data, with sample
    counts (``last_updated`` is set at write time and left out here)."""
    return round_doubles(model_metrics_table(spark, sf))


@query("release_gate", f"""{_MODEL_METRICS_SQL}
SELECT min(accuracy) AS min_accuracy, min(accuracy) >= 0.85 AS passed,
  coalesce(array_to_string(list_sort(list(model_name || ':' || model_version)
    FILTER (WHERE accuracy < 0.85)), ','), '') AS failing_models FROM mmet""")
def release_gate(spark, sf):
    """M10 over the model metric table."""
    return round_doubles(ml.release_gate(round_doubles(model_metrics_table(spark, sf))))


# --- fitted models (rows-only checks) -------------------------------------------

def _fit(spark, sf, reg: float = 0.0):
    d = labelled(spark, sf)
    return ml.train_classifier(d.filter(F.col("split") == "train"), reg, 20), d


@query("tfidf_features", f"""WITH l AS (SELECT d.doc_id, text FROM documents d JOIN labels USING (doc_id)),
t AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), {S.lit(f'[^{tx.WORD}]+')}),
        lambda x: x <> '')) AS term FROM l),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (SELECT term, ln(((SELECT count(*) FROM l) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term)
SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_tokens, count(*) AS n_terms, round(sum(tf * idf), 6) AS weight,
  round(max(tf * idf), 6) AS top_weight FROM tf JOIN w USING (term) GROUP BY doc_id""")
def tfidf_features(spark, sf):
    """M2: tokens, distinct terms and TF-IDF weights per labelled text."""
    rows = ml.tfidf_rows(labelled(spark, sf), "doc_id")
    w = F.col("tf") * F.col("idf")
    out = rows.groupBy("doc_id").agg(F.sum("tf").alias("n_tokens"), F.count(F.lit(1)).alias("n_terms"),
                                     F.sum(w).alias("weight"), F.max(w).alias("top_weight"))
    return round_doubles(out)


@query("train_classifier")
def train_classifier(spark, sf):
    """M3: fit on the train split; one summary row."""
    model, d = _fit(spark, sf)
    lr = model.stages[-1]
    train_n = d.filter(F.col("split") == "train")
    m = ml.weighted_metrics(model.transform(train_n))
    return m.select(F.lit("tfidf_logreg").alias("model_name"), F.lit(float(lr.intercept)).alias("intercept"),
                    F.lit(int(lr.numFeatures)).alias("num_features"), "accuracy", "f1_score",
                    F.col("samples").alias("training_samples"))


@query("select_model")
def select_model(spark, sf):
    """M4: small regParam grid; the candidates' metrics, the best one flagged."""
    d = labelled(spark, sf)
    _, metrics = ml.select_model(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "validation"),
                                 (0.0, 0.1), 20)
    return metrics


@query("evaluate_classifier")
def evaluate_classifier(spark, sf):
    """M5: held-out metrics of the M3 model."""
    model, d = _fit(spark, sf)
    return ml.evaluate(model, d.filter(F.col("split") != "train"))


@query("sentiment_ml")
def sentiment_ml(spark, sf):
    """M6, Spark ML back end: the M3 model scores the cleaned comments."""
    model, _ = _fit(spark, sf)
    kept = filters.comment_filter(comments(spark, sf), "value")
    return score_ml(kept, model).select("comment_id", "sentiment", "sentiment_confidence")


@query("train_aspect_classifier")
def train_aspect_classifier(spark, sf):
    """M9: (text, aspect) rows, aspect as a one-hot feature; train-split fit,
    held-out metrics."""
    d = A.add_aspects(labelled(spark, sf), FIXTURE_LEXICON, "text")
    rows = ml.aspect_training_rows(d)
    model = ml.aspect_classifier_pipeline(0.0, 20).fit(rows.filter(F.col("split") == "train"))
    return ml.weighted_metrics(model.transform(rows.filter(F.col("split") != "train")))
