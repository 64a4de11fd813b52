"""Learned classifiers for T07 / T08: nearest centroid on vectors, MLlib text pipeline.

* ``centroids`` -- the mean vector per label: ``posexplode`` the vectors and
  average per (label, position) -- a partial aggregate, one shuffle, at most
  labels x dimensions rows -- then reassemble one array per label.  The result
  has a proven size (labels x d), so it is collected and inlined as literal
  arrays; ``nearest_centroid`` then scores every row against each centroid
  with the native cosine (no join).
* ``train_text_classifier`` -- ``Tokenizer -> HashingTF -> IDF ->
  LogisticRegression`` from ``pyspark.ml``, trained on the labelled rows of a
  deterministic split (id hash), evaluated on the held-out rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmart.operators.vectors import cosine, vector_literal


def centroids(df: DataFrame, label_col: str, vec_col: str) -> dict:
    """label -> mean vector (as a Python list; labels x d values, a proven size)."""
    exploded = df.select(label_col, F.posexplode(F.col(vec_col).cast("array<double>"))
                         .alias("i", "x"))
    means = exploded.groupBy(label_col, "i").agg(F.avg("x").alias("m"))
    arrays = means.groupBy(label_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"])
        .alias("c"))
    return {r[label_col]: list(r["c"]) for r in arrays.collect()}


def nearest_centroid(vec: str | Column, cents: dict) -> Column:
    """T07 (b): label of the most similar centroid (ties -> smallest label)."""
    labels = sorted(cents)
    sims = [F.coalesce(cosine(vec, vector_literal(cents[lab])), F.lit(-2.0)) for lab in labels]
    best = F.greatest(*sims) if len(sims) > 1 else sims[0]
    out = None
    for lab, s in zip(labels, sims):
        out = F.when(s == best, F.lit(lab)) if out is None else out.when(s == best, F.lit(lab))
    return out


def split_by_hash(df: DataFrame, id_col: str, test_percent: int = 30) -> tuple[DataFrame, DataFrame]:
    """Deterministic train / test split on the id hash (same rows on every run)."""
    b = F.pmod(F.xxhash64(F.col(id_col)), F.lit(100))
    return df.filter(b >= test_percent), df.filter(b < test_percent)


def train_text_classifier(train: DataFrame, text_col: str, label_col: str,
                          num_features: int = 1 << 16, reg: float = 0.01, iters: int = 50):
    """T07 (c): a fitted ``PipelineModel`` predicting ``label_col`` from ``text_col``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="[a-z]+", gaps=False,
                       toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label_col, predictionCol="_pred",
                           regParam=reg, maxIter=iters),
    ]
    fitted = Pipeline(stages=stages).fit(train.select(text_col, F.col(label_col).cast("double")))
    # Persist the fitted pipeline to the shared checkpoint folder and load it back: the
    # loaded model is what a scoring job would use, and it carries no training summary
    # (which references the SparkSession and would otherwise be captured by the
    # prediction UDF -- not serializable once the session has used an Observation).
    import uuid

    from pyspark.ml import PipelineModel

    from cardmart.session import checkpoint_root
    path = f"{checkpoint_root(train.sparkSession).rstrip('/')}/models/{uuid.uuid4().hex}"
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def predict_text(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, F.col("_pred").cast("int").alias("predicted"))
