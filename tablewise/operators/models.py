"""Models from `pyspark.ml`: k-means groups and a logistic quality model.

Both fit with Spark's distributed estimators: each iteration is one pass of
partial sums over the partitions, merged into a model of fixed size (k
centres, or one coefficient per feature) on the driver.
"""

from __future__ import annotations

import warnings

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket
from ..functions.numeric import stable_round
from ..functions.vectors import as_double


def warn_unconverged(name: str, iterations: int, max_iter: int) -> None:
    """Say so if a fit ended because its iterations ran out."""
    if iterations >= max_iter:
        warnings.warn(f"{name}: stopped after {iterations} iterations, not converged", stacklevel=3)


def kmeans_groups(emb: DataFrame, k: int = 10, seed: int = 42, max_iter: int = 20,
                  id_col: str = "vec_id", vec_col: str = "embedding"):
    """k-means (k-means|| initialisation, fixed seed) over array vectors.
    Returns (assignments: id, cluster; fitted model, None for empty input)."""
    feats = emb.select(id_col, array_to_vector(as_double(F.col(vec_col))).alias("features"))
    if feats.isEmpty():  # nothing to fit or to assign
        return feats.select(id_col, F.lit(None).cast("int").alias("cluster")), None
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                   predictionCol="cluster").fit(feats)
    warn_unconverged("k-means", model.summary.numIter, max_iter)
    out = model.transform(feats).select(id_col, F.col("cluster").cast("int").alias("cluster"))
    return out, model


def quality_model(rows: DataFrame, id_col: str = "doc_id", label: str = "quality", digits: int = 6,
                  max_iter: int = 100):
    """Logistic regression of ``label`` on log document length and the
    toxicity flag, fitted on the training rows of `clean.hash_split`, which
    depends on the id alone. Returns (held-out predictions: id, label,
    score = P(label = 1); fitted model). Warns if ``max_iter`` ended the fit.
    Without training rows there is no model: held-out rows get a null score."""
    split = F.when(hash_bucket(F.col(id_col), 10) < 8, F.lit("train")).otherwise(F.lit("test"))
    data = (rows.withColumn("split", split)
            .select(id_col, F.col(label).cast("double").alias("label"),
                    F.log1p(F.col("n_chars").cast("double")).alias("log_len"),
                    F.col("toxic").cast("double").alias("toxic"), "split"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["log_len", "toxic"], outputCol="features"),
                            LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter)])
    train = data.where(F.col("split") == "train")
    test = data.where(F.col("split") == "test")
    if train.isEmpty():  # no model can be fitted: every held-out row, score unknown
        return test.select(id_col, F.col("label").cast("int").alias(label),
                           F.lit(None).cast("double").alias("score")), None
    model = pipe.fit(train)
    warn_unconverged("quality model", model.stages[-1].summary.totalIterations, max_iter)
    pred = model.transform(test)
    out = pred.select(id_col, F.col("label").cast("int").alias(label),
                      stable_round(vector_to_array("probability")[1], digits).alias("score"))
    return out, model
