"""Invariants for the rows-only operators: k-means, logistic model,
MinHash near-duplicates against brute force."""

import re

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tablewise.catalog import REGISTRY
from tablewise.operators import clean, evaluate, models, text_vectors

from small import SF_SMALL


def test_kmeans_assigns_nearest_centre(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    out, model = models.kmeans_groups(emb, k=10, seed=42)
    centres = np.array(model.clusterCenters())
    pdf = out.join(emb, "vec_id").toPandas()
    x = np.stack(pdf.embedding.map(lambda v: np.asarray(v, dtype=float)))
    d = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(-1)
    assert (d.argmin(1) == pdf.cluster.values).all()
    assert out.count() == emb.count()


def test_quality_model_auc_equals_rank_sum(spark):
    d = "/root/testdata/sf0.01"
    labels, docs = spark.read.parquet(f"{d}/labels.parquet"), spark.read.parquet(f"{d}/documents.parquet")
    rows = labels.join(docs.select("doc_id", "n_chars"), "doc_id")
    split = clean.hash_split(docs, "doc_id").select("doc_id", "split")
    out, _ = models.quality_model(rows)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC")
    auc_ml = ev.evaluate(out.select(F.col("score"), F.col("quality").cast("double").alias("label")))
    auc_rs = evaluate.auc_rank_sum(out, "score", "quality").first().auc
    assert abs(auc_ml - auc_rs) < 1e-9
    test_ids = split.where("split = 'test'").join(labels, "doc_id").count()
    assert out.count() == test_ids


def shingle_set(text, n=3):
    toks = [t for t in re.split(r"[ \t\r\n]+", text.lower()) if t]
    if len(toks) >= n:
        return {" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1)}
    return {" ".join(toks)} if toks else set()


def test_near_duplicates_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: (r.dup_of, r.jaccard) for r in text_vectors.near_duplicates(docs).collect()}
    pdf = docs.toPandas()
    sets = {i: shingle_set(t) for i, t in zip(pdf.doc_id, pdf.text)}
    ids = sorted(sets)
    partner = {}
    for a_i, a in enumerate(ids):
        for b in ids[a_i + 1:]:
            A, B = sets[a], sets[b]
            if A and B and len(A & B) / len(A | B) >= 0.8:
                partner.setdefault(b, []).append(a)
    # precision: every reported pair is a true pair with the reported Jaccard
    for d, (rep, j) in got.items():
        A, B = sets[d], sets[rep]
        assert rep < d and abs(len(A & B) / len(A | B) - j) < 1e-6 and j >= 0.8
    # recall: every document with an earlier near-duplicate is reported
    assert set(got) == set(partner)


def test_rows_only_queries_run(spark):
    for name, q in REGISTRY.items():
        if q.sql is None and not name.startswith("stream_"):
            assert q.build(spark, SF_SMALL).count() >= 0


def test_centroid_neighbours_in_batches_equal_one_pass(spark):
    from tablewise.operators import text_vectors
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one = sorted(tuple(r) for r in text_vectors.nearest_to_centroids(emb, 5).collect())
    batched = sorted(tuple(r) for r in text_vectors.nearest_to_centroids(emb, 5, max_per_pass=3).collect())
    assert len(one) == 50 and one == batched
