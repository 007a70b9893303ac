import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tickloom.llm import quality
from tickloom.llm.common import documents


def test_held_out_accuracy(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.classify(documents(spark, sf_dir), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.quality).mean() > 0.95
    assert found[found.quality == 1].predicted.mean() > 0.97


def test_held_out_is_the_crc_rule(spark):
    ids = spark.range(200).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in ids)


def test_scores_are_the_log_density_difference():
    draw = np.random.default_rng(3)
    d = quality._STATISTICS
    mix = draw.normal(size=(2, d, d))
    x = [draw.normal(size=(400, d)) @ mix[c] + c for c in (0, 1)]
    moments = np.stack([(e := np.hstack([np.ones((400, 1)), v])).T @ e for v in x])
    model = quality.from_moments(moments, 0.3)
    both = np.vstack(x)
    z = [(v - model.centre) / model.scale for v in x]
    pooled = sum(np.cov(v.T, bias=True) for v in z) / 2
    target = np.diag(np.diag(pooled)) + 1e-3 * np.eye(d)
    point = np.clip((both - model.centre) / model.scale, -quality.REACH, quality.REACH)
    logs = []
    for v in z:
        c = 0.7 * np.cov(v.T, bias=True) + 0.3 * target
        off = point - v.mean(axis=0)
        logs.append(-0.5 * (off @ np.linalg.inv(c) * off).sum(axis=1) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(model.scores(both), 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700))), atol=1e-6)


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, None), (5, 1), (6, 1), (None, 0), (7, 0), (8, 0), (12, 0)], "doc_id long, quality int")
    found = quality.classify(edge_docs, labels).collect()
    assert len(found) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert quality.classify(no_docs, labels).count() == 0
    alone = quality.classify(edge_docs, labels.where("quality = 1")).collect()
    assert len({r.score for r in alone}) == 1 and alone[0].score > 0.5
    assert quality.classify(edge_docs, labels.limit(0)).select("score").distinct().collect()[0][0] == pytest.approx(0.5)


def test_keep_good_is_what_classify_predicts(spark):
    docs, labels = documents(spark, SF_DIR), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = quality.keep_good(docs.withColumn("score", F.lit(1)), labels)
    good = quality.classify(docs, labels).where("predicted = 1")
    assert kept.columns == [*docs.columns, "score"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in good.collect())
    assert 0 < kept.count() < docs.count()
