"""Plan-shape regressions for the scale properties the operators promise."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from conftest import SF_SMOKE
from vectable.functions import arrays as A
from vectable.operators import batching, labels, metrics, model, vectors


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet")
    p = plan(batching.first_n_per_group(df, "label", ["vec_id"], 5))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_class_means_aggregate_partially(spark):
    df = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet")
    p = plan(vectors.class_means(df, "label", "embedding"))
    # Sums of each task below the exchange, and no aggregate that falls back to sorting vectors.
    assert p.index("MapInArrow merged") < p.index("Exchange hashpartitioning(label") < p.index("MapInArrow fn")
    assert "Aggregate" not in p


def test_report_counts_aggregate_partially(spark):
    df = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    p = plan(metrics.per_class_counts(df, "event_type", "event_type"))
    assert "partial_sum" in p


def test_encode_is_a_broadcast_join_and_scan_is_pruned(spark):
    e = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    dim = labels.label_dictionary(e.select(F.col("event_type").alias("label")))
    p = plan(labels.encode_labels(e.select("event_id", "event_type"), dim, "event_type"))
    assert "BroadcastHashJoin" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in p


@pytest.mark.parametrize("engine", ["jvm", "arrow"])
def test_scoring_runs_once_per_row(spark, engine):
    """The distance computation must appear once (no copy pushed into a
    filter inferred from the confusion-matrix join)."""
    e = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").select("vec_id", "label", "embedding")
    cents = vectors.class_means(e, "label", "embedding")
    scored = vectors.nearest_centroid(e, cents, "embedding", engine=engine)
    p = plan(metrics.pair_counts(scored, "label", "prediction").where("pred is not null"))
    if engine == "jvm":
        assert p.count("lambdafunction(aggregate(zip_with") == 1
    else:
        assert p.count("MapInArrow") == 1 and "embedding#" not in p.split("MapInArrow")[0]


@pytest.mark.parametrize("name", ["report_summary", "report_text", "class_report"])
def test_reports_read_the_predictions_once(spark, name):
    """What is left in the plan reads the pair counts; only class_report scans the table itself."""
    p = plan(queries()[name](spark, SF_SMOKE))
    assert p.count("events.parquet") == (1 if name == "class_report" else 0)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(queries()[name](spark, SF_SMOKE))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_metrics_agree_with_spark_ml_evaluator(spark):
    e = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").select("vec_id", "label", A.standardize("embedding").alias("z"))
    m = model.fit_classifier(e, "z", "label", 10, hidden=8, max_iter=10, seed=3)
    scored = model.predict(m, e, "z")
    rep = metrics.class_report(scored, "label", "prediction")
    summ = {r["metric"]: r for r in metrics.report_summary(rep, scored, "label", "prediction").collect()}
    ev_in = scored.select(F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert summ["accuracy"]["f1"] == pytest.approx(ev.setMetricName("accuracy").evaluate(ev_in), abs=1e-12)
    assert summ["weighted avg"]["precision"] == pytest.approx(ev.setMetricName("weightedPrecision").evaluate(ev_in), abs=1e-12)
    assert summ["weighted avg"]["recall"] == pytest.approx(ev.setMetricName("weightedRecall").evaluate(ev_in), abs=1e-12)
    assert summ["weighted avg"]["f1"] == pytest.approx(ev.setMetricName("weightedFMeasure").evaluate(ev_in), abs=1e-12)
    # cross-entropy with Spark's clipping equals the evaluator's log loss
    prob = model.with_features(scored, "probability", "probability_vec").select(
        F.col("label").cast("double").alias("label"), "probability_vec", F.col("prediction").cast("double").alias("prediction"), "probability", F.col("label").alias("i")
    )
    ll = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", probabilityCol="probability_vec", metricName="logLoss", eps=1e-15)
    ce = metrics.cross_entropy(prob, "probability", "i", eps=1e-15).first()["cross_entropy"]
    assert ce == pytest.approx(ll.evaluate(prob), rel=1e-9)
    assert np.isfinite(ce)


def test_class_means_compute_a_derived_vector_once(spark):
    """The complete-vector filter must not copy the standardisation below it."""
    e = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet")
    z = e.select("label", A.standardize("embedding").alias("z"))
    p = plan(vectors.class_means(z, "label", "z"))
    assert p.count("array_repeat(struct(mu") == 1


def test_vector_rejects_compute_the_reason_once(spark):
    from vectable.operators import quality

    e = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet")
    p = plan(quality.vector_rejects(e, "vec_id", "embedding", 64))
    assert p.count("THEN missing WHEN") == 1
