"""Registered queries whose operators SQL cannot express (model fit, file
trees, sinks, streams). Their inputs are written by Spark from the driver
tables into a fresh folder under the shared checkpoint folder, so the work
grows with the tables. The driver gives them a rows-only check; the tests
check them against brute force on small inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions import arrays as A
from vectable.operators import labels, model, vectors
from vectable.operators.common import materialize
from vectable.plans import mapping as M
from vectable.plans.catalog import _embeddings, named_predictions, query
from vectable.session import scratch_path
from vectable.sources import files
from vectable.sources.tables import table
from vectable.streaming import files as stream

# A row is in the train split when the first hex digit of md5(id) is below
# 'c' (12 of 16 buckets). md5 is computed the same way by Spark and DuckDB.
TRAIN_BELOW = "c"
MLP_ITERATIONS = 50


def _standardized(spark, sf) -> DataFrame:
    e = _embeddings(spark, sf)
    return e.select("vec_id", "label", A.standardize("embedding").alias("z"))


def _is_train(id_col: str = "vec_id"):
    return F.substr(F.md5(F.col(id_col).cast("string")), F.lit(1), F.lit(1)) < F.lit(TRAIN_BELOW)


def _fit(spark, sf):
    z = _standardized(spark, sf)
    n_classes = int(z.agg(F.max("label")).first()[0]) + 1
    m = model.fit_classifier(z.where(_is_train()), "z", "label", n_classes, hidden=64, max_iter=MLP_ITERATIONS, seed=M.BATCH_SEED)
    return m, z


@query("mlp_predict")
def mlp_predict(spark, sf):
    """Fit [64, 64, k] on the train part, score every row, and
    count the rows whose prediction is a class, whose probabilities sum to 1
    and whose prediction is their first maximum."""
    m, z = _fit(spark, sf)
    p = model.predict(m, z, "z")
    total = F.aggregate("probability", F.lit(0.0), lambda t, x: t + x)
    return p.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((F.col("prediction") >= 0) & (F.col("prediction") < F.size("probability"))).alias("n_class"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_one"),
        F.count_if(F.col("prediction") == A.argmax("probability")).alias("n_argmax"),
    )


@query("mlp_history")
def mlp_history(spark, sf):
    """K6: the loss per iteration of the fit: iterations without a gap, none
    with a higher loss than the one before."""
    m, _ = _fit(spark, sf)
    h = model.history_frame(spark, m)
    before = h.select((F.col("iteration") + 1).alias("iteration"), F.col("loss").alias("before"))
    j = h.join(before, "iteration", "left")
    n = F.count(F.lit(1))
    return j.agg(
        (F.max("iteration") - F.min("iteration") + 1 == n).alias("without_gap"),
        (F.count_if(F.col("loss") > F.col("before")) == 0).alias("never_rises"),
        (n <= F.lit(MLP_ITERATIONS + 1)).alias("within_limit"),
        (F.max_by("loss", "iteration") < F.min_by("loss", "iteration")).alias("has_learned"),
    )


@query("latent_2d")
def latent_2d(spark, sf):
    """K7, K8: hidden-layer features projected to 2-D: a point for every row,
    the first axis of no less variance than the second, and none correlated."""
    m, z = _fit(spark, sf)
    h = model.hidden_features(m, z, "z")
    p = model.project_2d(h, "hidden", ["vec_id"], "label")
    return p.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("n_points"),
        F.count_distinct("vec_id").alias("n_ids"),
        (F.var_pop("x") >= F.var_pop("y")).alias("axes_in_order"),
        (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
    )


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Save, load, score: rows where the loaded and the fresh model agree."""
    m, z = _fit(spark, sf)
    path = scratch_path(spark, "model")
    model.save_model(m, path)
    fresh = model.predict(m, z, "z").select("vec_id", F.col("prediction").alias("p0"), F.col("probability").alias("q0"))
    both = model.predict(model.load_model(path), z, "z").select("vec_id", "prediction", "probability").join(fresh, "vec_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("prediction") == F.col("p0")).alias("n_same_prediction"),
        F.count_if(F.col("probability") == F.col("q0")).alias("n_same_probability"),
    )


@query("csv_roundtrip")
def csv_roundtrip(spark, sf):
    """Predictions table to CSV with header and back."""
    p = named_predictions(spark, sf)
    path = scratch_path(spark, "predictions-csv")
    files.write_csv(p, path)
    return files.read_csv(spark, path, files.PREDICTIONS_SCHEMA)


@query("dump_roundtrip")
def dump_roundtrip(spark, sf):
    """Indexed frame with bytes, dumped partitioned by split, read back;
    the bytes read back are reported by their md5 checksum."""
    e = table(spark, sf, "events").select(
        F.encode("props", "UTF-8").alias("content"),
        F.concat(F.lit("events/"), F.col("event_id").cast("string")).alias("path"),
        F.col("event_type").alias("label"),
        M.event_split().alias("split"),
    )
    dim = labels.label_dictionary(e.select("label"))
    indexed = labels.encode_labels(e, dim)
    path = scratch_path(spark, "dump")
    files.write_dump(indexed, path, ["split"])
    back = files.read_dump(spark, path, indexed.schema)
    return back.select(F.md5("content").alias("content_md5"), "path", "label", "label_index", "split")


def _doc_tree(spark, sf) -> str:
    """documents as text files in a <lang>/<source> folder tree (Spark writes
    ``lang=<x>/source=<y>/part-*.txt``)."""
    path = scratch_path(spark, "doc-tree")
    d = table(spark, sf, "documents").select("lang", "source", "text")
    # The folder count is fixed by the data: a folder's rows go to a few tasks.
    salt = F.pmod(F.xxhash64("text"), F.lit(4))
    d.repartition("lang", "source", salt).write.mode("overwrite").partitionBy("lang", "source").text(path)
    return path


@query("labelled_files")
def labelled_files(spark, sf):
    """Files two levels below a folder, with the label of their
    parent folder, and the bytes of each label."""
    path = scratch_path(spark, "label-tree")
    d = table(spark, sf, "documents").select("source", "text")
    d.repartition("source", F.pmod(F.xxhash64("text"), F.lit(4))).write.mode("overwrite").partitionBy("source").text(path)
    found = files.labelled_files(spark, path, with_content=False)
    return found.groupBy("label").agg(F.sum("length").cast("long").alias("n_bytes"))


@query("files_scan")
def files_scan(spark, sf):
    """Metadata-only listing of a split/class file tree (no
    file bytes are read) and the bytes listed per (split, class) folder.
    (How many part files a folder gets depends on the write, so file counts
    per class, A3, are checked in the tests instead.)"""
    base = _doc_tree(spark, sf)
    listing = files.listing(spark, base)
    return listing.groupBy("split", "label").agg(F.sum("length").cast("long").alias("n_bytes"))


def _embedding_drops(spark, sf) -> tuple[str, DataFrame]:
    """embeddings written as parquet files in two drops (hash halves)."""
    base = scratch_path(spark, "embedding-drops")
    e = _embeddings(spark, sf)
    half = F.pmod(F.xxhash64("vec_id"), F.lit(2))
    for i in (0, 1):
        e.where(half == i).write.mode("overwrite").parquet(f"{base}/drop={i}")
    return base, e


@query("stream_score")
def stream_score(spark, sf):
    """Score vector files as they arrive (availableNow, checkpointed)."""
    base, e = _embedding_drops(spark, sf)
    z = e.select("vec_id", "label", A.standardize("embedding").alias("z"))
    cents = materialize(vectors.class_means(z, "label", "z"), "centroids")
    src = stream.file_stream(spark, f"{base}/*", "parquet", e.schema)
    out = scratch_path(spark, "stream-score-out")

    def score(batch: DataFrame) -> DataFrame:
        raw = batch.select("vec_id", "label", "embedding")
        out = vectors.nearest_centroid(raw, cents, "embedding", standardize_input=True)
        return out.select("vec_id", "label", "prediction")

    stream.run_available_now(src, out, scratch_path(spark, "stream-score-ckpt"), transform=score)
    return stream.read_sink(spark, out)


@query("stream_counts")
def stream_counts(spark, sf):
    """Running counts per (split, label) over arriving files."""
    base, e = _embedding_drops(spark, sf)
    src = stream.file_stream(spark, f"{base}/*", "parquet", e.schema)
    src = src.select(
        F.when(_is_train(), F.lit("train")).otherwise(F.lit("test")).alias("split"),
        F.col("label").cast("string").alias("label"),
    )
    out = scratch_path(spark, "stream-counts-out")
    stream.run_counts_available_now(src, out, scratch_path(spark, "stream-counts-ckpt"))
    return stream.read_counts(spark, out)
