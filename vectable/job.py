"""The training / evaluation job (H1, H2) over a labelled image tree
``<base>/<split>/<class>/<file>``, end to end on Spark:

scan (S2, S4) -> label dictionary over all splits (U1, U2, W2) -> every file
decoded once to a vector (F10-F13) and written as a table, those that give
none with the reason why as rejects (P7) -> encode labels (J1) -> counts of
all files by split (A1) and of the decoded ones (A17), class distribution (A3)
-> optional row caps in path order, applied before unusable files drop out
(L1, L2; a cap on the test split is a preview, not the whole evaluation) ->
fit (K1; dense layers, or convolutions in mini-batches with accuracy and loss
by epoch), history (K6) -> score the test split once (K2) -> decode names (J2)
-> predictions CSV (S7), report, confusion matrix long and wide (A5-A13) ->
spot checks of the first valid and test file (L3, R6, K3) -> model (S10),
training batches (L7, L8); with ``dashboard``: mean image per class (A4) and
the latent 2-D view of five files per class (W1, K7, K8).

Usage: ``python -m vectable.job --base <dir> --out <dir> [--size 256]
[--train-cap 500 --test-cap 200]``. Exit code 0 on success, 1 on error
(message on stderr); a session the job started is always stopped.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vectable.operators import batching, convnet, labels, metrics, model, neighbour_map, quality, vectors
from vectable.operators.common import materialize
from vectable.functions.text import data_uri_encode
from vectable.operators.images import encode_images, image_vectors
from vectable.operators.reports import predictions_table
from vectable.session import build_session
from vectable.sources import files, tree


def run_training_job(
    spark: SparkSession,
    base_dir: str,
    out_dir: str,
    size: tuple[int, int] = (256, 256),
    train_cap: int | None = None,
    test_cap: int | None = None,
    hidden: int = 64,
    max_iter: int = 100,
    seed: int = 42,
    batch_size: int = 32,
    dashboard: bool = False,
    network: str = "mlp",
    latent: str = "pca",
    epochs: int = 10,
    same_padding: bool = False,
    resampling: str = "cubic",
) -> dict:
    if network not in ("mlp", "conv"):
        raise ValueError(f"network is 'mlp' or 'conv', not {network!r}")
    if latent not in ("pca", "neighbours"):
        raise ValueError(f"latent is 'pca' or 'neighbours', not {latent!r}")
    out = out_dir.rstrip("/")
    listing = files.listing(spark, base_dir)
    dim = labels.check_dimension(labels.label_dictionary(listing.select("label")))
    dim.write.mode("overwrite").parquet(f"{out}/label_dictionary")

    # Decoding is the costly step: run it once for every file, whatever its name,
    # and keep the result as a table, which also cuts the lineage that the
    # iterative fit would otherwise replay. A file without a vector is a reject.
    imgs = files.labelled_images(spark, base_dir, only_image_names=False)
    decoded = labels.encode_labels(image_vectors(imgs, size, keep_undecodable=True, resampling=resampling), dim)
    decoded.write.mode("overwrite").partitionBy("split").parquet(f"{out}/vectors")
    decoded = spark.read.schema(decoded.schema).parquet(f"{out}/vectors")
    why = F.when(F.col("height") <= 0, F.lit("undecodable image")).otherwise(F.lit("constant image"))
    decoded.where(F.col("vector").isNull()).select("path", why.alias("reason")).write.mode("overwrite").parquet(f"{out}/rejects")
    vec = decoded.where(F.col("vector").isNotNull())

    counts = {r["split"]: r["n_rows"] for r in labels.split_counts(listing).collect()}
    loaded = {r["split"]: r["n_rows"] for r in labels.split_counts(vec).collect()}
    # Every class folder has a row, whether there are files in it or not.
    folders = tree.class_folders(spark, base_dir)
    tree.tree_distribution(folders, listing).write.mode("overwrite").parquet(f"{out}/class_distribution")

    def split_rows(split: str, cap: int | None):
        rows = vec.where(F.col("split") == split)
        if cap:
            # Cap the split's files (in path order), then drop those that do not
            # decode; fewer than ``cap`` may remain.
            first = batching.ordered_cap(listing.where(F.col("split") == split).select("path"), cap, ["path"])
            rows = rows.join(first, "path", "left_semi")
        return rows

    train = split_rows("train", train_cap).where(F.col("label_index") >= 0)
    quality.require_rows(train, "train split")
    n_classes = dim.count()
    if network == "conv":
        net = convnet.Network(*size, 3, n_classes, hidden=hidden, same=same_padding)
        state = convnet.fit(train, "path", "label_index", "vector", convnet.new_fit(net, seed), epochs, batch_size, seed, validation=split_rows("valid", None))
        convnet.save_fit(spark, state, f"{out}/model")
        convnet.history_frame(spark, state).write.mode("overwrite").parquet(f"{out}/history")
        final_loss = state.history[-1][2]
    else:
        m = model.fit_classifier(train, "vector", "label_index", n_classes, hidden=hidden, max_iter=max_iter, seed=seed)
        model.save_model(m, f"{out}/model")
        history = model.training_history(m)
        model.history_frame(spark, m).write.mode("overwrite").parquet(f"{out}/history")
        final_loss = history[-1][1] if history else None

    def predict(df):
        return convnet.predict(state, df, "vector") if network == "conv" else model.predict(m, df, "vector")

    # Seeded shuffle of the training rows into batches.
    batches = batching.mini_batches(train.select("path", "label_index"), "path", seed=seed, batch_size=batch_size)
    batching.batch_summary(batches, "label_index").write.mode("overwrite").parquet(f"{out}/batches")

    test = split_rows("test", test_cap)
    quality.require_rows(test, "test split")
    # Scored once; every report below reads the keys and classes from this table.
    scored = predict(test).select("path", "label_index", "prediction")
    scored = materialize(scored, "scored")
    named = labels.decode_labels(scored, dim, {"label_index": "true_label", "prediction": "predicted_label"})
    files.write_csv(predictions_table(named, "path", "true_label", "predicted_label"), f"{out}/predictions")

    classes = dim.select(F.col("label_index").alias("cls"))
    pairs = materialize(metrics.pair_counts(scored, "label_index", "prediction"), "pairs")
    report = metrics.class_report(scored, "label_index", "prediction", classes, counts=pairs)
    report.write.mode("overwrite").parquet(f"{out}/report")
    metrics.report_summary(report, scored, "label_index", "prediction", counts=pairs).write.mode("overwrite").parquet(f"{out}/summary")
    long = metrics.confusion_long(scored, "label_index", "prediction", classes, counts=pairs)
    long.write.mode("overwrite").parquet(f"{out}/confusion")
    names = {r["label_index"]: r["label"] for r in dim.collect()}  # class-sized: each class is a column
    metrics.confusion_wide(spark.read.parquet(f"{out}/confusion"), sorted(names), names).write.mode("overwrite").parquet(
        f"{out}/confusion_wide"
    )

    # The first file of the valid and test splits, scored on its
    # own; a file that does not decode gets no prediction.
    firsts = [
        batching.first_row(listing.where(F.col("split") == s).select("path", "split", "label"), ["path"])
        for s in ("valid", "test")
    ]
    spot = firsts[0].unionByName(firsts[1])
    paths = [r["path"] for r in spot.collect()]  # two at most
    spot = spot.join(vec.where(F.col("path").isin(paths)).select("path", "vector"), "path", "left")
    spot = predict(labels.encode_labels(spot, dim))
    spot = labels.decode_labels(spot, dim, {"label_index": "true_label", "prediction": "predicted_label"})
    spot.select("split", "path", "true_label", "predicted_label").write.mode("overwrite").parquet(f"{out}/spot_checks")

    if dashboard:
        # A4 on images: mean of the resized 0..255 pixels per class, truncated.
        named_images = files.labelled_images(spark, base_dir, ["train"])
        raw = image_vectors(named_images, size, standardize=False, resampling=resampling)
        means = encode_images(vectors.class_means_truncated(raw, "label", "vector"), "mean", *size, 3)
        means.withColumn("uri", data_uri_encode("content")).drop("content").write.mode("overwrite").parquet(f"{out}/mean_images")
        # W1 + K7 + K8: the first five training files per class, hidden-layer
        # features, projected to 2-D.
        few = batching.first_n_per_group(train, "label", ["path"], 5)
        few = few.select("path", "label", "vector")
        feats = convnet.predict(state, few, "vector", hidden_col="hidden") if network == "conv" else model.hidden_features(m, few, "vector")
        flat = neighbour_map.neighbour_map if latent == "neighbours" else model.project_2d
        flat(feats, "hidden", ["path"], "label").write.mode("overwrite").parquet(f"{out}/latent_2d")

    summary = {r["metric"]: r["f1"] for r in spark.read.parquet(f"{out}/summary").collect()}
    return {
        "counts": counts,
        "loaded": loaded,
        "classes": n_classes,
        "train_rows": train.count(),
        "test_rows": test.count(),
        "accuracy": summary.get("accuracy"),
        "final_loss": final_loss,
    }


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--base", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--size", type=int, default=256)
    ap.add_argument("--train-cap", type=int, default=None)
    ap.add_argument("--test-cap", type=int, default=None)
    ap.add_argument("--max-iter", type=int, default=100)
    ap.add_argument("--network", choices=("mlp", "conv"), default="mlp", help="dense layers on all pixels, or convolutions trained in mini-batches")
    ap.add_argument("--epochs", type=int, default=10, help="of the convolutional network")
    ap.add_argument("--batch-size", type=int, default=32)
    ap.add_argument("--same-padding", action="store_true", help="convolutions keep their size (small images)")
    ap.add_argument("--resampling", choices=("cubic", "triangle", "bilinear"), default="cubic")
    ap.add_argument("--latent", choices=("pca", "neighbours"), default="pca", help="axes of the latent 2-D view: principal components, or a map that keeps neighbours together")
    ap.add_argument("--dashboard", action="store_true", help="also write mean images and the latent 2-D view")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    owned = SparkSession.getActiveSession() is None
    spark = None
    try:
        spark = build_session("vectable-job", master=args.master)
        res = run_training_job(
            spark,
            args.base,
            args.out,
            (args.size, args.size),
            args.train_cap,
            args.test_cap,
            max_iter=args.max_iter,
            batch_size=args.batch_size,
            dashboard=args.dashboard,
            network=args.network,
            latent=args.latent,
            epochs=args.epochs,
            same_padding=args.same_padding,
            resampling=args.resampling,
        )
        print(json.dumps(res))
        return 0
    except Exception as e:  # noqa: BLE001 - the job's contract is an exit code
        print(f"ERROR: {e}", file=sys.stderr)
        return 1
    finally:
        if owned and spark is not None:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
