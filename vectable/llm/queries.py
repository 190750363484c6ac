"""The registered queries of this subpackage: thin uses of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm import ann_search, hard_negatives, html_text, jaccard_join, licenses, lm_scoring, mixing, packing, secrets, spherical_caps, toxicity, url_filters, vector_codes

#: Weights of the sources in code-point order, repeating.
SOURCE_WEIGHTS = [3.0, 1.0, 2.0]
#: Documents that the toxicity classifier may learn from.
TOXIC_HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"
TOXIC_LEARN = f"NOT ({TOXIC_HELD_OUT})"
#: Documents that the language model does not learn from, and those that its weights are learned on.
LM_HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 7 = 2"
LM_DELETED = "crc32(cast(cast(doc_id as string) as binary)) % 7 = 3"
#: Rules of hosts and paths.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_scoring.lm_scores(_table(spark, sf_dir, "documents"), f"NOT ({LM_HELD_OUT})", LM_DELETED)
    return out.select("doc_id", F.expr(LM_HELD_OUT).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(_table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op4_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical_caps.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"), keep=["page_id"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), TOXIC_LEARN)
    out = toxicity.toxicity(docs, model, keep=["doc_id"])
    return out.select("doc_id", F.expr(TOXIC_HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "flagged")


def op7_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_texts(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    forest = secrets.train_forest(secrets.bootstrap_findings(docs))
    return secrets.scan(docs, forest)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, sf_dir, "documents"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label), "vec_id % 100 = 0")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jaccard_join, op2_lm_scoring, op3_mix_sources, op4_spherical_caps, op5_html_text,
        op6_toxicity, op7_ann_search, op8_license_scan, op9_secret_scan, op10_best_fit_packing,
        op11_url_filters, op12_hard_negatives, op13_vector_codes,
    )
}

#: The others train, hash or tokenize; they are tested against brute force.
ORACLE: dict[str, str] = {
    "op8_license_scan": licenses.oracle_sql(),
    "op11_url_filters": url_filters.oracle_sql(URL_RULES),
    "op12_hard_negatives": hard_negatives.oracle_sql(),
    "op13_vector_codes": vector_codes.oracle_sql(),
}
