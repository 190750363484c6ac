"""The corpus pipeline: toxic documents go, of near duplicates one stays,
secrets are masked, sources are mixed to weights, and the rest is packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes
it as Parquet and hands the table to the next stage. All but the last return
the columns of ``documents`` (``doc_id, text, lang, source, n_chars``, and any
others that the table has). Stages without documents return none. Each sets
the session to small batches of rows (``small_batches``), as rows hold whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm import jaccard_join, mixing, packing, secrets, toxicity
from vectable.llm.blocks import stored
from vectable.llm.queries import SOURCE_WEIGHTS, TOXIC_LEARN
from vectable.session import small_batches


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is under its language's threshold. The classifier
    learns from the labels of ``sf_dir``, as ``op6`` does."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, TOXIC_LEARN)
    return toxicity.toxicity(docs, model).where(~F.col("flagged")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of linked ones. Rows without
    an id can't be linked by it, and stay; rows that repeat an id are one
    document, which goes when one of its texts has a smaller id's copy."""
    small_batches(spark)
    found = jaccard_join.jaccard_join(docs.select("doc_id", "text"))
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, each secret in a text replaced by a mask; ``n_chars`` follows."""
    small_batches(spark)
    forest = secrets.train_forest(secrets.bootstrap_findings(docs))
    out = secrets.redact(docs, forest)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    small_batches(spark)
    return mixing.take_copies(docs, SOURCE_WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every remaining document with its place in a sequence."""
    small_batches(spark)
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("mix_sources", mix_to_weights),
    ("best_fit_packing", pack_sequences),
]

#: Training, hashing and tokenizing have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
