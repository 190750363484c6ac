"""How the driver tables stand in for the reference's data.

* ``embeddings`` (vec_id, embedding float[64], label 0-9) plays the decoded
  images with their label index;
* ``events.event_type`` plays the class label, and a prediction is derived
  from ``value``; ``user_id`` assigns the dataset split;
* ``pages.url`` plays the file path; ``documents`` (lang x source) plays the
  split x class folders, ``n_chars`` the image test;
* ``labels`` (quality vs 1 - toxic) is a second true/predicted pair.

Each function is a column expression, so every query that uses it still
reads and processes its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the mapping (our own choices, mirrored in the oracle SQL).
SPLIT_TRAIN_MAX = 6  # user_id % 10 in 0..6 -> train, 7 -> valid, 8..9 -> test
MEMBER_MIN_CHARS = 1000  # a document "is an image" from this many characters
PAGE_SUFFIXES = ("jpg", "/", "top")
BATCH_SEED = 42
RICH_ACCTBAL = 9900.0
DOC_PAGE = 2
DOC_CAP = 500
EMBEDDING_DIM = 64  # expected vector length (the reference's fixed image shape)
MAX_PIVOT_CLASSES = 10_000  # column names that a pivot may get
EMPTY_PAIR = ("en", "src8")  # the (split, class) pair left out, so that a zero shows
MANY_CLASSES = 37
SMALL_BLOCK = 4096  # bytes of centroids in a block: several blocks
LAST_KEY = 29


def event_split(user_id: str = "user_id") -> Column:
    m = F.pmod(F.col(user_id), F.lit(10))
    return F.when(m <= SPLIT_TRAIN_MAX, F.lit("train")).when(m == 7, F.lit("valid")).otherwise(F.lit("test"))


def event_prediction(value: str = "value") -> Column:
    """A stand-in classifier over ``value``; it never predicts 'signup'."""
    v = F.col(value)
    return (
        F.when(v < 10, F.lit("click"))
        .when(v < 20, F.lit("error"))
        .when(v < 40, F.lit("view"))
        .otherwise(F.lit("purchase"))
    )


def pixel(x: Column) -> Column:
    """A component as a grey value 0 .. 255."""
    return F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 4.0) * 20.0))).cast("int")


def with_bad_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The rows, some with a vector that cannot be used, by the id's residue mod 7:
    0 missing, 1 short, 2 with a NaN, 3 constant."""
    v, k = F.col(vec_col), F.col(id_col) % 7
    nan = F.lit(float("nan")).cast("float")
    out = (
        F.when(k == 0, F.lit(None))
        .when(k == 1, F.slice(v, 1, 3))
        .when(k == 2, F.concat(F.array(nan), F.slice(v, 2, F.size(v))))
        .when(k == 3, F.transform(v, lambda x: F.lit(1.0).cast("float")))
        .otherwise(v)
    )
    return df.withColumn(vec_col, out)


def is_member_doc(n_chars: str = "n_chars") -> Column:
    return F.col(n_chars) >= F.lit(MEMBER_MIN_CHARS)
