"""Connected components of an edge table, as Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import dropped, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp) for every end of an edge: comp is the least id that is reachable.

    Each round links every root to the least root beside it and halves the
    paths, so the rounds grow with the logarithm of the longest path. Every
    round starts from written tables. Nulls are ignored; no edge gives no row.
    """
    e = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    both = e.union(e.select("v", "u"))
    label = stored(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("u")).alias("comp")), "labels")
    for _ in range(200):
        # Neighbours' labels, sent to the vertex and to its root.
        seen = both.join(label.select(F.col("id").alias("v"), F.col("comp").alias("cv")), "v").groupBy("u").agg(F.min("cv").alias("m"))
        near = seen.join(label.select(F.col("id").alias("u"), F.col("comp").alias("cu")), "u").where("m < cu")
        offers = near.select(F.col("cu").alias("id"), "m").union(near.select(F.col("u").alias("id"), "m"))
        hooked = label.join(offers.groupBy("id").agg(F.min("m").alias("m")), "id", "left").select("id", F.least("comp", "m").alias("comp"))
        hooked = stored(hooked, "hooked")
        up = hooked.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        new = stored(hooked.join(up, "comp", "left").select("id", F.least("comp", "up").alias("comp")), "labels")
        changed = new.join(label.withColumnRenamed("comp", "old"), "id").where("comp <> old").limit(1).count()
        dropped(label, hooked)
        label = new
        if not changed:
            dropped(e)
            return label
    raise RuntimeError("components: no end after 200 rounds")
