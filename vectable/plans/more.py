"""Registered queries: resampling by filters that follow the factor, numbering
and pages by key ranges, one file, schema and rows, decoding of unknown
indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectable.operators import centroid_tree, images, labels, neighbour_map, quality, ranges, reports, vectors
from vectable.operators.common import materialize
from vectable.plans import mapping as M
from vectable.plans.catalog import _embeddings, _r, query
from vectable.session import scratch_path
from vectable.sources import files, tree
from vectable.sources.tables import table

SIZES = {"triangle": 3, "cubic": 13}
RANGE_ROWS, PAGE, PAGE_ROWS = 100, 7, 10
TREE_CLASSES = 211


@query("image_resample")
def image_resample(spark, sf):
    """8 x 8 pixels at 3 x 3 (smaller, a wider filter) and at 13 x 13."""
    px = _embeddings(spark, sf).select("vec_id", F.transform("embedding", lambda x: M.pixel(x)).alias("px"))
    out = None
    for kind, n in SIZES.items():
        grid = images.resample_grid(px, "px", (8, 8, 1), (n, n), kind, "grid").select("vec_id", F.lit(kind).alias("kind"), F.posexplode("grid").alias("pos", "value"))
        out = grid if out is None else out.unionByName(grid)
    return out.select("vec_id", "kind", "pos", _r("value").alias("value"))


@query("dense_numbering")
def dense_numbering(spark, sf):
    """W2, L4 for many values: every different text of the corpus by its number
    in ascending order, numbered range by range."""
    return ranges.dense_index(table(spark, sf, "documents"), "text", "text_index", RANGE_ROWS).select(F.md5("text").alias("text_md5"), "text_index")


@query("page_by_number")
def page_by_number(spark, sf):
    """A page by its number, from the ranges that hold it."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return ranges.ranked(d, ["n_chars", "doc_id"], RANGE_ROWS).page(PAGE, PAGE_ROWS)


@query("single_files")
def single_files(spark, sf):
    """A file for each source, with the size of its texts, read
    back by its exact path: its bytes, and the schema that the rows have."""
    d = quality.require_rows(table(spark, sf, "documents"), "documents")
    lines = d.groupBy("source").agg(F.sum(F.octet_length("text") + 1).alias("n_bytes"))
    sources = labels.column_values(lines, "source")
    base = scratch_path(spark, "single-files")
    small = lines.select(F.lit("all").alias("split"), "source", F.concat(F.col("source"), F.lit(".txt")).alias("name"), F.encode(F.concat(F.col("source"), F.lit("="), F.col("n_bytes").cast("string")), "UTF-8").alias("content"))
    tree.write_files(small.withColumnRenamed("source", "folder"), base)
    out = None
    for s in sources:
        one = files.single_file(spark, f"{base}/all/{s}/{s}.txt")
        row = one.select(F.decode("content", "UTF-8").alias("content"), F.lit(reports.schema_text(one)).alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out


@query("decode_unknown_index")
def decode_unknown_index(spark, sf):
    """An index that no label has is an error, found by the first row that
    holds it; rows of known indexes decode."""
    e = table(spark, sf, "events").where(F.col("event_type").isNotNull())
    dim = materialize(labels.label_dictionary(e.select(F.col("event_type").alias("label"))), "dictionary")
    coded = labels.encode_labels(e.select("event_id", F.col("event_type").alias("label")), dim)
    wrong = coded.withColumn("label_index", F.when(F.col("event_id") % 100 == 0, F.lit(99)).otherwise(F.col("label_index")))
    try:
        labels.decode_labels(wrong, dim, {"label_index": "decoded"}).agg(F.count("decoded")).collect()
        raised = False
    except Exception as x:  # noqa: BLE001 - which error it is, is what the query tells
        raised = "unknown label index: 99" in str(x)
    known = labels.decode_labels(wrong.where(F.col("label_index") != 99), dim, {"label_index": "decoded"})
    return known.groupBy("label").agg(F.count_if(F.col("decoded") == F.col("label")).alias("n_same"), F.lit(raised).alias("unknown_raises"))


@query("nearest_centroid_tree")
def nearest_centroid_tree(spark, sf):
    """K4, J5 for many classes: the nearest of ``TREE_CLASSES`` class means by
    the tree, which the driver never holds; no row meets more than all of them
    and the pivots."""
    e = _embeddings(spark, sf)
    means = vectors.class_means(e.select((F.col("vec_id") % TREE_CLASSES).alias("label"), "embedding"), "label", "embedding")
    tree_ = centroid_tree.build_tree(means)
    out = centroid_tree.nearest_in_tree(e.select("vec_id", "embedding"), tree_, "embedding")
    return out.select("vec_id", "prediction", _r("distance").alias("distance"), (F.col("n_compared") <= tree_.n + len(tree_.pivots)).alias("within"))


@query("latent_neighbours")
def latent_neighbours(spark, sf):
    """K8: the 2-D map that keeps neighbours together, of all vectors: a point
    for every row, and neighbours nearer to each other than on the principal
    components that it starts from. Edges have the true distances."""
    e = _embeddings(spark, sf)
    graph = neighbour_map.neighbour_graph(e, "embedding", ["vec_id", "label"])
    xy = neighbour_map.layout(graph)
    better = neighbour_map.closeness(graph, xy) < neighbour_map.closeness(graph, neighbour_map.start(graph, 42))
    pts = graph.points.select("n", F.col("c0").alias("vec_id"), F.col("c1").alias("label"), "v")
    there = pts.select(F.col("n").alias("to"), F.col("v").alias("w"))
    edges = graph.edges.select("n", F.inline("near").alias("d", "to")).join(pts, "n").join(there, "to")
    gap = F.aggregate(F.zip_with("v", "w", lambda a, b: F.pow(a.cast("double") - b, 2)), F.lit(0.0), lambda s, x: s + x)
    near = edges.groupBy("n").agg(F.count_distinct("to").alias("n_near"), F.count_if((F.col("n") != F.col("to")) & (F.abs(gap - F.col("d")) < 1e-9)).alias("n_true"))
    has = F.col("x").isNotNull() & F.col("y").isNotNull()
    return pts.join(xy, "n").join(near, "n").select("vec_id", "label", has.alias("has_point"), "n_near", "n_true", F.lit(better).alias("better_than_start"))


# ------------------------------------------------------------------------ SQL


def _filtered(kind: str, n: int) -> str:
    x = f"abs((j + 0.5 - (i + 0.5) * 8.0 / {n}) / greatest(1.0, 8.0 / {n}))::DOUBLE"
    cubic = "CASE WHEN x < 1 THEN 1.5 * x * x * x - 2.5 * x * x + 1 WHEN x < 2 THEN -0.5 * (x * x * x - 5 * x * x + 8 * x - 4) ELSE 0 END"
    value = "greatest(0, 1 - x)" if kind == "triangle" else cubic
    return f"""
SELECT vec_id, '{kind}' AS kind, (a.i * {n} + b.i)::INTEGER AS pos, round(greatest(0, least(255, sum(px.v * a.w * b.w))), 6) + 0.0 AS value
FROM px JOIN w{n} a ON a.j = px.r JOIN w{n} b ON b.j = px.c GROUP BY vec_id, a.i, b.i""", f"""
  x{n} AS (SELECT i, j, {x} AS x FROM range({n}) AS s(i), range(8) AS t(j)),
  w{n} AS (SELECT i, j, ({value}) / sum({value}) OVER (PARTITION BY i) AS w FROM x{n})"""


_PARTS = [_filtered(kind, n) for kind, n in SIZES.items()]

ORACLE = {
    "latent_neighbours": """
SELECT vec_id, label, true AS has_point, least(15, (SELECT count(*) FROM embeddings) - 1)::BIGINT AS n_near, least(15, (SELECT count(*) FROM embeddings) - 1)::BIGINT AS n_true, true AS better_than_start FROM embeddings""",
    "image_resample": f"""
WITH u AS (SELECT vec_id, unnest(range(64)) AS p, unnest(embedding)::DOUBLE AS x FROM embeddings),
  px AS (SELECT vec_id, p // 8 AS r, p % 8 AS c, greatest(0, least(255, floor((x + 4.0) * 20.0))) AS v FROM u),{",".join(w for _, w in _PARTS)}
{" UNION ALL ".join(s for s, _ in _PARTS)}""",
    "nearest_centroid_tree": f"""
WITH u AS (SELECT vec_id, vec_id % {TREE_CLASSES} AS cls, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
  c AS (SELECT cls, i, avg(x) AS m FROM u GROUP BY cls, i),
  m AS (SELECT cls, list(m ORDER BY i) AS m FROM c GROUP BY cls),
  d AS (SELECT e.vec_id, m.cls, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(e.v, m.m)]) AS dist FROM (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings) e, m)
SELECT vec_id, arg_min(cls, dist) AS prediction, round(min(dist), 6) + 0.0 AS distance, true AS within FROM d GROUP BY vec_id""",
    "dense_numbering": "SELECT md5(text) AS text_md5, row_number() OVER (ORDER BY text) - 1 AS text_index FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)",
    "page_by_number": f"SELECT doc_id, lang, source, n_chars FROM documents ORDER BY n_chars NULLS FIRST, doc_id LIMIT {PAGE_ROWS} OFFSET {PAGE * PAGE_ROWS}",
    "single_files": "SELECT source || '=' || sum(strlen(text) + 1)::BIGINT AS content, 'struct<content:binary,path:string>' AS columns FROM documents GROUP BY source",
    "decode_unknown_index": "SELECT event_type AS label, count(*) AS n_same, true AS unknown_raises FROM events WHERE event_type IS NOT NULL AND event_id % 100 <> 0 GROUP BY event_type",
}
