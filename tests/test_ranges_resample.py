"""Dense numbering, page index and resampling against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.functions.resample import resample, response, weights
from vectable.operators import images, ranges
from vectable.operators.ranges import dense_index, ranked

KEYED = "k string, id long"


def keyed(n=500, seed=1):
    r = random.Random(seed)
    # A third of all rows share a key; some have none.
    return [(r.choice(["hot", f"k{r.randrange(60):02}", f"k{r.randrange(60):02}", None] if i % 9 == 0 else ["hot", f"k{r.randrange(60):02}", f"é{i % 7}"]), i) for i in range(n)]


def in_order(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))


@pytest.mark.parametrize("range_rows", [7, 64, 10_000])
def test_numbers_and_pages_of_the_whole_order(spark, range_rows):
    rows = keyed()
    r = ranked(spark.createDataFrame(rows, KEYED).repartition(5), ["k", "id"], range_rows)
    want = in_order(rows)
    assert r.n == 500
    got = sorted((x["row_idx"], x["k"], x["id"]) for x in r.numbered().collect()) if range_rows == 7 else None
    if got:
        assert got == [(i, *x) for i, x in enumerate(want)]
    for page in (0, 1, 7, 49, 50, 1000, -1):
        assert [tuple(x) for x in r.page(page).collect()] == (want[page * 10 : page * 10 + 10] if page >= 0 else [])
    assert [tuple(x) for x in r.slice(3, 490).collect()] == want[3:493]


def test_hot_key_is_dealt_over_ranges(spark):
    rows = [("same", i) for i in range(400)]
    r = ranked(spark.createDataFrame(rows, KEYED), ["k"], 50)
    sizes = [x["n"] for x in r.table.groupBy("__range").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 150
    assert sorted(x["id"] for x in r.numbered().collect()) == list(range(400))
    assert sorted(x["row_idx"] for x in r.numbered().collect()) == list(range(400))


def test_dense_index_is_the_place_among_distinct_values(spark):
    rows = keyed()
    got = {x["k"]: x["label_index"] for x in dense_index(spark.createDataFrame(rows, KEYED), "k", range_rows=9).collect()}
    assert got == {k: i for i, k in enumerate(sorted({k for k, _ in rows if k is not None}, key=str.encode))}
    none = spark.createDataFrame([], KEYED)
    assert dense_index(none, "k").count() == 0 and ranked(none, ["k"]).page(0).count() == 0


def test_ranges_are_as_many_as_the_driver_can_sample(spark, monkeypatch):
    """the keys that Spark samples for the bounds of small ranges are bounded in bytes."""
    count = ranges.range_count
    assert [count(n, 8 * n, 100) for n in (0, 1, 1000, 100_000)] == [1, 1, 10, ranges.RANGES]
    for n, wide in ((256_410, 3400), (5_000_000, 3400), (10_000, 1 << 20)):
        assert count(n, n * wide, 100) * ranges.SAMPLED * wide <= 2 * max(ranges.SAMPLE_BYTES, ranges.SAMPLED * wide)
    assert count(10**9, 8 * 10**9) == 2000
    monkeypatch.setattr(ranges, "RANGES", 5)
    rows = [(f"text {i * 7919 % 3000:05}", i) for i in range(3000)]
    r = ranked(spark.createDataFrame(rows, KEYED).repartition(6), ["k"], 10)
    assert len(r.starts) <= 5
    assert sorted((x["row_idx"], x["k"]) for x in r.numbered().collect()) == list(enumerate(sorted(k for k, _ in rows)))


def test_a_page_reads_its_ranges_only(spark):
    r = ranked(spark.createDataFrame(keyed(), KEYED), ["k", "id"], 50)
    page = r.page(12)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "PartitionFilters: [isnotnull(__range" in plan
    scan = page._jdf.queryExecution().sparkPlan().collectLeaves().apply(0)
    assert 1 <= scan.selectedPartitions().partitionCount() <= 2 < len(r.table.inputFiles())
    assert "Window" not in r.numbered()._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------- resample


@pytest.mark.parametrize("kind", ["triangle", "cubic"])
@pytest.mark.parametrize("n_in,n_out", [(8, 3), (8, 13), (5, 5), (1, 4), (9, 1), (300, 7)])
def test_weights_as_written_out(kind, n_in, n_out):
    scale = n_in / n_out
    reach = max(1.0, scale)
    for i, row in enumerate(weights(n_in, n_out, kind)):
        raw = [float(response(kind, np.array((j + 0.5 - (i + 0.5) * scale) / reach))) for j in range(n_in)]
        assert np.allclose(row, np.array(raw) / sum(raw)) and row.sum() == pytest.approx(1)
    assert weights(n_in, n_out, kind) is weights(n_in, n_out, kind)


def test_resample_keeps_flat_images_and_means():
    r = np.random.default_rng(1)
    assert np.allclose(resample(np.full((9, 7, 3), 77), 4, 20, "cubic"), 77)
    px = r.integers(0, 256, (64, 64, 3))
    small = resample(px, 4, 4, "triangle")
    assert abs(small.mean() - px.mean()) < 3  # every pixel counts
    stripes = np.tile([[0], [255]], (32, 64))[:, :, None]
    assert np.abs(resample(stripes, 8, 8, "triangle") - 127.5).max() < 20  # no aliasing
    assert (resample(px, 64, 64) == px).all()
    assert resample(np.array([[0, 255, 0, 255.0]])[:, :, None], 1, 9, "cubic").max() <= 255
    with pytest.raises(ValueError, match="filter"):
        weights(2, 3, "none")


def test_grid_column_and_image_vectors(spark):
    r = np.random.default_rng(2)
    px = r.integers(0, 256, (6, 5, 3))
    rows = [(1, px.ravel().tolist()), (2, None), (3, [1] * 7), (4, [None] * 90)]
    df = spark.createDataFrame(rows, "id int, px array<int>")
    got = {x["id"]: x["small"] for x in images.resample_grid(df, "px", (6, 5, 3), (2, 9), "cubic", "small").collect()}
    assert np.allclose(got[1], resample(px, 2, 9, "cubic").ravel()) and got[2] is None and got[3] is None and got[4] is None
    image = spark.createDataFrame([("p", "l", "s", 6, 5, 3, bytearray(px[:, :, ::-1].astype(np.uint8).tobytes()))], "path string, label string, split string, height int, width int, n_channels int, data binary")
    vec = images.image_vectors(image, (2, 2), standardize=False, resampling="triangle").first()["vector"]
    assert np.allclose(vec, resample(px, 2, 2, "triangle").ravel(), atol=1e-4)
