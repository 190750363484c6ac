"""Caps, top-k per group and mini-batch numbering against brute force."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from vectable.operators import batching


def test_mini_batches_match_brute_force(spark):
    ids = list(range(1, 300))
    df = spark.createDataFrame([(i, i % 3) for i in ids], "vec_id long, label int")
    # prefix_len 1 -> 16 ranges, several rows per range
    out = batching.mini_batches(df, "vec_id", seed=7, batch_size=32, prefix_len=1).collect()
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}7".encode()).hexdigest(), i))
    exp = {i: (pos, pos // 32) for pos, i in enumerate(order)}
    got = {r["vec_id"]: (r["row_idx"], r["batch_id"]) for r in out}
    assert got == exp


def test_mini_batches_no_single_partition_window(spark):
    df = spark.createDataFrame([(i, 0) for i in range(50)], "vec_id long, label int")
    plan = batching.mini_batches(df, "vec_id")._jdf.queryExecution().executedPlan().toString()
    # The only global window is over the per-range counts, not the rows.
    assert "__range" in plan


def test_batch_summary(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(70)], "vec_id long, label int")
    b = batching.mini_batches(df, "vec_id", seed=1, batch_size=32)
    s = {r["batch_id"]: r for r in batching.batch_summary(b, "label").collect()}
    assert [s[k]["n_rows"] for k in sorted(s)] == [32, 32, 6]
    rows = sorted(b.collect(), key=lambda r: r["row_idx"])
    assert s[0]["first_labels"] == ",".join(str(r["label"]) for r in rows[:5])


def test_first_n_per_group_and_page(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, g int")
    top = batching.first_n_per_group(df, "g", ["id"], 2).collect()
    assert sorted((r["g"], r["id"]) for r in top) == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
    page = [r["id"] for r in batching.page(df, 1, ["id"], 10).collect()]
    assert page == list(range(10, 20))
    assert [r["id"] for r in batching.ordered_cap(df, 3, [F.col("id").desc()]).collect()] == [29, 28, 27]


def test_rows_without_an_id_get_a_batch(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (None, 0)], "vec_id long, label int")
    assert sorted(r["row_idx"] for r in batching.mini_batches(df, "vec_id", batch_size=2).collect()) == [0, 1, 2]


def test_pages_by_key_are_the_pages_by_offset(spark):
    df = spark.createDataFrame([(i * 3, i % 3) for i in range(30)], "id long, g int")
    last = None
    for k in range(4):
        a = [r["id"] for r in batching.page(df, k, ["id"], 10).collect()]
        assert [r["id"] for r in batching.page_after(df, last, "id", 10).collect()] == a
        last = a[-1] if a else last
