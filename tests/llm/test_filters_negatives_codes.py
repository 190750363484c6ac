"""Operators 11 to 13 against brute force, on small frames with nulls, ties,
repeated rows, empty tables, long texts and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.llm import hard_negatives, queries, url_filters, vector_codes
from vectable.llm.hard_negatives import Lists, rest_norms, search_cell

SF = "/root/testdata/sf0.001"
RULE = "host string, path string, verdict string"
VEC = "vec_id long, embedding array<double>, label int"


# --- 11 ----------------------------------------------------------------------


def judge(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))]
    fits = [r for r in rules if r[0] and r[2] in ("allow", "block") and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1] or "")]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1] or ""), len(r[0]), r[2] == "block"))
    return host, path, best[0] + (best[1] or ""), best[2]


def urls(seed=1, n=600):
    r = random.Random(seed)
    hosts = ["example.org", "a.example.org", "A.Example.ORG", "b.a.example.org", "notexample.org", "org", "com", "x.com", "x..com", ".com", "com.", "Ünï.com", "x.org:80", "u@x.org", "", ".".join("l" * 1 for _ in range(40)) + ".org"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12.html", "/en/2", "/de/x", "/fr/", "/FR/", "/" + "p" * 200, "/" + "p" * 199 + "q", "/a\nb"]
    tails = ["", "?q=/es/", "#://com/de/", "?a#b"]
    out = [f"{r.choice(['http', 'https', ''])}://{r.choice(hosts)}{r.choice(paths)}{r.choice(tails)}" for _ in range(n)]
    return [*out, None, "", "no scheme.org/es/", "http:/example.org/es/", "://org/", "a://b://example.org/es/", "http://" + "x" * 100_000 + ".org/" + "y" * 100_000]


MANY = [
    *queries.URL_RULES, ("example.org", "", "allow"), ("a.example.org", "/es/1", "allow"), ("org", "/" + "p" * 200, "block"), ("org", "/" + "p" * 150, "allow"),
    ("com", "/de/", "allow"), (None, "/", "block"), ("", "/", "block"), ("x.com", None, "block"), ("com", "/en/2", "maybe"), (".".join(["l"] * 40) + ".org", "/", "block"), (".".join(["m"] + ["l"] * 39) + ".org", "/", "allow"),
]


@pytest.mark.parametrize("rules", [queries.URL_RULES, MANY])
def test_op11_rules_as_brute_force(spark, rules):
    given = urls()
    pages = spark.createDataFrame([(i % 500, u) for i, u in enumerate(given)], "page_id long, url string").repartition(3)
    out = url_filters.judge_urls(pages, spark.createDataFrame(rules, RULE), keep=["page_id", "url"])
    got = sorted(((r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()), key=str)
    assert got == sorted(((i % 500, u, *judge(u, rules)) for i, u in enumerate(given)), key=str)


def test_op11_hot_hash_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "SPLIT", 10)
    given = ["https://hot.example.org/es/1"] * 200 + urls(2, 50)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string")
    out = url_filters.judge_urls(pages, spark.createDataFrame(MANY, RULE))
    assert {r["page_id"]: tuple(r)[1:] for r in out.collect()} == {i: judge(u, MANY) for i, u in enumerate(given)}


def test_op11_no_rules_no_pages_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://x.org/", "mine", "mine too")], "page_id long, url string, host string, rule string")
    none = spark.createDataFrame([], RULE)
    out = url_filters.judge_urls(pages, none, keep=["page_id", "host", "rule"], default="block")
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert [tuple(r) for r in out.collect()] == [(1, "x.org", "/", None, "block")]
    assert url_filters.judge_urls(pages.limit(0), spark.createDataFrame(MANY, RULE)).count() == 0


# --- 12 ----------------------------------------------------------------------


def mined(rows, anchors, positives=5, negatives=5, low=80, high=100, scale=256):
    good = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in sorted({i for i, _, _ in good if anchors(i)}):
        lab, v = min((lab, v) for i, lab, v in good if i == a)
        s = [(sum(x * y for x, y in zip(v, w)), i, m == lab) for i, m, w in good if i != a]
        best = sorted((-x, i) for x, i, same in s if same)[:positives]
        for ps, p in [(-x, i) for x, i in best]:
            inside = sorted((-x, i) for x, i, same in s if not same and low * ps <= 100 * x <= high * ps)[:negatives]
            out += [(a, p, r + 1, i, ps, -x) for r, (x, i) in enumerate(inside)]
    return sorted(out)


def vectors(seed, n, dim=20, labels=4, spread=0.6):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(labels, dim))
    label = r.integers(0, labels, n)
    x = centre[label] * spread + r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.round(x, 2)  # ties
    return [(int(i), x[i].tolist(), int(label[i])) for i in range(n)]


def odd(dim):
    nan, inf = float("nan"), float("inf")
    return [
        (900, None, 1), (901, [], 1), (902, [nan] + [0.1] * (dim - 1), 1), (903, [inf] + [0.1] * (dim - 1), 1), (904, [None] + [0.1] * (dim - 1), 1),
        (None, [0.2] * dim, 1), (905, [0.2] * dim, None), (1000, [0.0] * dim, 1), (1001, [0.0] * dim, 2), (1002, [-0.5] * dim, 3),
    ]


def got_mined(df, **kw):
    out = hard_negatives.hard_negatives(df, "vec_id % 10 = 0", **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("seed,n,kw", [(1, 300, {}), (2, 40, {}), (3, 250, {"low": 50, "high": 90, "positives": 3, "negatives": 2}), (4, 7, {})])
def test_op12_as_brute_force(spark, seed, n, kw):
    rows = vectors(seed, n) + odd(20)
    rows += rows[: n // 10]  # repeated rows
    want = mined(rows, lambda i: i % 10 == 0, **kw)
    assert got_mined(spark.createDataFrame(rows, VEC).repartition(4), **kw) == want


def test_op12_thresholds_are_lowered_until_windows_fill(spark, monkeypatch):
    # A tiny sample sets poor thresholds, many cells and groups of anchors: the result is the same.
    rows = vectors(5, 400, labels=3) + [(2000 + i, v, 9) for i, v, _ in vectors(6, 3)]  # a rare label too
    want = mined(rows, lambda i: i % 10 == 0)
    for name, value in (("SAMPLE", 24), ("CELL_ROWS", 50), ("CELL_ANCHORS", 7), ("CELLS", 5)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert got_mined(spark.createDataFrame(rows, VEC)) == want


def test_op12_empty_and_clashing(spark):
    none = spark.createDataFrame([], VEC)
    assert got_mined(none) == []
    rows = vectors(7, 30)
    one_label = [(i, v, 1) for i, v, _ in rows]
    assert got_mined(spark.createDataFrame(one_label, VEC)) == []
    clash = spark.createDataFrame(rows, VEC).withColumn("rank", F.lit(1)).withColumn("id", F.lit("x")).withColumn("key", F.lit(0))
    assert got_mined(clash) == mined(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="64 bits|32 bits"):
        got_mined(spark.createDataFrame([(0, [1e300] * 3, 1), (1, [1.0] * 3, 2)], VEC))
    text = spark.createDataFrame([(i, v, f"label {m}") for i, v, m in rows], "vec_id long, embedding array<double>, label string")
    assert got_mined(text) == mined(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("dtype", [np.float32, np.float64, np.int64])
@pytest.mark.parametrize("t", [-50.0, 30.0, 400.0, 1500.0, 4000.0])
def test_op12_lists_lose_no_pair(dtype, t):
    r = np.random.default_rng(int(t) % 97)
    x = np.floor(r.normal(size=(300, 43)) * np.linspace(20, 1, 43)).astype(dtype)
    q = np.floor(r.normal(size=(17, 43)) * np.linspace(20, 1, 43)).astype(dtype)
    edges = [*range(0, 43, 8), 43]
    limit = t + np.arange(17.0)
    rest = rest_norms(q, edges)
    lists = Lists(x, float(limit.min()), rest.max(axis=0) * 1.0001)
    i, j, s = lists.pairs(q, rest, limit)
    full = (q.astype(np.int64) @ x.astype(np.int64).T)
    want = {(a, b, int(full[a, b])) for a, b in zip(*np.nonzero(full >= limit[:, None]))}
    assert {(int(a), int(b), int(c)) for a, b, c in zip(i, j, s)} == want
    if t >= 1500:  # rows whose rest cannot matter are not indexed to the end
        assert lists.many[-1] < len(x)


def test_op12_cell_keeps_no_more_than_windows_hold():
    r = np.random.default_rng(3)
    x = r.integers(-3, 4, (5000, 8)).astype(np.float32)
    q = x[:40]
    keys = r.integers(0, 2, 5000)
    far = hard_negatives.FAR
    a, w, ids, s = search_cell(x, np.arange(5000), keys, q, np.arange(40), keys[:40], np.full(40, -far), [[(1, far, -far)]] * 40, 5, True)
    assert len(a) == 200
    full = (q.astype(np.int64) @ x.astype(np.int64).T)
    for i in range(40):
        want = sorted((-full[i, j], j) for j in range(5000) if j != i and keys[j] == keys[i])[:5]
        assert sorted((-int(y), int(z)) for y, z in zip(s[a == i], ids[a == i])) == want


# --- 13 ----------------------------------------------------------------------


def coded(rows, parts=4, entries=16, rounds=6, scale=4096):
    good = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(good[0][2]) // parts
    piece = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, _, v in good]
    book = [[list(piece[e][p]) for e in range(min(entries, len(good)))] for p in range(parts)]

    def nearest(x, entries_):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(entries_))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(x[p], book[p])[1] for x in piece]
            for j in range(len(book[p])):
                mine = [x[p] for x, o in zip(piece, own) if o == j]
                if mine:
                    book[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    out, total = [], {}
    for (i, lab, _), x in zip(good, piece):
        best = [nearest(x[p], book[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        total[lab] = total.get(lab, 0) + error
        out.append((i, "".join(f"{j:02x}" for _, j in best), error, lab))
    digest = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    return sorted(((i, c, e, total[lab], digest) for i, c, e, lab in out), key=str)


def got_coded(df, **kw):
    out = vector_codes.vector_codes(df, **kw)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("n,entries,rounds", [(300, 16, 6), (11, 16, 6), (120, 3, 2), (60, 1, 6), (200, 2, 9), (150, 40, 4)])
def test_op13_as_brute_force(spark, n, entries, rounds):
    rows = vectors(n, n) + odd(20)[:5] + [(None, [0.25] * 20, 1), (5000, [0.25] * 20, None), (5001, [-0.25] * 20, None)]
    rows += rows[:10]  # repeated rows; ties among the first entries
    df = spark.createDataFrame(rows, VEC).repartition(3)
    assert got_coded(df, parts=4, entries=entries, rounds=rounds) == coded(rows, 4, entries, rounds)


def test_op13_equal_vectors_empty_tables_and_clashing_columns(spark):
    same = [(i, [0.1, -0.2, 0.3, 0.4], 1) for i in range(30)]
    df = spark.createDataFrame(same, VEC).withColumn("code", F.lit("mine")).withColumn("data", F.lit(1)).withColumn("block", F.lit(2))
    assert got_coded(df, parts=2) == coded(same, 2)
    assert got_coded(df.limit(0), parts=2) == []
    with pytest.raises(ValueError, match="divide"):
        vector_codes.vector_codes(df, parts=3)
    with pytest.raises(Exception, match="unequal lengths"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 4, 1), (2, [1.0] * 6, 1)], VEC), parts=2)
    text = spark.createDataFrame([(f"id{i:03}", v, f"l{m}") for i, v, m in vectors(8, 50)], "vec_id string, embedding array<double>, label string")
    assert len(got_coded(text, parts=4)) == 50


def test_op13_bounds_never_miss_and_save_distances():
    """Rounds with bounds equal rounds with all distances, while few parts meet all entries."""
    r = np.random.default_rng(4)
    x = np.floor(r.normal(size=(4000, 8)) * 900).astype(np.int64)
    x[1000:1200] = x[1000]
    book = x[:16].copy()
    book[5] = book[3]  # ties
    b, bounds, whole = 4, vector_codes.Bounds.measured(x, book, 4), []
    for step in range(14):
        exact = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (bounds.near[:, 0] == exact.argmin(1)).all()
        assert (bounds.outer <= np.sqrt(np.where((bounds.near[:, :, None] == np.arange(16)).any(1), np.inf, exact)).min(1)).all()
        own = bounds.near[:, 0]
        sums = np.stack([x[own == j].sum(0) for j in range(16)])
        new = vector_codes.refined(book, sums, np.bincount(own, minlength=16))
        drift = np.sqrt(((new - book) ** 2).sum(1)) * (1 + 1e-6) + 1e-6
        book = new
        bounds = bounds.resized(b)
        bounds.near = bounds.near.copy()
        used, all_ = bounds.moved(x, book, drift)
        whole.append(all_)
        b = vector_codes.next_width(b, 16, np.bincount(used, minlength=256), all_, len(x))
        assert 2 <= b <= 16
    assert whole[-1] < len(x) / 3


def test_new_queries_give_rows_and_columns(spark):
    for name in ("op11_url_filters", "op12_hard_negatives", "op13_vector_codes"):
        assert queries.QUERIES[name](spark, SF).count() > 0
        assert name in queries.ORACLE
