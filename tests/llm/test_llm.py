"""The ten operators and the pipeline against brute force, on small frames with
nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vectable.llm import ann_search, blocks, html_text, jaccard_join, licenses, lm_scoring, mixing, packing, queries, secrets, spherical_caps, toxicity
from vectable.llm.components import components
from vectable.llm.words import hash_words

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def corpus(seed=3, n=120):
    """Random texts with exact and near copies, chains, shared passages, short, empty and null texts."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "naïve", "\u00a0x"]
    passage = " ".join(r.choice(vocab) for _ in range(30))
    texts = []
    for i in range(n):
        t = [r.choice(vocab) for _ in range(r.choice([3, 12, 60, 150]))]
        texts.append(" ".join(t))
        if i % 3 == 0:
            texts.append(texts[-1].upper() if i % 2 else texts[-1])
        if i % 4 == 0:  # a chain of edits
            for _ in range(5):
                t = list(t)
                t[r.randrange(len(t))] = r.choice(vocab)
                texts.append("  ".join(t) + "\n")
        if i % 10 == 0:
            texts.append(passage + " " + " ".join(r.choice(vocab) for _ in range(20)))
    return [*texts, None, "", " \t\n", "one", "ONE", "one two", "two one", "a b c d", "a b c d e"]


def frame(spark, texts, start=0):
    rows = [(start + i, t, ["en", "de", None][i % 3], ["s1", "s2", "s2", None, "s3"][i % 5], len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def empty(spark):
    return spark.createDataFrame([], DOC)


def roots(pairs, ids):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# --- helpers -----------------------------------------------------------------


def test_hash_words_is_a_function_of_words():
    texts = ["The  cat\tsat", "", "cat THE", "x" * 40000, "\x0bé É\x0c"]
    h, bound = hash_words([t.encode() for t in texts])
    got, seen = [h[a:b].tolist() for a, b in zip(bound[:-1], bound[1:], strict=True)], {}
    for t, g in zip(texts, got, strict=True):
        assert len(g) == len(words(t))
        for w, x in zip(words(t), g, strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3), (3, None)]
    got = {x["id"]: x["comp"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {i for e in edges if None not in e and e[0] != e[1] for i in e}
    assert got == roots([e for e in edges if None not in e and e[0] != e[1]], ids)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pack_keeps_all_texts(spark):
    docs = frame(spark, corpus())
    back = {}
    for x in blocks.pack(docs, "doc_id", "text", "doc_id % 2").collect():
        for i, t in zip(x["ids"], blocks.texts_of(x["sizes"], bytes(x["data"])), strict=True):
            assert i % 2 == x["kind"]
            back[i] = t.decode()
    assert back == {i: t or "" for i, t in enumerate(corpus())}


# --- 1 -----------------------------------------------------------------------


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_jaccard(texts):
    sets = [shingles(t) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, roots(pairs, range(len(sets)))


@pytest.mark.parametrize("rounds", [0, 3, None])
def test_jaccard_join(spark, monkeypatch, rounds):
    # With no pairs allowed the rounds of centres run until they are spent; None: as in production.
    if rounds is not None:
        monkeypatch.setattr(jaccard_join, "PAIRS_A_POSTING", 16 if rounds == 0 else 0)
        monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    texts = corpus()
    docs = frame(spark, texts).withColumn("n", F.lit("clash")).withColumn("rep", F.lit(1)).withColumn("shared", F.lit(2))
    got = {x["doc_id"]: x for x in jaccard_join.jaccard_join(docs).collect()}
    sets, comp = brute_jaccard(texts)
    assert {i: (x["n_shingles"], x["component_id"]) for i, x in got.items()} == {i: (len(s), comp[i]) for i, s in enumerate(sets)}
    first = {}
    for i, s in enumerate(sets):
        assert got[i]["class_id"] == (first.setdefault(frozenset(s), i) if s else i)


def test_group_of_many_components_in_one_round(spark):
    # All share five words; families of near copies, and loose documents that link with nothing.
    r = random.Random(5)
    common, texts = "the words that all share", []
    for f in range(40):
        body = [f"f{f}w{i}" for i in range(30)]
        texts += [" ".join([common, *body[:k]]) for k in (30, 29, 27, 24)]
    texts += [" ".join([common, *(f"u{r.random()}" for _ in range(12))]) for _ in range(60)]
    texts += [common + " x"] * 9
    sets, comp = brute_jaccard(texts)
    got = {x["doc_id"]: x["component_id"] for x in jaccard_join.jaccard_join(frame(spark, texts)).collect()}
    assert got == dict(enumerate(comp[i] for i in range(len(texts))))


def test_suffix_filter_decides_before_the_exact_overlap(spark):
    row = "rep long, n long, shared array<long>, bins array<int>"
    reps = spark.createDataFrame([(1, 4, [1, 2, 3, 4], [4, 0]), (2, 4, [1, 2, 3, 4], [4, 0]), (3, 4, [1, 2, 3, 4], [0, 4]), (4, 4, [1, 2, 8, 9], [4, 0])], row)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "a long, b long")
    got = {(r["a"], r["b"]): r["linked"] for r in jaccard_join._verified(pairs, reps, 75).collect()}
    # 3 has the same set but no bin in common: the filter decides before sets are looked at.
    assert got == {(1, 2): True, (1, 3): False, (1, 4): False}


def test_jaccard_join_edges(spark):
    assert jaccard_join.jaccard_join(empty(spark)).count() == 0
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1)]
    got = sorted(tuple(x) for x in jaccard_join.jaccard_join(spark.createDataFrame(rows, DOC)).select("doc_id", "component_id").collect())
    assert got == [(1, 1), (1, 1), (2, 1)]


# --- 2 -----------------------------------------------------------------------


def test_lm_scores(spark):
    texts = corpus() + ["w1 w2 w3 " * 3000]
    docs = frame(spark, texts).withColumn("block", F.lit(1)).withColumn("kind", F.lit("x"))
    got = {x["doc_id"]: x for x in lm_scoring.lm_scores(docs, "doc_id % 7 <> 2", "doc_id % 7 = 3").collect()}
    tokens = [[*words(t), None] for t in texts]
    counts = Counter(w for i, t in enumerate(tokens) if i % 7 != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(tokens):
        x = got[i]
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert x["base_score"] == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert x["score"] < 0


def test_lm_probabilities_are_of_the_method(spark):
    """The score of a text equals the mixture with weights learned by the same EM on brute-force counts."""
    texts = [t for t in corpus(n=60)]
    docs = frame(spark, texts)
    got = {x["doc_id"]: x["score"] for x in lm_scoring.lm_scores(docs, "doc_id % 7 <> 2", "doc_id % 7 = 3").collect()}
    tokens = [[*words(t), None] for t in texts]

    def tables(keep):
        uni, bi, ctx = Counter(), Counter(), Counter()
        for i, t in enumerate(tokens):
            if keep(i):
                for a, b in zip(["<s>", *t], t, strict=False):
                    uni[b] += 1
                    bi[a, b] += 1
                    ctx[a] += 1
        return uni, bi, ctx, sum(uni.values())

    every, counted = tables(lambda i: i % 7 != 2), tables(lambda i: i % 7 not in (2, 3))
    v = len(every[0])

    def estimate(tabs, a, b):
        uni, bi, ctx, n = tabs
        octave = lm_scoring.OCTAVES + int(np.log2(ctx[a])) if ctx[a] else 0
        return octave, uni[b] / n, bi[a, b] / ctx[a] if ctx[a] else 0.0

    weights = {}
    held = [estimate(counted, a, b) for i, t in enumerate(tokens) if i % 7 == 3 for a, b in zip(["<s>", *t], t, strict=False)]
    for o in {h[0] for h in held}:
        p = np.array([[1 / (v + 1), h[1], h[2]] for h in held if h[0] == o])
        w = np.full(3, 1 / 3)
        for _ in range(lm_scoring.EM_ROUNDS):
            s = p * w
            s /= s.sum(axis=1, keepdims=True)
            w = s.sum(axis=0) + 1e-3
            w /= w.sum()
        weights[o] = w
    for i, t in enumerate(tokens):
        want = 0.0
        for a, b in zip(["<s>", *t], t, strict=False):
            o, p1, p2 = estimate(every, a, b)
            w = weights.get(o, np.full(3, 1 / 3))
            want += np.log10(w @ [1 / (v + 1), p1, p2])
        # Estimates fall into quarter octaves while weights are learned.
        assert got[i] == pytest.approx(want, rel=0.02)


def test_lm_edges(spark):
    assert lm_scoring.lm_scores(empty(spark), "true", "false").count() == 0
    rows = [(None, None, "en", "s", 0), (1, "a a", "en", "s", 0), (1, "a a", "en", "s", 0)]
    got = lm_scoring.lm_scores(spark.createDataFrame(rows, DOC), "doc_id = 1", "doc_id < 0").orderBy("doc_id").collect()
    assert [(x["doc_id"], x["n_tokens"], x["train_tokens"]) for x in got] == [(None, 1, 6), (1, 3, 6), (1, 3, 6)]
    none = lm_scoring.lm_scores(spark.createDataFrame(rows, DOC), "false", "false").collect()
    assert all(x["n_known"] == 0 and np.isfinite(x["score"]) for x in none)


def test_lm_beats_the_base_on_held_out_documents(spark):
    got = queries.op2_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.9 * got[1] and got[0] > got[1]


# --- 3 -----------------------------------------------------------------------


def brute_targets(sizes, weights=(3.0, 1.0, 2.0)):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    open_, left, out = set(order), 1.5 * sum(sizes.values()), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mix_sources(spark):
    texts = corpus(n=400)
    docs = frame(spark, texts).withColumn("size", F.lit("clash")).withColumn("grp", F.lit(3))
    got = mixing.mix_sources(docs, [3.0, 1.0, 2.0]).collect()
    again = mixing.mix_sources(docs.repartition(5), [3.0, 1.0, 2.0]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert Counter(x["doc_id"] for x in got) == Counter(range(len(texts)))
    sizes = Counter()
    for i, t in enumerate(texts):
        sizes[["s1", "s2", "s2", None, "s3"][i % 5]] += len(words(t))
    target = brute_targets(sizes)
    taken = Counter()
    for x in got:
        assert x["size"] == len(words(texts[x["doc_id"]])) and x["source_size"] == sizes[x["source"]]
        assert x["target"] == pytest.approx(target[x["source"]]) and 0 <= x["copies"] <= 2
        taken[x["source"]] += x["size"] * x["copies"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 80  # half of the longest document


def test_pivotal_rounding_keeps_mass_and_expectation(spark):
    rows = [(1, i, 1 + (i * 37) % 50, 0.3) for i in range(1500)] + [(2, 9, 5, 0.6)]
    df = blocks.stored(spark.createDataFrame(rows, "grp long, key long, size long, p double"), "t")
    picked = Counter()
    for seed in ("a", "b", "c", "d"):
        got = {(x["grp"], x["key"]): x["copy"] for x in mixing.pivotal_rounding(df, seed).collect()}
        assert len(got) == 1501 and got[2, 9] == 1
        assert abs(sum(s * got[g, k] for g, k, s, _ in rows if g == 1) - 0.3 * sum(r[2] for r in rows[:-1])) <= 50
        picked.update(k for (g, k), c in got.items() if g == 1 and c)
    assert 0.25 < sum(picked.values()) / 6000 < 0.35 and 5 < sum(1 for c in picked.values() if c == 4) < 40


def test_mix_edges(spark):
    assert mixing.mix_sources(empty(spark), [3.0, 1.0]).count() == 0
    rows = [(1, None, "en", "s", 0), (2, "", "en", None, 0), (2, "", "en", None, 0)]
    assert [x["copies"] for x in mixing.mix_sources(spark.createDataFrame(rows, DOC), [1.0]).collect()] == [0, 0, 0]


def test_mix_null_and_repeated_ids_are_documents(spark, monkeypatch):
    """A third of all ids null, some repeated, and many wholly equal rows."""
    monkeypatch.setattr(mixing, "CHUNK", 7)
    texts = corpus(n=400)
    ids = [None if i % 3 == 0 else i // 4 for i in range(len(texts))]
    rows = [(ids[i], t, "en", f"s{i % 4}", i % 2) for i, t in enumerate(texts)] + [(None, "five words in this row", "en", "s1", 0)] * 40
    docs = spark.createDataFrame(rows, DOC)
    got = mixing.mix_sources(docs, [3.0, 1.0, 2.0]).collect()
    again = mixing.mix_sources(docs.repartition(7), [3.0, 1.0, 2.0]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert Counter((x["doc_id"], x["source"], x["size"]) for x in got) == Counter((r[0], r[3], len(words(r[1]))) for r in rows)
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    for x in got:
        taken[x["source"]] += x["size"] * x["copies"]
    longest = max(len(words(t)) for t in texts)
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= longest / 2
    assert len({x["copies"] for x in got if x["doc_id"] is None and x["source"] == "s2"}) > 1  # no one unit
    # The pipeline's form: the same multiset, with all columns.
    whole = Counter(tuple(r) for r in mixing.take_copies(docs, [3.0, 1.0, 2.0]).collect())
    want = Counter()
    for x in got:
        want[x["doc_id"], x["source"], x["size"]] += x["copies"]
    have = Counter()
    for r, c in whole.items():
        have[r[0], r[3], len(words(r[1]))] += c
    assert +want == have and set(whole) <= set(rows)


# --- 4 and 7 -----------------------------------------------------------------


def vectors(spark, n=900, dim=24, seed=4):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    for i in range(0, n // 3):  # near copies of a few, scaled, and chains
        x[i] = x[i % 7] * r.uniform(0.5, 3) + r.normal(size=dim) * 0.12
    x[50], x[51], x[52] = x[49], x[49], 2 * x[49]
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5001, [0.0] * dim, 1), (5002, [float("nan")] * dim, 1), (5003, [None] + [1.0] * (dim - 1), 1), (5004, [float("inf")] * dim, 1), (None, [1.0] * dim, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), np.array([r[1] for r in rows[:n]], dtype=np.float64)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(spherical_caps, "BLOCK", 64)
    df, x = vectors(spark)
    got = {r["vec_id"]: r for r in spherical_caps.near_vectors(df.withColumn("cap", F.lit(1)).withColumn("id", F.lit("x"))).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    n = links.sum(axis=1)
    assert len(got) == len(x) + 5 and all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(5000, 5005))
    assert all(got[i]["n_links"] <= n[i] for i in range(len(x)))
    assert sum(got[i]["n_links"] for i in range(len(x))) >= 0.98 * n.sum()
    comp = roots(np.argwhere(links).tolist(), range(len(x)))
    assert np.mean([got[i]["component_id"] == comp[i] for i in range(len(x))]) > 0.99
    assert spherical_caps.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [10_000, 1_000_000])
def test_caps_recall_at_the_threshold_holds_as_rows_grow(rows):
    r = np.random.default_rng(1)
    x = r.normal(size=(1200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = spherical_caps.fitted(x[:600], 64, rows, 0.9)
    a, b = spherical_caps.pairs_at(x[600:], 0.9, 1000, seed=77)
    assert np.allclose((a * b).sum(axis=1), 0.9) and spherical_caps.recall(code, a, b) >= 0.93


def test_nearest(spark):
    df, x = vectors(spark)
    got = ann_search.nearest(df, "vec_id % 20 = 0").collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == set(range(0, len(x), 20))
    hit = 0
    for q, found in by.items():
        s = x @ x[q]
        best = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(f[2] == pytest.approx(s[f[1]], rel=1e-12) for f in found)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hit += len(set(best) & {f[1] for f in found})
    assert hit >= 0.9 * 20 * len(by)
    assert ann_search.nearest(df.limit(0), "true").count() == 0
    few = ann_search.nearest(df.where("vec_id < 3 or vec_id >= 5000"), "vec_id = 0").collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_nearest_in_blocks_of_queries_and_repeated_ids(spark, monkeypatch):
    df, x = vectors(spark)
    whole = sorted(tuple(r) for r in ann_search.nearest(df, "vec_id % 20 = 0").collect())
    monkeypatch.setattr(ann_search, "QUERY_ROWS", 3)
    monkeypatch.setattr(ann_search, "SPLIT", 16)
    assert sorted(tuple(r) for r in ann_search.nearest(df.union(df.where("vec_id < 40")), "vec_id % 20 = 0").collect()) == whole
    doubles = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted(tuple(r) for r in ann_search.nearest(doubles, "vec_id % 20 = 0").collect()) == whole


# --- 5 -----------------------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain   text\n here", "plain text here"),
        ("<p>one<p>two <b>bold<p>three", "one\n\ntwo bold\n\nthree"),
        ("<title>no</title><script>if (a<b) '</p>'</script><style>p{}</style><h1>Head</h1>text", "Head\n\ntext"),
        ("a<br>b<!-- c --><span hidden>x</span><div style='DISPLAY : none'>y</div> d", "a\nb d"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
        ("<table><tr><th>name<th>n<tr><td>long one<td>2</table>after", "name      n\nlong one  2\n\nafter"),
        ("<td>a<td>b<tr><td>c", "a  b\nc"),
        ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
        ("x &amp; y &lt;z&gt; &eacute;&#33;", "x & y <z> é!"),
        ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n  d1\n  d2"),
        ("</p></b>stray<unknown a=\"1>2\">in</unknown> < 3", "stray in < 3".replace("stray in", "strayin")),
        ("<div>" * 5000 + "deep", "deep"),
    ],
)
def test_page_text(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p title=Bob's>Visible text that isn't markup</p>", "Visible text that isn't markup"),
        ('<p title="a"">one</p><p title="b">two "three"</p>', 'one\n\ntwo "three"'),
        ("<a href=x='>one</a> it's <b title = 'a>b'>two</b>", "one it's two"),
        ('<p title="a>b" hidden>no</p>yes', "yes"),
        ("so <math><mfrac><mi>a</mi><mn>2</mn></mfrac><mo>=</mo><mi>c</mi><annotation>no</annotation></math> holds", "so a/2=c holds"),
        ("<p>fig <svg><title>no</title><defs><text>no</text></defs><style/><path d='M0'/>no<g><text>Label <tspan>one</tspan></text><text>two</text></g></svg></p>", "fig\nLabel one\ntwo"),
        ("<svg><foreignObject><p>html</p></foreignObject></svg>", "html"),
        ('<div style="visibility:hidden">no <b style="visibility: visible">yes</b> no</div>', "yes"),
        ('<table><tr style="visibility:hidden"><td>no</td><td style="visibility:visible">yes</td></tr><tr style="visibility:hidden"><td>no</td></tr></table>', "yes"),
        ("<div>" * 500 + '<div style="display:none">no<div>no</div>no</div>yes' + "</div>" * 500 + "end", "yes\nend"),
        ("<div>" * 20000 + "deep" + "</div>" * 20000 + "end", "deep\nend"),
        ("<table><tr><td>" * 300 + "deep" + "</table>" * 300 + "end", "deep\n\nend"),
    ],
)
def test_all_visible_text(page, text):
    got = [x.strip() for x in html_text.page_text(page).split("\n")]
    assert "\n".join(got) == text


def test_every_visible_word_is_kept(spark):
    got = {r["page_id"]: r["text"] for r in queries.op5_html_text(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        page = re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1>|<!doctype[^>]*>", "", r["html"])
        want = Counter(re.sub(r"<[^>]+>", " ", page).split())
        have = Counter(got[r["page_id"]].split())
        import html as h

        assert sum((Counter(h.unescape(" ".join(want.elements())).split()) - have).values()) <= 0.02 * sum(want.values())
    edge = spark.createDataFrame([(None, None, "clash"), (1, "<p>a", "x"), (1, "<p>a", "x")], "page_id long, html string, text string")
    assert [r["text"] for r in html_text.extract_text(edge).orderBy("page_id").collect()] == ["", "a", "a"]
    assert html_text.extract_text(edge.limit(0)).count() == 0


# --- 6 -----------------------------------------------------------------------


def test_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, sf)
    x = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert ((x["score"] >= 0) & (x["score"] <= 1)).all()
    assert (x["predicted"] == (x["score"] >= 0.7)).all()
    assert x[x["toxic"] == 1]["predicted"].mean() > 0.9 and x[x["toxic"] == 0]["predicted"].mean() < 0.02


def test_thresholds_from_both_labels():
    r = np.random.default_rng(3)

    def cost(s, y, t):
        return toxicity.CLEAN_COST * ((s >= t) & (y == 0)).sum() + ((s < t) & (y == 1)).sum()

    for _ in range(30):
        y = (r.random(150) < 0.4).astype(float)
        s = np.clip(0.3 + 0.45 * y + r.normal(0, 0.2, 150), 0, 1)
        t = toxicity.calibrated(s, y, 0.7)
        every = [c for c in [0.6, 0.9, *s, *np.nextafter(s, 2)] if 0.6 <= c <= 0.9 and (c == 0.6 or (s[y == 1] >= c).mean() >= toxicity.RECALL - 1e-12)]
        assert 0.6 <= t <= 0.9 and cost(s, y, t) == min(cost(s, y, c) for c in every)
    y = np.array([0.0] * 50 + [1.0] * 50)
    s = np.where(y == 1, 0.8, 0.2)
    s[0] = 0.95  # a clean text with a wrong label moves nothing
    assert toxicity.calibrated(s, y, 0.7) == pytest.approx(0.7)
    s[1:4] = 0.7  # clean texts at 0.7 raise it above them
    assert toxicity.calibrated(s, y, 0.7) == pytest.approx(0.75)
    assert toxicity.calibrated(s[:55], y[:55], 0.7) == 0.7


def test_labels_that_disagree_give_the_same_model(spark):
    texts = [f"{'vile scum' if i % 2 else 'kind people'} number {i % 7} of the town" for i in range(120)]
    docs = frame(spark, texts)
    marks = [(i, i % 2) for i in range(120)] + [(i, 0) for i in range(1, 9, 2)]
    made = [toxicity.fit(docs, spark.createDataFrame(m, "doc_id long, toxic int").repartition(k)) for m, k in ((marks, 2), (marks[::-1], 5))]
    a, b = (m["tables"] for m in made)
    assert all(np.array_equal(a[k], b[k]) for k in ("known", "embedding", "offsets", "out", "bias")) and made[0]["by_lang"] == made[1]["by_lang"]


def test_toxicity_learns_from_all_labelled_documents(spark, monkeypatch):
    """words that few of very many documents hold are counted and learned,
    in several shards, and the same for any partitions."""
    monkeypatch.setattr(toxicity, "SHARD", 500)
    monkeypatch.setattr(toxicity, "PASSES", (4, 8))
    bad = ["vile", "scum", "nasty", "dire"]
    rows = [(i, f"{bad[i % 4] if i % 3 == 0 else 'kind'} number {i % 7} of word{i % 900}", "en") for i in range(5400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    own = np.unique(toxicity.text_slots(" ".join(f"word{k}" for k in range(900)).encode())[:, 0])
    assert np.isin(own, model["tables"]["known"]).mean() > 0.95  # each is in six documents, a bounded sample misses some
    s = toxicity.scores([t.encode() for _, t, _ in rows], model["tables"])
    y = np.array([i % 3 == 0 for i, _, _ in rows])
    assert (s[y] > 0.7).mean() > 0.98 and (s[~y] < 0.7).mean() > 0.98
    again = toxicity.fit(docs.repartition(7), labels.repartition(3))
    assert all(np.array_equal(again["tables"][k], model["tables"][k]) for k in ("known", "embedding", "out", "bias")) and again["by_lang"] == model["by_lang"]


def test_toxicity_counts_equal_scores_at_once():
    r = np.random.default_rng(5)
    s, y = np.round(r.random(400), 2), (r.random(400) < 0.4).astype(int)
    u, n = np.unique(np.column_stack([s, y]), axis=0, return_counts=True)
    assert toxicity.calibrated(u[:, 0], u[:, 1], 0.7, n) == toxicity.calibrated(s, y, 0.7)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, None, "s", 0, 9), (2, "", "en", "s", 0, 9), (2, "", "en", "s", 0, 9)], DOC + ", score int")
    labels = spark.createDataFrame([(1, 0, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, toxicity.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "flagged"]
    assert [(r["doc_id"], r["text"], r["score"], r["flagged"]) for r in out.orderBy("doc_id").collect()] == [(1, None, 0.0, False), (2, "", 0.0, False), (2, "", 0.0, False)]


# --- 8 -----------------------------------------------------------------------


def test_license_scan_equals_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", "mit", "Released under the MIT license!\nreleased under THE mit Licence"]
    for _, t in licenses.TEMPLATES:
        w = t.split()
        for _ in range(6):
            v = [x if r.random() < 0.9 else r.choice(["the", "foo", ""]) for x in w]
            texts.append("Intro text. " + " ".join(v) + ("\nmore words here" if r.random() < 0.5 else ""))
    docs = frame(spark, texts).withColumn("segment", F.lit(1)).withColumn("part", F.lit("x")).withColumn("license", F.lit("x"))
    got = sorted(tuple(x) for x in licenses.license_scan(docs).collect())
    want = []
    for i, t in enumerate(texts):
        for k, s in enumerate(re.sub(r"([.!?;])[\x20\x09-\x0d]+", "\\1\n", t or "").split("\n")):
            a = set(licenses.bigrams_of(licenses.words_of(s)))
            best = min(((-2 * len(a & set(b)) / (len(a) + len(b)), name) for name, b in ((n, licenses.bigrams_of(licenses.words_of(u))) for n, u in licenses.TEMPLATES)), default=None) if a else None
            if best and -best[0] >= 0.8:
                want.append((i, k, best[1], round(-best[0], 6)))
    assert got == sorted(want) and len(got) > 40
    assert licenses.license_scan(empty(spark)).count() == 0


def test_licenses_across_lines(spark):
    texts, want = ["nothing of a license here\n" * 50], []
    for mark in ("", "# ", " * ", "// ", "REM "):
        for name, t in [*licenses.HEADERS, *(b for b in licenses.bodies() if len(b[1]) < 3000)]:
            for width in (60, 80, 10**6):
                t = " ".join(t.split())
                texts.append("Foo bar\nCopyright 2020 The Authors\n" + "\n".join(mark + x for x in textwrap.wrap(t, width)) + "\nint main() {\n" * 40)
                want.append((len(texts) - 1, name))
    for name, t in licenses.bodies():
        texts += [t, "x y z\n" * 30 + t]
        want += [(len(texts) - 2, name), (len(texts) - 1, name)]
    mit = dict(licenses.bodies())["MIT"]
    texts += [mit + "\nsome other words\n" + mit, "# Released under\n# the MIT License", 'Licensed under the Apache License,\nVersion 2.0']
    k = len(texts)
    want += [(k - 3, "MIT"), (k - 2, "MIT"), (k - 1, "Apache-2.0")]
    got = licenses.scan_texts(frame(spark, texts)).collect()
    assert {(x["doc_id"], x["license"]) for x in got} >= set(want) and not any(x["doc_id"] == 0 for x in got)
    # But for the notice that both BSD licences share, no other licence is found.
    assert {(x["doc_id"], x["license"]) for x in got} - set(want) <= {(i, "BSD-3-Clause") for i, n in want if n == "BSD-2-Clause"} | {(i, m) for i, n in want if "GPL" in n for m in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0") if "\n" in texts[i]}
    assert sum(x["doc_id"] == k - 3 for x in got) == 2
    assert licenses.license_places(empty(spark)).count() == 0


# --- 9 -----------------------------------------------------------------------


def test_secret_scan(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    hexes = ["%032x" % random.Random(i).getrandbits(128) for i in range(80)]
    texts = [f'text {"a" * (i % 5)} token = "{h}" end' for i, h in enumerate(hexes[:40])]
    texts += [f"file sha256 {h} checked" for h in hexes[40:]] + [f"a {'thing' * 6} word" for _ in range(30)]
    texts += [f"see {key} ok", f"login password={hexes[0][:18]} then", None, "", "nothing here", "x" * 200000]
    docs = frame(spark, texts).withColumn("c0", F.lit("clash")).withColumn("start", F.lit(1))
    forest = secrets.train_forest(secrets.bootstrap_findings(docs))
    got = {}
    for x in secrets.scan(docs, forest).collect():
        got.setdefault(x["doc_id"], []).append(x)
    for i, h in enumerate(hexes):
        (x,) = got[i]
        assert texts[i][x["start"] : x["start"] + x["length"]] == h and x["digest"] == zlib.crc32(h.encode()) and x["secret"] == (i < 40)
    assert got[110][0]["kind"] == "aws_access_key" and got[110][0]["secret"]
    assert got[111][0]["kind"] == "assigned" and got[111][0]["secret"]
    assert not any(x["secret"] for i in range(80, 110) for x in got[i])
    out = {r["doc_id"]: r["text"] for r in secrets.redact(docs, forest).collect()}
    assert out[0] == texts[0].replace(hexes[0], "[SECRET]") and out[50] == texts[50] and out[112] is None and out[115] == texts[115]
    assert secrets.scan(empty(spark), secrets.train_forest(secrets.bootstrap_findings(empty(spark)))).count() == 0


def test_secrets_are_masked_whole(spark):
    r = random.Random(4)
    value = "".join(r.choice("abcdefghijkABCDEF0123456789") for _ in range(2100))
    body = ["".join(r.choice("abcdefghijkABCDEF0123456789+/") for _ in range(64)) for _ in range(400)]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    blocks = [
        "\n".join([begin, *body, end]),
        "\n".join([begin, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", "", *body[:20], end]),
        "\\n".join([begin, *body[:20], end]),
        "\n".join([begin, *body[:20]]),
    ]
    texts = [f'token="{value}" end', *(f"a {b} end" for b in blocks), "token          =          hunter2abc9x end", f"{blocks[3]}\nsome words\n{blocks[0]} end", f"{begin} is how a key starts"]
    scan = secrets.Scanner()
    got = [[(t[a:b]) for _, a, b in scan(t.encode())[1]] for t in texts]
    assert got == [[value], *([b] for b in blocks), ["hunter2abc9x"], [blocks[3], blocks[0]], [begin]]
    assert scan(b"ghp_" + b"a1" * 18 + b".")[1] == [("github_token", 0, 40)]
    assert scan(b"token=ghp_" + b"a1" * 18 + b"$tail9")[1] == [("github_token", 6, 52)]
    forest = secrets.Forest(np.zeros((1, len(secrets.FEATURES))), np.ones(1))
    out = {x["doc_id"]: x["text"] for x in secrets.redact(frame(spark, texts[:5]), forest).collect()}
    assert out == {0: 'token="[SECRET]" end', **{i: "a [SECRET] end" for i in range(1, 4)}, 4: "a [SECRET] end"}
    # Repeated findings do not fill the sample.
    copies = frame(spark, [f'token = "{value[:40]}" end'] * 30 + [f'token = "{value[40 * i : 40 * i + 40]}" end' for i in range(1, 11)])
    assert secrets.bootstrap_findings(copies, sample=20).count() == 11


# --- 10 ----------------------------------------------------------------------


def test_encoder_equals_the_tokenizer_file():
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    encode = packing.Encoder(packing.default_tokenizer())
    r = random.Random(5)
    alphabet = "ab Zé\n\t  'sll\u00a0\u3000日本\U0001f600#1٣ \u200d\r\x0b\x85-_<|endoftext|>"
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "x" * 5000, " " * 300] + ["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(3000)]
    for t in texts:
        assert encode(t).tolist() == [*exact.encode(t, add_special_tokens=False).ids, 0]


def test_best_fit_packing(spark):
    texts = corpus() + ["w1 w2 w3 " * 4000, "hello " * 2047, "hello " * 2048]
    docs = frame(spark, texts).withColumn("length", F.lit("clash")).withColumn("shard", F.lit("clash"))
    got = [r.asDict() for r in packing.best_fit_packing(docs).collect()]
    encode = packing.Encoder(packing.default_tokenizer())
    parts, places = {}, {}
    for x in got:
        parts.setdefault(x["doc_id"], []).append(x)
        places.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    assert set(parts) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = encode(t or "")
        own = sorted(parts[i], key=lambda x: x["piece"])
        at = 0
        for k, x in enumerate(own):
            assert (x["piece"], x["start"]) == (k, at) and x["ids_crc32"] == zlib.crc32(ids[at : at + x["length"]].tobytes())
            at += x["length"]
        assert at == len(ids) and all(x["length"] == 2048 for x in own[1:])
    total = sum(x["length"] for x in got)
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-total // 2048) + 1
    assert packing.best_fit_packing(empty(spark)).count() == 0


def test_the_exact_tokenizer_is_loaded_when_a_text_needs_it():
    encode = packing.Encoder(packing.default_tokenizer())
    encode("plain words, and  blanks")
    assert "exact" not in vars(encode)
    encode("a<|endoftext|>")
    assert "exact" in vars(encode)


def test_large_batches_are_sent_back_in_slices(spark, monkeypatch):
    """What a task makes of a batch of texts at a time is not as large as the batch."""
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.concat("id", F.lit(" word" * 1600)).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    ran = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, schema, was=type(docs).mapInArrow: ran.append((self, fn)) or was(self, fn, schema))
    secrets.redact(docs, lambda features: 1.0)
    toxicity.toxicity(docs, {"tables": None, "threshold": 0.7, "by_lang": {}})
    packing.pieces(docs)
    assert len(ran) == 3
    for rows, fn in ran:
        (batch,) = rows.toArrow().combine_chunks().to_batches()
        assert batch.nbytes > 5 * blocks.SLICE_BYTES
        out = list(fn(iter([batch, batch.slice(0, 0)])))
        assert len(out) > 5 and max(x.nbytes for x in out) < 2 * blocks.SLICE_BYTES
        assert sum(x.num_rows for x in out) >= batch.num_rows
    whole = secrets.redact(docs, lambda features: 1.0).select("doc_id", "text")
    assert whole.exceptAll(docs.select("doc_id", "text")).count() == 0 and whole.count() == 1500


def test_bin_completion_is_optimal_on_small_cases():
    r = random.Random(8)
    for _ in range(60):
        cap = 30
        sizes = [r.randrange(1, cap) for _ in range(r.randrange(1, 9))]

        def fits(items, bins, cap=cap):
            if not items:
                return True
            s, *rest = items
            for i, b in enumerate(bins):
                if b + s <= cap and b not in bins[:i] and fits(rest, [*bins[:i], b + s, *bins[i + 1 :]]):
                    return True
            return False

        best = next(k for k in range(1, 10) if fits(sorted(sizes, reverse=True), [0] * k))
        got = packing.bin_completion(sizes, cap, width=40)
        assert sorted(s for b in got for s in b) == sorted(sizes) and all(sum(b) <= cap for b in got)
        assert len(got) == best
    # Perfect fillings that best-fit decreasing misses.
    sizes = [s for _ in range(30) for s in r.choice([(1000, 700, 348), (1200, 448, 400), (900, 648, 500), (1047, 1001)])]
    assert len(packing.bin_completion(sizes)) <= -(-sum(sizes) // 2048) + 1


def test_bin_completion_of_many_small_pieces():
    r = random.Random(3)
    better = 0
    for parts, bins in ((6, 40), (8, 40), (5, 120), (12, 60)):
        for _ in range(3):
            sizes = []
            for _ in range(bins):
                cut = sorted(r.sample(range(1, 2048 // 8), parts - 1))
                sizes += [8 * (b - a) for a, b in zip([0, *cut], [*cut, 2048 // 8], strict=True)]
            got = packing.bin_completion(sizes)
            assert sorted(s for b in got for s in b) == sorted(sizes) and all(sum(b) <= 2048 for b in got)
            assert len(got) <= len(packing.best_fit(sizes, 2048))
            better += len(got) < len(packing.best_fit(sizes, 2048))
    assert better > 0


# --- pipeline ----------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    held = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), queries.TOXIC_LEARN)
    flagged = {r["doc_id"] for r in toxicity.toxicity(docs, model).where("flagged").collect()}
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "secret_scans", "mix_sources", "best_fit_packing"]
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        docs = blocks.stored(stage(spark, docs, SF), name)
        steps.append(docs)
        if name != "best_fit_packing":
            assert docs.columns == columns
    clean, single, masked, mixed, packed = ([r.asDict() for r in s.collect()] for s in steps)
    assert {r["doc_id"] for r in clean} == set(held) - flagged
    kept = sorted(r["doc_id"] for r in clean)
    _, comp = brute_jaccard([held[i]["text"] for i in kept])
    assert {r["doc_id"] for r in single} == {kept[c] for c in comp.values()}
    assert len(masked) == len(single)
    for r in masked:
        assert r["text"] == held[r["doc_id"]]["text"] or "[SECRET]" in r["text"]
        assert r["n_chars"] == (len(r["text"]) if r["text"] != held[r["doc_id"]]["text"] else held[r["doc_id"]]["n_chars"])
    sizes, taken = Counter(), Counter()
    for r in masked:
        sizes[r["source"]] += len(words(r["text"]))
    for r in mixed:
        taken[r["source"]] += len(words(r["text"]))
    longest = max(len(words(r["text"])) for r in masked)
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= longest
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    encode = packing.Encoder(packing.default_tokenizer())
    assert sum(r["length"] for r in packed) == sum(len(encode(r["text"] or "")) for r in mixed)


def test_pipeline_of_odd_documents(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c d e f g", "en", None, 3), (2, "a b c d e f g", "en", None, 3), (3, "A b c d e f g", "en", "s", 3)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (spark.createDataFrame(rows, DOC + ""), empty(spark)):
        docs.withColumn("score", F.lit(1)).withColumn("n", F.lit(2)).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_shingling_a_block_takes_little_memory():
    """pipeline: a block of texts is hashed in parts, and they change no set."""
    import tracemalloc

    from vectable.llm import blocks, jaccard_join

    r = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 5000, 400)).encode() for _ in range(blocks.BLOCK_BYTES // 2200)]
    alone = [jaccard_join.shingle_sets([t])[0] for t in texts[::50]]
    tracemalloc.start()
    try:
        found = jaccard_join.shingle_sets(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12 * blocks.BLOCK_BYTES
    assert all(np.array_equal(a, b) for a, b in zip(found[::50], alone, strict=True))


def test_stages_send_texts_in_small_batches(spark):
    """pipeline: what an executor and a worker hold of a task's texts is a few MB,
    and a smaller setting of the caller's stays."""
    import pyarrow as pa

    from vectable import session

    docs = spark.range(0, 8000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 600) AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars")

    def told(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    try:
        for name, stage in corpus_pipeline.STAGES[2:]:
            for key in keys:
                spark.conf.unset(key)
            stage(spark, docs.limit(50), SF)
            sizes = [r["size"] for r in docs.mapInArrow(told, "size long").collect()]
            assert sum(sizes) > 4 * session.BATCH_BYTES and max(sizes) < 1.1 * session.BATCH_BYTES, name
            assert int(spark.conf.get(keys[1])) == session.READ_ROWS
        spark.conf.set(keys[0], "1k")
        spark.conf.set(keys[1], "7")
        session.small_batches(spark)
        assert [spark.conf.get(k) for k in keys] == ["1024", "7"]
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_a_worker_gives_back_what_it_freed():
    """pipeline: a task's worker is used again by later stages; it keeps no more than is live."""
    import ctypes

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("no such C library")

    def mb():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nAnonymous:\s+(\d+)", f.read()).group(1)) / 1024

    last = []

    def fn(batches):
        held = [b"x" * 60_000 for _ in range(3000)]
        last.append(b"x" * 60_000)  # above all others: without it the C library would give them back
        for b in batches:
            yield len(held) + b

    before = mb()
    assert list(blocks.tidy(fn)([1, 2])) == [3001, 3002]
    assert mb() - before < 60
