"""Property tests: random inputs, one Spark job per example batch, compared
with plain-Python definitions of the same operators."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vectable.functions import text as T
from vectable.operators import metrics

ascii_text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126), max_size=12)
segment = st.text(alphabet="abcXYZ._- ()", min_size=0, max_size=6)


@settings(max_examples=15, deadline=None)
@given(st.lists(ascii_text, min_size=1, max_size=30))
def test_display_and_slug_match_python(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "x string")
    got = df.select(T.display_label("x").alias("d"), T.label_slug("x").alias("s"), T.capitalize("x").alias("c")).collect()
    for w, r in zip(words, got):
        assert r["d"] == w.replace("_", " ").capitalize()
        assert r["s"] == w.lower().replace(" ", "_")
        assert r["c"] == w.capitalize()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(segment, min_size=1, max_size=5), min_size=1, max_size=30))
def test_path_parts_match_python(spark, paths):
    strs = ["/".join(p) for p in paths]
    df = spark.createDataFrame([(s,) for s in strs], "p string")
    got = df.select(T.label_from_path("p").alias("l"), T.split_from_path("p").alias("s")).collect()
    for s, r in zip(strs, got):
        parts = s.split("/")
        assert r["l"] == (parts[-2].replace(".", "_") if len(parts) >= 2 else None)
        assert r["s"] == (parts[-3] if len(parts) >= 3 else None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=60))
def test_report_matches_definition(spark, pairs):
    df = spark.createDataFrame(pairs, "t int, p int")
    rep = {r["cls"]: r for r in metrics.class_report(df, "t", "p").collect()}
    classes = sorted({c for pr in pairs for c in pr})
    assert sorted(rep) == classes
    for c in classes:
        tp = sum(1 for t, p in pairs if t == c and p == c)
        npred = sum(1 for _, p in pairs if p == c)
        sup = sum(1 for t, _ in pairs if t == c)
        prec = tp / npred if npred else 0.0
        rec = tp / sup if sup else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        assert rep[c]["support"] == sup
        assert rep[c]["precision"] == pytest.approx(prec)
        assert rep[c]["recall"] == pytest.approx(rec)
        assert rep[c]["f1"] == pytest.approx(f1)
    long = metrics.confusion_long(df, "t", "p").collect()
    assert len(long) == len(classes) ** 2
    assert sum(r["n"] for r in long) == len(pairs)
