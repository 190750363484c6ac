"""2. LM scoring: deleted interpolation of n-gram maximum-likelihood estimates.

The probability of a token after a context mixes the maximum-likelihood
estimates of all orders and a uniform one::

    p(w | v) = sum_k l[b, k] * c(v_k w) / c(v_k)  +  l[b, 0] / (V + 1)

with weights ``l`` by the context's bucket ``b``: how long a context of the
token was seen, and the octave of its frequency. Weights are learned by
expectation-maximisation on held-out counts: a part of the training documents
is deleted from the counts, the weights that make this part most likely are
found, and the part's counts are put back before scoring. The n-gram counts
themselves are exact and cover all training documents.

Documents are packed into blocks; each block sends its distinct n-grams with
local counts to hash buckets and gets the totals back (``blocks``). For EM
every held-out token falls into a cell (bucket, quarter octave of each
estimate); a cell's size is bounded by the binning and not by the corpus, so
the iterations run on the cells.

Tokens are words (``words``), ``A-Z`` lower-cased, then one end token per
document. n-grams are 64-bit hashes of which 56 and the bucket's bits are
kept; a collision could only add the counts of two n-grams.

Cases: a null or empty text is the end token alone; null ids are scored under
a null id and belong to neither part of a rule on ids (``train`` null counts as
not training); repeated rows are separate documents; without any training
document every estimate but the uniform one is 0, and the weights are uniform.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm import blocks as B
from vectable.llm.words import hash_words, in_chunks, mix

END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0x0FEDCBA987654321)
WIDTH = 7
#: Kinds of documents: scored only, training, and training whose counts are deleted for EM.
SCORED, COUNTED, DELETED = 0, 1, 2
OCTAVES = 24
EM_ROUNDS = 40
KEYS_A_BYTE = 0.2


def grams(texts: list[bytes], order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For all tokens of all texts in order: n-gram hashes of each length, the
    hashes of contexts of length 2 and up, and each text's first token."""
    each, bound = [], [np.zeros(1, np.int64)]
    for i, j in in_chunks(texts):
        h, b = hash_words(texts[i:j])
        each.append(np.insert(h, b[1:], END))
        bound.append(bound[-1][-1] + b[1:] + np.arange(1, j - i + 1))
    t = np.concatenate(each) if each else np.empty(0, np.uint64)
    bounds = np.concatenate(bound)
    place = np.arange(len(t)) - np.repeat(bounds[:-1], np.diff(bounds))
    out, contexts, ctx = [mix(t + np.uint64(1))], [], np.zeros(len(t), np.uint64)
    for k in range(1, order):
        back = np.full(len(t), START)
        back[k:] = np.where(place[k:] >= k, t[: max(0, len(t) - k)], START) if len(t) > k else START
        ctx = mix(ctx * np.uint64(0x9E3779B97F4A7C15) + back + np.uint64(k))
        if k > 1:
            contexts.append(ctx)
        out.append(mix(ctx ^ mix(t + np.uint64(k << 8))))
    return out, contexts, bounds


def _block_families(texts: list[bytes], order: int):
    g, c, bounds = grams(texts, order)
    return [np.unique(x, return_inverse=True, return_counts=True) for x in (*g, *c)], bounds


def exact_counts(packed: DataFrame, order: int, bits: int) -> DataFrame:
    """Replies ``(block, family, bucket, all, counted, n, v)``: the totals of a
    block's keys over all training documents, and over those not deleted; with
    a null block, the tokens and distinct tokens of a bucket."""

    def send(frames):
        for pdf in frames:
            for block, kind, sizes, data in zip(pdf["block"], pdf["kind"], pdf["sizes"], pdf["data"], strict=True):
                families, _ = _block_families(B.texts_of(sizes, data), order)
                for f, (keys, _, counts) in enumerate(families):
                    held = np.zeros((2, len(keys)), np.uint32)
                    if kind in (COUNTED, DELETED):
                        held[0] = counts
                    if kind == COUNTED:
                        held[1] = counts
                    yield B.to_buckets(block, f, keys, held, bits, WIDTH)

    def reply(pdf: pd.DataFrame, inverse: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
        family, bucket = int(pdf["family"].iloc[0]), int(pdf["bucket"].iloc[0])
        every, counted = (np.minimum(x, 2**32 - 1).astype(np.uint32)[inverse] for x in sums)
        out = [(int(block), family, bucket, B.squeeze(every[at]), B.squeeze(counted[at]), None, None, None) for block, at in zip(pdf["block"], B.row_slices(pdf, WIDTH), strict=True)]
        if family == 0:
            out.append((None, 0, bucket, None, None, int(sums[0].sum()), int(sums[1].sum()), int((sums[0] > 0).sum())))
        return pd.DataFrame(out, columns=["block", "family", "bucket", "every", "counted", "n", "n_counted", "v"])

    sent = packed.select("block", "kind", "sizes", "data").mapInPandas(send, B.SENT)
    return B.totals(sent, reply, 2, WIDTH, "block long, family int, bucket int, every binary, counted binary, n long, n_counted long, v long")


def _estimates(texts: list[bytes], right: pd.DataFrame, column: str, order: int, bits: int, n: int):
    """Of each token: its count, the maximum-likelihood estimate of each order, and its context's bucket."""
    families, bounds = _block_families(texts, order)
    got: list[np.ndarray] = []
    for f, (keys, inverse, _) in enumerate(families):
        top = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        total = np.zeros(len(keys), np.int64)
        for family, bucket, x in zip(right["family"], right["bucket"], right[column], strict=True):
            if family == f:
                x = B.expand(x, np.uint32)
                total[top[bucket] : top[bucket] + len(x)] = x
        got.append(total[inverse])
    count = got[0]
    p = [count / max(n, 1)]
    # A word is the context of the token after it as often as it occurs, and a
    # text's start as often as the end token does.
    starts, ends = bounds[:-1], bounds[1:] - 1
    before = np.concatenate([[0], count[:-1]])
    before[starts] = count[ends]
    octave = np.zeros(len(count), np.int64)
    for k in range(1, order):
        context = before if k == 1 else got[order + k - 2]
        p.append(np.divide(got[k], context, out=np.zeros(len(count)), where=context > 0))
        octave = np.where(context > 0, k * OCTAVES + np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64), OCTAVES - 1), octave)
    return count, p, octave, bounds


def em_weights(cells: pd.DataFrame, order: int, v: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights ``[bucket, estimate]`` (uniform first, then orders 1 and up) from
    cells ``(b, m, p1, p2, ...)``: bucket, held-out tokens, mean estimates."""
    out = np.full((order * OCTAVES, order + 1), 1.0 / (order + 1))
    for b, x in cells.groupby("b"):
        m = x["m"].to_numpy(float)
        p = np.column_stack([np.full(len(x), 1.0 / (v + 1)), *(x[f"p{k + 1}"].to_numpy(float) for k in range(order))])
        w = out[int(b)]
        for _ in range(rounds):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * m[:, None]).sum(axis=0) + 1e-3
            w /= w.sum()
        out[int(b)] = w
    return out


def lm_scores(docs: DataFrame, train: str, deleted: str, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """One row per document: ``id_col``, ``n_tokens``, ``n_known`` (tokens seen
    in training), ``train_tokens``, ``base_score`` (add-one unigrams), ``score``
    (both log10 probabilities of the text). ``train`` and ``deleted`` are SQL
    conditions: the training documents, and those of them that EM learns from."""
    kind = f"CASE WHEN NOT coalesce({train}, false) THEN {SCORED} WHEN coalesce({deleted}, false) THEN {DELETED} ELSE {COUNTED} END"
    packed = B.pack(docs, id_col, text_col, kind)
    bits = B.bucket_bits(packed, KEYS_A_BYTE)
    replies = B.stored(exact_counts(packed, order, bits), "counts")
    n, n_counted, v = (int(x or 0) for x in replies.where("block is null").select(F.sum("n"), F.sum("n_counted"), F.sum("v")).first())
    back = replies.where("block is not null")

    def cells(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in left.iterrows():
            _, p, octave, _ = _estimates(B.texts_of(block["sizes"], block["data"]), right, "counted", order, bits, n_counted)
            q = [octave, *(np.where(x > 0, (-4 * np.log2(np.where(x > 0, x, 1))).astype(np.int64) + 1, 0) for x in p)]
            key, inverse = np.unique(np.stack(q), axis=1, return_inverse=True)
            frame = {f"q{i}": k for i, k in enumerate(key)} | {"m": np.bincount(inverse, minlength=key.shape[1])}
            out.append(pd.DataFrame(frame | {f"p{k + 1}": np.bincount(inverse, weights=x, minlength=key.shape[1]) for k, x in enumerate(p)}))
        return pd.concat(out) if out else pd.DataFrame(columns=columns)

    columns = [f"q{i}" for i in range(order + 1)] + ["m"] + [f"p{k + 1}" for k in range(order)]
    schema = ", ".join([f"q{i} long" for i in range(order + 1)] + ["m long"] + [f"p{k + 1} double" for k in range(order)])
    parts = {k: packed.where(F.col("kind") == DELETED) if k == "em" else packed for k in ("em", "score")}
    held_out = back.join(parts["em"].select("block"), "block", "left_semi")
    seen = parts["em"].select("block", "sizes", "data").groupBy("block").cogroup(held_out.select("block", "family", "bucket", "counted").groupBy("block")).applyInPandas(cells, schema)
    # A cell for each bucket and bin of the estimates at most: bounded by the binning.
    summed = seen.groupBy(*[f"q{i}" for i in range(order + 1)]).agg(F.sum("m").alias("m"), *[(F.sum(f"p{k + 1}") / F.sum("m")).alias(f"p{k + 1}") for k in range(order)])
    weights = em_weights(summed.withColumnRenamed("q0", "b").toPandas().sort_values(["b", *[f"q{i + 1}" for i in range(order)]]), order, v)

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in left.iterrows():
            count, p, octave, bounds = _estimates(B.texts_of(block["sizes"], block["data"]), right, "every", order, bits, n)
            w = weights[octave]
            mixed = w[:, 0] / (v + 1)
            for k, x in enumerate(p):
                mixed = mixed + w[:, k + 1] * x
            first = bounds[:-1]
            base = np.add.reduceat(np.log10((count + 1.0) / (n + (v + 1.0))), first)
            out.append(
                pd.DataFrame(
                    {
                        "id": pd.array(block["ids"], dtype="Int64"), "n_tokens": np.diff(bounds), "n_known": np.add.reduceat((count > 0).astype(np.int64), first),
                        "train_tokens": np.int64(n), "base_score": base, "score": np.add.reduceat(np.log10(mixed), first),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = parts["score"].select("block", "ids", "sizes", "data").groupBy("block").cogroup(back.select("block", "family", "bucket", "every").groupBy("block")).applyInPandas(
        score, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.withColumnRenamed("id", id_col)
