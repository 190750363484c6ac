"""6. Toxicity: a convolutional text classifier, trained in NumPy on all labelled documents.

A word is embedded by the hashes of itself and of its first bytes, so that
inflected forms share what their stem has learned; filters of several widths
run over the words, and each keeps its maximum over the whole text; a logistic
layer on the maxima gives the score. A maximum passes its gradient
to one place, so a step touches few words. Hashes are dealt to ``SLOTS`` rows of
the embedding table, so a model has a bounded size for any vocabulary; rows
that ``SEEN_IN`` labelled documents hold are learned, counted over all of them.

Every labelled document takes part, as a whole: four fifths (by a hash of the
id) train, the last fifth calibrates thresholds, and then training goes on over
all of them. Documents are dealt to shards of about ``SHARD`` by a hash of the id.
In a round each shard goes on from the
shared parameters by mini-batch gradient descent (Adam) on the executors, and
the parameters are averaged by the number of documents, an embedding over the
shards that moved it; sums are of whole numbers, so the order of shards and
partitions changes nothing. The driver holds the parameters, no documents.

Scoring runs on the executors, and texts are read whole. A filter's answer to
a word is worked out once for each different word of a chunk of texts.

Thresholds are calibrated by language on all documents of the last fifth, which
training has not seen then, of both labels (``calibrated``): of each language, the score with the
least errors, a clean document lost counting ``CLEAN_COST`` toxic ones kept, among
those that find ``RECALL`` of its toxic documents; and the shared threshold
where it has too few. A label that is wrong lies over or under any threshold, so
one of them moves none. Scores come to the driver as counts of values
between ``LOWEST`` and ``HIGHEST``, in steps of ``1 / FINE``. Thresholds decide
``flagged``; a score itself never sees language, source, id or label.

Cases: a null or empty text has no words and gets the score of no evidence
(all maxima at zero); null labels are not learned from, and a document with both counts as toxic; a
labelled text of over ``TEXT_BYTES`` is passed over by the shared shards and counted
(``passed_over``): it is learned from whole, as a shard of its own; a null or unseen
language uses the shared threshold; repeated rows get equal scores; if the four
fifths lack a label, all documents train and none calibrates; without
any labelled document of both kinds, every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import slices, stored, tidy
from vectable.llm.words import hash_words, in_chunks

#: Width of an embedding, filters of each span, spans in words, and the prefixes (bytes) that a word is embedded by beside itself.
WIDTH, FILTERS, SPANS, PREFIXES = 8, 8, (1, 2, 3), (4, 5)
#: Rows of the embedding table, as a power of two.
SLOTS = 1 << 20
#: Documents of a shard, bytes of texts after which it is cut, and the most of a text that shares one.
SHARD, SHARD_BYTES, TEXT_BYTES = 4096, 24_000_000, 1_000_000
#: Steps over all, documents of a step, rate, training documents that hold a learned row; least and most passes over the documents, and most rounds.
STEPS, BATCH, RATE, SEEN_IN = 1000, 16, 0.02, 3
PASSES, ROUNDS = (2, 40), 4
#: Labelled ids that are sent to the documents; with more of them both sides are shuffled.
IDS_SENT = 3_000_000
#: How often a pass meets a document of the rarer label at most, and the share of label 1 in all gradients.
OFTEN, TOXIC_SHARE = 4, 0.7
#: Words of a text that are in memory at a time, and parts of one that scores and averaged parameters are told in.
PIECE, FINE, WHOLE = 1 << 16, 100_000, 1 << 30
#: Thresholds of a language: their range, least documents of a label, cost of a clean document lost in toxic ones kept, least share of toxic ones found.
LOWEST, HIGHEST, LEAST, CLEAN_COST, RECALL = 0.6, 0.9, 10, 3, 0.9
TRIM = ",.;:!?\"'()[]{}#$%&*"
PLAIN = bytes.maketrans(TRIM.encode(), b" " * len(TRIM))


def pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of its prefixes, a row a word, and each text's
    first word. Punctuation beside a word is not part of it."""
    return hash_words([t.translate(PLAIN) for t in texts], prefixes=PREFIXES)


def slots(hashes: np.ndarray) -> np.ndarray:
    """The row of the whole table of each hash; -1 where there is no prefix."""
    return np.where(hashes == 0, -1, (hashes >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)).astype(np.int32)


def text_slots(text: bytes) -> np.ndarray:
    """Rows of the whole table of each word of a text and of its prefixes; a long
    text is hashed in parts that end at a blank."""
    parts, i = [], 0
    while i < len(text):
        j = i + TEXT_BYTES
        while j < len(text) and text[j] not in b" \t\n\v\f\r":
            j += 1
        parts.append(slots(pieces([text[i:j]])[0]))
        i = j
    return np.concatenate(parts) if parts else np.empty((0, 1 + len(PREFIXES)), np.int32)


def places(at: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Rows of the model's embeddings; what training did not see gets the last one, which is zero."""
    row = np.searchsorted(known, at)
    return np.where(known[np.minimum(row, len(known) - 1)] == at, row, len(known)).astype(np.int32) if len(known) else np.zeros(at.shape, np.int32)


class Convolution:
    """Parameters, training and the tables that scoring needs."""

    def __init__(self, known: np.ndarray, seed: int = 7):
        r = np.random.default_rng(seed)
        self.known = known
        self.embedding = r.normal(0, 0.1, (len(known) + 1, WIDTH)).astype(np.float32)
        self.embedding[-1] = 0
        self.filters = [r.normal(0, 0.4, (w, WIDTH, FILTERS)).astype(np.float32) for w in SPANS]
        self.offsets = np.zeros((len(SPANS), FILTERS), np.float32)
        self.out = r.normal(0, 0.4, len(SPANS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    @classmethod
    def of(cls, tables: dict) -> Convolution:
        """A copy of a model to go on from."""
        net = cls.__new__(cls)
        net.known, net.embedding, net.filters = tables["known"], tables["embedding"].copy(), [f.copy() for f in tables["filters"]]
        net.offsets, net.out, net.bias = tables["offsets"].copy(), tables["out"].copy(), np.array([tables["bias"]], np.float32)
        return net

    def dense(self) -> list[np.ndarray]:
        """All parameters but the embeddings."""
        return [*self.filters, self.offsets, self.out, self.bias]

    def _forward(self, rows: np.ndarray):
        """Maxima (after the rectifier) and their places, of one text."""
        top, where = np.zeros((len(SPANS), FILTERS), np.float32), np.full((len(SPANS), FILTERS), -1)
        for i in range(0, len(rows), PIECE):
            part = rows[i : i + PIECE + max(SPANS) - 1]
            e = self.embedding[part].sum(axis=1)
            for s, w in enumerate(SPANS):
                n = len(part) - w + 1
                if n > 0:
                    a = sum(e[o : o + n] @ self.filters[s][o] for o in range(w)) + self.offsets[s]
                    at = a.argmax(axis=0)
                    best = a[at, np.arange(FILTERS)]
                    where[s] = np.where(best > top[s], at + i, where[s])
                    top[s] = np.maximum(best, top[s])
        return top.ravel(), where

    def train(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, passes: range, all_passes: int, seed: list[int]) -> None:
        """``texts``: rows of the embeddings of each word of each text; ``passes``
        of ``all_passes`` over them, which the rate falls with."""
        r = np.random.default_rng(seed)
        params = [self.embedding, *self.dense()]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        last, t = len(self.known), 0
        for epoch in passes:
            order = r.permutation(len(texts))
            rate = RATE * (1 - epoch / all_passes) + 1e-4
            for i in range(0, len(order), BATCH):
                grads = [np.zeros_like(p) for p in params[1:]]
                rows_of, grad_of = [], []
                for k in order[i : i + BATCH]:
                    rows = texts[k]
                    rows = rows[r.random(len(rows)) >= 0.1]  # words left out, against learning texts by heart
                    top, where = self._forward(rows)
                    d = (1 / (1 + np.exp(-np.clip(float(top @ self.out + self.bias[0]), -30, 30))) - y[k]) * weight[k] / BATCH
                    grads[-2] += d * top
                    grads[-1] += d
                    back = (d * self.out).reshape(len(SPANS), FILTERS)
                    for s, w in enumerate(SPANS):
                        f = np.flatnonzero(where[s] >= 0)
                        grads[-3][s, f] += back[s, f]
                        for o in range(w):
                            at = where[s, f] + o
                            grads[s][o][:, f] += back[s, f] * self.embedding[rows[at]].sum(axis=1).T
                            rows_of.append(rows[at])
                            grad_of.append(back[s, f][:, None] * self.filters[s][o][:, f].T)
                t += 1
                rate_t = rate * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                for p, g, a, b in zip(params[1:], grads, m[1:], v[1:], strict=True):
                    a += 0.1 * (g + 1e-4 * p - a)
                    b += 0.001 * (g * g - b)
                    p -= (rate_t * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
                rows = np.concatenate(rows_of) if rows_of else np.empty((0, 1), np.int64)
                if len(rows):  # only the embedding's rows that a maximum reached are updated
                    at, inverse = np.unique(rows, return_inverse=True)
                    g = np.zeros((len(at), WIDTH), np.float32)
                    np.add.at(g, inverse.ravel(), np.repeat(np.concatenate(grad_of), rows.shape[1], axis=0))
                    g[at == last] = 0
                    m[0][at] += 0.1 * (g - m[0][at])
                    v[0][at] += 0.001 * (g * g - v[0][at])
                    self.embedding[at] -= (rate_t * m[0][at] / (np.sqrt(v[0][at]) + 1e-8)).astype(np.float32)
                    self.embedding[last] = 0

    def tables(self) -> dict:
        """What scoring needs."""
        return {"known": self.known, "embedding": self.embedding, "filters": self.filters, "offsets": self.offsets, "out": self.out, "bias": float(self.bias[0])}


def scores(texts: list[bytes], model: dict) -> np.ndarray:
    """Scores of whole texts, 0 to 1."""
    out = np.empty(len(texts))
    for i, j in in_chunks(texts):
        h, bound = pieces(texts[i:j])
        # A filter's answers are worked out once for each different word of the chunk.
        _, first, word = np.unique(h[:, 0], return_index=True, return_inverse=True)
        e = model["embedding"][places(slots(h[first]), model["known"])].sum(axis=1)
        top = np.zeros((j - i, len(SPANS) * FILTERS), np.float32)
        for s, w in enumerate(SPANS):
            n = len(h) - w + 1
            if n <= 0:
                continue
            a = sum((e @ model["filters"][s][o])[word[o : o + n]] for o in range(w)) + model["offsets"][s]
            for k, (b, c) in enumerate(zip(bound[:-1], bound[1:], strict=True)):
                if c - b >= w:
                    top[k, s * FILTERS : (s + 1) * FILTERS] = np.maximum(a[b : c - w + 1].max(axis=0), 0)
        out[i:j] = 1 / (1 + np.exp(-np.clip(top.astype(np.float64) @ model["out"].astype(np.float64) + model["bias"], -30, 30)))
    return out


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    """The rows ``shard, text, y`` of each shard, cut after ``SHARD_BYTES``."""
    now, held, marks, size = None, [], [], 0
    for batch in batches:
        for shard, text, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            text = text.as_py()
            if held and (shard != now or size + len(text) > SHARD_BYTES):
                yield held, np.array(marks, dtype=np.float64)
                held, marks, size = [], [], 0
            now, size = shard, size + len(text)
            held.append(text_slots(text))
            marks.append(y)
    if held:
        yield held, np.array(marks, dtype=np.float64)


def seen(rows: DataFrame) -> np.ndarray:
    """Rows of the whole table that ``SEEN_IN`` of the texts hold, ascending."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                at = np.unique(text_slots(text.as_py()))
                n[at[at >= 0]] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["slot", "n"])

    counted = rows.select("text").mapInArrow(tidy(fn), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    return np.sort(counted.where(F.col("n") >= SEEN_IN).select("slot").toArrow().column(0).to_numpy())  # SLOTS at most


def averaged(rows: DataFrame, tables: dict, often: tuple[int, int], weight: tuple[float, ...], passes: range, all_passes: int) -> dict:
    """The model after a round: each shard goes on from ``tables``, and what comes
    out is averaged by documents. A pass meets a document as ``often`` as its
    label says, with the label's ``weight``. A part of the parameters is a row of ``WIDTH``
    numbers: an embedding, or (below 0) the next ones of the others."""
    shared = rows.sparkSession.sparkContext.broadcast(tables)  # bounded by SLOTS
    names = [f"q{i}" for i in range(WIDTH)]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        for texts, y in shards(batches):
            net = Convolution.of(start)
            for i, t in enumerate(texts):  # in their place: a shard is held once
                texts[i] = places(t, start["known"])
            at = np.repeat(np.arange(len(y)), np.where(y == 1, often[1], often[0]))
            net.train([texts[i] for i in at], y[at], np.where(y == 1, weight[1], weight[0])[at], passes, all_passes, [7, passes[0], len(y), sum(map(len, texts))])
            flat = np.concatenate([p.ravel() for p in net.dense()])
            flat = np.pad(flat, (0, -len(flat) % WIDTH)).reshape(-1, WIDTH)
            moved = np.flatnonzero((net.embedding != start["embedding"]).any(axis=1))
            part = np.concatenate([-1 - np.arange(len(flat)), moved]).astype(np.int32)
            q = np.rint(np.concatenate([flat, net.embedding[moved]]).astype(np.float64) * WHOLE).astype(np.int64) * len(y)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), len(y))), *(pa.array(np.ascontiguousarray(c)) for c in q.T)], ["part", "w", *names])

    made = rows.select("shard", "text", "y").mapInArrow(tidy(fn), "part int, w long, " + ", ".join(f"{c} long" for c in names))
    got = made.groupBy("part").agg(*((F.sum(c).cast("double") / F.sum("w") / WHOLE).cast("float").alias(c) for c in names)).toArrow()
    shared.destroy()
    net = Convolution.of(tables)
    part = got.column("part").to_numpy()
    value = np.stack([got.column(c).to_numpy() for c in names], axis=1)
    net.embedding[part[part >= 0]] = value[part >= 0]
    flat = value[part < 0][np.argsort(-part[part < 0])].ravel()
    for p in net.dense():
        p[...] = flat[: p.size].reshape(p.shape)
        flat = flat[p.size :]
    return net.tables()


def train(rows: DataFrame, n: tuple[int, int], tables: dict, even: float, again: bool = False) -> dict:
    """The tables of a classifier fitted on all rows ``shard, text, y``, in the
    order of their shards; ``n`` are of each label. Where it holds both labels
    for as likely, the score is ``even``. ``again``: ``tables`` are of such a fit,
    which the second half of the passes goes on from."""
    often = tuple(int(np.clip(max(n) // k, 1, OFTEN)) for k in n)
    met = [k * o for k, o in zip(n, often, strict=True)]
    weight = tuple(share * sum(met) / k for share, k in zip((1 - TOXIC_SHARE, TOXIC_SHARE), met, strict=True))
    passes = int(np.clip(round(STEPS * BATCH / sum(n)), *PASSES))
    rounds = min(passes, ROUNDS)
    shift = float(np.log(even / (1 - even)))
    if again:
        tables = tables | {"bias": tables["bias"] - shift}
    at = [passes * i // rounds for i in range(rounds // 2 if again else 0, rounds + 1)]
    for a, b in zip(at[:-1], at[1:], strict=True):
        tables = averaged(rows, tables, often, weight, range(a, b), passes)
    return tables | {"bias": tables["bias"] + shift}


def calibrated(s: np.ndarray, y: np.ndarray, default: float, n: np.ndarray | None = None) -> float:
    """The threshold for scores ``s`` of labels ``y`` (each ``n`` times), from ``LOWEST`` to
    ``HIGHEST``: of those that find ``RECALL`` of label 1, or the lowest, the one
    of the least errors, and of several the one in their middle; ``default`` if
    a label is rare."""
    n = np.ones(len(s), np.int64) if n is None else n
    (toxic, toxic_n), (clean, clean_n) = ((s[k][o], np.concatenate([[0], np.cumsum(n[k][o])])) for k in (y == 1, y == 0) for o in [np.argsort(s[k])])
    if min(toxic_n[-1], clean_n[-1]) < LEAST:
        return default
    # Errors change at scores only: just above a clean one, and at a toxic one.
    t = np.unique(np.concatenate([[LOWEST, HIGHEST], np.nextafter(clean, 2), toxic]))
    t = t[(t >= LOWEST) & (t <= HIGHEST)]
    t = np.unique(np.concatenate([t, (t[1:] + t[:-1]) / 2]))
    missed = toxic_n[np.searchsorted(toxic, t, "left")]
    t, missed = (x[(missed <= (1 - RECALL) * toxic_n[-1]) | (t == LOWEST)] for x in (t, missed))
    lost = clean_n[-1] - clean_n[np.searchsorted(clean, t, "left")]
    cost = CLEAN_COST * lost + missed
    best = t[cost == cost.min()]
    return float(best[np.argmin(np.abs(best - (best[0] + best[-1]) / 2))])


def fit(docs: DataFrame, labels: DataFrame, learn: str = "true", id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang", threshold: float = 0.7) -> dict:
    """A model from all labelled documents where ``learn`` (SQL on the joined row)
    holds; a hash of the id deals them (ids are otherwise not used)."""
    wanted = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col), F.col(label_col).alias("y")).where(learn).groupBy(id_col).agg(F.max("y").cast("int").alias("y"))
    ids = wanted.count()
    many = max(1, -(-ids // SHARD))
    order = F.xxhash64(id_col, F.lit("toxicity"))
    size = F.octet_length(text_col)
    shard = F.when(size > TEXT_BYTES, F.xxhash64(id_col, text_col)).otherwise(F.pmod(order, F.lit(many)))
    held = F.pmod(F.xxhash64(id_col, F.lit("calibrate")), F.lit(5)) == 4
    rows = docs.join(F.broadcast(wanted) if ids <= IDS_SENT else wanted, id_col).where(F.col(text_col).isNotNull())
    rows = rows.select(shard.alias("shard"), order.alias("o"), F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang"), "y", size.alias("bytes"), held.alias("held"))
    # Written in the order of shards: a round reads one after the other.
    table = stored(rows.repartition(many, "shard").sortWithinPartitions("shard", "o", "text", "y"), "labelled")
    told = {(r["held"], r["y"]): r for r in table.groupBy("held", "y").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("bytes") > TEXT_BYTES).alias("long")).collect()}
    passed_over = sum(r["long"] for r in told.values())
    n = tuple(sum(r["n"] for (_, y), r in told.items() if y == z) for z in (0, 1))
    if not min(n):
        return {"tables": None, "threshold": threshold, "by_lang": {}, "passed_over": passed_over}
    tables, by_lang = Convolution(seen(table)).tables(), {}
    if {(False, 0), (False, 1)} <= set(told):
        tables = train(table.where("not held"), tuple(told[False, y]["n"] for y in (0, 1)), tables, threshold)
        got = _scored(table.where("held and lang is not null").select("lang", "y", "text"), ["lang", "y"], "text", tables)
        # Clean scores are rounded up and toxic ones down, so a threshold keeps its side of them; those out of the range are one value.
        fine = F.when(F.col("y") == 0, F.ceil(F.col("score") * FINE)).otherwise(F.floor(F.col("score") * FINE)) / FINE
        fine = F.when(fine < LOWEST, 0.0).when(fine > HIGHEST, 1.0).otherwise(fine)
        got = got.groupBy("lang", "y", fine.alias("s")).agg(F.count(F.lit(1)).alias("n")).toPandas()
        for lang, x in got.groupby("lang"):
            by_lang[lang] = calibrated(x["s"].to_numpy(), x["y"].to_numpy(), threshold, x["n"].to_numpy())
        tables = train(table, n, tables, threshold, again=True)
    else:
        tables = train(table, n, tables, threshold)
    return {"tables": tables, "threshold": threshold, "by_lang": by_lang, "passed_over": passed_over}


def _scored(rows: DataFrame, backs: list[str], text_col: str, tables: dict | None) -> DataFrame:
    """Columns ``backs`` of rows with a text (bytes or string) and its ``score``."""
    shared = rows.sparkSession.sparkContext.broadcast(tables) if tables else None
    where = rows.columns.index(text_col)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value if shared else None
        for batch in slices(batches):
            texts = [x or b"" for x in batch.column(where).cast(pa.binary()).to_pylist()]
            s = scores(texts, tables) if tables else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in backs), pa.array(s, pa.float64())], names=[*backs, "score"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(tidy(fn), ", ".join(f"{c} {kinds[c]}" for c in backs) + ", score double")


def toxicity(docs: DataFrame, model: dict, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``score``, and ``flagged`` by the
    language's threshold. Columns of these names are replaced."""
    kept = [c for c in (keep or docs.columns) if c not in ("score", "flagged")]
    # Plain names inside, so that any column name may come back.
    ins = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*kept, text_col, lang_col]))}
    backs = [ins[c] for c in dict.fromkeys([*kept, lang_col])]
    out = _scored(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in ins.items()]), backs, ins[text_col], model["tables"])
    level = F.lit(model["threshold"])
    for lang, t in sorted(model["by_lang"].items()):
        level = F.when(F.col(ins[lang_col]) == lang, t).otherwise(level)
    return out.select(*[F.col(ins[c]).alias(c) for c in kept], "score", (F.col("score") >= level).alias("flagged"))
