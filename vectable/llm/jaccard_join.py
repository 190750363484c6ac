"""1. N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A document's set holds its distinct n-word shingles as 64-bit hashes. Two sets
link when ``100 * |intersection| >= percent * |union|``. The order of shingles
is (document frequency, hash), rarest first, with exact frequencies over all
documents, so a set's prefix of ``n - ceil(percent n / 100) + 1`` shingles must
meet the prefix of every set it links with:

1. Exact frequencies of all shingles (``blocks``): a shingle of one set only
   cannot be shared, so it takes a place in the prefix but is never joined. A
   set less than ``percent`` of whose shingles are shared links with nothing.
2. Equal sets become one class with the least id as its representative, so a
   group of exact copies is one row from here on.
3. Representatives meet on the shared shingles of their prefixes, under the
   length, positional and suffix filters. Groups of the same members are
   joined once, at their rarest shingle.
4. All pairs of a large group are never formed. A round verifies each member
   against ``CENTRES`` of its group and merges what links; a pair inside one
   component needs no check. After ``ROUNDS`` rounds, or one that leaves at
   most ``PAIRS_A_POSTING`` pairs a posting, what is left between components
   is verified as pairs. No pair is left out. With one round, the pairs of a
   group of ``c`` components are bounded by those between its components.

Shingle frequencies are kept by 54 to 78 bits of the hash; a collision there
only changes the order, the same way for all sets, so no link is lost.

Cases: a null, empty or blank text has the empty set, links with nothing and
is its own component; a text of fewer than ``words`` words is one shingle;
null ids are left out (they could not be named in the result); a repeated id
is one document, with its rows' texts as several sets that share its name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectable.llm import blocks as B
from vectable.llm.components import components
from vectable.llm.words import hash_words, in_chunks, mix

#: Bytes of texts whose words are hashed at a time; arrays take some forty times that.
CHUNK = 1 << 18
#: Bins of the suffix filter: shared shingles of a set counted by hash range.
BINS = 16
#: Pairs that may be formed for each posting before another round of centres, and the most such rounds.
PAIRS_A_POSTING, ROUNDS = 64, 1
#: Centres that a group has in a round.
CENTRES = 8
WIDTH = 6


def shingle_sets(texts: list[bytes], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for i, j in in_chunks(texts, CHUNK):
        h, bound = hash_words(texts[i:j])
        k = max(0, len(h) - words + 1)
        s = np.zeros(k, np.uint64)
        for d in range(words):
            s += h[d : d + k] * np.uint64((0x9E3779B97F4A7C15 + 0x632BE59BD9B4E01A * d) % 2**64)
        s = mix(s)
        for a, b in zip(bound[:-1], bound[1:], strict=True):
            if b - a >= words:
                out.append(np.unique(s[a : b - words + 1]))
            elif b > a:
                w = h[a:b] * np.uint64(0xA24BAED4963EE407) * np.arange(1, 2 * (b - a), 2, dtype=np.uint64)
                out.append(mix(w.sum(keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def _signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, not of its order."""
    a, b = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(), mix(s + np.uint64(0x14057B7EF767814F)).sum()
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _block_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block: sorted distinct shingles, how many sets hold each, and the place of each shingle of each set."""
    every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    keys, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    return keys, counts.astype(np.uint32), inverse


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """Step 1, written: a row for each document with ``n`` (set size), ``s1, s2``
    (signature) and, where enough of its shingles are shared with other sets,
    ``shared`` (their hashes), ``prefix`` (shared shingles of the prefix with
    their frequency, rarest first) and ``lead`` (how many unshared ones come
    before them)."""
    packed = B.pack(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    bits = B.bucket_bits(packed)

    def send(frames):
        for pdf in frames:
            for block, sizes, data in zip(pdf["block"], pdf["sizes"], pdf["data"], strict=True):
                keys, counts, _ = _block_keys(shingle_sets(B.texts_of(sizes, data), words))
                yield B.to_buckets(block, 0, keys, counts[None, :], bits, WIDTH)

    def reply(pdf: pd.DataFrame, inverse: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
        df = np.minimum(sums[0], 2**32 - 1)[inverse].astype(np.uint32)
        out = []
        for bucket, block, at in zip(pdf["bucket"], pdf["block"], B.row_slices(pdf, WIDTH), strict=True):
            own = df[at]
            some = np.flatnonzero(own >= 2).astype(np.uint32)
            if len(some):
                out.append((block, bucket, B.squeeze(some), B.squeeze(own[some])))
        return pd.DataFrame(out, columns=["block", "bucket", "place", "df"])

    sent = packed.select("block", "sizes", "data").mapInPandas(B.tidy(send), B.SENT)
    back = B.totals(sent, reply, 1, WIDTH, "block long, bucket int, place binary, df binary")

    def sets(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        B.give_back()
        rows = []
        for _, block in left.iterrows():
            own = shingle_sets(B.texts_of(block["sizes"], block["data"]), words)
            keys, _, inverse = _block_keys(own)
            df = np.ones(len(keys), np.uint32)
            top = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            for bucket, place, d in zip(right["bucket"], right["place"], right["df"], strict=True):
                df[top[bucket] + B.expand(place, np.uint32)] = B.expand(d, np.uint32)
            at = 0
            for i, s in zip(block["ids"], own, strict=True):
                f = df[inverse[at : at + len(s)]]
                at += len(s)
                n, common = len(s), int((f >= 2).sum())
                row = [i, n, *_signature(s), None, None, None, None, None]
                if n and 100 * common >= percent * n:
                    lead, m = n - common, f >= 2
                    s, f = s[m], f[m]
                    first = np.lexsort((s.view(np.int64), f))[: n + (-percent * n // 100) + 1 - lead]
                    row[4:] = s.view(np.int64), s[first].view(np.int64), f[first].astype(np.int64), lead, np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=BINS).astype(np.int32)
                rows.append(row)
        return pd.DataFrame(rows, columns=["id", "n", "s1", "s2", "shared", "prefix", "prefix_df", "lead", "bins"])

    out = packed.select("block", "ids", "sizes", "data").groupBy("block").cogroup(back.groupBy("block")).applyInPandas(
        sets, "id long, n long, s1 long, s2 long, shared array<long>, prefix array<long>, prefix_df array<long>, lead long, bins array<int>"
    )
    out = B.stored(out, "sets")
    B.dropped(packed)
    return out


def _enough(a: str, b: str, overlap, percent: int):
    """Whether ``overlap`` shared shingles suffice for sets of sizes a and b."""
    return (100 + percent) * overlap >= percent * (F.col(a) + F.col(b))


def _pairs(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of two posting tables that meet on ``h`` in
    different components and pass the length and positional filters."""
    l, r = (x.select("h", *[F.col(c).alias(f"{s}_{c}") for c in ("rep", "n", "pos", "comp")]) for x, s in ((left, "l"), (right, "r")))
    met = l.join(r, "h").where("l_comp <> r_comp").where((100 * F.least("l_n", "r_n") >= percent * F.greatest("l_n", "r_n")) & _enough("l_n", "r_n", F.least(F.col("l_n") - F.col("l_pos"), F.col("r_n") - F.col("r_pos")), percent))
    return met.select(F.least("l_rep", "r_rep").alias("a"), F.greatest("l_rep", "r_rep").alias("b")).distinct()


def _verified(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): the suffix filter, then the exact overlap."""
    side = {s: reps.select(F.col("rep").alias(s), F.col("n").alias(f"{s}_n"), F.col("shared").alias(f"{s}_s"), F.col("bins").alias(f"{s}_b")) for s in "ab"}
    x = pairs.join(side["a"], "a").join(side["b"], "b")
    most = F.aggregate(F.zip_with("a_b", "b_b", lambda p, q: F.least(p, q)), F.lit(0).cast("long"), lambda t, p: t + p)
    exact = F.size(F.array_intersect("a_s", "b_s")).cast("long")
    return x.select("a", "b", F.when(_enough("a_n", "b_n", most, percent), _enough("a_n", "b_n", exact, percent)).otherwise(False).alias("linked"))


def linked_classes(sets: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Steps 2 to 4: (classes ``s1, s2, n, rep``, components ``id, comp`` of the
    representatives that link with another one)."""
    held = sets.where("shared is not null")
    classes = B.stored(held.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("members")), "classes")
    own = held.select(F.col("id").alias("rep"), "n", "s1", "s2", "shared", "prefix", "prefix_df", "lead", "bins")
    reps = B.stored(own.join(classes.select("rep", "s1", "s2", "n"), ["rep", "s1", "s2", "n"]).dropDuplicates(["rep", "s1", "s2"]), "reps")
    each = reps.select("rep", "n", "lead", F.posexplode(F.arrays_zip("prefix", "prefix_df")).alias("i", "p"))
    posts = B.stored(each.select(F.col("p.prefix").alias("h"), F.col("p.prefix_df").alias("df"), "rep", "n", (F.col("lead") + F.col("i")).alias("pos")), "postings")
    # Groups of the same members: the rarest shingle of each stands for all.
    groups = posts.groupBy("h").agg(F.min("df").alias("df"), F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("x"), F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(38,0)")).alias("y")).where("m > 1")
    chosen = groups.groupBy("m", "x", "y").agg(F.min(F.struct("df", "h")).alias("g")).select(F.col("g.h").alias("h"))
    kept = B.stored(posts.join(B.stored(chosen, "groups"), "h").select("h", "rep", "n", "pos", F.col("rep").alias("comp")), "postings")
    B.dropped(posts)

    checked, comps, base = None, None, 0
    for k in range(ROUNDS + 1):
        by = kept.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
        mixed = B.stored(by.groupBy("h").agg(F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1").select("h", "m", F.col("top.comp").alias("top"), (F.col("m") - F.col("top.c")).alias("rest")), "mixed")
        cross, left = mixed.select(F.sum(F.col("m") * F.col("rest")), F.sum("m")).first()
        if not left:
            break
        base = base or left
        open_ = B.stored(kept.join(mixed.select("h", "top", "m"), "h"), "open")
        last = k == ROUNDS or k > 0 and cross <= PAIRS_A_POSTING * base
        if last:
            some = B.stored(open_.where("comp <> top"), "few")
        else:
            first = F.row_number().over(Window.partitionBy("h").orderBy(F.xxhash64("rep", F.lit(k)), "rep"))
            some = B.stored(open_.withColumn("first", first).where(F.col("first") <= CENTRES), "centres")
        found = _pairs(some, open_, percent)
        if checked is not None:
            found = found.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        new = B.stored(_verified(B.stored(found, "pairs"), reps, percent), "verified")
        checked = new if checked is None else checked.union(new)
        comps = components(checked.where("linked"))
        if last:
            break
        # Groups inside one component are done, and so are those that centres have met in full.
        rest = open_.where(F.col("m") > CENTRES + 1) if k == 0 else open_
        kept = B.stored(rest.drop("comp", "top", "m").join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "postings")
    if comps is None:
        comps = reps.where("false").select(F.col("rep").alias("id"), F.col("rep").alias("comp"))
    return classes, comps


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``class_id`` (least id
    with the same set), ``component_id`` (least id reachable by links)."""
    sets = document_sets(docs, id_col, text_col, words, percent)
    classes, comps = linked_classes(sets, percent)
    # Only classes that are more than their one document need a look-up.
    named = classes.join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    named = B.stored(named.select("s1", "s2", "n", "rep", "comp"), "named")
    out = sets.select("id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("rep", "id").alias("class_id"), F.coalesce("comp", "id").alias("component_id"))
