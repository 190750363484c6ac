"""3. Mixing sources to target weights: pivotal dependent rounding.

Every source gets a target size in words; a document is wanted
``target / source size`` times, a whole number of copies plus a fraction
``p``. Whether the fraction becomes a copy is decided by pivoting: two open
documents of one source, of sizes ``a`` and ``b`` with fractions ``p`` and
``q``, exchange mass in words, so ``a p + b q`` stays as it is, until one of
the fractions is 0 or 1; which way the mass goes is drawn such that the
expected fractions stay as they are. The one that stays open meets the next.

The pairing is a reduction tree: open documents of a source are dealt by hash
into groups of about ``FAN``, each group is folded from the longest to the
shortest document, and the one document a group leaves open goes to the next
level, until a source has one left. That one is rounded to the nearer side, so
a source misses its target by half a document at most.

A hot source is many groups, each bounded; a level leaves 1 / FAN of its rows,
so the levels are the logarithm of the largest source. Only DataFrame and SQL
functions; draws are hashes of the ids and ``seed``, so reruns agree.

Cases: null text has size 0, as has an empty one, and such a document gets the
whole copies of its source alone; a null source is a source of its own, after
all others; rows of null or repeated ids are documents like any other. Rows are
known by their id and a hash of all their columns; rows that are equal in every
column are counted before anything is shuffled, enter the tree by their number
(0 to their count) and are interchangeable in the result. An empty table gives
no rows; a source without words has target 0 and takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from vectable.llm.blocks import stored

FAN, CHUNK = 96, 10_000
WORD = r"[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.expr(f"regexp_count(`{text}`, '{WORD}')"), F.lit(0)).cast("long")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns (but maps, which have none), nulls told apart."""
    cols = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    return F.xxhash64(*cols, F.concat(*[c.isNull().cast("string") for c in cols]))


def share(total: Column, n: Column, i: Column) -> Column:
    """Copies of row ``i`` of ``n`` equal rows that are taken ``total`` times."""
    return (F.floor(total / n) + (i < total % n).cast("long")).cast("int")


def numbered(units: DataFrame, n: str = "n", out: str = "i") -> DataFrame:
    """A row for each number under ``n``, ``CHUNK`` at a time, so that a row of
    a very large ``n`` is many tasks' work."""
    starts = units.withColumn("__start", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(CHUNK).cast("long"))))
    if (units.agg(F.max(n)).first()[0] or 0) > CHUNK:
        starts = starts.repartition(*units.columns, "__start")
    return starts.withColumn(out, F.explode(F.sequence("__start", F.least(F.col("__start") + CHUNK, F.col(n)) - 1))).drop("__start")


def source_targets(sizes: DataFrame, weights: list[float], share_of: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` (words) for rows ``(source, size)``.

    Sources in code-point order, null last, get ``weights`` in turn and share
    ``share_of`` times all words by weight; a target stops at ``most`` times its
    source's size, and what is above goes to the others by weight until none
    is above. With sources in order of ``most * size / weight`` those that stop
    are the first ones: the first that does not, and all after it, get
    ``rest / weight left`` times their weight. One row a source is all that the
    ordered windows see."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    w = per.withColumn("weight", F.get(turn, (F.row_number().over(in_order) - 1) % len(weights)))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("rest", F.sum("source_size").over(every) * F.lit(float(share_of)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    w = w.withColumn("left", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("level", F.when(F.col("rest") * F.col("weight") / F.col("left") <= F.col("cap"), F.col("rest") / F.col("left")))
    level = F.first("level", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return w.select("source", "source_size", "n", F.least("cap", F.coalesce(F.col("weight") * level, "cap")).alias("target"))


def _fold(items: Column, draw: str, key_type: str) -> Column:
    """Pivot a group, an array of structs ``(size, key, p)``: a struct of the
    open item and the array of those decided (``p`` 0 or 1)."""
    empty = F.expr(f"CAST(array() AS array<struct<size: bigint, key: {key_type}, p: double>>)")

    def item(size: Column, key: Column, p: Column) -> Column:
        return F.struct(size.alias("size"), key.alias("key"), p.alias("p"))

    def step(acc: Column, x: Column) -> Column:
        o = acc["open"]
        a, p, b, q = o["size"], o["p"], x["size"], x["p"]
        up = F.least(a * (1 - p), b * q)  # words that may go from x to the open one
        down = F.least(a * p, b * (1 - q))
        u = (F.xxhash64(o["key"], x["key"], F.lit(draw)).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / float(1 << 52)
        # Up with probability down / (up + down): the expected move is none.
        rise = u * (up + down) < down
        m = F.when(rise, up).otherwise(-down)
        # What becomes whole is written as 0 or 1 exactly.
        p1 = F.when(rise & (up == a * (1 - p)), 1.0).when(~rise & (down == a * p), 0.0).otherwise(p + m / a)
        q1 = F.when(rise & (up == b * q), 0.0).when(~rise & (down == b * (1 - q)), 1.0).otherwise(q - m / b)
        whole = (p1 == 0) | (p1 == 1)
        mine, other = item(a, o["key"], p1), item(b, x["key"], q1)
        return F.struct(
            F.when(whole, other).otherwise(mine).alias("open"),
            F.concat(acc["done"], F.array(F.when(whole, mine).otherwise(other))).alias("done"),
        )

    first = F.struct(F.element_at(items, 1).alias("open"), empty.alias("done"))
    return F.aggregate(F.slice(items, 2, F.size(items)), first, step)


def pivotal_rounding(open_: DataFrame, seed: str = "mix") -> DataFrame:
    """``grp, key, copy`` (0 or 1) for written rows ``(grp, key, size, p)`` with
    0 < p < 1 and size > 0: the reduction tree."""
    parts, level, key_type = [], 0, open_.schema["key"].dataType.simpleString()
    while True:
        counts = stored(open_.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "groups")
        largest = counts.agg(F.max("n")).first()[0] or 0
        if largest <= 1:
            break
        dealt = open_.join(counts, "grp").withColumn("part", F.pmod(F.xxhash64("key", F.lit(f"{seed}{level}")), F.ceil(F.col("n") / F.lit(FAN))))
        groups = dealt.groupBy("grp", "part").agg(F.sort_array(F.collect_list(F.struct("size", "key", "p")), asc=False).alias("items"))
        folded = stored(groups.select("grp", _fold(F.col("items"), f"{seed}{level}", key_type).alias("f")), "folded")
        parts.append(folded.select("grp", F.explode("f.done").alias("d")).select("grp", "d.key", F.col("d.p").cast("int").alias("copy")))
        left = folded.select("grp", "f.open.key", "f.open.size", "f.open.p")
        # An exchange may make both sides whole: such a document is decided too.
        parts.append(left.where("p = 0 or p = 1").select("grp", "key", F.col("p").cast("int").alias("copy")))
        open_ = stored(left.where("p > 0 and p < 1"), "open")
        level += 1
    out = open_.select("grp", "key", F.when(F.col("p") >= 0.5, 1).otherwise(0).alias("copy"))
    for x in parts:
        out = out.union(x)
    return out


def mix_units(docs: DataFrame, weights: list[float], share_of: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One written row for each set of equal rows: ``id, content`` (``row_hash``),
    ``source, size, n`` (rows), ``source_size, target`` and ``total``, how often
    the mix takes any of them."""
    columns = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), row_hash(docs).alias("content"))
    units = stored(columns.groupBy("id", "content", "source", "size").agg(F.count(F.lit(1)).alias("n")), "units")
    grp = F.xxhash64(F.col("source").isNull(), "source")
    targets = stored(source_targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share_of, most).drop("n").withColumn("grp", grp), "targets")
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = units.withColumn("grp", grp).join(targets.drop("source"), "grp").withColumn("whole", F.floor(want)).withColumn("p", want - F.floor(want))
    planned = stored(planned, "planned")
    loose = planned.where("p > 0 and p < 1 and size > 0").select("grp", "id", "content", "size", "p", "n")
    items = numbered(loose).select("grp", F.struct("id", "content", "i").alias("key"), "size", "p")
    extra = pivotal_rounding(items, seed).groupBy(F.col("grp").alias("extra_grp"), F.col("key.id").alias("extra_id"), F.col("key.content").alias("extra_content")).agg(F.sum("copy").alias("extra"))
    on = [F.col("grp") == F.col("extra_grp"), F.col("id").eqNullSafe(F.col("extra_id")), F.col("content") == F.col("extra_content")]
    total = (F.col("n") * F.col("whole") + F.coalesce("extra", F.lit(0))).alias("total")
    return stored(planned.join(extra, on, "left").select("id", "content", "source", "size", "n", "source_size", "target", total), "mixed")


def mix_sources(docs: DataFrame, weights: list[float], share_of: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id_col, source, size, source_size, target,
    copies``; ``copies`` is how often the mix takes it (0 up to ``most``)."""
    units = mix_units(docs, weights, share_of, most, seed, id_col, text_col, source_col)
    copies = share(F.col("total"), F.col("n"), F.col("i")).alias("copies")
    return numbered(units).select(F.col("id").alias(id_col), "source", "size", "source_size", "target", copies)


def take_copies(docs: DataFrame, weights: list[float], share_of: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own
    columns. A merge join at every size: texts are dealt by id, and the plan
    stays the same as the input grows; equal rows lie together after it, and
    are numbered there."""
    units = mix_units(docs, weights, share_of, most, seed, id_col, text_col, source_col).where("total > 0")
    taken = units.select(F.col("id").alias("__id"), F.col("content").alias("__content"), F.col("n").alias("__n"), F.col("total").alias("__total")).hint("merge")
    rows = docs.withColumn("__row", row_hash(docs))
    both = rows.join(taken, [rows[id_col].eqNullSafe(F.col("__id")), rows["__row"] == F.col("__content")])
    place = F.row_number().over(Window.partitionBy("__id", "__content").orderBy("__n")) - 1
    both = both.withColumn("__copies", share(F.col("__total"), F.col("__n"), place)).where("__copies > 0")
    return both.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*docs.columns)
