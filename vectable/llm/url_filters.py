"""11. URL filters: host-suffix and path-prefix expressions looked up by hash.

A rule is a host and a path; it fits its host and all subdomains of it, where
the URL's path starts with the rule's. Each URL is expanded into expressions (a
suffix of its host, cut at dots, and a prefix of its path), for the shapes that
the rules have: so many labels, so many characters. Expressions and rules are
joined by the first 32 bits of their SHA-256 digests; the rules found for a URL
are confirmed by their full digests, and the longest one decides (ties: the
longer host, then block).

Shapes are bounded: hosts of over ``LABELS`` labels and paths of over ``HEAD``
characters are looked up by their last labels and first characters, and their
full digest, taken over the whole rule, confirms them. So a URL has at most
``LABELS * (HEAD + 1)`` expressions, whatever the number of rules, and each is
a row id and a hash. Hashes that very many URLs have (found by a frequent-items
sketch of bounded size) are dealt over several parts, to each of which their
rules are copied; the sketch has no effect on results. Rules are joined as any
table, and sent to all tasks only where Spark finds them small.

Cases: a null URL or one without ``://`` has an empty host and path, and fits no
rule; rules with a null or empty host or a verdict other than ``allow`` or
``block`` fit nothing; a null path is empty; a rule given twice with both
verdicts blocks. No rule or no page gives default verdicts or no rows. Repeated
rows stay as often as they come. Kept columns named as a result column are
replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import stored

LABELS, HEAD, PREFIX = 16, 128, 8  # of hosts, of paths, and hex digits of a short hash
HOT, TRACKED, SPLIT = 256, 8192, 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACE = "://([^/?#]*)([^?#]*)"
RESULT = ("host", "path", "rule", "verdict")

Rule = tuple[str, str, str]


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), PLACE, 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), PLACE, 2)


def _short(host: str, path: str, labels: str, head: str) -> Column:
    """The short hash of the last labels of a host and the head of a path."""
    return F.left(F.sha2(F.expr(f"concat(substring_index({host}, '.', -{labels}), left({path}, {head}))"), 256), F.lit(PREFIX))


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules, each once, with their shape, short hash and full digest."""
    path = F.coalesce(F.col("path"), F.lit(""))
    one = rules.where("verdict IN ('allow', 'block') AND host <> ''").select(F.translate("host", UPPER, LOWER).alias("host"), path.alias("path"), (F.col("verdict") == "block").alias("blocks"))
    one = one.groupBy("host", "path").agg(F.max("blocks").alias("blocks"))
    labels = F.least(F.size(F.split("host", "\\.")), F.lit(LABELS))
    one = one.withColumn("labels", labels).withColumn("head", F.least(F.length("path"), F.lit(HEAD)))
    return stored(
        one.select(
            "labels",
            "head",
            _short("host", "path", "labels", "head").alias("key"),
            F.sha2(F.concat("host", "path"), 256).alias("digest"),
            F.length("host").alias("host_length"),
            F.length("path").alias("path_length"),
            "blocks",
            F.concat("host", "path").alias("rule"),
        ),
        "rules",
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: Sequence[str] = ("page_id",), default: str = "allow") -> DataFrame:
    """``keep`` columns and ``host, path, rule, verdict`` for every row of
    ``pages``; ``rules`` has ``host, path, verdict``. Where no rule fits, the
    rule is null and the verdict is ``default``."""
    keep = [c for c in keep if c not in RESULT]
    kept = F.struct(*keep) if keep else F.lit(None).cast("string")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), kept.alias("kept"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    rows = stored(rows, "urls")
    table = rule_table(rules)
    shapes = table.select("labels", "head").distinct().collect()  # LABELS * (HEAD + 1) at most

    best = F.lit(None).cast("struct<length:int,host_length:int,blocks:boolean,rule:string>")
    out = rows
    if shapes:
        shape = F.array(*[F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["head"]).alias("head")) for s in shapes])
        labels = F.size(F.split("host", "\\."))
        spread = rows.where("host <> ''").select("row", "host", "path", labels.alias("has"), F.inline(shape)).where("has >= labels AND length(path) >= head")
        keys = spread.select("row", _short("host", "path", "labels", "head").alias("key"))
        hot = {r["item"]: r["count"] for r in keys.agg(F.expr(f"approx_top_k(key, {HOT}, {TRACKED})").alias("t")).first()["t"]}
        parts = {k: -(-n // SPLIT) for k, n in hot.items() if n > SPLIT}
        lit = F.lit(1)
        if parts:
            lit = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("key")).cast("int"), F.lit(1))
        keys = keys.withColumn("part", F.pmod(F.xxhash64("row"), lit).cast("int"))
        copies = table.withColumn("part", F.explode(F.sequence(F.lit(0), lit - 1)))
        found = keys.join(copies, ["key", "part"]).select("row", F.struct("digest", "host_length", "path_length", "blocks", "rule").alias("r"))
        found = found.groupBy("row").agg(F.collect_list("r").alias("found"))

        def confirmed(r: Column) -> Column:
            # The host ends with the rule's, at a dot or at its start.
            at = F.length("host") - r["host_length"]
            edge = (at == 0) | (F.substr(F.col("host"), at, F.lit(1)) == ".")
            whole = F.concat(F.right(F.col("host"), r["host_length"]), F.left(F.col("path"), r["path_length"]))
            return edge & (F.sha2(whole, 256) == r["digest"])

        fits = F.transform(
            F.filter("found", confirmed),
            lambda r: F.struct((r["host_length"] + r["path_length"]).alias("length"), r["host_length"].alias("host_length"), r["blocks"].alias("blocks"), r["rule"].alias("rule")),
        )
        out, best = rows.join(found, "row", "left"), F.array_max(fits)
    out = out.withColumn("best", best)
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def oracle_sql(rules: Sequence[Rule], default: str = "allow") -> str:
    """The query over ``pages`` in DuckDB SQL."""
    part = "regexp_extract(coalesce(url, ''), '{}', {})"
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    order = "length(r.host || r.path) * 100000 + length(r.host) * 10 + (r.verdict = 'block')::INT"
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, translate({part.format(PLACE, 1)}, '{UPPER}', '{LOWER}') AS host, {part.format(PLACE, 2)} AS path
  FROM pages
), r(host, path, verdict) AS (VALUES {values}),
best AS (
  SELECT u.rid, arg_max(r.host || r.path, {order}) AS rule, arg_max(r.verdict, {order}) AS verdict
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.rid
)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM u LEFT JOIN best USING (rid)
"""
