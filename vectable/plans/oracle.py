"""DuckDB SQL that computes the same result as each registered query, on the
driver tables registered as views. Used as the correctness oracle."""

from __future__ import annotations

# Shared fragments -------------------------------------------------------------

_SPLIT = "CASE WHEN user_id % 10 <= 6 THEN 'train' WHEN user_id % 10 = 7 THEN 'valid' ELSE 'test' END"
_PRED = (
    "CASE WHEN value < 10 THEN 'click' WHEN value < 20 THEN 'error' "
    "WHEN value < 40 THEN 'view' ELSE 'purchase' END"
)


def _cap(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


def _display(x: str) -> str:
    return _cap(f"replace({x}, '_', ' ')")


def _rj(x: str, width) -> str:
    """Right-justify without truncation (see ``reports.rjust``)."""
    return f"(repeat(' ', greatest({width} - length({x}), 0)) || {x})"


def _num(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL THEN '' ELSE printf('%.2f', {c}) END)"


def _slug(x: str) -> str:
    return f"replace(lower({x}), ' ', '_')"


# Standardised embeddings, long form (vec_id, label, pos, z).
_STD = """
  u AS (SELECT vec_id, label, unnest(range(len(embedding)))::INTEGER AS pos,
               unnest(embedding)::DOUBLE AS x FROM embeddings),
  s AS (SELECT vec_id, label, pos,
               (x - avg(x) OVER (PARTITION BY vec_id)) / stddev_pop(x) OVER (PARTITION BY vec_id) AS z
        FROM u)"""

# Nearest centroid over the standardised embeddings.
_CENTROID = _STD + """,
  c AS (SELECT label AS cls, pos, avg(z) AS m FROM s GROUP BY label, pos),
  d AS (SELECT s.vec_id, s.label, c.cls, sum((s.z - c.m) * (s.z - c.m)) AS dist
        FROM s JOIN c ON s.pos = c.pos GROUP BY s.vec_id, s.label, c.cls),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cls) AS rn FROM d),
  pred AS (SELECT vec_id, label, cls AS prediction FROM ranked WHERE rn = 1),
  prob AS (SELECT vec_id, label, cls,
                  exp(-(dist - min(dist) OVER (PARTITION BY vec_id))) AS e FROM d),
  probn AS (SELECT vec_id, label, cls, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM prob)"""

_EVENT_DICT = """
  dict AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_index
           FROM (SELECT DISTINCT event_type AS label FROM events WHERE event_type IS NOT NULL))"""

_TRAIN_DICT = f"""
  tdict AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_index
            FROM (SELECT DISTINCT event_type AS label FROM events
                  WHERE ({_SPLIT}) = 'train' AND event_type <> 'signup' AND event_type IS NOT NULL))"""

_PAIRS = f"pairs AS (SELECT event_id, event_type AS true_type, {_PRED} AS pred_type FROM events)"

# Per-class report over a pair frame `pr(t, p)` and class list `cl(cls)`.
_REPORT = """
  cnt AS (SELECT cls, sum(s) AS support, sum(pp) AS predicted, sum(tp) AS tp FROM (
            SELECT t AS cls, 1 AS s, 0 AS pp, CASE WHEN t = p THEN 1 ELSE 0 END AS tp FROM pr
            UNION ALL SELECT p AS cls, 0, 1, 0 FROM pr) x WHERE cls IS NOT NULL GROUP BY cls),
  rep0 AS (SELECT cl.cls, coalesce(cnt.support, 0) AS support, coalesce(cnt.predicted, 0) AS predicted,
                  coalesce(cnt.tp, 0) AS tp FROM cl LEFT JOIN cnt ON cl.cls = cnt.cls),
  rep1 AS (SELECT cls, support,
                  coalesce(tp::DOUBLE / nullif(predicted, 0), 0) AS precision,
                  coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall FROM rep0),
  rep AS (SELECT cls, support, precision, recall,
                 coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rep1),
  summ AS (
    SELECT 'accuracy' AS metric, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall,
           avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END) AS f1, count(*)::BIGINT AS support FROM pr
    UNION ALL
    SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM rep
    UNION ALL
    SELECT 'weighted avg', coalesce(sum(precision * support) / nullif(sum(support), 0), 0),
           coalesce(sum(recall * support) / nullif(sum(support), 0), 0),
           coalesce(sum(f1 * support) / nullif(sum(support), 0), 0), sum(support)::BIGINT FROM rep)"""

_BATCH = """
  b AS (SELECT vec_id, label,
               (row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '42'), vec_id) - 1)::BIGINT AS row_idx
        FROM embeddings),
  bb AS (SELECT vec_id, label, row_idx, floor(row_idx / 32)::BIGINT AS batch_id FROM b)"""

_HISTORY = """
  h AS (SELECT (ts::DATE - DATE '1970-01-01')::INTEGER AS epoch, round(avg(value), 6) AS accuracy,
               count(*)::DOUBLE AS loss FROM events GROUP BY 1)"""

_DOC_DIST = f"""
  dist AS (SELECT {_cap('lang')} AS "Dataset", {_display('source')} AS "Class",
                  sum(CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END)::BIGINT AS "Images"
           FROM documents GROUP BY lang, source)"""


# Vectors made unusable by the id's residue mod 7 (see ``mapping.with_bad_vectors``).
_BAD = """
  bad AS (SELECT vec_id, CASE vec_id % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'shape' WHEN 2 THEN 'nan' WHEN 3 THEN 'constant' END AS reason
          FROM embeddings)"""

ORACLE: dict[str, str] = {
    "path_label": """
SELECT page_id, url, replace(string_split(url, '/')[-2], '.', '_') AS label,
       string_split(url, '/')[-3] AS split FROM pages""",
    "path_suffix_filter": """
SELECT page_id, url FROM pages
WHERE ends_with(lower(url), 'jpg') OR ends_with(lower(url), '/') OR ends_with(lower(url), 'top')""",
    "display_label": f"""
SELECT name, {_slug('name')} AS slug, {_display(_slug('name'))} AS display
FROM (SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation)""",
    "label_slug": f"""
SELECT p_partkey, {_slug('p_name')} AS name_slug, {_cap('p_type')} AS type_display FROM part""",
    "data_uri_roundtrip": """
WITH x AS (SELECT doc_id, text, 'data:text/plain;base64,' || to_base64(encode(text)) AS uri FROM documents)
SELECT doc_id, uri, decode(from_base64(split_part(uri, ',', 2))) = text AS roundtrip_ok FROM x""",
    "records_json": """
SELECT to_json({'r_regionkey': r_regionkey, 'r_name': r_name})::VARCHAR AS record FROM region""",
    "split_counts": f"""
SELECT {_SPLIT} AS split, count(*)::BIGINT AS n_rows FROM events GROUP BY 1""",
    "labels_union_distinct": f"""
WITH e AS (SELECT {_SPLIT} AS split, event_type AS label FROM events)
SELECT label FROM e WHERE split = 'train'
UNION SELECT label FROM e WHERE split = 'valid'
UNION SELECT label FROM e WHERE split = 'test'""",
    "label_index": f"WITH {_EVENT_DICT} SELECT label, label_index FROM dict",
    "label_encode": f"""
WITH {_TRAIN_DICT}
SELECT e.event_id, e.event_type, coalesce(d.label_index, -1)::INTEGER AS label_index
FROM events e LEFT JOIN tdict d ON e.event_type = d.label""",
    "label_decode": f"""
WITH {_TRAIN_DICT},
  e AS (SELECT event_id, event_type, {_PRED} AS pred_type FROM events)
SELECT e.event_id, d1.label AS true_label, d2.label AS predicted_label
FROM e JOIN tdict d1 ON e.event_type = d1.label JOIN tdict d2 ON e.pred_type = d2.label""",
    "class_distribution": f"WITH {_DOC_DIST} SELECT * FROM dist",
    "class_distribution_wide": f"""
WITH {_DOC_DIST}
SELECT "Class",
       coalesce(sum("Images") FILTER (WHERE "Dataset" = 'De'), 0)::BIGINT AS "De",
       coalesce(sum("Images") FILTER (WHERE "Dataset" = 'En'), 0)::BIGINT AS "En",
       coalesce(sum("Images") FILTER (WHERE "Dataset" = 'Es'), 0)::BIGINT AS "Es",
       coalesce(sum("Images") FILTER (WHERE "Dataset" = 'Fr'), 0)::BIGINT AS "Fr"
FROM dist GROUP BY "Class" """,
    "classes_present": """
SELECT n_nationkey, n_name FROM nation n
WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = n.n_nationkey AND c.c_acctbal > 9900)""",
    "classes_missing": """
SELECT n_nationkey, n_name FROM nation n
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = n.n_nationkey AND c.c_acctbal > 9900)""",
    "standardize": f"WITH {_STD} SELECT vec_id, pos, round(z, 6) AS value FROM s",
    "standardize_eps": """
WITH u AS (SELECT vec_id, unnest(range(len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT vec_id, pos,
       round((x - avg(x) OVER (PARTITION BY vec_id)) / (stddev_pop(x) OVER (PARTITION BY vec_id) + 1e-7), 6) AS value
FROM u""",
    "scale": """
SELECT vec_id, unnest(range(len(embedding)))::INTEGER AS pos,
       round(unnest(embedding)::DOUBLE / 255.0, 9) AS value FROM embeddings""",
    "class_mean_vector": """
WITH u AS (SELECT label, unnest(range(len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT label, pos, round(avg(x), 6) AS value FROM u GROUP BY label, pos""",
    "class_mean_trunc": """
WITH u AS (SELECT label, unnest(range(len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT label, pos, trunc(avg((x + 4.0) * 20.0))::INTEGER AS value FROM u GROUP BY label, pos""",
    "centroid_predict": f"WITH {_CENTROID} SELECT vec_id, label, prediction FROM pred",
    "class_probability": f"WITH {_CENTROID} SELECT vec_id, cls, round(p, 6) AS prob FROM probn",
    "argmax_confidence": f"""
WITH {_CENTROID},
  top AS (SELECT vec_id, cls, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, cls) AS rn FROM probn)
SELECT vec_id, cls AS predicted, round(p, 6) AS confidence, printf('%.2f%%', p * 100) AS confidence_text
FROM top WHERE rn = 1""",
    "cross_entropy": f"""
WITH {_CENTROID}
SELECT round(avg(-ln(least(greatest(p, 1e-7), 1 - 1e-7))), 6) AS cross_entropy, count(*)::BIGINT AS n_rows
FROM probn WHERE cls = label""",
    "confusion_long": f"""
WITH {_CENTROID},
  cl AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
  n AS (SELECT label AS t, prediction AS p, count(*) AS n FROM pred GROUP BY 1, 2)
SELECT a.c AS "true", b.c AS pred, coalesce(n.n, 0)::BIGINT AS n
FROM cl a CROSS JOIN cl b LEFT JOIN n ON n.t = a.c AND n.p = b.c""",
    "confusion_wide": f"""
WITH {_CENTROID}
SELECT label AS "true",
{chr(10).join(f"  count(*) FILTER (WHERE prediction = {i})::BIGINT AS pred_{i}," for i in range(10)).rstrip(',')}
FROM pred GROUP BY label""",
    "confusion_annotated": f"""
WITH {_EVENT_DICT}, {_PAIRS},
  enc AS (SELECT d1.label_index AS t, d2.label_index AS p FROM pairs
          LEFT JOIN dict d1 ON pairs.true_type = d1.label LEFT JOIN dict d2 ON pairs.pred_type = d2.label),
  n AS (SELECT t, p, count(*) AS n FROM enc GROUP BY 1, 2),
  cells AS (SELECT a.label_index AS y, b.label_index AS x, coalesce(n.n, 0) AS n
            FROM dict a CROSS JOIN dict b LEFT JOIN n ON n.t = a.label_index AND n.p = b.label_index)
SELECT x, y, n::VARCHAR AS text,
       CASE WHEN n > (SELECT max(n) FROM cells) / 2.0 THEN 'white' ELSE 'black' END AS colour
FROM cells""",
    "class_report": f"""
WITH {_EVENT_DICT}, {_PAIRS},
  pr AS (SELECT true_type AS t, pred_type AS p FROM pairs),
  cl AS (SELECT label AS cls FROM dict), {_REPORT}
SELECT cls AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support::BIGINT AS support FROM rep""",
    "report_summary": f"""
WITH {_EVENT_DICT}, {_PAIRS},
  pr AS (SELECT true_type AS t, pred_type AS p FROM pairs),
  cl AS (SELECT label AS cls FROM dict), {_REPORT}
SELECT metric, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM summ""",
    "report_summary_labels": f"""
WITH pr AS (SELECT quality AS t, 1 - toxic AS p FROM labels),
  cl AS (SELECT t AS cls FROM pr WHERE t IS NOT NULL UNION SELECT p FROM pr WHERE p IS NOT NULL), {_REPORT}
SELECT metric, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM summ""",
    "report_text": f"""
WITH {_EVENT_DICT}, {_PAIRS},
  pr AS (SELECT true_type AS t, pred_type AS p FROM pairs),
  cl AS (SELECT label AS cls FROM dict), {_REPORT},
  w AS (SELECT greatest(coalesce(max(length(cls)), 0), 12, 2) AS width FROM rep),
  rows AS (SELECT cls AS row_name, 1 AS section, precision, recall, f1, support FROM rep
           UNION ALL SELECT metric, 2, precision, recall, f1, support FROM summ)
SELECT '' AS row_name, 0 AS section,
       {_rj("''", "width")} || ' ' || ' ' || {_rj("'precision'", 9)} || ' ' || {_rj("'recall'", 9)}
       || ' ' || {_rj("'f1-score'", 9)} || ' ' || {_rj("'support'", 9)} AS line
FROM w
UNION ALL
SELECT row_name, section,
       {_rj("row_name", "(SELECT width FROM w)")} || ' '
       || ' ' || {_rj(_num("precision"), 9)} || ' ' || {_rj(_num("recall"), 9)}
       || ' ' || {_rj(_num("f1"), 9)} || ' ' || {_rj("support::VARCHAR", 9)} AS line
FROM rows""",
    "predictions_table": f"""
WITH {_CENTROID}
SELECT 'embeddings/' || label::VARCHAR || '/' || vec_id::VARCHAR AS image_path,
       label::VARCHAR AS true_label, prediction::VARCHAR AS predicted_label FROM pred""",
    "reject_rows": f"""
WITH {_BAD} SELECT vec_id, reason FROM bad WHERE reason IS NOT NULL""",
    "loaded_counts": f"""
WITH {_BAD}
SELECT count(*)::BIGINT AS n_rows, count_if(reason IS NULL)::BIGINT AS n_loaded,
       ceil(count_if(reason IS NULL) / 32.0)::BIGINT AS n_batches FROM bad""",
    "first_n_per_class": """
SELECT vec_id, label, rank::INTEGER AS rank FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rank FROM embeddings)
WHERE rank <= 5""",
    "ordered_cap": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 500",
    "first_row": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 1",
    "page": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 10 OFFSET 20",
    "mini_batches": f"WITH {_BATCH} SELECT vec_id, label, row_idx, batch_id FROM bb",
    "batch_summary": f"""
WITH {_BATCH}
SELECT batch_id, count(*)::BIGINT AS n_rows,
       array_to_string(list_slice(list(label::VARCHAR ORDER BY row_idx), 1, 5), ',') AS first_labels
FROM bb GROUP BY batch_id""",
    "history_long": f"""
WITH {_HISTORY}
SELECT epoch, 'accuracy' AS variable, accuracy AS value FROM h
UNION ALL SELECT epoch, 'loss', loss FROM h""",
    "history_last": f"""
WITH {_HISTORY}
SELECT max(epoch) AS last_epoch, arg_max(accuracy, epoch) AS final_accuracy, arg_max(loss, epoch) AS final_loss FROM h""",
}

ORACLE["class_distribution_grid"] = """
SELECT l.lang, s.source,
       coalesce(sum(CASE WHEN d.n_chars >= 1000 AND NOT (d.lang = 'en' AND d.source = 'src8') THEN 1 END), 0)::BIGINT AS "Images"
FROM (SELECT DISTINCT lang FROM documents) l CROSS JOIN (SELECT DISTINCT source FROM documents) s
LEFT JOIN documents d ON d.lang = l.lang AND d.source = s.source
GROUP BY l.lang, s.source"""
ORACLE["dictionary_maps"] = f"""
WITH {_EVENT_DICT}
SELECT e.event_id, d.label_index, d.label FROM events e LEFT JOIN dict d ON e.event_type = d.label"""
ORACLE["nearest_centroid_many_classes"] = f"""
WITH {_STD.replace('SELECT vec_id, label, unnest', 'SELECT vec_id, (vec_id % 37)::INTEGER AS label, unnest')},
  c AS (SELECT label AS cls, pos, avg(z) AS m FROM s GROUP BY label, pos),
  d AS (SELECT s.vec_id, c.cls, sum((s.z - c.m) * (s.z - c.m)) AS dist FROM s JOIN c ON s.pos = c.pos GROUP BY s.vec_id, c.cls),
  r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cls) AS rn FROM d)
SELECT vec_id, CASE WHEN vec_id % 3 <> 0 THEN vec_id % 5 END AS row_key, cls AS prediction FROM r WHERE rn = 1"""
ORACLE["uniform_dim"] = "SELECT len(embedding)::INTEGER AS dim, count(*)::BIGINT AS n_rows FROM embeddings GROUP BY 1"
ORACLE["user_model"] = """
WITH u AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT vec_id, round(sum(x * pos), 6) AS score FROM u GROUP BY vec_id"""
ORACLE["image_vectors"] = """
WITH u AS (SELECT vec_id, unnest(range(64)) AS p, unnest(embedding)::DOUBLE AS x FROM embeddings),
  px AS (SELECT vec_id, p // 8 AS r, p % 8 AS c, greatest(0, least(255, floor((x + 4.0) * 20.0))) AS v FROM u),
  cell AS (SELECT vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM px GROUP BY vec_id, r // 2, c // 2)
SELECT vec_id, ((r * 4 + c) * 3 + k)::INTEGER AS pos, v::DOUBLE AS value FROM cell CROSS JOIN (SELECT unnest([0, 1, 2]) AS k)"""
ORACLE["fixed_text"] = "SELECT event_id, printf('%.4f', value) AS value_text FROM events"
ORACLE["confusion_with_unknowns"] = f"""
WITH {_EVENT_DICT},
  pairs AS (SELECT event_type AS t, CASE WHEN value < 5 THEN NULL WHEN value < 10 THEN 'unheard' ELSE {_PRED} END AS p FROM events),
  n AS (SELECT t, p, count(*) AS n FROM pairs GROUP BY 1, 2),
  grid AS (SELECT a.label AS t, b.label AS p FROM dict a CROSS JOIN dict b)
SELECT t AS "true", p AS pred, n::BIGINT AS n FROM n
UNION ALL
SELECT t, p, 0 FROM grid WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.t = grid.t AND n.p = grid.p)"""
ORACLE["page_after"] = "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id > 29 ORDER BY doc_id LIMIT 10"
ORACLE["mini_batches_null_id"] = """
WITH e AS (SELECT CASE WHEN vec_id <> 7 THEN vec_id END AS vec_id, label FROM embeddings),
  b AS (SELECT vec_id, label, (row_number() OVER (ORDER BY md5(coalesce(vec_id::VARCHAR, '') || '42'), vec_id NULLS FIRST) - 1)::BIGINT AS row_idx FROM e)
SELECT vec_id, label, row_idx, floor(row_idx / 32)::BIGINT AS batch_id FROM b"""
ORACLE["labelled_files"] = "SELECT 'source=' || source AS label, sum(strlen(text) + 1)::BIGINT AS n_bytes FROM documents GROUP BY source"
# Facts that hold for any right fit, counted over all rows.
ORACLE["mlp_predict"] = """
SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_class, count(*)::BIGINT AS n_sum_one, count(*)::BIGINT AS n_argmax FROM embeddings"""
ORACLE["mlp_history"] = "SELECT true AS without_gap, true AS never_rises, true AS within_limit, true AS has_learned"
ORACLE["latent_2d"] = """
SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_points, count(DISTINCT vec_id)::BIGINT AS n_ids, true AS axes_in_order, true AS uncorrelated FROM embeddings"""
ORACLE["model_roundtrip"] = """
SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_same_prediction, count(*)::BIGINT AS n_same_probability FROM embeddings"""

# Rows-only jobs whose result is still exactly known in SQL.
ORACLE["csv_roundtrip"] = ORACLE["predictions_table"]
ORACLE["stream_score"] = ORACLE["centroid_predict"]
ORACLE["stream_counts"] = """
SELECT CASE WHEN substr(md5(vec_id::VARCHAR), 1, 1) < 'c' THEN 'train' ELSE 'test' END AS split,
       label::VARCHAR AS label, count(*)::BIGINT AS n
FROM embeddings GROUP BY 1, 2"""
ORACLE["dump_roundtrip"] = f"""
WITH {_EVENT_DICT}
SELECT md5(e.props) AS content_md5, 'events/' || e.event_id::VARCHAR AS path, e.event_type AS label,
       coalesce(d.label_index, -1)::INTEGER AS label_index, {_SPLIT} AS split
FROM events e LEFT JOIN dict d ON e.event_type = d.label"""
ORACLE["files_scan"] = """
SELECT 'lang=' || lang AS split, 'source=' || source AS label, sum(strlen(text) + 1)::BIGINT AS n_bytes
FROM documents GROUP BY lang, source"""


def _plus_zero(sql: str) -> str:
    """Rewrite every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB keeps the
    sign of a zero result (-0.0) where Spark's ``round`` gives 0.0; adding
    +0.0 makes both the same value under any hashing."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("(round(" + _plus_zero(sql[j + len("round(") : k]) + ") + 0.0)")
        i = k + 1


ORACLE = {name: _plus_zero(sql) for name, sql in ORACLE.items()}

from vectable.plans.more import ORACLE as _MORE  # noqa: E402
from vectable.plans.training import ORACLE as _TRAINING  # noqa: E402
from vectable.plans.trees import ORACLE as _TREES  # noqa: E402

ORACLE.update(_MORE)
ORACLE.update(_TREES)
ORACLE.update(_TRAINING)
