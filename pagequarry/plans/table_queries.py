"""Queries on OCR lines, rows and cells."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as g
from ..functions import sequence as sq
from ..functions import text as t
from ..operators import tables as tb
from ..operators.numbering import medians
from .registry import fixture, query

fixture("base_lines", "SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_partkey) AS pk, min(l_suppkey) AS sk, min(l_returnflag) AS rf FROM lineitem GROUP BY l_orderkey, l_linenumber")
fixture(
    "ocr_lines",
    """SELECT CAST(ok % 200 AS INT) AS page, ok AS table_id, CAST(ln * 2 + c.k AS INT) AS line_no,
  CASE WHEN pk % 29 = 0 THEN ' ' WHEN pk % 13 = 0 THEN CAST(ln AS STRING) WHEN pk % 11 = 0 THEN concat('- bullet ', rf) WHEN ln % 3 = 1 THEN concat(CAST(ln AS STRING), '. Numbered item ', rf, ' of supplier ', CAST(sk % 10 AS STRING)) WHEN pk % 7 = 0 THEN '## ** !! ..' WHEN pk % 5 = 0 THEN 'GENERAL NOTES' ELSE concat('Row text ', rf, ' tail') END AS text,
  CAST(60 + pk % 40 - 5 * c.k AS DOUBLE) / 100 AS confidence,
  CAST((pk % 40) * 10 + 2 * c.k AS DOUBLE) AS x1, CAST(60 * ln + (sk % 5) * 3 + c.k + CASE WHEN ok % 7 = 0 AND ln > 3 THEN 200 ELSE 0 END AS DOUBLE) AS y1,
  CAST((pk % 40) * 10 + 100 + (pk % 7) * 10 AS DOUBLE) AS x2, CAST(60 * ln + (sk % 5) * 3 + 20 + pk % 3 + CASE WHEN ok % 7 = 0 AND ln > 3 THEN 200 ELSE 0 END AS DOUBLE) AS y2,
  CASE WHEN c.k = 0 THEN 'detected_table_crop' ELSE 'detected_table_tile' END AS source_kind
FROM base_lines CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1) c WHERE (c.k = 0 AND pk % 17 <> 0) OR (c.k = 1 AND (pk % 4 = 0 OR pk % 17 = 0))""",
    "base_lines",
)


@query("p07_source_policy", "ocr_lines", sql=" SELECT page, table_id, line_no FROM (SELECT *, max(CASE WHEN source_kind = 'detected_table_crop' THEN 1 ELSE 0 END) OVER (PARTITION BY page, table_id) AS c FROM ocr_lines) q WHERE source_kind = 'detected_table_crop' OR c = 0")
def p07(i):
    return tb.by_source(i.ocr_lines, "prefer_crop").select("page", "table_id", "line_no")


@query("p08_confidence_filter", "ocr_lines", sql=" SELECT page, table_id, line_no, confidence FROM ocr_lines WHERE confidence >= 0.70::DOUBLE")
def p08(i):
    return i.ocr_lines.filter("confidence >= 0.70D").select("page", "table_id", "line_no", "confidence")


@query("g06_source_rank", "ocr_lines", sql=" SELECT source_kind, CASE source_kind WHEN 'detected_table_crop' THEN 3 WHEN 'detected_table_tile' THEN 2 ELSE 1 END AS source_rank, count(*) AS n FROM ocr_lines GROUP BY 1, 2")
def g06(i):
    return i.ocr_lines.groupBy("source_kind", tb.source_rank(F.col("source_kind")).alias("source_rank")).agg(F.count("*").alias("n"))


KIND = r"CASE WHEN trim(text) = '' THEN 'blank' WHEN regexp_matches(text, '^\s*\d{1,4}\s*[.):\-]\s*\S.+$') THEN 'numbered_start' WHEN regexp_matches(text, '^\s*\d{1,4}\s*[.):\-]?\s*$') THEN 'number_only' WHEN regexp_matches(text, '^\s*[-•–]\s+\S+') THEN 'bullet' ELSE 'continuation' END"


@query("p09_row_kind", "ocr_lines", sql=f" SELECT page, table_id, line_no, {KIND} AS kind FROM ocr_lines")
def p09(i):
    return i.ocr_lines.select("page", "table_id", "line_no", tb.row_kind(F.col("text")).alias("kind"))


@query(
    "g05_iou",
    "ocr_lines",
    sql=""", lists AS (SELECT table_id, list({'line_no': line_no, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}) AS ls FROM ocr_lines GROUP BY 1),
lefts AS (SELECT table_id, ls, unnest(ls) AS a FROM lists),
pairs AS (SELECT table_id, a, unnest(ls) AS b FROM lefts),
p AS (SELECT table_id, a.line_no AS left_no, b.line_no AS right_no, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) AS w, greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS h, (a.x2 - a.x1) * (a.y2 - a.y1) AS s, (b.x2 - b.x1) * (b.y2 - b.y1) AS r FROM pairs WHERE a.line_no < b.line_no)
SELECT table_id, left_no, right_no, CASE WHEN s + r - w * h > 0 THEN w * h / (s + r - w * h) ELSE 0 END AS iou, CASE WHEN least(s, r) > 0 THEN w * h / least(s, r) ELSE 0 END AS overlap FROM p WHERE w > 0 AND h > 0""",
)
def g05(i):
    b = i.ocr_lines.select("table_id", "line_no", g.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("b"))
    j = g.overlapping(b, ["table_id"], "line_no")
    return j.select("table_id", "left_no", "right_no", g.iou(F.col("left"), F.col("right")).alias("iou"), g.overlap_ratio(F.col("left"), F.col("right")).alias("overlap"))


GREEDY = """/*recursive*/, k AS (SELECT *, row_number() OVER (PARTITION BY table_id, lower(trim(text)) ORDER BY CASE source_kind WHEN 'detected_table_crop' THEN 3 ELSE 2 END DESC, confidence DESC, (x2 - x1) * (y2 - y1) DESC, line_no) AS rn, lower(trim(text)) AS key FROM ocr_lines),
rec AS (SELECT page, table_id, key, rn, [line_no] AS kept FROM k WHERE rn = 1
UNION ALL SELECT k.page, k.table_id, k.key, k.rn, CASE WHEN EXISTS (SELECT 1 FROM k m WHERE m.table_id = k.table_id AND m.key = k.key AND list_contains(rec.kept, m.line_no) AND greatest(0, least(m.x2, k.x2) - greatest(m.x1, k.x1)) * greatest(0, least(m.y2, k.y2) - greatest(m.y1, k.y1)) >= 0.35::DOUBLE * ((m.x2 - m.x1) * (m.y2 - m.y1) + (k.x2 - k.x1) * (k.y2 - k.y1) - greatest(0, least(m.x2, k.x2) - greatest(m.x1, k.x1)) * greatest(0, least(m.y2, k.y2) - greatest(m.y1, k.y1)))) THEN rec.kept ELSE list_append(rec.kept, k.line_no) END FROM rec JOIN k ON k.table_id = rec.table_id AND k.key = rec.key AND k.rn = rec.rn + 1),
fin AS (SELECT *, row_number() OVER (PARTITION BY table_id, key ORDER BY rn DESC) AS z FROM rec), kept AS (SELECT page, table_id, unnest(kept) AS line_no FROM fin WHERE z = 1) """


@query("g03_greedy_dedup", "ocr_lines", sql=GREEDY + "SELECT page, table_id, line_no FROM kept")
def g03(i):
    return tb.deduplicated(i.by_order.ocr_lines).select("page", "table_id", "line_no")


CLUSTER = """/*recursive*/, s AS (SELECT *, (y1 + y2) / 2 AS cy, row_number() OVER (PARTITION BY table_id ORDER BY (y1 + y2) / 2, x1, line_no) AS rn FROM ocr_lines),
c AS (SELECT table_id, rn, cy AS total, CAST(1 AS BIGINT) AS n, CAST(1 AS BIGINT) AS cid FROM s WHERE rn = 1
UNION ALL SELECT s.table_id, s.rn, CASE WHEN abs(s.cy - c.total / c.n) <= 18 THEN c.total + s.cy ELSE s.cy END, CASE WHEN abs(s.cy - c.total / c.n) <= 18 THEN c.n + 1 ELSE 1 END, CASE WHEN abs(s.cy - c.total / c.n) <= 18 THEN c.cid ELSE c.cid + 1 END FROM c JOIN s ON s.table_id = c.table_id AND s.rn = c.rn + 1),
vr AS (SELECT s.page, s.table_id, CAST(c.cid AS INT) AS row_no, string_agg(s.text, ' ' ORDER BY s.x1, s.line_no) AS text, avg(s.confidence) AS confidence, min(s.x1) AS x1, min(s.y1) AS y1, max(s.x2) AS x2, max(s.y2) AS y2, count(*) AS n_lines FROM s JOIN c USING (table_id, rn) GROUP BY 1, 2, 3) """


@query("g01_mean_clusters", "ocr_lines", sql=CLUSTER + "SELECT s.page, s.table_id, s.line_no, CAST(c.cid AS INT) AS row_no FROM s JOIN c USING (table_id, rn)")
def g01(i):
    item = F.struct(((F.col("y1") + F.col("y2")) / 2).alias("cy"), F.col("x1").alias("x1"), F.col("line_no").alias("line_no"))
    groups = i.by_order.ocr_lines.groupBy("page", "table_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    ids = sq.mean_clusters(F.transform("items", lambda x: x["cy"]), F.lit(18.0))
    return groups.select("page", "table_id", F.explode(F.arrays_zip("items", ids.alias("ids"))).alias("z")).select("page", "table_id", "z.items.line_no", F.col("z.ids").alias("row_no"))


@query("a05_bbox_hull", "ocr_lines", sql=CLUSTER + "SELECT page, table_id, row_no, x1, y1, x2, y2 FROM vr")
def a05(i):
    return tb.visual_rows(i.by_order.ocr_lines).select("page", "table_id", "row_no", "x1", "y1", "x2", "y2")


@query("a06_mean_confidence", "ocr_lines", sql=CLUSTER + "SELECT page, table_id, row_no, round(confidence, 9) AS confidence, n_lines FROM vr")
def a06(i):
    return tb.visual_rows(i.by_order.ocr_lines).select("page", "table_id", "row_no", F.round("confidence", 9).alias("confidence"), "n_lines")


@query("a07_ordered_text", "ocr_lines", sql=CLUSTER + "SELECT page, table_id, row_no, text FROM vr")
def a07(i):
    return tb.visual_rows(i.by_order.ocr_lines).select("page", "table_id", "row_no", "text")


SESSION = (
    CLUSTER
    + f""", v AS (SELECT *, {KIND} AS kind, row_number() OVER (PARTITION BY table_id ORDER BY row_no) AS vn FROM vr),
l AS (SELECT table_id, vn, y2 AS low, CAST(1 AS BIGINT) AS gid FROM v WHERE vn = 1
UNION ALL SELECT v.table_id, v.vn, CASE WHEN v.kind = 'numbered_start' OR v.y1 - l.low > 180 THEN v.y2 ELSE greatest(l.low, v.y2) END, CASE WHEN v.kind = 'numbered_start' OR v.y1 - l.low > 180 THEN l.gid + 1 ELSE l.gid END FROM l JOIN v ON v.table_id = l.table_id AND v.vn = l.vn + 1),
lr AS (SELECT v.page, v.table_id, CAST(gid AS INT) AS record_no, arg_min(kind, row_no) AS first_kind, string_agg(text, ' ' ORDER BY row_no) AS text, string_agg(CAST(row_no AS STRING), ',' ORDER BY row_no) AS source_rows, count(*) AS n_rows, avg(confidence) AS confidence FROM v JOIN l USING (table_id, vn) GROUP BY 1, 2, 3),
rk AS (SELECT *, CASE WHEN first_kind = 'numbered_start' OR record_no > 1 THEN 'numbered_start' ELSE 'unstructured' END AS record_kind FROM lr),
st AS (SELECT *, CASE WHEN record_kind = 'numbered_start' AND round(confidence, 9) >= 0.85 THEN 'candidate' ELSE 'needs_review' END AS status FROM rk),
logical AS (SELECT *, CASE WHEN status = 'candidate' THEN '' WHEN record_kind = 'numbered_start' THEN 'low_average_ocr_confidence' ELSE 'no_numbered_record_start' END AS reason FROM st) """
)


def _logical(i):
    rows = tb.visual_rows(i.by_order.ocr_lines)
    return tb.logical_rows(rows)


@query("w04_logical_rows", "ocr_lines", sql=SESSION + "SELECT page, table_id, record_no, text, source_rows, n_rows, record_kind FROM logical")
def w04(i):
    return _logical(i).select("page", "table_id", "record_no", "text", "source_rows", "n_rows", "record_kind")


@query("p10_logical_status", "ocr_lines", sql=SESSION + "SELECT page, table_id, record_no, record_kind, status, reason FROM logical WHERE abs(confidence - 0.85) > 1e-6")
def p10(i):
    return _logical(i).filter("abs(confidence - 0.85) > 1e-6").select("page", "table_id", "record_no", "record_kind", "status", "reason")


@query("p11_needs_review", "ocr_lines", sql=SESSION + "SELECT page, table_id, record_no FROM logical WHERE status = 'needs_review' AND abs(confidence - 0.85) > 1e-6")
def p11(i):
    return _logical(i).filter("status = 'needs_review' and abs(confidence - 0.85) > 1e-6").select("page", "table_id", "record_no")


PRI = "CASE WHEN regexp_matches(reason, 'no_numbered_record_start|missing') OR confidence < 0.8 THEN 'high' WHEN regexp_matches(reason, 'continuation|merged|inconsistent') THEN 'medium' ELSE 'low' END"


@query("p12_review_priority", "ocr_lines", sql=SESSION + f"SELECT page, table_id, record_no, {PRI} AS priority FROM logical WHERE abs(confidence - 0.85) > 1e-6 AND abs(confidence - 0.8) > 1e-6")
def p12(i):
    r = _logical(i).filter("abs(confidence - 0.85) > 1e-6 and abs(confidence - 0.8) > 1e-6")
    return r.select("page", "table_id", "record_no", tb.review_priority(F.col("reason"), F.col("confidence")).alias("priority"))


@query("o03_review_order", "ocr_lines", sql=SESSION + f"SELECT page, table_id, record_no, row_number() OVER (PARTITION BY page ORDER BY CASE {PRI} WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, table_id, record_no) AS position FROM logical WHERE abs(confidence - 0.85) > 1e-6 AND abs(confidence - 0.8) > 1e-6")
def o03(i):
    r = _logical(i).filter("abs(confidence - 0.85) > 1e-6 and abs(confidence - 0.8) > 1e-6")
    rank = t.rank(tb.review_priority(F.col("reason"), F.col("confidence")), {"high": 0, "medium": 1, "low": 2})
    w = Window.partitionBy("page").orderBy(rank, "table_id", "record_no")
    return r.select("page", "table_id", "record_no", F.row_number().over(w).alias("position"))


fixture(
    "review_rows",
    """SELECT page, table_id, line_no, text, CASE WHEN line_no % 11 = 0 THEN 0.0 ELSE confidence END AS confidence, CAST(line_no % 6 AS INT) AS n_rows,
CASE CAST(line_no % 7 AS INT) WHEN 0 THEN 'No_numbered_record_start' WHEN 1 THEN 'low_average_ocr_confidence' WHEN 2 THEN 'missing_activity_number; merged' WHEN 3 THEN 'continuation_without_clear_start' WHEN 4 THEN 'unstructured, no_table_candidate_detected' ELSE '' END AS reason,
CASE WHEN table_id % 9 = 0 THEN '' WHEN table_id % 9 = 4 THEN NULL ELSE concat('crop_', CAST(line_no AS STRING), '.png') END AS crop FROM ocr_lines""",
    "ocr_lines",
)
AUTO = r""", r0 AS (SELECT *, length(trim(text)) AS ln, CASE WHEN length(trim(text)) > 0 THEN length(regexp_replace(trim(text), '[^\p{L}\p{N}]', '', 'g')) / length(trim(text)) ELSE 0.0 END AS al, count(*) OVER (PARTITION BY page, table_id, regexp_replace(upper(text), '[^A-Z0-9]', '', 'g')) AS copies,
regexp_matches(lower(reason), 'no_numbered_record_start|unstructured|continuation_without_clear_start') AS loose, regexp_matches(lower(reason), 'missing_inspection_detail|missing_activity_number|no_table_candidate_detected') AS hard FROM review_rows),
sc AS (SELECT *, least(100, greatest(0, (CASE WHEN crop <> '' THEN 20 ELSE 0 END) + (CASE WHEN confidence >= 0.8 THEN 30 WHEN confidence >= 0.65 THEN 18 WHEN confidence > 0 THEN 5 ELSE 0 END) + (CASE WHEN ln >= 30 THEN 20 WHEN ln >= 12 THEN 10 ELSE 0 END) + (CASE WHEN al >= 0.55 THEN 15 WHEN al >= 0.35 THEN 7 ELSE 0 END) + (CASE WHEN n_rows = 1 THEN 15 WHEN n_rows BETWEEN 2 AND 4 THEN 7 ELSE 0 END) + (CASE WHEN copies = 1 THEN 10 ELSE 0 END) - (CASE WHEN loose THEN 8 ELSE 0 END) - (CASE WHEN hard THEN 25 ELSE 0 END))) AS score,
concat_ws(',', CASE WHEN crop <> '' THEN 'review_crop_exists' END, CASE WHEN confidence >= 0.8 THEN 'strong_average_ocr_confidence' WHEN confidence >= 0.65 THEN 'moderate_average_ocr_confidence' END, CASE WHEN ln >= 30 THEN 'substantive_text' WHEN ln >= 12 THEN 'short_but_nonempty_text' END, CASE WHEN al >= 0.55 THEN 'readable_alphanumeric_content' END, CASE WHEN n_rows = 1 THEN 'single_visual_row' WHEN n_rows BETWEEN 2 AND 4 THEN 'bounded_wrapped_rows' END, CASE WHEN copies = 1 THEN 'unique_within_page_table' END) AS positive,
concat_ws(',', CASE WHEN crop IS NULL THEN 'crop_manifest_entry_missing' WHEN crop = '' THEN 'crop_path_missing' END, CASE WHEN confidence >= 0.8 THEN NULL WHEN confidence >= 0.65 THEN 'moderate_ocr_confidence' WHEN confidence > 0 THEN 'low_ocr_confidence' ELSE 'missing_ocr_confidence' END, CASE WHEN ln < 12 THEN 'very_short_or_empty_text' END, CASE WHEN al >= 0.55 THEN NULL WHEN al >= 0.35 THEN 'mixed_or_noisy_text' ELSE 'mostly_symbols_or_noise' END, CASE WHEN n_rows BETWEEN 2 AND 4 THEN 'merged_visual_rows' WHEN n_rows > 4 THEN 'many_merged_visual_rows' WHEN n_rows < 1 THEN 'source_rows_unknown' END, CASE WHEN copies > 1 THEN 'possible_duplicate_record' END, CASE WHEN loose THEN 'low_structure_confidence' END, CASE WHEN hard THEN 'existing_hard_extraction_issue' END) AS cautions FROM r0),
au AS (SELECT *, CASE WHEN regexp_matches(cautions, 'crop_path_missing|crop_manifest_entry_missing|very_short_or_empty_text|mostly_symbols_or_noise|existing_hard_extraction_issue|missing_ocr_confidence') THEN 'needs_human_review' WHEN score >= 70 AND contains(cautions, 'low_structure_confidence') THEN 'auto_accepted_low_structure' WHEN score >= 70 THEN 'auto_accepted' WHEN score >= 45 THEN 'auto_accepted_low_confidence' ELSE 'needs_human_review' END AS decision FROM sc) """


@query("p13_auto_review_score", "review_rows", sql=AUTO + "SELECT page, table_id, line_no, score, positive, cautions FROM au")
def p13(i):
    return tb.auto_review(i.review_rows).select("page", "table_id", "line_no", "score", F.array_join("positive", ",").alias("positive"), F.array_join("cautions", ",").alias("cautions"))


@query("p14_auto_decision", "review_rows", sql=AUTO + "SELECT page, table_id, line_no, decision FROM au")
def p14(i):
    return tb.auto_review(i.review_rows).select("page", "table_id", "line_no", "decision")


@query("p15_accept_split", "review_rows", sql=AUTO + "SELECT CASE WHEN decision LIKE 'auto_accepted%' THEN 'accepted' ELSE 'unresolved' END AS side, decision, count(*) AS n FROM au GROUP BY 1, 2")
def p15(i):
    a = tb.auto_review(i.review_rows)
    return a.groupBy(F.when(F.startswith("decision", F.lit("auto_accepted")), "accepted").otherwise("unresolved").alias("side"), "decision").agg(F.count("*").alias("n"))


@query("a04_duplicate_count", "review_rows", sql=AUTO + "SELECT page, table_id, line_no, copies FROM au")
def a04(i):
    return tb.auto_review(i.review_rows).select("page", "table_id", "line_no", "copies")


@query("j06_crop_manifest", "review_rows", sql=" SELECT page, table_id, line_no, CASE WHEN line_no % 2 = 0 THEN coalesce(crop, '') ELSE '' END AS crop_file FROM review_rows")
def j06(i):
    m = i.review_rows.filter("line_no % 2 = 0").select("table_id", "line_no", F.col("crop").alias("crop_file"))
    return i.review_rows.join(m, ["table_id", "line_no"], "left").select("page", "table_id", "line_no", t.text("crop_file").alias("crop_file"))


@query("j05_review_to_table", "review_rows", "ocr_lines", sql=" SELECT r.page, r.table_id, r.line_no, q.n FROM review_rows r JOIN (SELECT page, table_id, count(*) AS n FROM ocr_lines GROUP BY 1, 2) q USING (page, table_id)")
def j05(i):
    n = i.ocr_lines.groupBy("page", "table_id").agg(F.count("*").alias("n"))
    return i.review_rows.join(n, ["page", "table_id"]).select("page", "table_id", "line_no", "n")


@query("j04_source_rows", "ocr_lines", sql=SESSION + ", x AS (SELECT page, table_id, record_no, unnest(string_split(source_rows, ',')) AS r FROM logical) SELECT x.page, x.table_id, x.record_no, vr.row_no, vr.n_lines FROM x JOIN vr ON vr.table_id = x.table_id AND vr.row_no = CAST(x.r AS INT)")
def j04(i):
    rows = tb.visual_rows(i.by_order.ocr_lines)
    x = tb.logical_rows(rows).select("page", "table_id", "record_no", F.explode(F.split("source_rows", ",")).alias("r")).withColumn("row_no", F.col("r").cast("int"))
    return x.join(rows.select("page", "table_id", "row_no", "n_lines"), ["page", "table_id", "row_no"]).select("page", "table_id", "record_no", "row_no", "n_lines")


@query("o07_reading_order", "ocr_lines", sql=" SELECT page, table_id, line_no, row_number() OVER (PARTITION BY table_id ORDER BY y1, x1, line_no) AS position FROM ocr_lines")
def o07(i):
    return i.ocr_lines.select("page", "table_id", "line_no", F.row_number().over(Window.partitionBy("table_id").orderBy("y1", "x1", "line_no")).alias("position"))


HEAD = r"(NOT contains(text, ':') AND length(text) BETWEEN 3 AND 80 AND length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 0 AND length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / greatest(1, length(regexp_replace(text, '[^\p{L}]', '', 'g'))) >= 0.75)"


@query("p26_heading", "ocr_lines", sql=f" SELECT page, table_id, line_no, {HEAD} AS heading FROM ocr_lines")
def p26(i):
    return i.ocr_lines.select("page", "table_id", "line_no", tb.heading(F.col("text")).alias("heading"))


@query("w03_gap_blocks", "ocr_lines", sql=f", k AS (SELECT *, lag(y2) OVER w AS py2, lag(x1) OVER w AS px1, lag(y2 - y1) OVER w AS ph FROM ocr_lines WINDOW w AS (PARTITION BY page ORDER BY y1, x1, line_no, table_id)), f AS (SELECT *, CASE WHEN py2 IS NULL OR y1 - py2 > greatest(85, floor(greatest(ph, y2 - y1) * 3.5)) OR (px1 - x1 > 220 AND y1 - py2 > 10) OR {HEAD} THEN 1 ELSE 0 END AS new FROM k) SELECT page, table_id, line_no, CAST(sum(new) OVER (PARTITION BY page ORDER BY y1, x1, line_no, table_id) AS BIGINT) AS block_no FROM f")
def w03(i):
    return tb.blocks(i.ocr_lines).select("page", "table_id", "line_no", "block_no")


@query("w05_header_segments", "ocr_lines", sql=CLUSTER + ", h AS (SELECT *, contains(text, 'GENERAL') AS hd FROM vr), s2 AS (SELECT *, sum(hd::INT) OVER (PARTITION BY table_id ORDER BY row_no) AS segment FROM h), w AS (SELECT *, coalesce(y1 - lag(y2) OVER (PARTITION BY table_id, segment ORDER BY row_no) > 180, false) AS wide FROM s2 WHERE segment > 0), z AS (SELECT *, max(wide::INT) OVER (PARTITION BY table_id, segment ORDER BY row_no) AS cut FROM w) SELECT page, table_id, row_no, CAST(segment AS BIGINT) AS segment FROM z WHERE cut = 0 AND NOT hd")
def w05(i):
    rows = tb.visual_rows(i.by_order.ocr_lines).withColumn("is_header", F.contains("text", F.lit("GENERAL")))
    return tb.data_rows(rows).select("page", "table_id", "row_no", "segment")


fixture("headers", "SELECT p_partkey AS header_no, CASE CAST(p_partkey % 12 AS INT) WHEN 0 THEN 'Tag No' WHEN 1 THEN 'Serial-Number' WHEN 2 THEN 'S/N' WHEN 3 THEN 'Model.' WHEN 4 THEN 'Report No' WHEN 5 THEN 'Equipment  Tag Number' WHEN 6 THEN 'Date' WHEN 7 THEN 'my serial' WHEN 8 THEN 'Loop number x' WHEN 9 THEN 'stage' WHEN 10 THEN p_brand ELSE p_name END AS header FROM part")


def _names(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


P16 = rf""", h AS (SELECT header_no, header, trim(regexp_replace(lower(header), '[^a-z0-9/]+', ' ', 'g')) AS h FROM headers),
sem AS (SELECT header_no, header, CASE WHEN list_contains({_names(tb.SERIAL_HEADERS)}, h) THEN 'serial' WHEN list_contains({_names(tb.TAG_HEADERS)}, h) THEN 'tag' WHEN list_contains({_names(tb.MODEL_HEADERS)}, h) THEN 'model' WHEN list_contains({_names(tb.EXCLUDED_HEADERS)}, h) THEN 'excluded' WHEN len(list_filter({_names(tb.SERIAL_HEADERS)}, lambda x: contains(h, x))) > 0 THEN 'serial' WHEN len(list_filter({_names(tb.TAG_HEADERS)}, lambda x: contains(h, x))) > 0 THEN 'tag' WHEN len(list_filter({_names(tb.MODEL_HEADERS)}, lambda x: contains(h, x))) > 0 THEN 'model' WHEN len(list_filter({_names(tb.EXCLUDED_HEADERS)}, lambda x: contains(h, x))) > 0 THEN 'excluded' ELSE '' END AS semantic FROM h) """


@query("p16_header_semantic", "headers", sql=P16 + "SELECT header_no, header, semantic FROM sem")
def p16(i):
    return i.headers.select("header_no", "header", tb.header_semantic(F.col("header")).alias("semantic"))


fixture("values_to_judge", "SELECT p_partkey AS value_no, CASE CAST(p_partkey % 8 AS INT) WHEN 0 THEN concat('12', CAST(p_partkey AS STRING), '-7') WHEN 1 THEN concat('AB', CAST(p_partkey AS STRING)) WHEN 2 THEN concat('x-', CAST(p_partkey AS STRING), '.b') WHEN 3 THEN CAST(p_partkey AS STRING) WHEN 4 THEN p_brand WHEN 5 THEN 'a' WHEN 6 THEN concat('pt ', CAST(p_partkey AS STRING), '/9') ELSE p_name END AS value FROM part")


@query("p17_plausible_value", "values_to_judge", sql=r", v AS (SELECT value_no, upper(regexp_replace(value, '\s+', '', 'g')) AS v FROM values_to_judge), k AS (SELECT *, regexp_matches(v, '[A-Z]') AND regexp_matches(v, '\d') AS m, length(v) BETWEEN 3 AND 48 AS n FROM v) SELECT value_no, n AND (regexp_matches(v, '^\d{2,8}([-_/]\d{1,8})+$') OR (m AND regexp_matches(v, '^[A-Z0-9]+([-_/][A-Z0-9]+)*$'))) AS tag, n AND m AND regexp_matches(v, '^[A-Z0-9]+([-_/.][A-Z0-9]+)+$') AS serial, n AND m AND regexp_matches(v, '^[A-Z0-9]+([-_/.][A-Z0-9]+)*$') AS model FROM k")
def p17(i):
    return i.values_to_judge.select("value_no", *[tb.plausible(F.col("value"), F.lit(k)).alias(k) for k in ("tag", "serial", "model")])


fixture("columns_x", "SELECT DISTINCT page, table_id, CAST(c.n AS INT) AS column_no, CAST(c.n * 130 + table_id % 5 AS DOUBLE) AS column_x, CAST(40 + table_id % 60 AS DOUBLE) AS column_width FROM ocr_lines CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) c", "ocr_lines")


@query("j17_nearest_column", "ocr_lines", "columns_x", sql=", j AS (SELECT l.page, l.table_id, l.line_no, c.column_no, abs((l.x1 + l.x2) / 2 - c.column_x) AS d, c.column_width AS cw FROM ocr_lines l JOIN columns_x c USING (page, table_id)) SELECT page, table_id, line_no, column_no, d AS distance FROM j WHERE d <= greatest(1.8::DOUBLE * cw, 120) QUALIFY row_number() OVER (PARTITION BY table_id, line_no ORDER BY d, column_no) = 1")
def j17(i):
    cells = i.ocr_lines.select("page", "table_id", "line_no", ((F.col("x1") + F.col("x2")) / 2).alias("cx"))
    return tb.nearest_column(cells, i.columns_x)


ANCHOR = """/*recursive*/, s AS (SELECT *, (x1 + x2) / 2 AS cx, row_number() OVER (PARTITION BY table_id ORDER BY (x1 + x2) / 2, line_no) AS rn FROM ocr_lines),
c AS (SELECT table_id, rn, cx AS last, [cx] AS anchors FROM s WHERE rn = 1 UNION ALL SELECT s.table_id, s.rn, CASE WHEN s.cx - c.last > 60 THEN s.cx ELSE c.last END, CASE WHEN s.cx - c.last > 60 THEN list_append(c.anchors, s.cx) ELSE c.anchors END FROM c JOIN s ON s.table_id = c.table_id AND s.rn = c.rn + 1),
an AS (SELECT table_id, arg_max(anchors, rn) AS anchors FROM c GROUP BY 1) """


def _anchors(i):
    cx = (F.col("x1") + F.col("x2")) / 2
    return i.ocr_lines.groupBy("table_id").agg(sq.anchor_clusters(F.array_sort(F.collect_list(cx)), F.lit(60.0)).alias("anchors"))


@query("g02_anchor_clusters", "ocr_lines", sql=ANCHOR + "SELECT table_id, len(anchors) AS n_anchors, list_sum(anchors) AS total FROM an")
def g02(i):
    return _anchors(i).select("table_id", F.size("anchors").cast("long").alias("n_anchors"), F.aggregate("anchors", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("j18_nearest_anchor", "ocr_lines", sql=ANCHOR + ", x AS (SELECT table_id, unnest(anchors) AS a, generate_subscripts(anchors, 1) - 1 AS i FROM an) SELECT s.table_id, s.line_no, CAST(x.i AS INT) AS column_index FROM s JOIN x USING (table_id) QUALIFY row_number() OVER (PARTITION BY s.table_id, s.line_no ORDER BY abs(x.a - s.cx), x.i) = 1")
def j18(i):
    j = i.ocr_lines.join(_anchors(i), "table_id")
    return j.select("table_id", "line_no", sq.nearest_index(F.col("anchors"), (F.col("x1") + F.col("x2")) / 2).alias("column_index"))


@query("a09_medians", "ocr_lines", sql=" SELECT table_id, median(y2 - y1) AS middle, list_sort(list(y2 - y1))[len(list(y2 - y1)) // 2 + 1] AS upper_middle FROM ocr_lines GROUP BY 1")
def a09(i):
    heights = i.ocr_lines.select("table_id", (F.col("y2") - F.col("y1")).alias("height"))
    return medians(heights, ["table_id"], "height").drop("n")


@query("a10_mode_first_seen", "ocr_lines", sql=", k AS (SELECT page, text, count(*) AS n, min(table_id * 100 + line_no) AS first FROM ocr_lines GROUP BY 1, 2) SELECT page, text, n FROM k QUALIFY row_number() OVER (PARTITION BY page ORDER BY n DESC, first) = 1")
def a10(i):
    return tb.modes(i.ocr_lines, ["page"], "text", F.col("table_id") * 100 + F.col("line_no"))


@query("a28_best_orientation", "ocr_lines", sql=", k AS (SELECT page, (line_no % 4) * 90 AS rotation, count(DISTINCT table_id) AS tables, CAST(round(sum(confidence) * 100) AS BIGINT) AS score FROM ocr_lines GROUP BY 1, 2) SELECT page, rotation, score FROM k QUALIFY row_number() OVER (PARTITION BY page ORDER BY score DESC, tables DESC, rotation) = 1")
def a28(i):
    k = i.ocr_lines.groupBy("page", ((F.col("line_no") % 4) * 90).alias("rotation")).agg(F.countDistinct("table_id").alias("tables"), F.round(F.sum("confidence") * 100).cast("long").alias("score"))
    return tb.best_orientation(k)


@query("a29_table_score", "ocr_lines", sql=" SELECT table_id, 10 * count(*) FILTER (contains(text, 'GENERAL')) + 2 * count(DISTINCT text) FILTER (contains(text, 'Row')) + least(5, floor(count(*) FILTER (confidence >= 0.8) / 100)) AS score FROM ocr_lines GROUP BY 1".replace("least(5, floor(count(*) FILTER (confidence >= 0.8) / 100))", "CAST(least(5, count(*) FILTER (confidence >= 0.8)) AS BIGINT)"))
def a29(i):
    has = lambda word: F.contains("text", F.lit(word))
    return i.ocr_lines.groupBy("table_id").agg(tb.table_score(has("GENERAL"), has("Row"), F.col("confidence") >= 0.8, F.col("text")).alias("score"))


# pages with none to five labelled lines
fixture("field_lines", "SELECT page, k AS line_no, CASE WHEN k < page % 6 THEN concat('Serial No: ', CAST(page AS STRING)) ELSE 'plain words' END AS text FROM (SELECT CAST(doc_id AS BIGINT) AS page FROM documents) d CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) n")


@query("p42_sparse_pages", "field_lines", sql=" SELECT page, count(*) AS n FROM field_lines WHERE contains(text, ':') GROUP BY 1 HAVING count(*) <= 2")
def p42(i):
    return tb.sparse_pages(i.field_lines)


@query("p49_region_expansion", "ocr_lines", sql=" SELECT table_id, line_no, CASE WHEN w >= 140 AND h <= 350 THEN greatest(0, y1 - greatest(40, floor(h * 0.3))) ELSE y1 END AS ny1, CASE WHEN w >= 140 AND h <= 350 THEN least(1000, y2 + 550) ELSE y2 END AS ny2 FROM (SELECT *, x2 - x1 AS w, y2 - y1 AS h FROM ocr_lines) q")
def p49(i):
    b = g.stretched(g.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), F.lit(200.0), F.lit(1000.0))
    return i.ocr_lines.select("table_id", "line_no", b["y1"].alias("ny1"), b["y2"].alias("ny2"))


@query("g17_box_transforms", "ocr_lines", sql=" SELECT table_id, line_no, CASE line_no % 4 WHEN 1 THEN y1 WHEN 2 THEN 1000 - x2 WHEN 3 THEN 1000 - y2 ELSE x1 END AS tx1, CASE line_no % 4 WHEN 1 THEN 2000 - x2 WHEN 2 THEN 2000 - y2 WHEN 3 THEN x1 ELSE y1 END AS ty1, greatest(0, x1 - 12) AS px1, least(1000, x2 + 12) AS px2 FROM ocr_lines")
def g17(i):
    b = g.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    turned = g.turned(b, (F.col("line_no") % 4) * 90, F.lit(1000.0), F.lit(2000.0))
    pad = g.padded(b, F.lit(12.0), F.lit(1000.0), F.lit(2000.0))
    return i.ocr_lines.select("table_id", "line_no", turned["x1"].alias("tx1"), turned["y1"].alias("ty1"), pad["x1"].alias("px1"), pad["x2"].alias("px2"))


@query("f15_box_text", "ocr_lines", sql=" SELECT table_id, line_no, x1, y1, x2, y2 FROM ocr_lines WHERE line_no % 3 <> 0")
def f15(i):
    s = F.concat(F.lit("["), F.concat_ws(", ", *[F.col(c).cast("string") for c in ("x1", "y1", "x2")]), F.when(F.col("line_no") % 3 == 0, "]").otherwise(F.concat(F.lit(", "), F.col("y2").cast("string"), F.lit("]"))))
    parsed = i.ocr_lines.select("table_id", "line_no", g.parse_box(s).alias("b"))
    return parsed.filter("b is not null").select("table_id", "line_no", "b.*")


@query("g21_polygon_box", "ocr_lines", sql=" SELECT table_id, line_no, x1 AS px1, y1 - 1 AS py1, x2 + 2 AS px2, y2 AS py2 FROM ocr_lines")
def g21(i):
    pts = F.array(F.array("x1", F.col("y1") - 1), F.array(F.col("x2") + 2, F.col("y1")), F.array("x2", "y2"), F.array("x1", "y2"))
    b = g.polygon_box(pts)
    return i.ocr_lines.select("table_id", "line_no", *[b[c].alias(f"p{c}") for c in ("x1", "y1", "x2", "y2")])


@query("g20_valid_boxes", "ocr_lines", sql=" SELECT page, table_id, line_no FROM ocr_lines WHERE x2 > x1 AND y2 > y1 AND trim(text) <> ''")
def g20(i):
    return tb.valid_lines(i.ocr_lines).select("page", "table_id", "line_no")


@query("g22_table_groups", "ocr_lines", sql=" SELECT page, table_id, count(*) AS n_lines, min(line_no) AS first_line FROM ocr_lines WHERE trim(text) <> '' GROUP BY 1, 2")
def g22(i):
    return tb.table_groups(i.ocr_lines)


fixture("key_lines", "SELECT page, line_no, table_id, CASE CAST(line_no % 7 AS INT) WHEN 0 THEN concat('Serial No: ', CAST(table_id AS STRING)) WHEN 1 THEN 'Model : MAH-77 ' WHEN 2 THEN 'ends with:' WHEN 3 THEN ': no label' WHEN 4 THEN 'CLIENT: ACME: Ltd' WHEN 5 THEN '99 x: y' ELSE text END AS text FROM ocr_lines", "ocr_lines")
KV = r""", k AS (SELECT *, trim(regexp_replace(regexp_extract(text, '^\s*([^:]{2,60}?)\s*:\s*(.+)$', 1), '\s+', ' ', 'g')) AS label, trim(regexp_replace(regexp_extract(text, '^\s*([^:]{2,60}?)\s*:\s*(.+)$', 2), '\s+', ' ', 'g')) AS value FROM key_lines),
kv AS (SELECT * FROM k WHERE regexp_matches(label, '^[A-Za-z][A-Za-z0-9 ./#&()''-]*$') AND len(string_split(label, ' ')) BETWEEN 1 AND 8 AND value <> '' AND NOT suffix(value, ':') AND regexp_matches(value, '[\p{L}\p{N}]')) """


@query("p25_key_value", "key_lines", sql=KV + "SELECT page, table_id, line_no, label, value FROM kv")
def p25(i):
    return i.key_lines.withColumn("kv", tb.key_value(F.col("text"))).filter("kv is not null").select("page", "table_id", "line_no", "kv.*")


@query("f27_split_label", "key_lines", sql=KV + "SELECT trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS label, count(*) AS n FROM kv GROUP BY 1")
def f27(i):
    k = i.key_lines.withColumn("kv", tb.key_value(F.col("text"))).filter("kv is not null")
    return k.groupBy(t.norm_label("kv.label").alias("label")).agg(F.count("*").alias("n"))


@query("f28_after_label", "key_lines", sql=r" SELECT table_id, line_no, trim(regexp_replace(regexp_extract(text, '(?i)\bCLIENT\s*[:#]\s*(.+)$', 1), '\s+', ' ', 'g')) AS client FROM key_lines")
def f28(i):
    return i.key_lines.select("table_id", "line_no", t.after_label("text", "CLIENT").alias("client"))


CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10) || ':;,.()[]{}')"
fixture("phrases", "SELECT table_id, line_no, CASE CAST(line_no % 9 AS INT) WHEN 0 THEN ' (Tag #) ' WHEN 1 THEN 'for manufacturer' WHEN 2 THEN 'JOB NO.' WHEN 3 THEN 'ab' WHEN 4 THEN concat('r - review, ', text) WHEN 5 THEN 'see API 6A' WHEN 6 THEN 'act:# 12 x' WHEN 7 THEN '1 2 3 4 5' ELSE concat(text, ' of the open ', repeat('w', line_no)) END AS text FROM ocr_lines", "ocr_lines")


@query("p39_noise_values", "phrases", sql=f" SELECT table_id, line_no, NOT (upper({CLEAN}) IN ({', '.join(repr(x) for x in tb.NOISE_VALUES)})) AND length({CLEAN}) BETWEEN 3 AND 100 AND len(regexp_extract_all(upper({CLEAN}), '[A-Z]{{2,}}')) >= 1 AS valid, NOT (upper({CLEAN}) IN ({', '.join(repr(x) for x in tb.NOISE_VALUES)})) AND length({CLEAN}) BETWEEN 3 AND 100 AND len(regexp_extract_all(upper({CLEAN}), '[A-Z]{{2,}}')) >= 2 AS two_words FROM phrases")
def p39(i):
    return i.phrases.select("table_id", "line_no", tb.valid_phrase(F.col("text")).alias("valid"), tb.valid_phrase(F.col("text"), 2).alias("two_words"))


@query("p40_related_markers", "phrases", sql=f" SELECT table_id, line_no FROM phrases WHERE regexp_matches(upper({CLEAN}), 'INSPECTION|ACT:#|ACTIVITY|STANDARD|H - HOLD|R - REVIEW|W - WITNESS|M - MONITOR|CERTIFICATE|ASME|API |NACE|EN ')")
def p40(i):
    return i.phrases.filter(tb.related_record(F.col("text"))).select("table_id", "line_no")


@query("f06_line_fields", "key_lines", sql=r", f AS (SELECT table_id, line_no, regexp_extract(upper(text), 'SERIAL NO: *(\S+)', 1) AS serial, regexp_extract(upper(text), 'MODEL *: *(\S+)', 1) AS model, regexp_extract(upper(text), 'CLIENT: *(.+)$', 1) AS client FROM key_lines) SELECT table_id, line_no, field_name, value FROM (UNPIVOT f ON serial, model, client INTO NAME field_name VALUE value) q WHERE value <> ''")
def f06(i):
    return tb.line_fields(i.key_lines, ["table_id", "line_no"])
