"""Queries on pages: profile, classes, selection, comparison."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t
from ..operators import pages as pg
from .registry import fixture, query

# fixed values, written out again for the SQL, so that it does not depend on the lists of the operators
SQL_CERTIFICATE = "FINAL TEST CERTIFICATE|DECLARATION OF CONFORMITY|CALIBRATION CERTIFICATE|TEST CERTIFICATE|INSPECTION CERTIFICATE|CERTIFICATE OF CONFORMITY|CERTIFICATE|DECLARATION"
SQL_EQUIPMENT_CONTEXT = "EQUIPMENT|INSTRUMENTS?|VALVE|ACTUATOR|TRANSMITTER|CONTROLLER|SWITCH|GAUGE|DETECTOR|SENSOR|METER|ANALYSER|ANALYZER|SOLENOID|CONTROL VALVE|PRESSURE|TEMPERATURE|FLOW|LEVEL|PROCESS CONNECTION|SET ?POINT|PROOF PRESSURE|RANGE|MANUFACTURER|MODEL|TYPE|SERIAL"
SQL_EQUIPMENT_TERMS = ("EQUIPMENT", "VESSEL", "RECEIVER", "PUMP", "COMPRESSOR", "MOTOR", "TANK", "FILTER", "SEPARATOR", "EXCHANGER", "HEATER", "COOLER", "VALVE", "SKID", "PACKAGE", "BLOWER", "FAN", "GENERATOR", "TURBINE", "INSTRUMENT", "AIR",)
SQL_EXPLICIT_LABEL = r"\b(EQUIPMENT|VESSEL|PUMP|COMPRESSOR|MOTOR|SKID|PACKAGE)\s+(TAG|NO\.?|NUMBER)\b|\bTAG\s*(NO\.?|NUMBER|#)?\s*[:#]|\bEQUIPMENT\s*:"
SQL_ISA_FUNCTIONS = "XV|HV|MOV|SDV|ESDV|BDV|PSV|PCV|FCV|LCV|TCV|PT|PI|PIC|PIT|PC|PS|PSH|PSHH|PSL|PSLL|TT|TI|TIC|TIT|TC|TS|TSH|TSHH|TSL|TSLL|FT|FI|FIC|FIT|FC|FS|FSH|FSHH|FSL|FSLL|LT|LI|LIC|LIT|LC|LS|LSH|LSHH|LSL|LSLL|AT|AI|AIC|AIT|AC|AS|ZT|ZI|ZIC|ZIT|ZC|ZS|YT|YI|YIC|YIT|YC|YS|TE|FE|PE|LE|AE|VE|WE"
SQL_RELEVANT_CLASSES = ("certificate", "material_traceability", "inspection_plan", "inspection_report", "spare_parts", "calibration", "pressure_test", "ndt", "equipment_metadata",)
SQL_RELEVANT_ROUTES = ("table_extraction", "ocr_key_value",)
SQL_SERIAL_FIELD = "SERIAL|SERIAL NO|SERIAL NUMBER|S/N|SNO"
SQL_TABLE_CONTEXT = "TABLE|EQUIPMENT LIST|INSTRUMENT DATA|DATA SHEET|DOCUMENT REGISTER|DOCUMENT NUMBER|DRAWING|SPARE PARTS?|PART NUMBER|QUANTITY|DESCRIPTION|MODEL|RANGE|SET ?POINT|TERMINAL|WIRING|SCHEMATIC|PNEUMATIC|HYDRAULIC|PACKING|STORAGE"
SQL_TAG_FIELD = "TAG|INSTRUMENT TAG|EQUIPMENT TAG|LOOP TAG|ITEM TAG|TAG NO"
SQL_TITLE_BLOCK_TERMS = ("SCALE", "SHEET", "DRAWN", "CHECKED", "APPROVED", "APPD", "DWN", "REVISION", "DOCUMENT NUMBER", "PURCHASER", "CLIENT REP",)

fixture("page_text", "SELECT source AS document_id, CAST(doc_id AS BIGINT) AS page, text, CAST(doc_id % 5 AS INT) AS images FROM documents WHERE text IS NOT NULL")
TAXONOMY = [
    ("index", "high", "native_text_plus_visual_check", ["License, Version", "contents"]),
    ("certificate", "high", "table_extraction", ["Licensed under", "version 3", "que la"]),
    ("calibration", "high", "ocr_key_value", ["in th", "die", "rights reserved"]),
    ("drawing", "medium", "drawing_review", ["la de", "of the"]),
    ("manual", "low", "native_text", ["the", "la", "der"]),
]


def _profile_sql() -> str:
    return r""", prof AS (SELECT document_id, page, CAST(length(trim(text)) AS BIGINT) AS text_characters, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS BIGINT) AS word_count,
CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) / length(text) ELSE 0.0 END AS alnum_ratio, CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / length(text) ELSE 0.0 END AS upper_ratio,
left(trim(regexp_replace(text, '\s+', ' ', 'g')), 60) AS preview, images FROM page_text),
routed AS (SELECT *, CASE WHEN text_characters < 80 OR word_count < 15 OR alnum_ratio < 0.25 THEN 'render_ocr' WHEN images >= 1 THEN 'native_text_plus_visual_check' ELSE 'native_text' END AS recommended_route FROM prof) """


def _class_sql() -> str:
    rows = ", ".join(f"('{c}', {n}, '{p}', '{r}', '{k}')" for n, (c, p, r, ks) in enumerate(TAXONOMY) for k in ks)
    return f""", tax(cls, class_order, priority, route, keyword) AS (VALUES {rows}),
hit AS (SELECT p.document_id, p.page, t.*, len(string_split(t.keyword, ' ')) AS w FROM page_text p JOIN tax t ON contains(lower(p.text), lower(t.keyword))),
c AS (SELECT document_id, page, cls, class_order, priority, route, max(w) AS mw, sum(w) AS sw FROM hit GROUP BY ALL),
s AS (SELECT *, CAST(100 * mw + 10 * sw + 2 * (CASE priority WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS INT) AS score, (cls = 'index' AND mw >= 2) AS wins, CASE priority WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS pr, CASE route WHEN 'native_text' THEN 1 WHEN 'native_text_plus_visual_check' THEN 2 WHEN 'drawing_review' THEN 3 WHEN 'ocr_key_value' THEN 4 WHEN 'table_extraction' THEN 5 ELSE 0 END AS rr FROM c),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY document_id, page ORDER BY wins DESC, score DESC, pr DESC, rr DESC, class_order) = 1),
m AS (SELECT document_id, page, string_agg(DISTINCT class_order || ':' || cls, ' | ' ORDER BY class_order || ':' || cls) AS mc FROM hit GROUP BY 1, 2),
classes AS (SELECT p.document_id, p.page, coalesce(b.cls, '') AS page_class, coalesce(b.priority, 'low') AS priority, coalesce(b.route, 'manual_review') AS route, coalesce(b.score, 0) AS score, coalesce(regexp_replace(m.mc, '[0-9]:', '', 'g'), '') AS matched_classes FROM page_text p LEFT JOIN best b USING (document_id, page) LEFT JOIN m USING (document_id, page)) """


def _classes(i):
    return pg.classified(i.page_text, TAXONOMY)


@query("p01_page_route", "page_text", sql=_profile_sql() + "SELECT document_id, page, text_characters, word_count, recommended_route FROM routed")
def p01(i):
    return pg.profile(i.page_text).select("document_id", "page", "text_characters", "word_count", "recommended_route")


@query("f16_character_ratios", "page_text", sql=_profile_sql() + "SELECT page, alnum_ratio, upper_ratio FROM routed")
def f16(i):
    return pg.profile(i.page_text).select("page", "alnum_ratio", "upper_ratio")


@query("f17_counts_previews", "page_text", sql=_profile_sql() + "SELECT page, text_characters, word_count, preview FROM routed")
def f17(i):
    return pg.profile(i.page_text).select("page", "text_characters", "word_count", "preview")


@query("o10_truncation", "page_text", sql=r" SELECT page, left(text, 40) AS head, array_to_string(list_slice(regexp_split_to_array(trim(text), '\s+'), 1, 3), ' ') AS first_words FROM page_text")
def o10(i):
    return i.page_text.select("page", pg.preview(F.col("text")).alias("head"), pg.first_words(F.col("text")).alias("first_words"))


@query("p02_route_lists", "page_text", sql=_profile_sql() + "SELECT recommended_route, string_agg(CAST(page AS STRING), ',' ORDER BY page) AS pages FROM routed GROUP BY 1")
def p02(i):
    g = pg.profile(i.page_text).groupBy("recommended_route").agg(F.sort_array(F.collect_list("page")).alias("p"))
    return g.select("recommended_route", F.array_join("p", ",").alias("pages"))


@query("a30_page_class", "page_text", sql=_class_sql() + "SELECT document_id, page, page_class, priority, route, score FROM classes")
def a30(i):
    return _classes(i).select("document_id", "page", "page_class", "priority", "route", "score")


@query("j29_keyword_containment", "page_text", sql=_class_sql() + "SELECT page, matched_classes FROM classes")
def j29(i):
    return _classes(i).select("page", "matched_classes")


@query("a01_count_by_key", "page_text", sql=_class_sql() + "SELECT page_class, route, count(*) AS n FROM classes GROUP BY 1, 2")
def a01(i):
    return _classes(i).groupBy("page_class", "route").agg(F.count("*").alias("n"))


@query("a02_multi_label_count", "page_text", sql=_class_sql() + "SELECT cls AS page_class, count(DISTINCT row(document_id, page)) AS n FROM hit GROUP BY 1")
def a02(i):
    return pg.class_hits(i.page_text, TAXONOMY).select(F.explode("hits").alias("h")).groupBy(F.col("h.cls").alias("page_class")).agg(F.count("*").alias("n"))


@query("p03_intake_relevance", "page_text", sql=_class_sql() + f"SELECT page, priority = 'high' AND page_class IN {SQL_RELEVANT_CLASSES} AND route IN {SQL_RELEVANT_ROUTES} AS relevant FROM classes")
def p03(i):
    return _classes(i).select("page", pg.relevant(F.col("priority"), F.col("page_class"), F.col("route")).alias("relevant"))


@query("o01_queue_order", "page_text", sql=_class_sql() + "SELECT document_id, page, row_number() OVER (PARTITION BY document_id ORDER BY CASE priority WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC, CASE route WHEN 'native_text' THEN 1 WHEN 'native_text_plus_visual_check' THEN 2 WHEN 'drawing_review' THEN 3 WHEN 'ocr_key_value' THEN 4 WHEN 'table_extraction' THEN 5 ELSE 0 END DESC, score DESC, page) AS position FROM classes")
def o01(i):
    w = Window.partitionBy("document_id").orderBy(*pg.queue_order(F.col("priority"), F.col("route"), F.col("score"), F.col("page")))
    return _classes(i).select("document_id", "page", F.row_number().over(w).alias("position"))


fixture("selected_pages", "SELECT CAST(doc_id AS BIGINT) AS page FROM documents WHERE doc_id % 3 = 0 UNION SELECT CAST(doc_id + 100000000 AS BIGINT) FROM documents WHERE doc_id % 50 = 0")
fixture("review_pages", "SELECT CAST(doc_id AS BIGINT) AS page FROM documents WHERE doc_id % 4 = 0 OR doc_id % 7 = 0")
COMPARE = (
    _class_sql()
    + _profile_sql()
    + f""", j AS (SELECT page, coalesce(page_class, '') AS page_class, coalesce(priority, '') AS priority, coalesce(route, '') AS route, coalesce(recommended_route, '') AS recommended_route, coalesce(images, 0) AS images, coalesce(sel, false) AS selected, coalesce(rev, false) AS in_review
FROM (SELECT page, page_class, priority, route FROM classes) c FULL JOIN (SELECT page, recommended_route, images FROM routed) p USING (page) FULL JOIN (SELECT page, true AS sel FROM selected_pages) s USING (page) FULL JOIN (SELECT page, true AS rev FROM review_pages) r USING (page)),
k AS (SELECT *, priority = 'high' AND page_class IN {SQL_RELEVANT_CLASSES} AND route IN {SQL_RELEVANT_ROUTES} AS intake_relevant FROM j),
f AS (SELECT *, CASE WHEN selected AND intake_relevant THEN 'tag_selected_intake_agrees' WHEN selected THEN 'tag_selected_intake_disagrees' WHEN intake_relevant THEN 'intake_relevant_not_tag_selected' WHEN in_review THEN 'weak_tag_evidence' WHEN page_class = '' THEN 'unknown_or_low_evidence' ELSE 'not_selected_not_intake_relevant' END AS flag FROM k),
cmp AS (SELECT *, CASE WHEN flag = 'intake_relevant_not_tag_selected' THEN 'high' WHEN flag = 'weak_tag_evidence' THEN 'medium' WHEN flag = 'tag_selected_intake_disagrees' AND (recommended_route = 'render_ocr' OR images >= 3) THEN 'medium' WHEN priority = 'high' THEN 'medium' ELSE 'low' END AS review_priority FROM f) """
)


def _compared(i):
    return pg.compared(_classes(i), pg.profile(i.page_text), i.selected_pages, i.review_pages)


@query("j01_page_union", "page_text", "selected_pages", "review_pages", sql=COMPARE + "SELECT page, page_class, priority, route, recommended_route, images, selected, in_review, intake_relevant FROM cmp")
def j01(i):
    return _compared(i).select("page", "page_class", "priority", "route", "recommended_route", "images", "selected", "in_review", "intake_relevant")


@query("p04_comparison_flag", "page_text", "selected_pages", "review_pages", sql=COMPARE + "SELECT page, flag FROM cmp")
def p04(i):
    return _compared(i).select("page", "flag")


@query("p05_intake_priority", "page_text", "selected_pages", "review_pages", sql=COMPARE + "SELECT page, flag, review_priority FROM cmp")
def p05(i):
    return _compared(i).select("page", "flag", "review_priority")


@query("p06_supplemental_pages", "page_text", "selected_pages", sql=_class_sql() + f"SELECT page, page_class, score FROM classes WHERE priority = 'high' AND page_class IN {SQL_RELEVANT_CLASSES} AND route IN {SQL_RELEVANT_ROUTES} AND score >= 100 AND page NOT IN (SELECT page FROM selected_pages)")
def p06(i):
    c = _classes(i).filter(pg.relevant(F.col("priority"), F.col("page_class"), F.col("route")) & (F.col("score") >= 100))
    return c.join(i.selected_pages, "page", "left_anti").select("page", "page_class", "score")


@query("j02_anti_pages", "page_text", "selected_pages", "review_pages", sql=" SELECT page FROM selected_pages WHERE page NOT IN (SELECT page FROM review_pages)")
def j02(i):
    return i.selected_pages.join(i.review_pages, "page", "left_anti")


@query("j03_page_sets", "page_text", "selected_pages", "review_pages", sql=", u AS (SELECT page FROM page_text UNION ALL SELECT page FROM selected_pages UNION ALL SELECT page FROM review_pages) SELECT page, count(*) AS n_frames FROM u GROUP BY 1 HAVING count(*) < 3")
def j03(i):
    return pg.page_sets_equal(i.page_text, i.selected_pages, i.review_pages)


@query("u01_set_union", "selected_pages", "review_pages", sql=" SELECT page FROM selected_pages UNION SELECT page FROM review_pages")
def u01(i):
    return i.selected_pages.union(i.review_pages).distinct()


@query("u03_set_equality", "selected_pages", "review_pages", sql=" SELECT (SELECT count(*) FROM (SELECT page FROM selected_pages EXCEPT SELECT page FROM review_pages) q) AS only_left, (SELECT count(*) FROM (SELECT page FROM review_pages EXCEPT SELECT page FROM selected_pages) q) AS only_right")
def u03(i):
    a, b = i.selected_pages.select("page"), i.review_pages.select("page")
    left = a.exceptAll(b).agg(F.count("*").alias("only_left"))
    return left.join(b.exceptAll(a).agg(F.count("*").alias("only_right")), F.lit(True))


# each page in four rotations; every kind of tag, field and reference stands at some places, next to others or far from them
fixture("rotations", """SELECT page, r.rotation, CASE
WHEN page % 8 = 0 THEN concat('TAG NO: PT-', CAST(page % 900 + 100 AS STRING), ' TT-', CAST(page % 90 + 10 AS STRING), 'AB ZS-1 ', text)
WHEN page % 8 = 1 AND r.rotation = 90 THEN concat('Serial no 4411-', CAST(page % 90 + 10 AS STRING), '-7 certificate of conformity ', text)
WHEN page % 8 = 2 AND r.rotation = 0 THEN concat(left(text, 50), ' instrument valve PSV 4', CAST(page % 50 + 10 AS STRING), ' ', substring(text, 51))
WHEN page % 8 = 3 THEN concat('equipment tag table certificate spare parts set point wiring ', text)
WHEN page % 8 = 4 THEN concat('FS5 ', text, ' 100PT2', CAST(page % 9 AS STRING), ' 200 FT 300 LT 400 | ZT — 12345')
WHEN page % 8 = 5 AND r.rotation >= 180 THEN concat(text, ' item tag 4321 QQQ 55 and 4321QQQ55 123/45 S/N')
WHEN page % 8 = 6 THEN concat('LT_7 ', substring(text, 1, 100), ' PIT 77 level ', substring(text, 101))
WHEN page % 9 = 3 THEN concat('drawing 7777-1 ', text) ELSE text END AS text
FROM (SELECT page, text FROM page_text) p CROSS JOIN (SELECT 0 AS rotation UNION ALL SELECT 90 UNION ALL SELECT 180 UNION ALL SELECT 270) r""", "page_text")


def _scan_sql() -> str:
    """The twin's engine has no look-around: runs of characters are marked instead, and patterns take the marks in."""
    gap = r"(?:⟩\s*⟨)?"
    tags = {
        "compact_instrument_tag": rf"⟨\d{{3,8}}{gap}(?:{SQL_ISA_FUNCTIONS}){gap}\d{{1,8}}(?:[A-Z]{{1,4}})?⟩",
        "isa_instrument_tag": rf"⟨(?:{SQL_ISA_FUNCTIONS})(?:⟩\s*-?\s*⟨)?\d{{1,8}}(?:[A-Z]{{1,4}})?⟩",
        "broad": rf"⟨\d{{3,8}}{gap}[A-Z]{{2,8}}{gap}\d{{2,8}}(?:[A-Z]{{1,4}})?⟩",
    }
    has = lambda c, words: rf"regexp_matches({c}, '(^|[^\p{{L}}\p{{N}}_])({words})([^\p{{L}}\p{{N}}_]|$)')"
    table = SQL_TABLE_CONTEXT.replace(" ?", r"(?:⟩\s*⟨)?").replace(" ", r"⟩\s+⟨")
    hits = " UNION ALL ".join(f"SELECT page, rotation, s, '{k}' AS kind, {n} AS nth, regexp_extract_all(a, '{p}') AS hits, string_split_regex(a, '{p}') AS gaps FROM n" for n, (k, p) in enumerate(tags.items()))
    return rf""", n0 AS (SELECT page, rotation, trim(regexp_replace(translate(upper(replace(text, 'ß', 'ss')), '–—|_', '--  '), '[\s\p{{Z}}\x0b\x1c-\x1f\x85]+', ' ', 'g')) AS s FROM rotations),
n AS (SELECT page, rotation, s, regexp_replace(s, '([A-Z0-9]+)', '⟨\1⟩', 'g') AS a, regexp_replace(s, '(\d+)', '⟨\1⟩', 'g') AS digits, regexp_replace(s, '([\p{{L}}\p{{N}}_]+)', '⟨\1⟩', 'g') AS w FROM n0),
h0 AS ({hits}),
h1 AS (SELECT page, rotation, s, kind, nth, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM h0 WHERE len(hits) > 0),
h2 AS (SELECT page, rotation, s, kind, nth, i, translate(hit, '⟨⟩', '') AS hit, length(translate(hit, '⟨⟩', '')) AS size, sum(length(translate(gap, '⟨⟩', '')) + length(translate(hit, '⟨⟩', ''))) OVER (PARTITION BY page, rotation, nth ORDER BY i) AS stop FROM h1),
h3 AS (SELECT *, regexp_replace(hit, '\s+', '', 'g') AS tag, substring(s, CAST(greatest(stop - size - 220, 0) + 1 AS BIGINT), CAST(stop - greatest(stop - size - 220, 0) + 220 AS BIGINT)) AS near FROM h2),
h4 AS (SELECT *, {has("near", SQL_TAG_FIELD)} AS near_tag, {has("near", SQL_EQUIPMENT_CONTEXT)} AS near_equipment FROM h3),
hit AS (SELECT page, rotation, kind, nth, i, tag, near_tag, near_equipment, kind = 'compact_instrument_tag' OR CASE WHEN length(tag) > 5 THEN contains(hit, '-') OR length(tag) >= 7 OR near_tag OR near_equipment ELSE near_tag OR near_equipment END AS accepted FROM h4 WHERE kind <> 'broad'),
sure AS (SELECT page, rotation, list_distinct(list(tag)) AS sure, CAST(5 * count(DISTINCT tag) + sum(5 * near_tag::INT + 2 * near_equipment::INT) AS INT) AS points, bool_or(near_tag OR near_equipment) AS near, bool_or(near_equipment) AS near_equipment FROM hit WHERE accepted GROUP BY 1, 2),
brd AS (SELECT h4.page, h4.rotation, tag, min(i) AS i FROM h4 LEFT JOIN sure USING (page, rotation) WHERE kind = 'broad' AND near_tag AND NOT list_contains(coalesce(sure, []), tag) GROUP BY 1, 2, 3),
brds AS (SELECT page, rotation, list(tag) AS broad FROM brd GROUP BY 1, 2),
ser AS (SELECT page, rotation, ref, min(i) AS i FROM (SELECT page, rotation, unnest(x) AS ref, generate_subscripts(x, 1) AS i FROM (SELECT page, rotation, list_transform(regexp_extract_all(digits, '⟨\d{{3,8}}⟩\s*[-/]\s*⟨\d{{1,8}}⟩'), lambda r: regexp_replace(translate(r, '⟨⟩', ''), '\s+', '', 'g')) AS x FROM n) q) q GROUP BY 1, 2, 3),
sers AS (SELECT page, rotation, list_sort(list(ref)) AS serials FROM ser GROUP BY 1, 2),
f AS (SELECT page, rotation, s, {has("s", SQL_TAG_FIELD)} AS tag_field, {has("s", SQL_SERIAL_FIELD)} AS serial_field, {has("s", SQL_CERTIFICATE)} AS certificate, {has("s", SQL_EQUIPMENT_CONTEXT)} AS equipment, len(list_distinct(regexp_extract_all(w, '⟨(?:{table})⟩'))) AS terms FROM n),
ev AS (SELECT f.*, coalesce(near, false) AS near, coalesce(near_equipment, false) AS near_equipment, list_sort(list_concat(coalesce(sure, []), coalesce(broad, []))) AS tags, coalesce(serials, []) AS serials,
CAST(coalesce(points, 0) + 3 * len(coalesce(broad, [])) AS INT) AS equipment_score, CAST(len(coalesce(serials, [])) AS INT) AS serial_score,
CAST(3 * tag_field::INT + 2 * serial_field::INT + 3 * (tag_field AND serial_field)::INT + 3 * certificate::INT + equipment::INT + (terms > 0)::INT + 2 * (terms >= 3)::INT AS INT) AS review_score
FROM f LEFT JOIN sure USING (page, rotation) LEFT JOIN brds USING (page, rotation) LEFT JOIN sers USING (page, rotation)),
why AS (SELECT page, rotation, nth AS part, i, 1 AS sub, CASE WHEN accepted THEN kind || ':' || tag ELSE 'short_tag_rejected_without_context:' || tag END AS reason FROM hit
UNION ALL SELECT page, rotation, nth, i, 2, 'tag_field_near:' || tag FROM hit WHERE accepted AND near_tag UNION ALL SELECT page, rotation, nth, i, 3, 'equipment_context_near:' || tag FROM hit WHERE accepted AND near_equipment
UNION ALL SELECT page, rotation, 2, i, 0, 'broad_candidate_in_tag_context:' || tag FROM brd UNION ALL SELECT page, rotation, 3, i, 0, 'serial_or_reference:' || ref FROM ser
UNION ALL SELECT page, rotation, 4, 1, 0, 'tag_field_present' FROM f WHERE tag_field UNION ALL SELECT page, rotation, 4, 2, 0, 'serial_field_present' FROM f WHERE serial_field UNION ALL SELECT page, rotation, 4, 3, 0, 'serial_and_tag_fields_present' FROM f WHERE serial_field AND tag_field
UNION ALL SELECT page, rotation, 4, 4, 0, 'certificate_or_declaration_present' FROM f WHERE certificate UNION ALL SELECT page, rotation, 4, 5, 0, 'equipment_context_present' FROM f WHERE equipment
UNION ALL SELECT page, rotation, 4, 6, 0, 'table_or_document_context_present' FROM f WHERE terms > 0 UNION ALL SELECT page, rotation, 4, 7, 0, 'table_context_terms:' || terms FROM f WHERE terms >= 3),
reasons AS (SELECT page, string_agg(rotation || 'deg:' || reason, ' | ' ORDER BY rotation, place) AS reasons FROM (SELECT page, rotation, reason, min(100000 * part + 10 * i + sub) AS place FROM why GROUP BY 1, 2, 3) q GROUP BY 1),
m AS (SELECT page, max(equipment_score) AS equipment_score, max(review_score) AS review_score, max(serial_score) AS serial_score, list_sort(list_distinct(flatten(list(tags)))) AS tags, list_sort(list_distinct(flatten(list(serials)))) AS serials,
coalesce(string_agg(CAST(rotation AS STRING), ',' ORDER BY rotation) FILTER (near), '') AS strong_rotations, coalesce(string_agg(CAST(rotation AS STRING), ',' ORDER BY rotation) FILTER (review_score >= 5), '') AS review_rotations,
bool_or(near) AS near, bool_or(tag_field AND (equipment OR certificate)) AS field, bool_or(equipment OR near_equipment) AS equipment, bool_or(terms > 0) AS tbl FROM ev GROUP BY 1),
d AS (SELECT page, equipment_score, review_score, serial_score, array_to_string(tags, ',') AS tags, array_to_string(serials, ',') AS serials, strong_rotations, review_rotations, coalesce(reasons, '') AS reasons, near OR (field AND equipment) AS selected,
CASE WHEN near THEN 'tag_detected_with_context' WHEN field AND equipment THEN 'tag_field_with_equipment_context' WHEN len(tags) > 0 THEN 'tag_like_text_without_supporting_context' WHEN len(serials) > 0 THEN 'serial_or_document_reference_only' WHEN tbl THEN 'document_or_table_context_only' ELSE 'no_tag_evidence' END AS decision FROM m LEFT JOIN reasons USING (page)) """


SCAN = _scan_sql()


@query("a03_rotation_merge", "rotations", sql=SCAN + "SELECT page, equipment_score, review_score, serial_score, tags, serials, strong_rotations, review_rotations, reasons FROM d")
def a03(i):
    return pg.merged_rotations(pg.tag_evidence(i.rotations)).drop("decision", "selected")


@query("p44_selection_decision", "rotations", sql=SCAN + "SELECT page, decision, selected FROM d")
def p44(i):
    return pg.merged_rotations(pg.tag_evidence(i.rotations)).select("page", "decision", "selected")


@query("p45_tag_acceptance", "rotations", sql=SCAN + "SELECT page, rotation, kind, CAST(row_number() OVER (PARTITION BY page, rotation ORDER BY nth, i) - 1 AS INT) AS nth, tag, accepted FROM hit")
def p45(i):
    found = i.rotations.select("page", "rotation", F.posexplode(t.bind(t.scan_text("text"), pg.tag_matches)).alias("nth", "m"))
    return found.select("page", "rotation", "m.kind", "nth", "m.tag", "m.accepted")


@query("f04_regex_scan", "rotations", sql=SCAN + "SELECT page, rotation, array_to_string(tags, ',') AS tags, array_to_string(serials, ',') AS serials, equipment_score, review_score FROM ev")
def f04(i):
    return pg.tag_evidence(i.rotations).select("page", "rotation", F.array_join("tags", ",").alias("tags"), F.array_join("serials", ",").alias("serials"), "equipment_score", "review_score")


@query("f03_scan_text", "rotations", sql=SCAN + "SELECT page, rotation, s AS scan_text FROM n")
def f03(i):
    return i.rotations.select("page", "rotation", t.scan_text("text").alias("scan_text"))


@query("j24_text_proximity", "rotations", sql=SCAN + "SELECT page, rotation, CAST(i - 1 AS INT) AS nth, hit AS value, near_tag, near_equipment FROM h4 WHERE kind = 'isa_instrument_tag'")
def j24(i):
    contexts = {"near_tag": t.worded(pg.TAG_FIELD), "near_equipment": t.worded(pg.EQUIPMENT_CONTEXT)}
    found = t.bind(t.scan_text("text"), lambda s: t.near_matches(s, pg.ISA_TAG, contexts, headed=True))
    return i.rotations.select("page", "rotation", F.posexplode(found).alias("nth", "m")).select("page", "rotation", "nth", "m.*")


fixture("table_text", "SELECT page, concat(text, chr(10), 'name | qty | code', chr(10), 'a | ', CAST(page AS STRING), ' | b', CASE WHEN page % 3 = 0 THEN concat(chr(10), 'c | d | e') ELSE '' END, chr(10), 'plain', chr(10), CASE WHEN page % 2 = 0 THEN concat('x  y', chr(10), 'u  v  w', chr(10), chr(10), 'lonely | row') ELSE concat('p', chr(9), 'q') END) AS text FROM page_text WHERE position('|' IN text) = 0", "page_text")
TABLES_SQL = r""", l AS (SELECT page, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM table_text),
k AS (SELECT *, CASE WHEN trim(line) = '' THEN false WHEN contains(trim(line), '|') THEN len(list_filter(string_split(trim(line), '|'), lambda x: trim(x) <> '')) >= 2 WHEN contains(trim(line), chr(9)) THEN len(list_filter(string_split(trim(line), chr(9)), lambda x: trim(x) <> '')) >= 2 ELSE regexp_matches(trim(line), '\s{2,}') END AS ok FROM l),
r AS (SELECT page, line_no, line, line_no - row_number() OVER (PARTITION BY page ORDER BY line_no) AS island FROM k WHERE ok),
tb AS (SELECT page, CAST(min(line_no) AS INT) AS first_line, count(*) AS n_lines, arg_min(trim(line), line_no) AS header FROM r GROUP BY page, island HAVING count(*) >= 2) """


@query("s22_text_tables", "table_text", sql=TABLES_SQL + "SELECT page, first_line, n_lines, header FROM tb")
def s22(i):
    return pg.text_tables(i.table_text)


@query("w06_islands", "table_text", sql=TABLES_SQL + "SELECT page, count(*) AS n_tables, CAST(sum(n_lines) AS BIGINT) AS n_lines FROM tb GROUP BY 1")
def w06(i):
    return pg.text_tables(i.table_text).groupBy("page").agg(F.count("*").alias("n_tables"), F.sum("n_lines").alias("n_lines"))


@query("p41_table_line", "table_text", sql=TABLES_SQL + "SELECT page, CAST(line_no AS INT) AS line_no, ok AS table_like FROM k")
def p41(i):
    lines = i.table_text.select("page", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("page", "line_no", pg.table_like(F.col("line")).alias("table_like"))


@query("k04_page_list", "selected_pages", sql=" SELECT printf('%03d', page) AS value FROM selected_pages")
def k04(i):
    return i.selected_pages.select(F.format_string("%03d", "page").alias("value"))


@query("s14_pages_list", sql=r", l(line) AS (SELECT CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN concat('# ', CAST(o_orderkey AS STRING)) WHEN 1 THEN concat(' ', CAST(o_orderkey % 500 AS STRING), ' ') WHEN 2 THEN '' ELSE concat('0', CAST(o_orderkey % 300 AS STRING)) END FROM orders) SELECT DISTINCT CAST(trim(line) AS INT) AS page FROM l WHERE regexp_matches(trim(line), '^\d+$') AND CAST(trim(line) AS INT) >= 1")
def s14(i):
    from ..sources.readers import page_numbers

    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    line = F.when(k % 4 == 0, F.concat(F.lit("# "), s(k))).when(k % 4 == 1, F.concat(F.lit(" "), s(k % 500), F.lit(" "))).when(k % 4 == 2, "").otherwise(F.concat(F.lit("0"), s(k % 300)))
    return page_numbers(i.orders.select(line.alias("value")))


@query("s11_last_row_wins", sql=" SELECT page, o_orderstatus AS status, o_orderkey AS seq FROM (SELECT *, o_orderkey % 97 AS page FROM orders) q QUALIFY row_number() OVER (PARTITION BY page ORDER BY o_orderkey DESC) = 1")
def s11(i):
    from ..sources.readers import last_wins

    rows = i.orders.select((F.col("o_orderkey") % 97).alias("page"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("seq"))
    return last_wins(rows, ["page"], "seq")


CANDIDATE = r"""(SELECT page, CASE CAST(page % 5 AS INT) WHEN 0 THEN concat('863-ACS-', CAST(page % 900 + 100 AS STRING)) WHEN 1 THEN concat('IN-', CAST(page AS STRING), '-AB') WHEN 2 THEN concat('863-AB-', CAST(page % 800 + 100 AS STRING), '/', CAST(page % 800 + 101 AS STRING)) WHEN 3 THEN concat('X', CAST(page AS STRING), '-7-2') ELSE concat('512-P-', CAST(page % 700 + 200 AS STRING)) END AS candidate,
CASE CAST(page % 7 AS INT) WHEN 0 THEN concat('EQUIPMENT TAG: here ', text) WHEN 1 THEN CASE WHEN page % 2 = 0 THEN 'pump and valve near' ELSE 'skid pump motor filter 512-PV-100/200, ' END WHEN 2 THEN 'DRAWING no' WHEN 3 THEN 'document specification' WHEN 4 THEN 'JOB 12' WHEN 5 THEN concat('ITP ref ', text) ELSE concat('scale sheet drawn checked package fan air skid 863-AB-', CAST(page % 800 + 100 AS STRING), ' / ', CAST(page % 800 + 101 AS STRING), ' ', text) END AS context FROM page_text)"""
fixture("candidates", CANDIDATE.removeprefix("(").removesuffix(")"), "page_text")
TERMS = ", ".join(f"'{x}'" for x in sorted(SQL_EQUIPMENT_TERMS))
TITLES = ", ".join(f"'{x}'" for x in SQL_TITLE_BLOCK_TERMS)
UP = r"upper(trim(regexp_replace({0}, '\s+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10) || ':;,.()[]{{}}'))"
P38 = rf""", c AS (SELECT page, candidate, {UP.format("candidate")} AS v, {UP.format("context")} AS u FROM candidates),
x AS (SELECT *, len(list_filter([{TERMS}], lambda x: contains(u, x)))::INT AS n, len(list_filter([{TITLES}], lambda x: contains(u, x))) >= 3 AS title, regexp_matches(v, '^\d{{3,4}}\s*-\s*[A-Z]{{1,4}}\s*-\s*\d{{3,5}}$') AS f, regexp_matches(u, '\b\d{{3,4}}\s*-\s*[A-Z]{{1,4}}\s*-\s*\d{{3,5}}\s*/\s*\d{{3,5}}\b') AS pr,
regexp_matches(u, '{SQL_EXPLICIT_LABEL}') AS ex, regexp_matches(u, '\b(DRG|DWG|DRAWING)') AS dr, regexp_matches(u, '\b(DOC|DOCUMENT|QCP|WPS|WPQR|ITP|MDR|P&ID)\b') AS dc, regexp_matches(u, '\bJOB') AS jb FROM c),
y AS (SELECT *, (CASE WHEN ex THEN 8 ELSE 0 END) + least(4, n) + (CASE WHEN pr THEN 3 ELSE 0 END) - (CASE WHEN title THEN 5 ELSE 0 END) + (CASE WHEN f THEN 2 ELSE -2 END) AS total FROM x),
z AS (SELECT page, candidate, CASE WHEN dr OR regexp_matches(v, '^(RFT-|GMMOS-|IN-)') THEN 'drawing_or_document_reference|-7|exclude_from_asset_admission' WHEN dc AND regexp_matches(u, 'SPECIFICATION|PROCEDURE|DOCUMENT') THEN 'document_or_procedure_reference|-6|exclude_from_asset_admission' WHEN f AND ex THEN 'likely_equipment_tag|12|admit_to_asset_candidate_queue' WHEN f AND n >= 1 THEN 'possible_equipment_tag|' || (6 + least(3, n)) || '|review_for_asset_admission' WHEN dc THEN 'document_or_procedure_reference|-6|exclude_from_asset_admission' WHEN jb THEN 'job_number_or_reference|-5|exclude_from_asset_admission' WHEN total >= 10 THEN 'likely_equipment_tag|' || total || '|admit_to_asset_candidate_queue' WHEN total >= 5 THEN 'possible_equipment_tag|' || total || '|review_for_asset_admission' ELSE 'ambiguous_identifier|' || total || '|review_only' END AS w FROM y),
cand AS (SELECT page, candidate, split_part(w, '|', 1) AS type, CAST(split_part(w, '|', 2) AS INT) AS score, split_part(w, '|', 3) AS recommendation FROM z) """


def _candidates(i):
    return i.candidates.select("page", "candidate", "context", pg.tag_candidate(F.col("candidate"), F.col("context")).alias("c")).select("page", "candidate", "context", "c.*")


@query("p38_tag_candidates", "candidates", sql=P38 + "SELECT page, candidate, type, score, recommendation FROM cand")
def p38(i):
    return _candidates(i).drop("context")


@query("p43_possible_tags", "candidates", sql=P38 + "SELECT page, candidate, score FROM cand WHERE type = 'possible_equipment_tag'")
def p43(i):
    return _candidates(i).filter("type = 'possible_equipment_tag'").select("page", "candidate", "score")


@query("a21_candidate_rollup", "candidates", sql=P38 + ", k AS (SELECT replace(candidate, ' ', '') AS name, type, count(*) AS n FROM cand GROUP BY 1, 2), b AS (SELECT replace(candidate, ' ', '') AS name, max(score) AS best_score, count(*) AS occurrences, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages FROM cand GROUP BY 1) SELECT name, best_score, occurrences, pages, types FROM b JOIN (SELECT name, string_agg(type || '=' || n, '; ' ORDER BY n DESC, type) AS types FROM k GROUP BY 1) q USING (name)")
def a21(i):
    c = _candidates(i).withColumn("name", F.replace("candidate", F.lit(" "), F.lit("")))
    kinds = c.groupBy("name", "type").agg(F.count("*").alias("n")).groupBy("name").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "type"))).alias("k"))
    best = c.groupBy("name").agg(F.max("score").alias("best_score"), F.count("*").alias("occurrences"), F.array_join(F.array_sort(F.collect_set("page")), ",").alias("pages"))
    return best.join(kinds, "name").select("name", "best_score", "occurrences", "pages", F.array_join(F.transform("k", lambda x: F.concat(x["type"], F.lit("="), (-x["m"]).cast("string"))), "; ").alias("types"))


@query("o04_candidate_order", "candidates", sql=P38 + "SELECT candidate, page, row_number() OVER (PARTITION BY recommendation ORDER BY score DESC, candidate, page) AS position FROM cand")
def o04(i):
    w = Window.partitionBy("recommendation").orderBy(F.desc("score"), "candidate", "page")
    return _candidates(i).select("candidate", "page", F.row_number().over(w).alias("position"))


@query("f26_nearby_terms", "candidates", sql=f" SELECT page, candidate, array_to_string(list_filter([{TERMS}], lambda x: contains({UP.format('context')}, x)), ',') AS terms FROM candidates")
def f26(i):
    return i.candidates.select("page", "candidate", F.array_join(pg.nearby_terms(F.col("context")), ",").alias("terms"))


@query("f05_tag_extraction", "candidates", sql=r", p AS (SELECT page, candidate, regexp_extract_all(upper(candidate), '\b(\d{3,4})\s*-\s*([A-Z]{1,4})\s*-\s*(\d{3,5})\s*/\s*(\d{3,5})\b', 1) AS a, regexp_extract(upper(candidate), '\b(\d{3,4})-([A-Z]{1,4})-(\d{3,5})/(\d{3,5})\b', 1) AS p1, regexp_extract(upper(candidate), '\b(\d{3,4})-([A-Z]{1,4})-(\d{3,5})/(\d{3,5})\b', 2) AS p2, regexp_extract(upper(candidate), '\b(\d{3,4})-([A-Z]{1,4})-(\d{3,5})/(\d{3,5})\b', 3) AS p3, regexp_extract(upper(candidate), '\b(\d{3,4})-([A-Z]{1,4})-(\d{3,5})/(\d{3,5})\b', 4) AS p4, regexp_extract(upper(candidate), '\b(\d{3,4})-([A-Z]{1,4})-(\d{3,5})\b', 0) AS f FROM candidates) SELECT page, candidate, CASE WHEN len(a) > 0 THEN p1 || '-' || p2 || '-' || p3 || ',' || p1 || '-' || p2 || '-' || p4 ELSE f END AS tags FROM p")
def f05(i):
    return i.candidates.select("page", "candidate", F.array_join(t.equipment_tags("candidate"), ",").alias("tags"))
