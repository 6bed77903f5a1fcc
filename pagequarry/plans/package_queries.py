"""Queries on scans, review packages and what stages hand on."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import measure as ms
from ..operators import pages as pg
from ..operators import tables as tb
from ..sources import readers as rd
from ..sources import sinks
from . import evidence_queries, measure_queries, page_queries, table_queries  # noqa: F401  their fixtures are used here too
from .registry import fixture, query


@query("s01_page_scan", "page_text", sql=" SELECT document_id, page, sha256(text) AS text_sha256, CAST(length(text) AS BIGINT) AS characters, images FROM page_text")
def s01(i):
    return i.page_text.select("document_id", "page", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.length("text").cast("long").alias("characters"), "images")


@query("s02_page_subset", "page_text", "selected_pages", sql=" SELECT document_id, page, length(text) AS characters FROM page_text WHERE page BETWEEN 5 AND 400 AND page IN (SELECT page FROM selected_pages)")
def s02(i):
    p = i.page_text.filter("page between 5 and 400").join(i.selected_pages, "page", "left_semi")
    return p.select("document_id", "page", F.length("text").cast("long").alias("characters"))


fixture(
    "ocr_words",
    "SELECT CAST(ok % 100 AS INT) AS page, ok AS block, CAST(ln % 2 AS INT) AS par, CAST(ln AS INT) AS line, CAST(w.n AS INT) AS word_no, CASE WHEN (pk + w.n) % 13 = 0 THEN ' ' ELSE concat('w', CAST((pk + w.n) % 50 AS STRING)) END AS text, CAST((pk * 7 + w.n * 31) % 100 AS DOUBLE) AS conf, CAST(w.n * 60 + pk % 9 AS INT) AS x, CAST(ln * 40 + (sk + w.n) % 3 AS INT) AS y, CAST(CASE WHEN (pk + w.n) % 17 = 0 THEN 0 ELSE 50 END AS INT) AS w, 18 AS h FROM base_lines CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) w",
    "base_lines",
)


@query("s05_word_lines", "ocr_words", sql=" SELECT page, block, par, line, string_agg(trim(text), ' ' ORDER BY y, x, word_no) AS text, round(avg(conf), 6) AS confidence, min(x) AS x1, min(y) AS y1, max(x + w) AS x2, max(y + h) AS y2 FROM ocr_words WHERE conf >= 20 AND trim(text) <> '' AND w > 0 AND h > 0 GROUP BY 1, 2, 3, 4 HAVING avg(conf) >= 35")
def s05(i):
    w = i.ocr_words.filter((F.col("conf") >= 20) & (F.btrim("text") != "") & (F.col("w") > 0) & (F.col("h") > 0))
    parts = F.array_sort(F.collect_list(F.struct("y", "x", "word_no", F.btrim("text").alias("text"))))
    lines = w.groupBy("page", "block", "par", "line").agg(F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"), F.avg("conf").alias("c"), F.min("x").alias("x1"), F.min("y").alias("y1"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"))
    return lines.filter("c >= 35").select("page", "block", "par", "line", "text", F.round("c", 6).alias("confidence"), "x1", "y1", "x2", "y2")


@query("s07_tile_starts", sql=" SELECT p_partkey AS crop, n AS tile, CAST(least(n * floor(floor((1800 + p_partkey) / 3.8::DOUBLE) * 0.7::DOUBLE), 1800 + p_partkey - floor((1800 + p_partkey) / 3.8::DOUBLE)) AS BIGINT) AS start_x FROM part CROSS JOIN (SELECT unnest(range(5)) AS n) v")
def s07(i):
    w = F.col("p_partkey") + 1800
    return i.part.select(F.col("p_partkey").alias("crop"), F.posexplode(g.tile_starts(w))).select("crop", F.col("pos").cast("long").alias("tile"), F.col("col").cast("long").alias("start_x"))


# a crop of 1900 pixels for each table: tiles of 500 that start at 0, 350, 700, 1050 and 1400, each with the lines that it holds whole
fixture(
    "tile_lines",
    """SELECT page, table_id, CAST(line_no * 10 + k.tile AS INT) AS line_no, CASE WHEN k.tile % 2 = 0 THEN text ELSE lower(text) END AS text, confidence - k.tile * CAST(0.01 AS DOUBLE) AS confidence, CAST(40 AS DOUBLE) AS crop_x, CAST(table_id % 90 AS DOUBLE) AS crop_y, 1900 AS crop_width, k.tile AS tile, x1 * 4 - k.tile * 350 AS x1, y1, x2 * 3 + x1 - k.tile * 350 AS x2, y2
FROM (SELECT page, table_id, line_no, text, confidence, x1, y1, x2, y2 FROM ocr_lines WHERE source_kind = 'detected_table_crop') q CROSS JOIN (SELECT 0 AS tile UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) k
WHERE x1 * 4 - k.tile * 350 >= 0 AND x2 * 3 + x1 - k.tile * 350 <= 500""",
    "ocr_lines",
)


@query("s07_tile_lines", "tile_lines", sql=" SELECT page, table_id, min(line_no) AS line_no, arg_min(text, line_no) AS text, max(confidence) AS confidence, min(x1 + tile * 350 + 40) AS x1, min(y1 + crop_y) AS y1, min(x2 + tile * 350 + 40) AS x2, min(y2 + crop_y) AS y2 FROM tile_lines GROUP BY page, table_id, CAST(floor(line_no / 10) AS INT)")
def s07_lines(i):
    return tb.tile_lines(i.tile_lines)


@query("s18_manifest_last_wins", sql=", m AS (SELECT o_custkey % 500 AS review_id, o_orderkey AS seq, concat('crop_', CAST(o_orderkey AS STRING), '.png') AS crop FROM orders) SELECT review_id, crop FROM m QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY seq DESC) = 1")
def s18(i):
    items = i.orders.groupBy((F.col("o_custkey") % 500).alias("k")).agg(F.sort_array(F.collect_list("o_orderkey")).alias("items"))
    rows = items.select(F.col("k").alias("review_id"), F.posexplode("items").alias("seq", "o")).select("review_id", "seq", F.concat(F.lit("crop_"), F.col("o").cast("string"), F.lit(".png")).alias("crop"))
    return rd.last_wins(rows, ["review_id"], "seq").select("review_id", "crop")


fixture("shapes", """SELECT o_orderkey AS shape_no, CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN concat('{"table_id": "t', CAST(o_orderkey AS STRING), '", "headers": ["a", "b"], "rows": [["1", "2"], ["3", "4"]]}') WHEN 1 THEN concat('[["h1", "h2"], ["x', CAST(o_orderkey AS STRING), '", "y"]]') ELSE concat('plain ', CAST(o_orderkey AS STRING)) END AS payload FROM orders""")


@query("s23_extractor_shapes", "shapes", sql=" SELECT shape_no, CASE WHEN payload LIKE '{%' THEN json_extract_string(payload, '$.table_id') ELSE concat('table_', CAST(shape_no AS STRING)) END AS table_id, CAST(CASE WHEN payload LIKE '{%' THEN json_array_length(json_extract(payload, '$.rows')) WHEN payload LIKE '[%' THEN json_array_length(CAST(payload AS JSON)) ELSE 1 END AS INT) AS n_rows FROM shapes")
def s23(i):
    name, n = tb.extractor_tables(F.col("payload"), F.col("shape_no"))
    return i.shapes.select("shape_no", name.alias("table_id"), n.alias("n_rows"))


@query("k03_summary_counts", "page_text", sql=page_queries._class_sql() + "SELECT 'rows' AS fact, '' AS label, count(*) AS n FROM classes UNION ALL SELECT 'page_class', page_class, count(*) FROM classes GROUP BY 2 UNION ALL SELECT 'route', route, count(*) FROM classes GROUP BY 2")
def k03(i):
    s = sinks.summary(pg.classified(i.page_text, page_queries.TAXONOMY), ["page_class", "route"])
    rows = s.select(F.lit("rows").alias("fact"), F.lit("").alias("label"), F.col("n_rows").alias("n"))
    for k in ("page_class", "route"):
        rows = rows.unionByName(s.select(F.lit(k).alias("fact"), F.explode(f"by_{k}").alias("label", "n")))
    return rows


@query("a31_table_counts", "ocr_lines", "review_rows", "page_text", sql=" SELECT 'ocr_lines' AS name, count(*) AS n FROM ocr_lines UNION ALL SELECT 'review_rows', count(*) FROM review_rows UNION ALL SELECT 'page_text', count(*) FROM page_text")
def a31(i):
    out = None
    for name in ("ocr_lines", "review_rows", "page_text"):
        row = getattr(i, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("m09_package_lineage", "register_wide", "registry_rows", sql=" SELECT 'registry' AS sheet, count(*) AS n_rows, 'equipment_id, equipment_tag, serial_number' AS columns FROM registry_rows UNION ALL SELECT 'register', count(*), 'equipment_tag, serial_number, model' FROM register_wide")
def m09(i):
    return sinks.lineage({"registry": i.registry_rows, "register": i.register_wide.select("equipment_tag", "serial_number", "model")})


@query("m05_batch_rows", "page_text", "selected_pages", sql=" SELECT document_id, page, 'table_extraction' AS recommended_route, 'selected_tag_page' AS reason FROM page_text WHERE page IN (SELECT page FROM selected_pages)")
def m05(i):
    return pg.batch_rows(i.page_text, i.selected_pages)


@query("m06_review_queue", "review_pages", "key_lines", sql=" SELECT page, 'weak_tag_evidence' AS review_reason FROM review_pages UNION ALL SELECT page, 'sparse_non_tabular_fields' FROM (SELECT page FROM key_lines WHERE contains(text, 'CLIENT') GROUP BY 1 HAVING count(*) <= 2) q")
def m06(i):
    return pg.page_review_queue(i.review_pages, i.key_lines.filter(F.contains("text", F.lit("CLIENT"))))


@query("g18_header_columns", "headers", sql=table_queries.P16 + "SELECT header_no, semantic, header_no * 3.0::DOUBLE + 20 AS column_x, greatest(1, header_no % 50)::DOUBLE AS column_width FROM sem WHERE semantic NOT IN ('', 'excluded')")
def g18(i):
    h = i.headers.select("header_no", tb.header_semantic(F.col("header")).alias("semantic"), (F.col("header_no") * 3.0).alias("x1"))
    return h.filter("semantic not in ('', 'excluded')").select("header_no", "semantic", ((F.col("x1") + F.col("x1") + 40) / 2).alias("column_x"), F.greatest(F.lit(1.0), (F.col("header_no") % 50).cast("double")).alias("column_width"))


fixture("grid_cells", "SELECT page, table_id, line_no, CASE CAST(line_no % 5 AS INT) WHEN 0 THEN concat('PT-', CAST(table_id % 300 AS STRING)) WHEN 1 THEN concat('AB', CAST(table_id AS STRING), '/7') WHEN 2 THEN text WHEN 3 THEN concat('12', CAST(table_id % 10 AS STRING), '-', CAST(line_no AS STRING)) ELSE 'MAHX9' END AS text, confidence, x1, x2 FROM ocr_lines", "ocr_lines")


@query(
    "g19_layout_fields",
    "grid_cells",
    "columns_x",
    sql=r""", j AS (SELECT l.*, c.column_no, abs((l.x1 + l.x2) / 2 - c.column_x) AS d, c.column_width AS cw FROM grid_cells l JOIN columns_x c USING (page, table_id)), n AS (SELECT * FROM j WHERE d <= greatest(1.8::DOUBLE * cw, 120) QUALIFY row_number() OVER (PARTITION BY table_id, line_no ORDER BY d, column_no) = 1),
k AS (SELECT *, CASE column_no WHEN 0 THEN 'tag' WHEN 1 THEN 'serial' WHEN 2 THEN 'model' ELSE '' END AS semantic, upper(regexp_replace(text, '\s+', '', 'g')) AS v FROM n),
p AS (SELECT * FROM k WHERE length(v) BETWEEN 3 AND 48 AND CASE semantic WHEN 'tag' THEN regexp_matches(v, '^\d{2,8}([-_/]\d{1,8})+$') OR (regexp_matches(v, '[A-Z]') AND regexp_matches(v, '\d') AND regexp_matches(v, '^[A-Z0-9]+([-_/][A-Z0-9]+)*$')) WHEN 'serial' THEN regexp_matches(v, '[A-Z]') AND regexp_matches(v, '\d') AND regexp_matches(v, '^[A-Z0-9]+([-_/.][A-Z0-9]+)+$') WHEN 'model' THEN regexp_matches(v, '[A-Z]') AND regexp_matches(v, '\d') AND regexp_matches(v, '^[A-Z0-9]+([-_/.][A-Z0-9]+)*$') ELSE false END)
SELECT page, table_id, semantic, v AS value, round(max(least(1, 0.78::DOUBLE + 0.18::DOUBLE * confidence)), 9) AS confidence FROM p GROUP BY 1, 2, 3, 4""",
)
def g19(i):
    cells = i.grid_cells.withColumn("cx", (F.col("x1") + F.col("x2")) / 2)
    near = tb.nearest_column(cells.select("page", "table_id", "line_no", "cx"), i.columns_x)
    j = i.grid_cells.join(near, ["page", "table_id", "line_no"])
    semantic = F.when(F.col("column_no") == 0, "tag").when(F.col("column_no") == 1, "serial").when(F.col("column_no") == 2, "model").otherwise("")
    j = j.withColumn("semantic", semantic).filter(tb.plausible(F.col("text"), F.col("semantic")))
    value = F.upper(F.regexp_replace("text", r"\s+", ""))
    return j.groupBy("page", "table_id", "semantic", value.alias("value")).agg(F.round(F.max(F.least(F.lit(1.0), F.col("confidence") * 0.18 + 0.78)), 9).alias("confidence"))


@query("s21_alias_columns", sql=" SELECT c_custkey AS tag, c_name AS direction, c_acctbal AS nominal FROM customer")
def s21(i):
    return rd.resolve_columns(i.customer, {"tag": ["equipment_tag", "C_CUSTKEY"], "direction": ["c_name"], "nominal": ["nominal_value", "c_acctbal"]})


@query("s13_unwrapped_records", "review_rows", sql=" SELECT table_id, line_no, crop FROM review_rows")
def s13(i):
    rows = i.review_rows.select(F.struct("table_id", "line_no").alias("review"), F.struct("table_id", "line_no", "crop").alias("raw_record"))
    return rd.unwrapped(rows)


@query("k02_envelopes", "review_rows", sql=" SELECT table_id AS t, line_no AS l, crop FROM review_rows")
def k02(i):
    e = sinks.enveloped(i.review_rows.select("table_id", "line_no", "crop"), ["crop"])
    return e.select(F.col("review.table_id").alias("t"), F.col("review.line_no").alias("l"), F.col("raw_record.crop").alias("crop"))


@query("o09_first_source", "layer", "cells", sql=" SELECT tag, direction, count(*) AS n FROM layer GROUP BY 1, 2")
def o09(i):
    # the reconciled layer stands before the cells it was made of
    first = ms.first_available({"layer": i.layer, "cells": i.cells}, ("reconciled", "layer", "cells"))
    return first.groupBy("tag", "direction").agg(F.count("*").alias("n"))
