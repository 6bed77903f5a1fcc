"""Queries that go through files: readers, sinks, stage plans and ingestion, written to the shared folder and read again."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import evidence as ev
from ..operators import pages as pg
from ..operators import regions as rg
from ..sources import binary, documents, files, named, sinks, workbook
from ..sources import readers as rd
from ..streaming import ledger
from ..streaming.resume import ingest
from . import evidence_queries, page_queries, table_queries
from . import stages as st
from .registry import fixture, query

# OCR pages as JSON texts, some of them broken
fixture(
    "page_lines",
    "SELECT CAST(table_id % 150 AS INT) AS page, CAST(table_id AS INT) AS table_index, CAST(row_number() OVER (PARTITION BY table_id ORDER BY line_no, x1) - 1 AS INT) AS line_no, text, confidence, x1, y1, x2, y2, source_kind FROM ocr_lines",
    "ocr_lines",
)


def _page_texts(i, broken: bool = True, parts: int = 1):
    """A JSON text for each page, with its tables and lines in order; each seventh page is broken or has no number.

    With ``parts`` a page comes in up to so many texts, each with some of its tables
    whole: a text is one value, which a task holds several times over, and these
    pages are the same 150 however many lines there are.
    """
    line = F.struct("line_no", "text", "confidence", F.struct("x1", "y1", "x2", "y2").alias("bbox"), "source_kind")
    # lines of a page come together once, for its tables and for itself
    key = ["page"] if parts == 1 else ["page", "part"]
    lines = i.by_order.page_lines.withColumn("part", F.pmod(F.xxhash64("table_index"), F.lit(parts)))
    lines = lines.repartition(8 + i.n_parts("lineitem"), *key)
    tables = lines.groupBy(*key, "table_index").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    pages = tables.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("table_index", "lines"))).alias("tables"))
    text = F.to_json(F.struct(F.lit("d").alias("document_id"), "page", "tables"))
    bad = F.when(F.col("page") % 14 == 0, F.concat(F.lit("{"), text)).when(F.col("page") % 7 == 0, F.replace(text, F.lit('"page":'), F.lit('"no":'))).otherwise(text)
    return pages.select("page", (bad if broken else text).alias("value"))


@query("s09_ocr_pages", "page_lines", sql=" SELECT 'd' AS document_id, page, table_index, line_no, text, confidence, x1, y2, source_kind FROM page_lines WHERE page % 7 <> 0")
def s09(i):
    path = files.scratch(i.spark, "ocr-pages")
    _page_texts(i).select("value").write.text(path, compression="gzip")
    return rd.parsed_ocr_pages(i.spark.read.text(path)).select("document_id", "page", "table_index", "line_no", "text", "confidence", "x1", "y2", "source_kind")


@query("x01_resumed_ingestion", "page_lines", sql=" SELECT page, count(*) AS n_lines, count(DISTINCT table_index) AS n_tables FROM page_lines WHERE page % 7 <> 0 GROUP BY 1")
def x01(i):
    source, table, mark = (files.scratch(i.spark, n) for n in ("incoming", "ingested", "progress"))
    texts = _page_texts(i)
    # two arrivals, and a third run that finds nothing new
    for part in (texts.filter("page < 75"), texts.filter("page >= 75"), None):
        if part is not None:
            part.select("value").write.mode("append").text(source, compression="gzip")
        ingest(i.spark, source, table, mark, names="*.txt.gz", whole=False)
    return i.spark.read.parquet(table).groupBy("page").agg(F.count("*").alias("n_lines"), F.countDistinct("table_index").alias("n_tables"))


@query("s10_csv_round_trip", "review_rows", sql=" SELECT CAST(table_id AS STRING) AS table_id, CAST(line_no AS STRING) AS line_no, text, reason, coalesce(crop, '') AS crop FROM review_rows")
def s10(i):
    path = files.scratch(i.spark, "csv")
    sinks.write_csv(i.review_rows, path, ["table_id", "line_no", "text", "reason", "crop"])
    return rd.read_csv(i.spark, path)


@query("k01_csv_columns", "evidence", sql=" SELECT CAST(source_page AS STRING) AS source_page, evidence_id, array_to_string([field_name, field_value], ' | ') AS both FROM evidence")
def k01(i):
    path = files.scratch(i.spark, "csv")
    sinks.write_csv(i.evidence.withColumn("both", F.array("field_name", "field_value")), path, ["source_page", "evidence_id", "both"])
    return rd.read_csv(i.spark, path)


@query("s12_json_lines", "evidence", sql=" SELECT evidence_id, field_name, confidence FROM evidence WHERE source_page % 5 <> 0")
def s12(i):
    path = files.scratch(i.spark, "json-lines")
    p = F.col("source_page")
    record = F.to_json(F.struct("evidence_id", "field_name", "confidence"))
    i.evidence.select(F.when(p % 10 == 0, "  ").when(p % 5 == 0, "[1, 2]").otherwise(record).alias("value")).write.text(path)
    schema = i.evidence.select("evidence_id", "field_name", "confidence").schema
    return rd.read_jsonl(i.spark, path, schema)


def _taxonomy_text() -> str:
    import yaml

    return yaml.safe_dump({"classes": {name: {"priority": p, "route": r, "keywords": words} for name, p, r, words in page_queries.TAXONOMY}}, sort_keys=False)


@query("s15_taxonomy", "page_text", sql=page_queries._class_sql() + "SELECT document_id, page, page_class, priority, route FROM classes")
def s15(i):
    path = files.scratch(i.spark, "taxonomy.yaml")
    files.put_text(i.spark, path, _taxonomy_text())
    return pg.classified(i.page_text, rd.parse_taxonomy(files.get_text(i.spark, path))).select("document_id", "page", "page_class", "priority", "route")


@query("x03_taxonomy_extension", "page_text", sql=" SELECT page, CASE WHEN contains(lower(text), 'added word') OR contains(lower(text), 'die') THEN 'added' ELSE '' END AS page_class FROM page_text")
def x03(i):
    spec = "classes:\n  added:\n    priority: high\n    route: native_text\n    keywords: [added word, die]\n"
    return pg.classified(i.page_text, rd.parse_taxonomy(spec)).select("page", "page_class")


@query("s16_policy_defaults", "evidence", sql=evidence_queries.RANKED.replace("confidence >= 0.95) AS ok", "confidence >= 0.93) AS ok").replace("ps >= 40", "ps >= 30") + "SELECT equipment_id, field_name, priority, auto_accepted FROM decided")
def s16(i):
    path = files.scratch(i.spark, "policy.json")
    files.put_text(i.spark, path, json.dumps({"auto_accept": {"minimum_confidence": 0.93}, "priority_thresholds": {"medium": 30}}))
    policy = rd.parse_policy(files.get_text(i.spark, path))
    return ev.decide(ev.best_evidence(i.evidence, policy), policy).select("equipment_id", "field_name", "priority", "auto_accepted")


@query("s17_decision_file", "registry_rows", sql=" SELECT r.equipment_tag, d.name AS equipment_name FROM registry_rows r JOIN (VALUES ('1', 'Pump one'), ('3', 'Valve')) d(tag, name) ON upper(trim(r.equipment_tag)) = d.tag")
def s17(i):
    text = "decisions:\n  ' 1 ': {decision: accept_equipment_name, equipment_name: Pump one}\n  '2': {decision: accept_equipment_name, equipment_name: ' '}\n  '3': {decision: accept_equipment_name, equipment_name: ' Valve '}\n  '4': {decision: no_name_evidence_found, equipment_name: x}\n  '5': none\n"
    path = files.scratch(i.spark, "decisions.yaml")
    files.put_text(i.spark, path, text)
    names = rd.parse_decisions(i.spark, files.get_text(i.spark, path))
    return i.registry_rows.join(names, F.upper(F.btrim("equipment_tag")) == F.col("tag")).select("equipment_tag", "equipment_name")


@query("s19_image_pages", "page_text", sql=" SELECT page FROM page_text WHERE page % 3 <> 0")
def s19(i):
    p = F.col("page")
    name = F.when(p % 3 == 0, F.format_string("/in/cover_%d.png", p)).when(p % 3 == 1, F.format_string("/in/page_%05d.png", p)).otherwise(F.format_string("/in/scan-page-%d.jpg", p))
    return rd.image_pages(i.page_text.select(name.alias("path"))).select(F.col("page").cast("long").alias("page"))


@query("s20_batch_contract", "page_text", sql=" SELECT document_id, page, 'table_extraction' AS recommended_route FROM page_text")
def s20(i):
    # a batch for each document
    batches = i.page_text.select("document_id", "page", F.lit("table_extraction").alias("recommended_route"), F.lit("selected").alias("reason"))
    return rd.checked_batches(batches, F.col("document_id")).select("document_id", "page", "recommended_route")


@query("k08_full_text", "page_text", sql=" SELECT document_id, page, CAST(sum(strlen(text) + 1) OVER (PARTITION BY document_id ORDER BY page) - strlen(text) - 1 AS BIGINT) AS position, CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS text_md5 FROM page_text")
def k08(i):
    folder = files.scratch(i.spark, "full-text")
    index = documents.write_full_text(i.page_text, folder)
    return documents.read_pages(index, folder).select("document_id", "page", F.col("offset").alias("position"), "bytes", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("k07_control_file", "evidence", sql=" SELECT field_name AS key, count(*) AS n FROM evidence GROUP BY 1")
def k07(i):
    counts = {r["field_name"]: r["count"] for r in i.evidence.groupBy("field_name").count().collect()}
    path = files.scratch(i.spark, "control.json")
    files.put_text(i.spark, path, "{}")
    files.put_text(i.spark, path, json.dumps(counts))
    kept = F.from_json("value", "map<string, bigint>")
    return i.spark.read.text(path, wholetext=True).select(F.explode(kept).alias("key", "n"))


@query("k09_header_only", "register_wide", sql=" SELECT equipment_tag, '' AS note FROM register_wide")
def k09(i):
    path = files.scratch(i.spark, "absent")
    sinks.write_csv(sinks.header_only(i.spark, ["equipment_tag", "note"]), path)
    absent = rd.read_csv(i.spark, path) if files.exists(i.spark, path) else sinks.header_only(i.spark, ["equipment_tag", "note"])
    absent = absent if absent.columns else sinks.header_only(i.spark, ["equipment_tag", "note"])
    return i.register_wide.select("equipment_tag").join(absent, "equipment_tag", "left").select("equipment_tag", F.coalesce("note", F.lit("")).alias("note"))


@query("k10_text_summary", "evidence", sql=" SELECT concat('n_rows: ', count(*)) AS line FROM evidence UNION ALL SELECT concat('pages: ', count(DISTINCT source_page)) FROM evidence UNION ALL SELECT 'title: evidence'")
def k10(i):
    facts = i.evidence.agg(F.count("*").alias("n_rows"), F.countDistinct("source_page").alias("pages")).withColumn("title", F.lit("evidence"))
    path = files.scratch(i.spark, "summary.txt")
    files.put_text(i.spark, path, sinks.report(facts))
    return i.spark.read.text(path).select(F.col("value").alias("line"))


@query("k11_copied_artefacts", "registry_rows", sql=" SELECT equipment_id, serial_number FROM registry_rows")
def k11(i):
    source, target = files.scratch(i.spark, "made"), files.scratch(i.spark, "kept")
    i.registry_rows.select("equipment_id", "serial_number").write.parquet(source)
    files.copy(i.spark, source, target)
    files.delete(i.spark, source)
    return i.spark.read.parquet(target)


@query("k05_workbook", "register_wide", sql=" SELECT 'register' AS sheet, CAST(row_number() OVER (ORDER BY equipment_tag) + 1 AS INT) AS row_no, array_to_string([equipment_tag, serial_number, model], '|') AS cells FROM register_wide UNION ALL SELECT 'register', 1, 'equipment_tag|serial_number|model' UNION ALL SELECT 'counts', 1, 'n' UNION ALL SELECT 'counts', 2, CAST(count(*) AS STRING) FROM register_wide")
def k05(i):
    path = files.scratch(i.spark, "package.xlsx")
    r = i.register_wide.select("equipment_tag", "serial_number", "model")
    workbook.write_workbook({"register": r.orderBy("equipment_tag"), "counts": r.agg(F.count("*").alias("n"))}, path, further=True)
    return workbook.read_workbook(i.spark, path).select("sheet", "row_no", F.array_join("cells", "|").alias("cells"))


# boxes far apart in two columns: those of one column lie closer than the gap and share most of their width
fixture("regions", "SELECT page, CAST((table_id % 3) * 1000 AS DOUBLE) AS x1, CAST(line_no * 50 AS DOUBLE) AS y1, CAST((table_id % 3) * 1000 + 200 AS DOUBLE) AS x2, CAST(line_no * 50 + CASE WHEN line_no % 4 = 0 THEN 5 ELSE 30 END AS DOUBLE) AS y2 FROM (SELECT DISTINCT page, table_id % 3 AS table_id, line_no FROM ocr_lines) q", "ocr_lines")


@query(
    "g16_merged_regions",
    "regions",
    sql=""", o AS (SELECT *, CASE WHEN y1 - max(y2) OVER (PARTITION BY page, x1 ORDER BY y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 60 THEN 0 ELSE 1 END AS fresh FROM regions),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY page, x1 ORDER BY y1) AS grp FROM o) SELECT page, x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM k GROUP BY page, x1, grp""",
)
def g16(i):
    return rg.merged_regions(i.regions, ["page"])


# a raster for each table, of 300 by 350 pixels, with the outlines of its lines and of all of them
PAGE_WIDTH, PAGE_HEIGHT = 300, 350
fixture("ruled_lines", "SELECT page, table_id, line_no, confidence, floor(x1 / 2) AS x1, floor(y1 / 2) AS y1, floor(x2 / 2) AS x2, floor(y2 / 2) AS y2 FROM ocr_lines", "ocr_lines")


def _rasters(i):
    """Lines, packed runs and sizes of the rasters; lines of an order are made once, in one task."""
    key, sides = ["page", "table_id"], ("x1", "y1", "x2", "y2")
    lines = files.written(i.by_order.ruled_lines, "ruled-lines")
    hull = lines.groupBy(*key).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    runs = files.written(rg.outlined(lines.select(*key, *sides).unionByName(hull), key), "rasters")
    return lines, runs, hull.select(*key, F.lit(PAGE_WIDTH).alias("width"), F.lit(PAGE_HEIGHT).alias("height"))


@query(
    "s08_table_regions",
    "ruled_lines",
    sql=f""", h AS (SELECT page, table_id, greatest(min(x1) - 18, 0) AS x1, greatest(min(y1) - 18, 0) AS y1, least(max(x2) + 18, {PAGE_WIDTH}) AS x2, least(max(y2) + 18, {PAGE_HEIGHT}) AS y2 FROM ruled_lines GROUP BY 1, 2),
p AS (SELECT *, greatest(12, floor((x2 - x1) * 0.02)) AS px, greatest(12, floor((y2 - y1) * 0.02)) AS py FROM h WHERE x2 - x1 >= 75 AND y2 - y1 >= 17 AND (x2 - x1) * (y2 - y1) >= 4200)
SELECT page, table_id, greatest(x1 - px, 0) AS x1, greatest(y1 - py, 0) AS y1, least(x2 + px, {PAGE_WIDTH}) AS x2, least(y2 + py, {PAGE_HEIGHT}) AS y2 FROM p""",
)
def s08(i):
    _, runs, pages = _rasters(i)
    return rg.table_regions(runs, pages, ["page", "table_id"])


@query(
    "k06_row_crops",
    "ruled_lines",
    sql=f""", e AS (SELECT DISTINCT table_id, x1, y1, x2, y2 FROM ruled_lines UNION SELECT table_id, min(x1), min(y1), max(x2), max(y2) FROM ruled_lines GROUP BY 1),
rows AS (SELECT *, unnest(range(y1::BIGINT, y2::BIGINT)) AS y FROM e),
spans AS (SELECT table_id, y, x1::BIGINT AS a, x2::BIGINT AS z FROM rows WHERE y IN (y1::BIGINT, y2::BIGINT - 1) UNION SELECT table_id, y, x1::BIGINT, x1::BIGINT + 1 FROM rows UNION SELECT table_id, y, x2::BIGINT - 1, x2::BIGINT FROM rows),
q AS (SELECT table_id, line_no, greatest(x1 - 20, 0)::INT AS l, greatest(y1 - 10, 0)::INT AS t, least(x2 + 20, {PAGE_WIDTH})::INT AS r, least(y2 + 10, {PAGE_HEIGHT})::INT AS b FROM ruled_lines WHERE confidence < 0.70::DOUBLE),
ink AS (SELECT DISTINCT q.table_id, q.line_no, s.y, unnest(range(greatest(a, l), least(z, r))) AS x FROM q JOIN spans s ON s.table_id = q.table_id AND s.y >= t AND s.y < b AND a < r AND z > l),
n AS (SELECT table_id, line_no, count(*) AS n FROM ink GROUP BY 1, 2)
SELECT concat(q.table_id, '_', q.line_no, '.png') AS name, (r - l)::INT AS width, (b - t)::INT AS height, n AS n_black FROM q JOIN n USING (table_id, line_no)""",
)
def k06(i):
    lines, runs, pages = _rasters(i)
    queue = lines.filter("confidence < 0.70D").select(F.concat_ws("/", "table_id", "line_no").alias("crop_id"), "page", "table_id", "x1", "y1", "x2", "y2", F.lit(0).alias("rotation"))
    folder = files.scratch(i.spark, "crops")
    kept = binary.write_files(binary.row_crops(runs, pages, queue, ["page", "table_id"], (20, 10)), folder)

    def look(batches):
        for b in batches:
            images = [binary.pixels(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.shape[1] for x in images], pa.int32()), pa.array([x.shape[0] for x in images], pa.int32()), pa.array([int((x == 0).sum()) for x in images], pa.int64())], names=["name", "width", "height", "n_black"])

    return binary.read_files(kept, folder).mapInArrow(look, "name string, width int, height int, n_black long")


def _evidence_run(i, **options):
    catalog = st.Catalog(i.spark, files.scratch(i.spark, "stages"))
    return catalog, st.run(st.evidence_stages(), catalog, {"evidence": i.evidence}, **options)


def _told(catalog, stages):
    """What stages wrote, by the counts taken while they wrote it."""
    return st.progress(stages, catalog).filter("n_rows is not null").select("stage", "table_name", "n_rows")


KEYED = evidence_queries.RANKED + evidence_queries.PATTERN


@query(
    "m01_stage_slice",
    "evidence",
    sql=KEYED + """SELECT 'pattern_queue' AS stage, 'patterns' AS table_name, count(*) AS n_rows FROM (SELECT DISTINCT norm_field, norm_value, norm_source FROM k)
UNION ALL SELECT 'review_queue', 'decided', count(*) FROM decided UNION ALL SELECT 'review_queue', 'review_queue', count(*) FROM decided WHERE NOT auto_accepted UNION ALL SELECT 'review_queue', 'auto_accepted', count(*) FROM decided WHERE auto_accepted
UNION ALL SELECT 'review_queue', 'summary', count(*) FROM (SELECT DISTINCT equipment_id, equipment_tag, serial_number FROM decided)""",
)
def m01(i):
    catalog, _ = _evidence_run(i, start="7a", stop="review_queue")
    return _told(catalog, st.evidence_stages())


@query("m02_stage_timeout", sql=" SELECT 'quick' AS stage, 'quick' AS table_name, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'other', 'other', count(DISTINCT l_partkey) FROM lineitem")
def m02(i):
    # a sum over each row times a number of steps that would take hours
    slow = i.lineitem.select(F.explode(F.sequence(F.lit(1), F.lit(2_000_000))).alias("k"), "l_orderkey").agg(F.sum(F.sqrt(F.hash("k", "l_orderkey"))).alias("x"))
    make = lambda name, needs, build: st.Stage(name, needs, (name,), lambda _, f: {name: build(f)})
    plan = [
        make("quick", ("lineitem",), lambda f: f["lineitem"]),
        make("endless", ("lineitem",), lambda f: slow),
        make("after", ("endless",), lambda f: f["endless"]),
        make("other", ("quick",), lambda f: f["quick"].select("l_partkey").distinct()),
    ]
    catalog = st.Catalog(i.spark, files.scratch(i.spark, "stages"))
    # the limit is the endless stage's own: what the others take grows with the table
    st.run(plan, catalog, {"lineitem": i.lineitem}, keep_going=True, timeout={"endless": 10})
    return _told(catalog, plan)


@query("m03_precondition", "evidence", sql=" SELECT count(*) AS n_rows, true AS raised FROM evidence")
def m03(i):
    catalog, raised = st.Catalog(i.spark, files.scratch(i.spark, "stages")), False
    try:
        st.run(st.evidence_stages(), catalog, start="final_registry")
    except rd.MissingInput:
        raised = True
    return i.evidence.agg(F.count("*").alias("n_rows"), F.lit(raised).alias("raised"))


@query(
    "m04_table_batch",
    "page_lines",
    sql=""" SELECT 'render' AS stage, 'rendered_pages' AS table_name, count(DISTINCT page) AS n_rows FROM page_lines UNION ALL SELECT 'image_ocr', 'ocr_lines', count(*) FROM page_lines WHERE page % 7 <> 0
UNION ALL SELECT 'lines', CAST(page AS STRING), count(*) FROM page_lines WHERE page % 7 <> 0 GROUP BY page""",
)
def m04(i):
    catalog = st.Catalog(i.spark, files.scratch(i.spark, "batch"))
    # texts stay as long as they are while there are more lines
    texts = _page_texts(i, parts=i.n_parts("lineitem"))
    pages = files.written(i.page_lines.select("page").distinct(), "pages")
    images = pages.select(F.format_string("/in/page_%03d.png", "page").alias("path"))
    plan = st.table_batch_stages()
    st.run(plan, catalog, {"images": images, "ocr_pages": texts.select("value")}, keep_going=True)
    lines = catalog.load("ocr_lines").groupBy("page").agg(F.count("*").alias("n_rows"))
    first = _told(catalog, plan).filter("stage in ('render', 'image_ocr')")
    # the last stage is there only if all before it ran
    catalog.load("export_summary")
    return first.unionByName(lines.select(F.lit("lines").alias("stage"), F.col("page").cast("string").alias("table_name"), "n_rows"))


def _page_files(i, texts):
    """Page files of their own in a folder."""
    folder = files.scratch(i.spark, "page-files")
    binary.write_files(texts.select(F.format_string("page_%05d.json", "page").alias("name"), F.col("value").alias("content")), folder)
    return folder


@query("s24_named_reader", "page_lines", sql=" SELECT 'd' AS document_id, page, table_index, line_no, text, confidence, x1, y2, source_kind FROM page_lines WHERE page % 7 <> 0")
def s24(i):
    folder = _page_files(i, _page_texts(i))
    return i.spark.read.format(named.use(i.spark, "ocr_page_lines")).load(folder).select("document_id", "page", "table_index", "line_no", "text", "confidence", "x1", "y2", "source_kind")


@named.reader("page_sizes", "page int, n_tables long, n_lines long")
def page_sizes(_, text):
    """A reader as users add them: how much a page file holds."""
    data = json.loads(text)
    tables = data["tables"]
    yield int(data["page"]), len(tables), sum(len(x["lines"]) for x in tables)


@query("x03_own_reader", "page_lines", sql=" SELECT page, count(DISTINCT table_index) AS n_tables, count(*) AS n_lines FROM page_lines WHERE page % 7 <> 0 GROUP BY page")
def x03_reader(i):
    return named.read_tables(i.spark, _page_files(i, _page_texts(i)), ("page_sizes",))


@query("m04_page_ledger", "page_lines", sql=" SELECT page, CASE WHEN page % 7 = 0 THEN 2 ELSE 1 END AS attempts, 'done' AS outcome, count(*) AS n_lines FROM page_lines GROUP BY page")
def m04_ledger(i):
    folder = _page_files(i, _page_texts(i))
    pages = ledger.Pages(i.spark, folder, *(files.scratch(i.spark, n) for n in ("page-rows", "page-ledger", "page-progress")), files_at_once=70)
    pages.run()
    # what failed is mended, and comes again
    mended = _page_texts(i, broken=False).filter("page % 7 = 0")
    binary.write_files(mended.select(F.format_string("page_%05d.json", "page").alias("name"), F.col("value").alias("content")), folder)
    pages.run()
    lines = pages.rows().groupBy("page").agg(F.count("*").alias("n_lines"))
    return pages.latest().join(lines, "page", "left").select("page", F.col("attempt").alias("attempts"), "outcome", "n_lines")


@query("m07_fallback_source", "registry_rows", sql=" SELECT equipment_id, equipment_tag FROM registry_rows")
def m07(i):
    catalog = st.Catalog(i.spark, files.scratch(i.spark, "stages"))
    catalog.save("registry", i.registry_rows.select("equipment_id", "equipment_tag"))
    return catalog.first_of("reviewed_registry", "registry")


@query(
    "x02_progress",
    "evidence",
    sql=KEYED + """SELECT 'promote_evidence' AS stage, 'promoted' AS table_name, count(*) AS n_rows FROM evidence UNION ALL SELECT 'promote_evidence', 'registry', count(*) FROM (SELECT DISTINCT concat(regexp_replace(upper(equipment_tag), '[^A-Z0-9]', '', 'g'), '::', trim(serial_number)) FROM evidence)
UNION ALL SELECT 'pattern_queue', 'patterns', count(*) FROM (SELECT DISTINCT norm_field, norm_value, norm_source FROM k)""",
)
def x02(i):
    catalog, _ = _evidence_run(i, stop="pattern_queue")
    # as another process sees it
    return _told(st.Catalog(i.spark, catalog.folder), st.evidence_stages())
