"""OCR lines to visual rows, logical rows and reviewed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as g
from ..functions import sequence as sq
from ..functions import text as t

TABLE = ("page", "table_id")
# fixed values
TAG_HEADERS = ("tag", "tag no", "tag number", "equipment tag", "equipment no", "equipment number", "equipment id", "asset id", "asset no", "instrument tag", "instrument no", "loop no", "loop number")
SERIAL_HEADERS = ("serial", "serial no", "serial number", "s/n", "s no", "sno")
MODEL_HEADERS = ("model", "model no", "model number", "device", "device no", "type", "part no", "part number")
EXCLUDED_HEADERS = ("certificate", "certificate no", "report", "report no", "drawing", "drawing no", "revision", "rev", "date", "range", "rating", "accuracy", "pressure", "position", "pos", "item", "line", "sr no", "s r no")
HARD_FAILURES = ("crop_path_missing", "crop_manifest_entry_missing", "very_short_or_empty_text", "mostly_symbols_or_noise", "existing_hard_extraction_issue", "missing_ocr_confidence")
ITEM = "array<struct<rank: int, confidence: double, area: double, line_no: int, text: string, box: struct<x1: double, y1: double, x2: double, y2: double>>>"


def source_rank(kind: Column) -> Column:
    return F.when(kind == "detected_table_crop", 3).when(kind == "detected_table_tile", 2).otherwise(1)


def by_source(lines: DataFrame, policy: str) -> DataFrame:
    """Lines of the sources that a policy takes: crop_only, tiles_only, prefer_crop or all."""
    crop = F.col("source_kind") == "detected_table_crop"
    if policy == "crop_only":
        return lines.filter(crop)
    if policy == "tiles_only":
        return lines.filter(F.col("source_kind") == "detected_table_tile")
    if policy == "prefer_crop":
        any_crop = F.max(crop.cast("int")).over(Window.partitionBy(*TABLE))
        return lines.withColumn("_c", any_crop).filter(crop | (F.col("_c") == 0)).drop("_c")
    return lines


def deduplicated(lines: DataFrame, least: float = 0.35) -> DataFrame:
    """Lines of equal text that overlap by ``least`` or more, reduced to the best: source, confidence, area, then first."""
    b = g.box(*[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")])
    item = F.struct(source_rank(F.col("source_kind")).alias("rank"), F.col("confidence").alias("confidence"), g.area(b).alias("area"), (-F.col("line_no")).cast("int").alias("line_no"), F.col("text").alias("text"), b.alias("box"))
    groups = lines.groupBy(*TABLE, t.casefold(t.clean("text")).alias("_key")).agg(F.sort_array(F.collect_list(item), asc=False).alias("items"))
    kept = groups.select(*TABLE, F.explode(sq.greedy(F.col("items"), lambda k, x: g.iou(k["box"], x["box"]) >= least, ITEM)).alias("i"))
    return kept.select(*TABLE, (-F.col("i.line_no")).alias("line_no"), "i.text", "i.confidence", "i.box.*")


def tile_lines(lines: DataFrame, least: float = 0.5) -> DataFrame:
    """Lines of tiles in the coordinates of their page, those met in several tiles once.

    ``lines`` has ``page, table_id, line_no``, ``text, confidence``, the crop's place
    ``crop_x, crop_y`` and ``crop_width``, the ``tile`` from 0, and ``x1, y1, x2, y2`` in
    the tile. Of lines of equal text, whatever the case, that overlap by ``least`` or
    more the most confident stays, then the first.
    """
    start = F.element_at(g.tile_starts(F.col("crop_width")), F.col("tile").cast("int") + 1)
    dx, dy = F.col("crop_x") + start, F.col("crop_y")
    placed = lines.filter(F.col("tile") < F.size(g.tile_starts(F.col("crop_width")))).select(*TABLE, "line_no", "text", "confidence", *[(F.col(c) + d).cast("double").alias(c) for c, d in (("x1", dx), ("y1", dy), ("x2", dx), ("y2", dy))])
    item = F.struct(F.col("confidence"), (-F.col("line_no")).cast("int").alias("line_no"), F.col("text"), g.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("box"))
    groups = placed.groupBy(*TABLE, F.upper("text").alias("_key")).agg(F.sort_array(F.collect_list(item), asc=False).alias("items"))
    kind = "array<struct<confidence: double, line_no: int, text: string, box: struct<x1: double, y1: double, x2: double, y2: double>>>"
    kept = groups.select(*TABLE, F.explode(sq.greedy(F.col("items"), lambda k, x: g.iou(k["box"], x["box"]) >= least, kind)).alias("i"))
    return kept.select(*TABLE, (-F.col("i.line_no")).alias("line_no"), "i.text", "i.confidence", "i.box.*")


def visual_rows(lines: DataFrame, tolerance: float = 18.0) -> DataFrame:
    """Rows of lines by running-mean clusters of their vertical centres."""
    cy = (F.col("y1") + F.col("y2")) / 2
    item = F.struct(cy.alias("cy"), F.col("x1").alias("x1"), F.col("line_no").alias("line_no"), F.col("text").alias("text"), F.col("confidence").alias("confidence"), F.col("y1").alias("y1"), F.col("x2").alias("x2"), F.col("y2").alias("y2"))
    groups = lines.groupBy(*TABLE).agg(F.array_sort(F.collect_list(item)).alias("items"))
    ids = sq.mean_clusters(F.transform("items", lambda i: i["cy"]), F.lit(tolerance))
    flat = groups.select(*TABLE, F.explode(F.arrays_zip("items", ids.alias("ids"))).alias("z")).select(*TABLE, F.col("z.ids").alias("row_no"), "z.items.*")
    text = F.array_sort(F.collect_list(F.struct("x1", "line_no", "text")))
    return flat.groupBy(*TABLE, "row_no").agg(
        F.array_join(F.transform(text, lambda i: i["text"]), " ").alias("text"),
        F.avg("confidence").alias("confidence"),
        F.min("x1").alias("x1"),
        F.min("y1").alias("y1"),
        F.max("x2").alias("x2"),
        F.max("y2").alias("y2"),
        F.count("*").alias("n_lines"),
    )


def row_kind(text: Column) -> Column:
    """How a row starts a record, if it does."""
    return (
        F.when(F.btrim(text) == "", "blank")
        .when(text.rlike(r"^\s*\d{1,4}\s*[.):\-]\s*\S.+$"), "numbered_start")
        .when(text.rlike(r"^\s*\d{1,4}\s*[.):\-]?\s*$"), "number_only")
        .when(text.rlike(r"^\s*[-•–]\s+\S+"), "bullet")
        .otherwise("continuation")
    )


def logical_rows(rows: DataFrame, max_gap: float = 180.0, least: float = 0.85) -> DataFrame:
    """Records of visual rows: a numbered row starts one, and so does a gap below the lowest row of the record."""
    item = F.struct(F.col("row_no").alias("row_no"), row_kind(F.col("text")).alias("kind"), F.col("text").alias("text"), F.col("confidence").alias("confidence"), F.col("y1").cast("double").alias("y1"), F.col("y2").cast("double").alias("y2"))
    groups = rows.groupBy(*TABLE).agg(F.array_sort(F.collect_list(item)).alias("items"))
    ids = sq.sessions(F.col("items"), lambda r, y2: (r["kind"] == "numbered_start") | (r["y1"] - y2 > max_gap))
    flat = groups.select(*TABLE, F.explode(F.arrays_zip("items", ids.alias("ids"))).alias("z")).select(*TABLE, F.col("z.ids").alias("record_no"), "z.items.*")
    parts = F.array_sort(F.collect_list(F.struct("row_no", "text")))
    out = flat.groupBy(*TABLE, "record_no").agg(
        F.min_by("kind", "row_no").alias("first_kind"),
        F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"),
        F.array_join(F.transform(parts, lambda p: p["row_no"].cast("string")), ",").alias("source_rows"),
        F.count("*").alias("n_rows"),
        F.avg("confidence").alias("confidence"),
    )
    gap = (F.col("record_no") > 1) & (F.col("first_kind") != "numbered_start")
    numbered = (F.col("first_kind") == "numbered_start") | gap
    out = out.withColumn("record_kind", F.when(numbered, "numbered_start").otherwise("unstructured"))
    status = F.when(numbered & (F.col("confidence") >= least), "candidate").otherwise("needs_review")
    reason = F.when(status == "candidate", "").when(numbered, "low_average_ocr_confidence").otherwise("no_numbered_record_start")
    return out.select("*", status.alias("status"), reason.alias("reason"))


def review_priority(reason: Column, confidence: Column) -> Column:
    has = lambda *words: F.coalesce(reason.rlike("|".join(words)), F.lit(False))
    return F.when(has("no_numbered_record_start", "missing") | (confidence < 0.8), "high").when(has("continuation", "merged", "inconsistent"), "medium").otherwise("low")


# fixed values
STRUCTURE_REASONS = "no_numbered_record_start|unstructured|continuation_without_clear_start"
HARD_REASONS = "missing_inspection_detail|missing_activity_number|no_table_candidate_detected"


def auto_review(rows: DataFrame, least: float = 0.8, accept: int = 70, provisional: int = 45) -> DataFrame:
    """Scores 0 to 100, what speaks for and against a row, and the decision.

    ``rows`` has ``page, table_id, text, confidence, n_rows, reason, crop``; a null
    crop has no entry in the manifest, an empty one no file.
    """
    c, n, length, crop = F.col("confidence"), F.col("n_rows"), F.length(F.btrim("text")), F.col("crop")
    alnum = t.ratio(F.btrim("text"), r"\p{L}\p{N}")
    copies = F.count("*").over(Window.partitionBy(*TABLE, t.norm_upper("text")))
    r = rows.withColumn("copies", copies)
    reason = F.lower(t.text("reason"))
    # for each test: whether it holds, points, what speaks for the row, what speaks against it
    tests = [
        [(crop != "", 20, "review_crop_exists", None), (crop == "", 0, None, "crop_path_missing"), (crop.isNull(), 0, None, "crop_manifest_entry_missing")],
        [
            (c >= least, 30, "strong_average_ocr_confidence", None),
            (c >= 0.65, 18, "moderate_average_ocr_confidence", "moderate_ocr_confidence"),
            (c > 0, 5, None, "low_ocr_confidence"),
            (F.lit(True), 0, None, "missing_ocr_confidence"),
        ],
        [(length >= 30, 20, "substantive_text", None), (length >= 12, 10, "short_but_nonempty_text", None), (F.lit(True), 0, None, "very_short_or_empty_text")],
        [(alnum >= 0.55, 15, "readable_alphanumeric_content", None), (alnum >= 0.35, 7, None, "mixed_or_noisy_text"), (F.lit(True), 0, None, "mostly_symbols_or_noise")],
        [(n == 1, 15, "single_visual_row", None), (n.between(2, 4), 7, "bounded_wrapped_rows", "merged_visual_rows"), (n > 4, 0, None, "many_merged_visual_rows"), (F.lit(True), 0, None, "source_rows_unknown")],
        [(F.col("copies") == 1, 10, "unique_within_page_table", None), (F.lit(True), 0, None, "possible_duplicate_record")],
        [(reason.rlike(STRUCTURE_REASONS), -8, None, "low_structure_confidence")],
        [(reason.rlike(HARD_REASONS), -25, None, "existing_hard_extraction_issue")],
    ]

    def first(test: list[tuple], k: int, other) -> Column:
        out = F.when(test[0][0], F.lit(test[0][k]))
        for case in test[1:]:
            out = out.when(case[0], F.lit(case[k]))
        return out.otherwise(F.lit(other))

    score = sum((first(x, 1, 0) for x in tests[1:]), first(tests[0], 1, 0))
    said = lambda k: F.array_compact(F.array(*[first(x, k, None).cast("string") for x in tests]))
    r = r.select("*", F.greatest(F.lit(0), F.least(F.lit(100), score)).alias("score"), said(2).alias("positive"), said(3).alias("cautions"))
    hard = F.arrays_overlap("cautions", F.array(*[F.lit(x) for x in HARD_FAILURES]))
    decision = (
        F.when(hard, "needs_human_review")
        .when((F.col("score") >= accept) & F.array_contains("cautions", "low_structure_confidence"), "auto_accepted_low_structure")
        .when(F.col("score") >= accept, "auto_accepted")
        .when(F.col("score") >= provisional, "auto_accepted_low_confidence")
        .otherwise("needs_human_review")
    )
    return r.select("*", decision.alias("decision"))


def header_semantic(text: Column) -> Column:
    """What a header names: excluded, serial, model or tag; empty if none, an alias counts where it stands in the text."""
    h = t.norm_header(text)
    equal = lambda names: F.exists(F.array(*[F.lit(n) for n in names]), lambda n: h == n)
    inside = lambda names: F.exists(F.array(*[F.lit(n) for n in names]), lambda n: F.contains(h, n))
    return (
        F.when(equal(SERIAL_HEADERS), "serial").when(equal(TAG_HEADERS), "tag").when(equal(MODEL_HEADERS), "model").when(equal(EXCLUDED_HEADERS), "excluded")
        .when(inside(SERIAL_HEADERS), "serial").when(inside(TAG_HEADERS), "tag").when(inside(MODEL_HEADERS), "model").when(inside(EXCLUDED_HEADERS), "excluded").otherwise("")
    )


def plausible(value: Column, semantic: Column) -> Column:
    """Whether a value can be of a kind: 3 to 48 characters without spaces and the kind's pattern."""
    v = F.upper(F.regexp_replace(value, r"\s+", ""))
    mixed = v.rlike("[A-Z]") & v.rlike(r"\d")
    tag = v.rlike(r"^\d{2,8}([-_/]\d{1,8})+$") | (mixed & v.rlike("^[A-Z0-9]+([-_/][A-Z0-9]+)*$"))
    serial = mixed & v.rlike("^[A-Z0-9]+([-_/.][A-Z0-9]+)+$")
    model = mixed & v.rlike("^[A-Z0-9]+([-_/.][A-Z0-9]+)*$")
    return F.length(v).between(3, 48) & F.when(semantic == "tag", tag).when(semantic == "serial", serial).when(semantic == "model", model).otherwise(False)


def heading(text: Column) -> Column:
    """Whether a line is a heading: 3 to 80 characters, mostly capitals, no colon."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]", ""))
    return ~F.contains(text, F.lit(":")) & F.length(text).between(3, 80) & (letters > 0) & (upper / F.greatest(letters, F.lit(1)) >= 0.75)


def key_value(text: Column) -> Column:
    """Label and value of a ``label: value`` line; null if it is none."""
    label = t.clean(F.regexp_extract(text, r"^\s*([^:]{2,60}?)\s*:\s*(.+)$", 1))
    value = t.clean(F.regexp_extract(text, r"^\s*([^:]{2,60}?)\s*:\s*(.+)$", 2))
    ok = label.rlike(r"^[A-Za-z][A-Za-z0-9 ./#&()'-]*$") & t.word_count(label).between(1, 8) & (value != "") & ~F.endswith(value, F.lit(":")) & value.rlike(r"[\p{L}\p{N}]")
    return F.when(ok, F.struct(label.alias("label"), value.alias("value")))


# fixed values
NOISE_VALUES = (
    "", "TAG", "TAG #", "EQUIPMENT", "EQUIPMENT:", "PROJECT", "PROJECT:", "CLIENT", "CLIENT:", "JOB", "JOB #", "JOB NO", "DRG",
    "DRG #", "DWG", "DRAWING", "DRAWING:", "REV", "REVISION", "DOCUMENT", "MODEL", "TYPE", "SCALE", "SIZE", "SHEET", "DATE",
    "DESCRIPTION", "CLIENT DOCS", "CLIENT REP", "FOR CLIENT", "FOR MANUFACTURER",
)
RELATED_MARKERS = (
    "INSPECTION", "ACT:#", "ACTIVITY", "STANDARD", "H - HOLD", "R - REVIEW", "W - WITNESS", "M - MONITOR", "CERTIFICATE", "ASME",
    "API ", "NACE", "EN ",
)


def valid_phrase(value: Column, words: int = 1) -> Column:
    """Whether a value says something: no label, 3 to 100 characters, and ``words`` words of two letters or more."""
    v = t.clean(value, t.EDGES)
    found = F.size(F.regexp_extract_all(F.upper(v), F.lit("([A-Z]{2,})"), F.lit(1)))
    return ~F.upper(v).isin(*NOISE_VALUES) & F.length(v).between(3, 100) & (found >= words)


def related_record(text: Column) -> Column:
    """Whether a line belongs to an inspection, certificate or standard."""
    up = F.upper(t.clean(text, t.EDGES))
    return F.exists(F.array(*[F.lit(m) for m in RELATED_MARKERS]), lambda m: F.contains(up, m))


def best_orientation(scores: DataFrame) -> DataFrame:
    """The rotation of each page with the best score, then most tables, then least turn (``page, rotation, score, tables``)."""
    return scores.groupBy("page").agg(F.max_by("rotation", F.struct("score", "tables", -F.col("rotation"))).alias("rotation"), F.max("score").alias("score"))


def sparse_pages(lines: DataFrame, most: int = 2) -> DataFrame:
    """Pages with labelled lines, but ``most`` of them or fewer (``page, text``): ``page, n``."""
    fields = lines.filter(key_value(F.col("text")).isNotNull())
    return fields.groupBy("page").agg(F.count("*").alias("n")).filter(F.col("n") <= most)


def blocks(lines: DataFrame, gap: float = 85.0, reset: float = 220.0) -> DataFrame:
    """Block numbers of lines in reading order: a new one after a gap, a jump to the left, or at a heading."""
    w = Window.partitionBy("page").orderBy("y1", "x1", "line_no", "table_id")
    h = F.col("y2") - F.col("y1")
    before = lambda c: F.lag(c).over(w)
    space = F.col("y1") - before("y2")
    far = space > F.greatest(F.lit(gap), F.floor(F.greatest(before(h), h) * 3.5).cast("double"))
    jump = (before("x1") - F.col("x1") > reset) & (space > 10)
    new = F.when(before("y2").isNull() | far | jump | heading(F.col("text")), 1).otherwise(0)
    return lines.withColumn("_new", new).withColumn("block_no", F.sum("_new").over(w)).drop("_new")


def data_rows(rows: DataFrame, max_gap: float = 180.0) -> DataFrame:
    """Rows under each header row (``is_header``) up to the next one or the first larger gap."""
    w = Window.partitionBy(*TABLE).orderBy("row_no")
    r = rows.withColumn("segment", F.sum(F.col("is_header").cast("int")).over(w)).filter("segment > 0")
    s = Window.partitionBy(*TABLE, "segment").orderBy("row_no")
    wide = F.coalesce(F.col("y1") - F.lag("y2").over(s) > max_gap, F.lit(False))
    return r.withColumn("_wide", wide.cast("int")).withColumn("_cut", F.max("_wide").over(s)).filter("_cut = 0 and not is_header").drop("_cut", "_wide")


def nearest_column(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """The header column nearest to each cell's centre, if it is within the larger of 1.8 widths and 120."""
    j = cells.join(columns, list(TABLE))
    d = F.abs(F.col("cx") - F.col("column_x"))
    j = j.filter(d <= F.greatest(F.col("column_width") * 1.8, F.lit(120.0)))
    return j.groupBy(*TABLE, "line_no").agg(F.min_by("column_no", F.struct(d, F.col("column_no"))).alias("column_no"), F.min(d).alias("distance"))


def extractor_tables(payload: Column, number: Column) -> tuple[Column, Column]:
    """The id and the number of rows of what an extractor gave: an object with rows, a list of rows, or one value.

    What names no table gets an id from ``number``.
    """
    made, many = F.startswith(payload, F.lit("{")), F.startswith(payload, F.lit("["))
    n = F.when(made, F.json_array_length(F.get_json_object(payload, "$.rows"))).when(many, F.json_array_length(payload)).otherwise(1)
    name = F.when(made, F.get_json_object(payload, "$.table_id")).otherwise(F.concat(F.lit("table_"), number.cast("string")))
    return name, n


def modes(rows: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    """``keys``, the most frequent ``value`` and its count ``n``; of equals the first by ``order``."""
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col("_first"))).alias(value), F.max("n").alias("n"))


def table_score(heading: Column, row: Column, sure: Column, text: Column) -> Column:
    """An aggregate: 10 for each heading line, 2 for each different row text, and up to 5 for sure lines."""
    rows = F.countDistinct(F.when(row, text))
    return F.count_if(heading) * 10 + rows * 2 + F.least(F.lit(5), F.count_if(sure))


def valid_lines(lines: DataFrame) -> DataFrame:
    """Lines with a text and a box that has an area."""
    return lines.filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")) & (F.btrim("text") != ""))


def table_groups(lines: DataFrame) -> DataFrame:
    """Tables with their number of lines that hold text, and the first such line."""
    return lines.filter(F.btrim("text") != "").groupBy(*TABLE).agg(F.count("*").alias("n_lines"), F.min("line_no").alias("first_line"))


# fixed values
LINE_FIELDS = {"serial": r"SERIAL NO: *(\S+)", "model": r"MODEL *: *(\S+)", "client": "CLIENT: *(.+)$"}


def line_fields(lines: DataFrame, keys: list[str], patterns: dict[str, str] | None = None) -> DataFrame:
    """``keys, field_name, value`` of the fields that upper-cased lines name."""
    patterns = patterns or LINE_FIELDS
    found = lines.select(*keys, *[F.regexp_extract(F.upper("text"), p, 1).alias(n) for n, p in patterns.items()])
    return found.unpivot(keys, list(patterns), "field_name", "value").filter("value <> ''")
