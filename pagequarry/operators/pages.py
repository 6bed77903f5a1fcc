"""Pages: profile, classification, selection, comparison of what stages chose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t

# fixed values
ROUTE_RANK = {"manual_review": 0, "native_text": 1, "native_text_plus_visual_check": 2, "drawing_review": 3, "ocr_key_value": 4, "table_extraction": 5}
PRIORITY_RANK = {"low": 1, "medium": 2, "high": 3}
RELEVANT_CLASSES = ("certificate", "material_traceability", "inspection_plan", "inspection_report", "spare_parts", "calibration", "pressure_test", "ndt", "equipment_metadata")
RELEVANT_ROUTES = ("table_extraction", "ocr_key_value")
ISA_FUNCTIONS = (
    "XV|HV|MOV|SDV|ESDV|BDV|PSV|PCV|FCV|LCV|TCV|"
    "PT|PI|PIC|PIT|PC|PS|PSH|PSHH|PSL|PSLL|"
    "TT|TI|TIC|TIT|TC|TS|TSH|TSHH|TSL|TSLL|"
    "FT|FI|FIC|FIT|FC|FS|FSH|FSHH|FSL|FSLL|"
    "LT|LI|LIC|LIT|LC|LS|LSH|LSHH|LSL|LSLL|"
    "AT|AI|AIC|AIT|AC|AS|ZT|ZI|ZIC|ZIT|ZC|ZS|"
    "YT|YI|YIC|YIT|YC|YS|TE|FE|PE|LE|AE|VE|WE"
)
TAG_FIELD = "TAG|INSTRUMENT TAG|EQUIPMENT TAG|LOOP TAG|ITEM TAG|TAG NO"
SERIAL_FIELD = "SERIAL|SERIAL NO|SERIAL NUMBER|S/N|SNO"
CERTIFICATE = (
    "FINAL TEST CERTIFICATE|DECLARATION OF CONFORMITY|CALIBRATION CERTIFICATE|TEST CERTIFICATE|"
    "INSPECTION CERTIFICATE|CERTIFICATE OF CONFORMITY|CERTIFICATE|DECLARATION"
)
EQUIPMENT_CONTEXT = (
    "EQUIPMENT|INSTRUMENTS?|VALVE|ACTUATOR|TRANSMITTER|CONTROLLER|SWITCH|GAUGE|DETECTOR|SENSOR|METER|ANALYSER|ANALYZER|"
    "SOLENOID|CONTROL VALVE|PRESSURE|TEMPERATURE|FLOW|LEVEL|PROCESS CONNECTION|SET ?POINT|PROOF PRESSURE|RANGE|"
    "MANUFACTURER|MODEL|TYPE|SERIAL"
)
TABLE_CONTEXT = (
    "TABLE|EQUIPMENT LIST|INSTRUMENT DATA|DATA SHEET|DOCUMENT REGISTER|DOCUMENT NUMBER|DRAWING|SPARE PARTS?|PART NUMBER|"
    "QUANTITY|DESCRIPTION|MODEL|RANGE|SET ?POINT|TERMINAL|WIRING|SCHEMATIC|PNEUMATIC|HYDRAULIC|PACKING|STORAGE"
)


def route(chars: Column, words: Column, alnum: Column, images: Column, min_chars: int = 80, min_words: int = 15, min_alnum: float = 0.25) -> Column:
    """How a page should be read."""
    poor = (chars < min_chars) | (words < min_words) | (alnum < min_alnum)
    return F.when(poor, "render_ocr").when(images >= 1, "native_text_plus_visual_check").otherwise("native_text")


def profile(pages: DataFrame) -> DataFrame:
    """Counts, ratios, preview and route of each page's text (``document_id, page, text, images``)."""
    bare = F.btrim(t.text("text"))
    out = pages.select(
        "document_id",
        "page",
        F.length(bare).cast("long").alias("text_characters"),
        t.word_count("text").cast("long").alias("word_count"),
        t.ratio("text", r"\p{L}\p{N}").alias("alnum_ratio"),
        t.ratio("text", r"\p{Lu}").alias("upper_ratio"),
        F.left(t.clean("text"), F.lit(60)).alias("preview"),
        "images",
    )
    return out.withColumn("recommended_route", route(F.col("text_characters"), F.col("word_count"), F.col("alnum_ratio"), F.col("images")))


def class_hits(pages: DataFrame, taxonomy: list[tuple[str, str, str, list[str]]]) -> DataFrame:
    """Pages with the keywords of each class that occur in their text, as substrings without case.

    The taxonomy is a literal: (class, priority, route, keywords) in file order.
    """
    low = F.lower(t.text("text"))
    hits = [
        F.struct(
            F.lit(k).alias("cls"),
            F.lit(n).alias("class_order"),
            F.lit(p).alias("priority"),
            F.lit(r).alias("route"),
            F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, F.lower(w))).alias("keywords"),
        )
        for n, (k, p, r, words) in enumerate(taxonomy)
    ]
    return pages.select("document_id", "page", F.filter(F.array(*hits), lambda h: F.size(h["keywords"]) > 0).alias("hits"))


def classified(pages: DataFrame, taxonomy: list[tuple[str, str, str, list[str]]]) -> DataFrame:
    """The class of each page by score, with an index page winning outright on a hit of two words."""
    words = lambda k: F.size(F.split(k, r"\s+"))
    rank = lambda c, ranks: F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[c], F.lit(0))

    def scored(h: Column) -> Column:
        sizes = F.transform(h["keywords"], words)
        score = F.array_max(sizes) * 100 + F.aggregate(sizes, F.lit(0), lambda a, x: a + x) * 10 + rank(h["priority"], PRIORITY_RANK) * 2
        wins = (h["cls"] == "index") & (F.array_max(sizes) >= 2)
        return F.struct(wins.alias("wins"), score.alias("score"), rank(h["priority"], PRIORITY_RANK).alias("pr"), rank(h["route"], ROUTE_RANK).alias("rr"), (-h["class_order"]).alias("o"), h["cls"].alias("cls"), h["priority"].alias("priority"), h["route"].alias("route"))

    best = class_hits(pages, taxonomy).withColumn("b", F.array_max(F.transform("hits", scored)))
    return best.select(
        "document_id",
        "page",
        F.coalesce("b.cls", F.lit("")).alias("page_class"),
        F.coalesce("b.priority", F.lit("low")).alias("priority"),
        F.coalesce("b.route", F.lit("manual_review")).alias("route"),
        F.coalesce("b.score", F.lit(0)).alias("score"),
        F.array_join(F.transform("hits", lambda h: h["cls"]), " | ").alias("matched_classes"),
        F.array_join(F.flatten(F.transform("hits", lambda h: h["keywords"])), " | ").alias("matched_keywords"),
    )


def relevant(priority: Column, page_class: Column, route_: Column) -> Column:
    return (priority == "high") & page_class.isin(*RELEVANT_CLASSES) & route_.isin(*RELEVANT_ROUTES)


def comparison_flag(selected: Column, relevant_: Column, review: Column, page_class: Column) -> Column:
    return (
        F.when(selected & relevant_, "tag_selected_intake_agrees")
        .when(selected, "tag_selected_intake_disagrees")
        .when(relevant_, "intake_relevant_not_tag_selected")
        .when(review, "weak_tag_evidence")
        .when(page_class == "", "unknown_or_low_evidence")
        .otherwise("not_selected_not_intake_relevant")
    )


def intake_priority(flag: Column, weak_text: Column, image_heavy: Column, priority: Column) -> Column:
    return (
        F.when(flag == "intake_relevant_not_tag_selected", "high")
        .when(flag == "weak_tag_evidence", "medium")
        .when((flag == "tag_selected_intake_disagrees") & (weak_text | image_heavy), "medium")
        .when(priority == "high", "medium")
        .otherwise("low")
    )


def compared(classes: DataFrame, profiles: DataFrame, selected: DataFrame, review: DataFrame) -> DataFrame:
    """Every page that any of the four frames has (by ``page``), with flag and priority."""
    j = (
        classes.select("page", "page_class", "priority", "route")
        .join(profiles.select("page", "recommended_route", "images"), "page", "full")
        .join(selected.select("page", F.lit(True).alias("sel")), "page", "full")
        .join(review.select("page", F.lit(True).alias("rev")), "page", "full")
    )
    j = j.select("page", *[t.text(c).alias(c) for c in ("page_class", "priority", "route", "recommended_route")], F.coalesce("images", F.lit(0)).alias("images"), F.coalesce("sel", F.lit(False)).alias("selected"), F.coalesce("rev", F.lit(False)).alias("in_review"))
    j = j.withColumn("intake_relevant", relevant(F.col("priority"), F.col("page_class"), F.col("route")))
    j = j.withColumn("flag", comparison_flag(F.col("selected"), F.col("intake_relevant"), F.col("in_review"), F.col("page_class")))
    return j.withColumn("review_priority", intake_priority(F.col("flag"), F.col("recommended_route") == "render_ocr", F.col("images") >= 3, F.col("priority")))


def page_sets_equal(*frames: DataFrame) -> DataFrame:
    """Pages that not all frames have, with how many do; none means that the sets are equal."""
    every = frames[0].select("page").distinct()
    for f in frames[1:]:
        every = every.unionByName(f.select("page").distinct())
    return every.groupBy("page").agg(F.count("*").alias("n_frames")).filter(F.col("n_frames") < len(frames))


# fixed values, but for the looks ahead, which change no match and save time
#: Found by its digits, which are few; its function (group 1) is looked back at. In a scan text at most one space stands on each side of the dash.
ISA_TAG = rf"(?=\d)(?<=[A-Z]\s?-?\s?)(?<=(?<![A-Z0-9])((?:{ISA_FUNCTIONS})\s?-?\s?))\d{{1,8}}(?:[A-Z]{{1,4}})?(?![A-Z0-9])"
COMPACT_TAG = rf"(?=\d)(?<![A-Z0-9])\d{{3,8}}\s*(?:{ISA_FUNCTIONS})\s*\d{{1,8}}(?:[A-Z]{{1,4}})?(?![A-Z0-9])"
BROAD_TAG = r"(?=\d)(?<![A-Z0-9])\d{3,8}\s*[A-Z]{2,8}\s*\d{2,8}(?:[A-Z]{1,4})?(?![A-Z0-9])"
SERIAL_OR_REFERENCE = r"(?=\d)(?<!\d)\d{3,8}\s*[-/]\s*\d{1,8}(?!\d)"
_NEAR = {"near_tag": t.worded(TAG_FIELD), "near_equipment": t.worded(EQUIPMENT_CONTEXT)}


def tag_accepted(tag: Column, compact: Column, separated: Column, near: Column) -> Column:
    """Whether a tag counts: compact ones do, long ones if anything speaks for them, those of five characters or fewer only near a context."""
    size = F.length(tag)
    return compact | F.when(size > 5, separated | (size >= 7) | near).otherwise(near)


def tag_matches(s: Column) -> Column:
    """Tags in a scan text, compact ones first: structs of ``kind, tag, near_tag, near_equipment, accepted``."""

    def judged(kind: str, pattern: str) -> Column:
        def one(m: Column) -> Column:
            tag = F.regexp_replace(m["value"], r"\s+", "")
            ok = tag_accepted(tag, F.lit(kind == "compact_instrument_tag"), F.contains(m["value"], F.lit("-")), m["near_tag"] | m["near_equipment"])
            return F.struct(F.lit(kind).alias("kind"), tag.alias("tag"), m["near_tag"].alias("near_tag"), m["near_equipment"].alias("near_equipment"), ok.alias("accepted"))

        return F.transform(t.near_matches(s, pattern, _NEAR, headed=pattern == ISA_TAG), one)

    return F.concat(judged("compact_instrument_tag", COMPACT_TAG), judged("isa_instrument_tag", ISA_TAG))


def broad_tags(s: Column) -> Column:
    """Other compact identifiers near a tag field, in order."""
    near = F.filter(t.near_matches(s, BROAD_TAG, {"near_tag": t.worded(TAG_FIELD)}), lambda m: m["near_tag"])
    return F.array_distinct(F.transform(near, lambda m: F.regexp_replace(m["value"], r"\s+", "")))


def serial_references(s: Column) -> Column:
    """Serial numbers and references in a scan text, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(s, F.lit(SERIAL_OR_REFERENCE), F.lit(0)), lambda x: F.regexp_replace(x, r"\s+", "")))


def _evidence(s: Column) -> Column:
    """What one scan text shows, as a struct.

    Every identifier has a digit, and one scan tells whether any of the words occurs,
    so most patterns are looked for in few texts only.
    """
    some = s.rlike(t.worded("|".join([TAG_FIELD, SERIAL_FIELD, CERTIFICATE, EQUIPMENT_CONTEXT, TABLE_CONTEXT])))
    match = "array<struct<kind: string, tag: string, near_tag: boolean, near_equipment: boolean, accepted: boolean>>"

    def looked_at(any_of: Column) -> Column:
        where = lambda c, kind: F.when(any_of["digit"], c).otherwise(F.array().cast(kind))
        has = lambda words: any_of["word"] & s.rlike(t.worded(words))
        found = F.size(F.array_distinct(F.regexp_extract_all(s, F.lit(t.worded(TABLE_CONTEXT)), F.lit(0))))
        return F.struct(
            where(tag_matches(s), match).alias("matches"),
            where(broad_tags(s), "array<string>").alias("broad"),
            where(serial_references(s), "array<string>").alias("references"),
            has(TAG_FIELD).alias("tag_field"),
            has(SERIAL_FIELD).alias("serial_field"),
            has(CERTIFICATE).alias("certificate"),
            has(EQUIPMENT_CONTEXT).alias("equipment"),
            F.when(any_of["word"], found).otherwise(0).alias("table_terms"),
        )

    # bound, so that each of the two scans is done once
    return t.bind(F.struct(s.rlike("[0-9]").alias("digit"), some.alias("word")), looked_at)


def _reasons(e: Column, broad: Column) -> Column:
    """Why a text scores, in order and each once."""
    said = lambda label, x: F.concat(F.lit(f"{label}:"), x)

    def of(m: Column) -> Column:
        accepted = F.array(F.concat_ws(":", m["kind"], m["tag"]), F.when(m["near_tag"], said("tag_field_near", m["tag"])), F.when(m["near_equipment"], said("equipment_context_near", m["tag"])))
        return F.when(m["accepted"], accepted).otherwise(F.array(said("short_tag_rejected_without_context", m["tag"])))

    flags = F.array(
        F.when(e["tag_field"], "tag_field_present"),
        F.when(e["serial_field"], "serial_field_present"),
        F.when(e["serial_field"] & e["tag_field"], "serial_and_tag_fields_present"),
        F.when(e["certificate"], "certificate_or_declaration_present"),
        F.when(e["equipment"], "equipment_context_present"),
        F.when(e["table_terms"] > 0, "table_or_document_context_present"),
        F.when(e["table_terms"] >= 3, said("table_context_terms", e["table_terms"].cast("string"))),
    )
    every = F.concat(
        F.flatten(F.transform(e["matches"], of)),
        F.transform(broad, lambda x: said("broad_candidate_in_tag_context", x)),
        F.transform(e["references"], lambda x: said("serial_or_reference", x)),
        flags,
    )
    return F.array_distinct(F.array_compact(every))


def tag_evidence(rotations: DataFrame) -> DataFrame:
    """Tags, context, scores and reasons of each rotation's text (``page, rotation, text``)."""
    found = rotations.select("page", "rotation", t.bind(t.scan_text("text"), _evidence).alias("e"))
    e = F.col("e")
    good = F.filter(e["matches"], lambda m: m["accepted"])
    found = found.select("page", "rotation", "e", good.alias("good"), F.array_distinct(F.transform(good, lambda m: m["tag"])).alias("sure"))
    found = found.withColumn("broad", F.array_except(e["broad"], "sure"))
    point = lambda c, n: F.when(c, n).otherwise(0)
    bonus = F.aggregate("good", F.lit(0), lambda a, m: a + point(m["near_tag"], 5) + point(m["near_equipment"], 2))
    review = (
        point(e["tag_field"], 3)
        + point(e["serial_field"], 2)
        + point(e["tag_field"] & e["serial_field"], 3)
        + point(e["certificate"], 3)
        + point(e["equipment"], 1)
        + point(e["table_terms"] > 0, 1)
        + point(e["table_terms"] >= 3, 2)
    )
    return found.select(
        "page",
        "rotation",
        F.array_sort(F.concat("sure", "broad")).alias("tags"),
        F.array_sort(e["references"]).alias("serials"),
        e["tag_field"].alias("tag_field"),
        e["certificate"].alias("certificate"),
        e["equipment"].alias("equipment"),
        (e["table_terms"] > 0).alias("table"),
        (5 * F.size("sure") + bonus + 3 * F.size("broad")).alias("equipment_score"),
        review.alias("review_score"),
        F.size(e["references"]).alias("serial_score"),
        F.exists("good", lambda m: m["near_tag"] | m["near_equipment"]).alias("near"),
        F.exists("good", lambda m: m["near_equipment"]).alias("near_equipment"),
        _reasons(e, F.col("broad")).alias("reasons"),
    )


def merged_rotations(found: DataFrame) -> DataFrame:
    """One row for each page: largest scores, tags and reasons of all rotations, and the decision."""
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    turned = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("rotation")))), ",")
    said = F.array_sort(F.collect_list(F.struct("rotation", "reasons")))
    m = found.groupBy("page").agg(
        *[F.max(c).alias(c) for c in ("equipment_score", "review_score", "serial_score")],
        flat("tags").alias("tags"),
        flat("serials").alias("serials"),
        F.bool_or("near").alias("near"),
        F.bool_or(F.col("tag_field") & (F.col("equipment") | F.col("certificate"))).alias("field"),
        F.bool_or(F.col("equipment") | F.col("near_equipment")).alias("equipment"),
        F.bool_or("table").alias("table"),
        turned(F.col("near")).alias("strong_rotations"),
        turned(F.col("review_score") >= 5).alias("review_rotations"),
        F.flatten(F.transform(said, lambda r: F.transform(r["reasons"], lambda x: F.concat(r["rotation"].cast("string"), F.lit("deg:"), x)))).alias("reasons"),
    )
    decision = (
        F.when(F.col("near"), "tag_detected_with_context")
        .when(F.col("field") & F.col("equipment"), "tag_field_with_equipment_context")
        .when(F.size("tags") > 0, "tag_like_text_without_supporting_context")
        .when(F.size("serials") > 0, "serial_or_document_reference_only")
        .when(F.col("table"), "document_or_table_context_only")
        .otherwise("no_tag_evidence")
    )
    return m.select(
        "page",
        "equipment_score",
        "review_score",
        "serial_score",
        F.array_join("tags", ",").alias("tags"),
        F.array_join("serials", ",").alias("serials"),
        "strong_rotations",
        "review_rotations",
        F.array_join(F.array_distinct("reasons"), " | ").alias("reasons"),
        decision.alias("decision"),
        (F.col("near") | (F.col("field") & F.col("equipment"))).alias("selected"),
    )


def table_like(line: Column) -> Column:
    """Whether a line looks like a table's row: two filled cells between bars or tabs, or two spaces in a row."""
    bare = F.btrim(line)
    cells = lambda sep: F.size(F.filter(F.split(bare, sep), lambda x: F.btrim(x) != "")) >= 2
    return F.when(bare == "", False).when(F.contains(bare, F.lit("|")), cells(r"\|")).when(F.contains(bare, F.lit("\t")), cells("\t")).otherwise(bare.rlike(r"\s{2,}"))


def text_tables(pages: DataFrame) -> DataFrame:
    """Runs of two or more lines that look like table rows (``page, text``): ``page, first_line, n_lines, header``."""
    lines = pages.select("page", F.posexplode(F.split(t.text("text"), "\n")).alias("line_no", "line"))
    lines = lines.withColumn("like", table_like(F.col("line")))
    w = Window.partitionBy("page").orderBy("line_no")
    island = F.col("line_no") - F.row_number().over(w)
    runs = lines.filter("like").withColumn("island", island)
    out = runs.groupBy("page", "island").agg(F.min("line_no").alias("first_line"), F.count("*").alias("n_lines"), F.min_by(F.btrim("line"), "line_no").alias("header"))
    return out.filter("n_lines >= 2").drop("island")


def queue_order(priority: Column, route_: Column, score: Column, page: Column) -> list[Column]:
    return [F.desc(t.rank(priority, PRIORITY_RANK)), F.desc(t.rank(route_, ROUTE_RANK)), score.desc(), page]


# fixed values
EQUIPMENT_TERMS = (
    "EQUIPMENT", "VESSEL", "RECEIVER", "PUMP", "COMPRESSOR", "MOTOR", "TANK", "FILTER", "SEPARATOR", "EXCHANGER", "HEATER",
    "COOLER", "VALVE", "SKID", "PACKAGE", "BLOWER", "FAN", "GENERATOR", "TURBINE", "INSTRUMENT", "AIR",
)
TITLE_BLOCK_TERMS = ("SCALE", "SHEET", "DRAWN", "CHECKED", "APPROVED", "APPD", "DWN", "REVISION", "DOCUMENT NUMBER", "PURCHASER", "CLIENT REP")
REFERENCE_PREFIXES = ("RFT-", "GMMOS-", "IN-")
EXPLICIT_LABEL = r"\b(EQUIPMENT|VESSEL|PUMP|COMPRESSOR|MOTOR|SKID|PACKAGE)\s+(TAG|NO\.?|NUMBER)\b|\bTAG\s*(NO\.?|NUMBER|#)?\s*[:#]|\bEQUIPMENT\s*:"
DRAWING_LABEL = r"\b(DRG|DWG|DRAWING)"
DOCUMENT_LABEL = r"\b(DOC|DOCUMENT|QCP|WPS|WPQR|ITP|MDR|P&ID)\b"
JOB_LABEL = r"\bJOB"
EXCLUDE, ADMIT, REVIEW = "exclude_from_asset_admission", "admit_to_asset_candidate_queue", "review_for_asset_admission"


def _terms_in(text: Column, terms: tuple[str, ...]) -> Column:
    return F.filter(F.array(*[F.lit(x) for x in sorted(terms)]), lambda x: F.contains(text, x))


def nearby_terms(context: Column) -> Column:
    """The equipment terms that stand in a text, in order."""
    return _terms_in(F.upper(t.clean(context, t.EDGES)), EQUIPMENT_TERMS)


def tag_candidate(value: Column, context: Column) -> Column:
    """What an identifier in its line is: struct of type, score and recommendation."""

    def judged(c: Column) -> Column:
        ctx, v = c["ctx"], c["value"]
        n = F.size(_terms_in(ctx, EQUIPMENT_TERMS))
        full = v.rlike(rf"^(?:{t.FULL})$")
        explicit, document = ctx.rlike(EXPLICIT_LABEL), ctx.rlike(DOCUMENT_LABEL)
        prefix = F.exists(F.array(*[F.lit(p) for p in REFERENCE_PREFIXES]), lambda p: F.startswith(v, p))
        make = lambda kind, score, what: F.struct(F.lit(kind).alias("type"), score.cast("int").alias("score"), F.lit(what).alias("recommendation"))
        point = lambda c, n: F.when(c, n).otherwise(0)
        title = F.size(_terms_in(ctx, TITLE_BLOCK_TERMS)) >= 3
        total = point(explicit, 8) + F.least(F.lit(4), n) + point(ctx.rlike(t.PAIR), 3) - point(title, 5) + F.when(full, 2).otherwise(-2)
        return (
            F.when(ctx.rlike(DRAWING_LABEL) | prefix, make("drawing_or_document_reference", F.lit(-7), EXCLUDE))
            .when(document & ctx.rlike("SPECIFICATION|PROCEDURE|DOCUMENT"), make("document_or_procedure_reference", F.lit(-6), EXCLUDE))
            .when(full & explicit, make("likely_equipment_tag", F.lit(12), ADMIT))
            .when(full & (n >= 1), make("possible_equipment_tag", F.lit(6) + F.least(F.lit(3), n), REVIEW))
            .when(document, make("document_or_procedure_reference", F.lit(-6), EXCLUDE))
            .when(ctx.rlike(JOB_LABEL), make("job_number_or_reference", F.lit(-5), EXCLUDE))
            .when(total >= 10, make("likely_equipment_tag", total, ADMIT))
            .when(total >= 5, make("possible_equipment_tag", total, REVIEW))
            .otherwise(make("ambiguous_identifier", total, "review_only"))
        )

    up = lambda c: F.upper(t.clean(c, t.EDGES))
    return t.bind(F.struct(up(context).alias("ctx"), up(value).alias("value")), judged)


def batch_rows(pages: DataFrame, selected: DataFrame, route: str = "table_extraction", reason: str = "selected_tag_page") -> DataFrame:
    """Rows of a batch for the selected pages: ``document_id, page, recommended_route, reason``."""
    kept = pages.join(selected, "page", "left_semi")
    return kept.select("document_id", "page", F.lit(route).alias("recommended_route"), F.lit(reason).alias("reason"))


def page_review_queue(weak: DataFrame, fields: DataFrame, most: int = 2) -> DataFrame:
    """``page, review_reason``: pages of weak tag evidence, and those with ``most`` rows of ``fields`` or fewer."""
    sparse = fields.groupBy("page").agg(F.count("*").alias("n")).filter(F.col("n") <= most)
    named = lambda df, why: df.select(F.col("page").cast("long").alias("page"), F.lit(why).alias("review_reason"))
    return named(weak, "weak_tag_evidence").unionByName(named(sparse, "sparse_non_tabular_fields"))


def preview(text: Column, size: int = 40) -> Column:
    """The first characters of a text."""
    return F.left(text, F.lit(size))


def first_words(text: Column, n: int = 3) -> Column:
    return F.array_join(F.slice(F.split(F.btrim(text, F.lit(" ")), r"\s+"), 1, n), " ")
