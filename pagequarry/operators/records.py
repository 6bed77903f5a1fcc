"""Dense records: serial and tag pairing, values near anchors, completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t
from ..sources.files import written
from .measure import checked_broadcast

# fixed values
SERIAL = r"(?i)ser(?:ial)?\.?\s*(?:no|number)\.?\s*[:#-]?\s*(\d{4,})"
DIRECT = r"(?i)ser(?:ial)?\.?\s*(?:no|number)\.?\s*[:#-]+\s*(\d{4,})\s*tag\s*[:#-]?\s*([A-Z0-9-]{5,})"
TAG = r"(?i)(?:^|[^A-Z0-9])(\d{3,8}[A-Z]{1,10}\d{2,8})(?:[^A-Z0-9]|$)"
SET_POINT = r"(?i)(?:set\s*[12]|setpoint)\s*[:#-]?\s*(\d+(?:\.\d+)?\s*BAR)"
RANGE = r"(?i)(\d+(?:\.\d+)?\s*(?:/|-|TO)\s*\d+(?:\.\d+)?\s*BAR)"
MODEL = r"(?i)\b(MAH[A-Z0-9]{3,})\b"


def unit_confidence(c: Column) -> Column:
    """Confidence on the scale to 1, also where it was given to 100."""
    return F.when(c > 1, c / 100).otherwise(c)


def pair_score(direct: Column, tag: Column, confidence: Column, dy: Column) -> Column:
    n = F.length(tag)
    return F.when(direct, 10000.0).otherwise(0.0) + F.when(n >= 10, 1000.0).otherwise(0.0) + n * 10 + confidence * 100 - dy / 10


def _band(y: Column, height: float = 64.0) -> Column:
    """Which horizontal band of a page ``y`` lies in."""
    return F.floor(y / height)


def _counted(rows: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group of ``by`` in ``order``; tasks keep no more before they shuffle."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= most).drop("_r")


def pairs(lines: DataFrame) -> DataFrame:
    """Serial numbers with tags: on the same line, or from the first neighbour to the right on the same row.

    ``lines`` has ``page, line_no, text, confidence, x1, y1, x2, y2``; ``line_no`` tells
    the lines of a page apart. What a serial number reaches depends on its place
    only, and of tags in one place only the first two can be a neighbour, the second
    one for a line that is the first itself. So places meet, by bands of the page's
    height, and not lines; a page may have any number of these.
    """
    serial, mark = F.regexp_extract("text", SERIAL, 1), F.upper(F.regexp_extract("text", TAG, 1))
    found = F.struct(serial.alias("serial"), mark.alias("mark"), F.regexp_extract("text", DIRECT, 1).alias("direct_serial"), F.upper(F.regexp_extract("text", DIRECT, 2)).alias("direct_tag"))
    # a generator, so that each pattern runs once for a line
    read = lines.select("page", "line_no", "x1", "x2", "y1", "y2", unit_confidence(F.col("confidence")).alias("confidence"), F.inline(F.array(found)))
    direct = read.filter("direct_tag <> ''").select("page", "line_no", F.col("direct_serial").alias("serial"), F.col("direct_tag").alias("tag"), "confidence", F.lit(True).alias("direct"), F.lit(0.0).alias("dy"))
    reach = F.greatest(F.lit(26.0), (F.col("y2") - F.col("y1")) * 1.15)
    alone = read.filter("serial <> '' and direct_tag = ''").select("page", "line_no", "serial", "x2", "y1", reach.alias("reach"), "confidence")
    place = ["page", "x2", "y1", "reach"]
    asked = alone.select(*place).distinct()
    asked = asked.withColumn("band", F.explode(F.sequence(_band(F.col("y1") - F.col("reach")), _band(F.col("y1") + F.col("reach")))))
    others = read.filter("mark <> ''").select("page", F.col("line_no").alias("n_no"), F.col("mark").alias("tag"), F.col("x1").alias("nx1"), F.col("y1").alias("ny1"), F.col("confidence").alias("n_confidence"))
    others = _counted(others, ["page", "nx1", "ny1"], [F.col(c) for c in ("n_no", "tag", "n_confidence")], 2).withColumn("band", _band(F.col("ny1")))
    j = asked.join(others, ["page", "band"]).withColumn("dy", F.abs(F.col("ny1") - F.col("y1"))).filter((F.col("dy") <= F.col("reach")) & (F.col("nx1") >= F.col("x2") - 30))
    first = _counted(j, place, [F.col(c) for c in ("nx1", "dy", "n_no", "tag", "n_confidence")], 2)
    near = first.groupBy(*place).agg(F.array_sort(F.collect_list(F.struct("nx1", "dy", "n_no", "tag", "n_confidence"))).alias("near"))
    hit = F.get(F.filter("near", lambda n: n["n_no"] != F.col("line_no")), F.lit(0))
    split = alone.join(checked_broadcast(written(near, "near")), place).withColumn("b", hit).filter("b is not null")
    split = split.select("page", "line_no", "serial", "b.tag", F.least("confidence", "b.n_confidence").alias("confidence"), F.lit(False).alias("direct"), F.col("b.dy").alias("dy"))
    both = direct.unionByName(split)
    return both.withColumn("score", pair_score(F.col("direct"), F.col("tag"), F.col("confidence"), F.col("dy")))


def ranked_pairs(found: DataFrame) -> DataFrame:
    """Pairs with their rank for the page and serial number; rank 1 is the record, the others the audit."""
    w = Window.partitionBy("page", "serial").orderBy(F.desc("score"), F.desc(F.length("tag")), F.desc("confidence"), "line_no", "tag")
    return found.withColumn("rank", F.row_number().over(w))


def nearest_set_points(records: DataFrame, lines: DataFrame, most: float = 120.0) -> DataFrame:
    """The set point line of the page that is closest to each record's line, within ``most``.

    Of set points at one height the first line counts, and records at one height
    have the same one, so heights meet and not lines.
    """
    found = F.struct(F.regexp_extract("text", SET_POINT, 1).alias("set_point"))
    points = lines.select("page", F.col("y1").alias("sy"), F.col("line_no").alias("s_no"), F.inline(F.array(found))).filter("set_point <> ''")
    points = _counted(points, ["page", "sy"], [F.col("s_no"), F.col("set_point")], 1).withColumn("band", _band(F.col("sy")))
    asked = records.select("page", "y1").distinct().withColumn("band", F.explode(F.sequence(_band(F.col("y1") - most), _band(F.col("y1") + most))))
    j = asked.join(points, ["page", "band"]).withColumn("d", F.abs(F.col("sy") - F.col("y1"))).filter(F.col("d") <= most)
    best = j.groupBy("page", "y1").agg(F.min(F.struct("d", "s_no", "set_point")).alias("b"))
    return records.join(checked_broadcast(written(best, "nearest")), ["page", "y1"]).select("page", "line_no", F.col("b.set_point").alias("set_point"), F.col("b.d").alias("distance"))


def best_values(lines: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """The best value of each field on each page: complete and labelled ones first, then longer and surer ones."""
    hits = F.array(*[F.struct(F.lit(k).alias("field_name"), t.clean(F.upper(F.regexp_extract("text", p, 1))).alias("value")) for k, p in patterns.items()])
    x = lines.select("page", "line_no", "text", unit_confidence(F.col("confidence")).alias("confidence"), F.explode(hits).alias("h")).select("page", "line_no", "text", "confidence", "h.*").filter("value <> ''")
    complete = F.when(F.col("value").rlike(r"BAR$|^MAH"), 10000.0).otherwise(0.0)
    labelled = F.when(F.contains("text", F.lit(":")), 1000.0).otherwise(0.0)
    score = F.round(complete + labelled + F.length("value") * 10 + F.col("confidence") * 100, 6)
    best = x.withColumn("score", score).groupBy("page", "field_name").agg(F.max(F.struct("score", (-F.col("line_no")).alias("o"), "value")).alias("b"))
    return best.select("page", "field_name", F.col("b.value").alias("value"), F.col("b.score").alias("score"))


def completion(records: DataFrame, core: tuple[str, ...] = ("model", "equipment_description", "range_or_rating", "set_point")) -> DataFrame:
    """What records lack, whether their range has a lower end, and their review status."""
    missing = F.concat_ws(", ", *[F.when(F.col(c) == "", c) for c in core])
    no_low = (F.col("range_or_rating") != "") & ~F.upper("range_or_rating").rlike(r"\d+(\.\d+)?\s*(/|-|TO)\s*\d+")
    reason = F.concat_ws("; ", F.when(missing != "", F.concat(F.lit("missing "), missing)), F.when(no_low, "range lower limit not captured"))
    return records.select("*", reason.alias("review_reason"), F.when(reason == "", "complete").otherwise("review_required").alias("record_status"))
