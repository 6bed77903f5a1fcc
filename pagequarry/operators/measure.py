"""Measurement series: slots, schemas, observations and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sequence as sq
from ..functions import text as t

# fixed values
DIRECTIONS = {"rising": "rising", "falling": "falling", "increasing": "increasing", "decreasing": "decreasing", "ascending": "increasing", "descending": "decreasing"}
CANONICAL = {"increasing": "rising", "decreasing": "falling"}
TERMS = ("pressure", "reading", "measurement", "measured", "observed", "actual", "indicated", "value", "test", "calibration", "deviation", "error")
UNITS = ("bar", "mbar", "kpa", "mpa", "psi", "pa", "v", "mv", "kv", "a", "ma", "hz", "rpm", "°c", "°f")


def direction(c) -> Column:
    """The direction that a text names as a whole word, ascending as increasing and so on; empty if none."""
    low = F.lower(t.text(c))
    out = F.lit("")
    for word, name in reversed(DIRECTIONS.items()):
        out = F.when(low.rlike(rf"\b{word}\b"), name).otherwise(out)
    return out


def canonical_direction(c: Column) -> Column:
    out = c
    for k, v in CANONICAL.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def has_term(c) -> Column:
    return F.lower(t.text(c)).rlike(rf"\b({'|'.join(TERMS)})\b")


def unit(c) -> Column:
    """The longest unit that stands alone in a text, lower case; empty if none."""
    names = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    return F.regexp_extract(F.lower(t.text(c)), rf"(?:^|[^a-z°])({names})(?:[^a-z]|$)", 1)


def range_of(c) -> Column:
    """Lower and upper end of the first ``a to b`` with b > a; null if there is none."""
    pattern = r"([-+]?\d+(?:[.,]\d+)?)\s*(?:to|-|–|—)\s*([-+]?\d+(?:[.,]\d+)?)"
    low, high = (F.regexp_extract_all(F.lower(t.text(c)), F.lit(pattern), F.lit(k)) for k in (1, 2))
    pairs = F.transform(F.arrays_zip(low.alias("a"), high.alias("b")), lambda p: F.struct(t.number(p["a"]).alias("lower"), t.number(p["b"]).alias("upper")))
    return F.get(F.filter(pairs, lambda p: p["upper"] > p["lower"]), F.lit(0))


def slots(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Slots of header cells (``x, value``) by running-mean clusters of x; the tolerance follows the gaps."""
    item = F.struct(F.col("x").cast("double").alias("x"), F.col("value").cast("double").alias("value"), F.col("confidence").alias("confidence"))
    g = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def gaps(xs: Column) -> Column:
        every = F.transform(xs, lambda x, i: F.when(i > 0, x - F.get(xs, i - 1)))
        return F.array_sort(F.filter(every, lambda d: d.between(5, 90)))

    def tolerance(d: Column) -> Column:
        middle = F.try_element_at(d, (F.floor(F.size(d) / 2) + 1).cast("int"))
        return F.when(F.size(d) > 0, F.least(F.lit(80.0), F.greatest(F.lit(25.0), middle * 1.3))).otherwise(55.0)

    # each bound, so that the clusters don't compute all before them again at each x
    clustered = lambda xs: t.bind(t.bind(gaps(xs), tolerance), lambda most: sq.mean_clusters(xs, most))
    ids = t.bind(F.transform("items", lambda i: i["x"]), clustered)
    flat = g.select(*keys, F.explode(F.arrays_zip("items", ids.alias("ids"))).alias("z")).select(*keys, F.col("z.ids").alias("slot"), "z.items.*")
    return flat.groupBy(*keys, "slot").agg(F.avg("x").alias("x"), F.max_by("value", F.struct("confidence", -F.col("x"))).alias("value"), F.count("*").alias("support"))


SERIES = ("document_id", "direction")
BROADCAST_ROWS = 100_000


def checked_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a hint to broadcast it if it has ``most`` rows or fewer, counted up to one more."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def tracks(slots_: DataFrame, tolerance: float = 100.0, keys: tuple[str, ...] = SERIES) -> DataFrame:
    """Consensus tracks of slots over the pages of a document, by direction: mean x, modal value, pages and agreement.

    A group is one direction of one document, so its array is as long as the document has slots.
    """
    item = F.struct(F.col("x").cast("double").alias("x"), "page", "slot", F.round("value", 3).alias("value"))
    g = slots_.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    ids = sq.mean_clusters(F.transform("items", lambda i: i["x"]), F.lit(tolerance))
    flat = g.select(*keys, F.explode(F.arrays_zip("items", ids.alias("ids"))).alias("z")).select(*keys, F.col("z.ids").alias("track"), "z.items.*")
    modal = flat.groupBy(*keys, "track", "value").agg(F.count("*").alias("n"), F.min("x").alias("first"))
    modal = modal.groupBy(*keys, "track").agg(F.max_by("value", F.struct("n", -F.col("first"))).alias("value"), F.max("n").alias("agree"))
    base = flat.groupBy(*keys, "track").agg(F.avg("x").alias("x"), F.countDistinct("page").alias("n_pages"), F.count("*").alias("support"))
    return base.join(modal, [*keys, "track"]).select(*keys, "track", "x", "value", "n_pages", "support", (F.col("agree") / F.col("support")).alias("agreement"))


def rising_tracks(tracks_: DataFrame, keys: tuple[str, ...] = SERIES) -> DataFrame:
    """The tracks of each direction whose values form the longest strictly rising series from left to right."""
    g = tracks_.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("x", "track", "value", "n_pages"))).alias("items"))
    path = sq.rising_subsequence(F.transform("items", lambda i: i["value"]))
    kept = g.select(*keys, F.posexplode(F.transform(path, lambda p: F.get(F.col("items"), p))).alias("slot", "i"))
    return kept.select(*keys, (F.col("slot") + 1).alias("slot"), "i.track", "i.x", "i.value")


def gap_tolerance(schema: DataFrame, factor: float, default: float) -> DataFrame:
    """How far from a slot a value may lie, by direction: a share of the median gap, 35 to 120."""
    w = Window.partitionBy("direction").orderBy("x")
    gaps = schema.withColumn("gap", F.lead("x").over(w) - F.col("x")).groupBy("direction").agg(F.median(F.when(F.col("gap") > 0, F.col("gap"))).alias("gap"))
    return gaps.select("direction", F.least(F.lit(120.0), F.greatest(F.lit(35.0), F.coalesce("gap", F.lit(default)) * factor)).alias("tolerance"))


def nearest_slots(cells: DataFrame, schema: DataFrame, factor: float = 0.45, default: float = 100.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """The nearest slot of its direction for each cell (``cell_id, direction, x``) within the tolerance, with the columns of ``keep``.

    The schema has one row for each direction and slot, so its slots are an array
    for each direction, and cells are not shuffled if directions are counted to be few.
    """
    slots_ = schema.groupBy("direction").agg(F.collect_list(F.struct("x", "slot", "value")).alias("_slots"))
    s = slots_.join(gap_tolerance(schema, factor, default), "direction")
    near = F.array_min(F.transform("_slots", lambda k: F.struct(F.abs(F.col("x") - k["x"]).alias("distance"), k["slot"].alias("slot"), k["value"].alias("nominal"))))
    # a generator, so that the nearest one is found once
    found = cells.join(checked_broadcast(s), "direction").select("cell_id", "direction", *keep, "tolerance", F.inline(F.array(near)))
    return found.select("cell_id", "direction", "slot", "nominal", "distance", (F.col("distance") <= F.col("tolerance")).alias("within"), *keep)


def mapping_status(distance: Column, difference: Column, tolerance: float = 100.0) -> Column:
    return F.when((distance <= tolerance) & (difference <= 1.0), "matched_canonical_slot").when(distance <= tolerance, "x_matches_value_disagrees").otherwise("outside_canonical_track")


def territories(directions: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Ranges of x that don't overlap: halfway to the neighbours, the table's edges outside (``x, left, right``)."""
    w = Window.partitionBy(*keys).orderBy("x", "direction")
    before, after = (F.col("x") + F.lag("x").over(w)) / 2, (F.col("x") + F.lead("x").over(w)) / 2
    return directions.select(*keys, "direction", F.coalesce(before, F.col("left")).alias("from_x"), F.coalesce(after, F.col("right")).alias("to_x"))


def dominant_prefix(identifiers: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The most frequent numeric prefix of identifiers, or else letter family; ties to the lesser."""
    p = identifiers.select(*keys, F.regexp_extract("identifier", r"^0*(\d{3,12})-\d", 1).alias("prefix"), F.regexp_extract("identifier", r"^([A-Z]{1,12})[-_]", 1).alias("family"))
    modal = lambda c: p.filter(F.col(c) != "").groupBy(*keys, c).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(c).alias("v"))).alias(f"m_{c}"))
    every = p.select(*keys).distinct().join(modal("prefix"), list(keys), "left").join(modal("family"), list(keys), "left")
    return every.select(*keys, F.coalesce("m_prefix.v", F.lit("")).alias("prefix"), F.when(F.col("m_prefix").isNull(), F.coalesce("m_family.v", F.lit(""))).otherwise("").alias("family"))


def identifier_form(c) -> Column:
    """``003656-0001`` as ``3656-1``; other identifiers in upper case."""
    u = F.upper(F.btrim(t.text(c)))
    parts = [F.regexp_extract(u, r"^(\d{3,12})-(\d{1,6})$", k).try_cast("bigint").cast("string") for k in (1, 2)]
    return F.when(u.rlike(r"^\d{3,12}-\d{1,6}$"), F.concat_ws("-", *parts)).otherwise(u)


def sequence_checks(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Gaps and duplicates in the suffix numbers of each series."""
    g = rows.withColumn("suffix", t.suffix_number("identifier")).filter("suffix is not null").groupBy(*keys)
    g = g.agg(F.count("*").alias("n_rows"), F.collect_set("suffix").alias("s"), F.min("suffix").alias("first"), F.max("suffix").alias("last"))
    missing = F.array_sort(F.array_except(F.sequence("first", "last"), F.col("s")))
    return g.select(*keys, "n_rows", "first", "last", F.array_join(missing, ",").alias("missing"), (F.col("n_rows") - F.size("s")).alias("n_duplicates"))


def direction_bands(cells: DataFrame, keys: tuple[str, ...], least: float = 70.0, share: float = 0.3) -> DataFrame:
    """The range of x that each direction's headers reach, with a margin (``text, x1, x2``).

    Only cells that name a direction and a measurement count, and only those with a width.
    """
    wide = F.col("x2") - F.col("x1")
    margin = F.greatest(F.lit(least), wide * share)
    c = cells.select(*keys, "x1", "x2", direction("text").alias("direction"), has_term("text").alias("_term")).filter("direction <> '' and _term and x2 > x1")
    return c.groupBy(*keys, "direction").agg(F.min(F.greatest(F.lit(0.0), F.col("x1") - margin)).alias("from_x"), F.max(F.col("x2") + margin).alias("to_x"))


def direction_groups(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One hull for the header cells of each direction, with its centre and its different texts in order."""
    c = cells.withColumn("direction", direction("text")).filter((F.col("direction") != "") & has_term("text"))
    g = c.groupBy(*keys, "direction").agg(
        F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.min("y1").alias("y1"), F.max("y2").alias("y2"), F.array_join(F.array_sort(F.collect_set(t.clean("text"))), " | ").alias("text")
    )
    return g.withColumn("x_centre", (F.col("x1") + F.col("x2")) / 2)


def body_cells(cells: DataFrame, headers: DataFrame, keys: tuple[str, ...], below: float = 18.0) -> DataFrame:
    """The cells more than ``below`` under the lowest header of their group (``headers``: keys and ``bottom``)."""
    return cells.join(headers, list(keys)).filter(F.col("y") > F.col("bottom") + below).drop("bottom")


def row_groups(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows by the row number that cells were given, from 1: number of cells, and their texts from left to right."""
    parts = F.array_sort(F.collect_list(F.struct("x", "y", "text")))
    g = cells.filter("row_no > 0").groupBy(*keys, "row_no").agg(F.count("*").alias("n_cells"), parts.alias("p"))
    return g.select(*keys, "row_no", "n_cells", F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"))


def row_confidence(identifier: Column, rising: Column, falling: Column) -> Column:
    points = F.lit(45) + F.when(identifier != "", 20).otherwise(0) + F.when(rising, 15).otherwise(0) + F.when(falling, 15).otherwise(0)
    return F.least(points, F.lit(95)) / 100


def coverage_gaps(tags: DataFrame, schema: DataFrame, found: DataFrame) -> DataFrame:
    """Tags with the slots of the schema that they have no observation for.

    Each tag meets each slot, which is the result before what was found is taken
    out. The schema has one row for each direction and slot and is broadcast if it
    is counted to be small.
    """
    slots_ = checked_broadcast(schema.select("direction", "slot", F.col("value").alias("nominal")))
    every = tags.select("tag").distinct().crossJoin(slots_)
    return every.join(found.select("tag", "direction", "slot").distinct(), ["tag", "direction", "slot"], "left_anti")


def per_number(rows: DataFrame, keys: list[str], numbers: list[str], *aggregates: Column) -> DataFrame:
    """Rows that share ``keys`` and ``numbers`` as one, with aggregates over them, so that a number is made text once and not for each row."""
    # groups don't tell the two zeros apart, texts do
    zero = [F.when(F.col(c) == 0, F.col(c).cast("string")).alias(f"_zero_{c}") for c in numbers]
    groups = rows.groupBy(*keys, *[F.col(c).alias(f"_{c}") for c in numbers], *zero)
    # a number is told by an aggregate, so that no filter on its text goes below and looks at each row
    return groups.agg(*[F.max(c).alias(c) for c in numbers], *aggregates).drop(*[f"_{c}" for c in numbers], *[f"_zero_{c}" for c in numbers])


def resolved_gaps(gaps: DataFrame, layer: DataFrame) -> DataFrame:
    """Gaps with the values of a completed layer on tag, direction and nominal: resolved, none or in conflict."""
    key = ["tag", "direction", "nominal_text"]
    known = layer.groupBy(*key).agg(F.array_sort(F.collect_set(t.general(F.col("observed")))).alias("values"))
    j = gaps.withColumn("nominal_text", t.general(F.col("nominal"))).join(known, key, "left")
    n = F.size(F.coalesce("values", F.array().cast("array<string>")))
    status = F.when(n == 1, "resolved_from_completed_layer").when(n == 0, "unresolved_no_match").otherwise("unresolved_secondary_conflict")
    return j.select(*key, F.when(n == 1, F.get("values", F.lit(0))).otherwise("").alias("value"), status.alias("status"), n.alias("n_values"))


def reconciled(primary: DataFrame, review: DataFrame, layer: DataFrame) -> DataFrame:
    """One value for each key of primary or review rows: the primary's, or the only secondary one."""
    key = ["tag", "direction", "nominal_text"]
    last = primary.groupBy(*key).agg(F.max_by("observed", "seq").alias("p"))
    known = layer.groupBy(*key).agg(F.array_sort(F.collect_set(t.general(F.col("observed")))).alias("s"))
    every = last.select(*key).unionByName(review.select(*key)).distinct()
    j = every.join(last, key, "left").join(known, key, "left").withColumn("s", F.coalesce("s", F.array().cast("array<string>")))
    primary_, n = t.general(F.col("p")), F.size("s")
    status = F.when(F.col("p").isNotNull(), "primary_observation").when(n == 1, "resolved_from_completed_layer").when(n > 1, "unresolved_secondary_conflict").otherwise("unresolved")
    review_ = F.when(F.col("p").isNotNull(), "primary").when(n == 1, "secondary_verified").otherwise("review_required")
    value = F.when(F.col("p").isNotNull(), primary_).when(n == 1, F.get("s", F.lit(0))).otherwise("")
    return j.select(*key, value.alias("value"), status.alias("status"), review_.alias("review_status"))


def row_identifiers(words: DataFrame, row: str = "row_no") -> DataFrame:
    """The leftmost word of each row that has parts joined by hyphen, underscore or slash."""
    found = words.filter(F.upper("word").rlike("^[A-Z0-9]+([-_/][A-Z0-9]+)+$"))
    return found.groupBy(row).agg(F.min_by("word", "x").alias("identifier"))


def row_positions(words: DataFrame, row: str = "row_no", most: int = 10_000) -> DataFrame:
    """The leftmost integer of each row, from 1 to ``most``."""
    n = F.when(F.col("word").rlike(r"^\d+$"), F.col("word").try_cast("int"))
    return words.withColumn("n", n).filter(F.col("n").between(1, most)).groupBy(row).agg(F.min_by("n", "x").alias("position"))


def unique_bands(members: DataFrame) -> DataFrame:
    """Cells that lie in one band only (``n`` is their number of bands)."""
    return members.filter("n = 1").select("cell_id", "band")


def shares_terms(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether a text has one of the terms as a word between spaces."""
    return F.arrays_overlap(F.split(F.lower(text), " "), F.array(*[F.lit(x) for x in terms]))


def row_window(cells: DataFrame, anchors: DataFrame, keys: list[str], height: float = 62.0) -> DataFrame:
    """``cell_id, anchor``: anchors (``keys, anchor, ay``) within ``height`` above or below a cell of their group.

    Cells and anchors meet by bands of that height, a cell in the bands around its own.
    """
    band = F.floor(F.col("y") / height)
    near = cells.withColumn("_band", F.explode(F.array(band - 1, band, band + 1)))
    banded = anchors.withColumn("_band", F.floor(F.col("ay") / height))
    return near.join(banded, [*keys, "_band"]).filter(F.abs(F.col("y") - F.col("ay")) <= height).select("cell_id", "anchor")


def order_acceptance(declaration: Column) -> Column:
    """The five digits at the end of a declaration's reference, else nothing."""
    return F.regexp_extract(declaration, r"(\d{5})$", 1)


def valid_date(text: Column) -> Column:
    """A date from day, month and year or the other way round; null where it is none."""
    return F.coalesce(F.try_to_date(text, "dd-MM-yyyy"), F.try_to_date(text, "yyyy-MM-dd"))


def valid_serial(text: Column) -> Column:
    return text.rlike(r"^\d{6}$")


def first_available(sources: dict[str, DataFrame], names: tuple[str, ...]) -> DataFrame:
    """The first of some sources, by name, that is given."""
    found = next((n for n in names if n in sources), None)
    if found is None:
        raise KeyError(f"none of {', '.join(names)} is there")
    return sources[found]
