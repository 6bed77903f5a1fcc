"""Removal of lines that many sites share, in DataFrame functions only.

The spread of a line is the number of different sites that it occurs on. Lines
on one site only are told apart by the least and the greatest site; of the
others, HyperLogLog sketches of the sites are merged for each line hash. Where
an estimate is near the threshold, sites are counted exactly, so the decisions
are those of exact counts. A line is known by two hashes of 64 bits each. Texts
are split once; what follows reads the written hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_table

MIN_SITES = 10
SKETCH_BITS = 12
BLANKS = " \t\r"
LINE = ["line", "line2"]
SALTS = 16


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """Columns that tell rows apart, also where ids repeat or are null."""
    return [F.xxhash64(doc_id, text).alias("_row"), F.coalesce(doc_id.cast("string"), F.lit("")).alias("_doc")]


def lines(docs: DataFrame) -> DataFrame:
    """``_row, _doc, site, position, line, line2``: a row for each line that isn't blank.

    ``line`` and ``line2`` are hashes of the line without blanks around it.
    """
    rows = docs.filter("text is not null").select(
        *_row_key(F.col("doc_id"), F.col("text")),
        F.coalesce("source", F.lit("")).alias("site"),
        F.posexplode(F.split("text", "\n", -1)).alias("position", "_line"),
    )
    bare = F.btrim("_line", F.lit(BLANKS))
    return rows.filter(bare != "").select("_row", "_doc", "site", "position", F.xxhash64(bare).alias("line"), F.xxhash64(F.lit(1), bare).alias("line2"))


def shared_lines(found: DataFrame, min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``line, line2``: hashes of lines on ``min_sites`` different sites or more."""
    seen = found.select(*LINE, "site", F.pmod("_row", F.lit(SALTS)).cast("int").alias("salt"))
    if min_sites <= 1:
        return seen.select(*LINE).distinct()
    site = F.xxhash64("site")
    several = seen.groupBy(*LINE).agg(F.min(site).alias("a"), F.max(site).alias("z")).filter("a <> z").select(*LINE)
    several = stage_table(several, "lines")
    # a frequent line's rows are joined and sketched in as many tasks as there are salts
    salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sketches = seen.join(salted, [*LINE, "salt"], "left_semi").groupBy(*LINE, "salt").agg(F.hll_sketch_agg("site", F.lit(sketch_bits)).alias("sketch"))
    sketches = sketches.groupBy(*LINE).agg(F.hll_union_agg("sketch").alias("sketch"))
    spread = stage_table(sketches.select(*LINE, F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    # five standard errors of a sketch on either side
    band = 5 * 1.04 / 2 ** (sketch_bits / 2)
    sure = spread.filter(F.col("sites") > min_sites * (1 + band)).select(*LINE)
    near = spread.filter(F.col("sites").between(min_sites * (1 - band) - 1, min_sites * (1 + band))).select(*LINE)
    exact = seen.join(near, LINE, "left_semi").select(*LINE, "site").distinct().groupBy(*LINE).count().filter(F.col("count") >= min_sites)
    return sure.unionByName(exact.select(*LINE))


def without_shared_lines(docs: DataFrame, min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``docs`` with all its columns, ``text`` without lines that ``min_sites`` sites share, and ``n_lines, n_removed``.

    Lines are parted by newlines and compared without blanks around them; blank
    lines stay. A document none of whose lines is its own, since each is shared,
    is a copy and not a carrier of boilerplate; it stays whole, for
    near-duplicate removal to decide. A null source is a site of its own. A null
    text stays null and has no lines. Repeated rows are treated alike; other
    columns pass through, except that ``n_lines`` and ``n_removed`` are replaced;
    an empty table gives an empty one.
    """
    found = stage_table(lines(docs), "found")
    shared = stage_table(shared_lines(found, min_sites, sketch_bits), "shared-lines")
    drops = found.join(shared, LINE, "left_semi").groupBy("_row", "_doc").agg(F.collect_set("position").alias("_drop"))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # a struct, so that no column of the table can clash with those added here
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_r"), *_row_key(F.col("doc_id"), F.col("text")))
    joined = keyed.join(drops, ["_row", "_doc"], "left")
    text = F.col("_r.text")
    parts = F.split(text, "\n", -1)
    kept = F.filter(parts, lambda x, i: ~F.array_contains("_drop", i))
    own = F.exists(kept, lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    cut = joined.withColumn("_kept", F.when(F.col("_drop").isNotNull(), F.when(own, kept)))
    whole = F.col("_kept").isNull()
    return cut.select(
        *[F.when(whole, text).otherwise(F.array_join("_kept", "\n")).alias("text") if c == "text" else F.col(f"_r.`{c}`").alias(c) for c in columns],
        F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("_drop")).cast("long").alias("n_removed"),
    )


def digests(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce(source, '') AS site FROM documents),
parts AS (SELECT r, site, string_split(text, chr(10)) AS p FROM rows WHERE text IS NOT NULL),
lines AS (SELECT r, site, unnest(p) AS raw, generate_subscripts(p, 1) AS position FROM parts),
found AS (SELECT r, site, position, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM lines WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''),
shared AS (SELECT line FROM found GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
marked AS (SELECT r, position, line IN (SELECT line FROM shared) AS gone FROM found),
drops AS (SELECT r, list(position) FILTER (WHERE gone) AS gone FROM marked GROUP BY r HAVING bool_or(gone) AND NOT bool_and(gone))
SELECT doc_id,
       CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines,
       coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN coalesce(text, '')
              ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i)), chr(10)) END) AS kept_sha256
FROM rows LEFT JOIN drops USING (r)
"""
