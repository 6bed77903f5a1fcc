"""Readers of the files that stages exchange, and checks of what they hold."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import files

BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])
LINE = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("bbox", BOX),
        T.StructField("source_kind", T.StringType()),
        T.StructField("table_index", T.IntegerType()),
        T.StructField("page_rotation_degrees", T.IntegerType()),
    ]
)
OCR_PAGE = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("source_image", T.StringType()),
        T.StructField("selected_rotation_degrees", T.IntegerType()),
        T.StructField("selected_score", T.DoubleType()),
        T.StructField("tables", T.ArrayType(T.StructType([T.StructField("table_index", T.IntegerType()), T.StructField("bbox", BOX), T.StructField("crop_file", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lines", T.ArrayType(LINE))]))),
    ]
)


class MissingInput(FileNotFoundError):
    """A stage needs a table that does not exist."""


class ContractError(ValueError):
    """A table breaks the contract of the stage that reads it."""


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns text, missing values empty."""
    df = spark.read.csv(path, header=True, encoding="UTF-8", multiLine=True, escape='"', nullValue="\0", emptyValue="")
    return df.na.fill("")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file with an object on each line; other lines are left out."""
    if schema is None:
        return spark.read.option("mode", "DROPMALFORMED").json(path)
    lines = spark.read.text(path).filter(F.startswith(F.btrim("value"), F.lit("{")))
    parsed = lines.select(F.from_json("value", T.StructType([*schema, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.filter("r is not null and r._bad is null").select("r.*").drop("_bad")


def parsed_ocr_pages(texts: DataFrame, pages: list[int] | None = None) -> DataFrame:
    """Lines of OCR pages (``value``, a JSON object each), one row for each; broken pages are left out.

    ``document_id, page, table_index, line_no, text, confidence, x1, y1, x2, y2, source_kind``.
    """
    schema = T.StructType([*OCR_PAGE, T.StructField("_bad", T.StringType())])
    # a generator, so that a page is parsed once
    parsed = F.explode(F.array(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})))
    df = texts.select(parsed.alias("r")).filter("r._bad is null and r.page is not null").select("r.*")
    if pages is not None:
        df = df.filter(F.col("page").isin(*pages))
    tables = df.select("document_id", "page", F.posexplode("tables").alias("table_no", "table"))
    lines = tables.select("document_id", "page", F.coalesce("table.table_index", "table_no").alias("table_index"), F.posexplode("table.lines").alias("line_no", "line"))
    return lines.select("document_id", "page", "table_index", "line_no", "line.text", "line.confidence", "line.bbox.*", "line.source_kind")


def read_ocr_pages(spark: SparkSession, path: str, pages: list[int] | None = None) -> DataFrame:
    """``parsed_ocr_pages`` of a folder of files, a page each."""
    return parsed_ocr_pages(spark.read.option("pathGlobFilter", "page_*.json").text(path, wholetext=True), pages)


def unwrapped(rows: DataFrame) -> DataFrame:
    """Rows whose fields stand in ``raw_record`` or ``review`` envelopes, with the fields at the top."""
    found = set(rows.columns)
    if "raw_record" not in found:
        return rows
    inner = rows.schema["raw_record"].dataType.names
    extra = [F.col("review.review_id")] if "review" in found and "review_id" in rows.schema["review"].dataType.names else []
    own = [F.col("review_id")] if "review_id" in found else []
    ids = [F.coalesce(*([F.col("raw_record.review_id")] if "review_id" in inner else []), *own, *extra).alias("review_id")] if own or extra or "review_id" in inner else []
    return rows.select(*[F.col(f"raw_record.{c}").alias(c) for c in inner if c != "review_id"], *ids)


def page_numbers(lines: DataFrame) -> DataFrame:
    """Different page numbers of a list with one on each line (``value``); other lines, comments and 0 are left out."""
    value = F.btrim("value")
    return lines.filter(value.rlike(r"^\d{1,9}$")).select(value.cast("int").alias("page")).filter("page >= 1").distinct()


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def image_pages(paths: DataFrame) -> DataFrame:
    """``path, page`` from file names such as ``page_007.png``; raises if two files are one page."""
    out = paths.select("path", F.regexp_extract("path", r"page[_-]?0*(\d+)", 1).try_cast("int").alias("page")).filter("page is not null")
    if not out.groupBy("page").count().filter("count > 1").isEmpty():
        raise ContractError("two images are one page")
    return out


def resolve_columns(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Rename columns to logical names by the first alias found, without case; raises on what is missing."""
    low = {c.lower(): c for c in df.columns}
    found = {k: next((low[a.lower()] for a in names if a.lower() in low), None) for k, names in aliases.items()}
    missing = sorted(k for k, v in found.items() if v is None)
    if missing:
        raise ContractError(f"columns are missing: {', '.join(missing)}")
    return df.select(*[F.col(v).alias(k) for k, v in found.items()])


def checked_batch(df: DataFrame, columns: tuple[str, ...] = ("document_id", "page", "recommended_route", "reason"), route: str = "table_extraction") -> DataFrame:
    """A batch of one document whose pages all take one route; raises otherwise."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"columns are missing: {', '.join(missing)}")
    row = df.agg(F.count_distinct("document_id").alias("n"), F.count_if(F.col("recommended_route") != route).alias("other")).first()
    if row["n"] != 1:
        raise ContractError("a batch holds one document")
    if row["other"]:
        raise ContractError(f"a batch holds pages of the route {route} only")
    return df


def checked_batches(df: DataFrame, batch: Column, columns: tuple[str, ...] = ("document_id", "page", "recommended_route", "reason"), route: str = "table_extraction") -> DataFrame:
    """Batches, told apart by ``batch``, each of one document whose pages all take one route; raises otherwise. None is left out; a missing document is one, too."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"columns are missing: {', '.join(missing)}")
    ids = df.groupBy(batch.alias("batch")).agg(F.min("document_id").alias("lo"), F.max("document_id").alias("hi"), F.count_if(F.col("document_id").isNull()).alias("none"), F.count_if(~F.col("recommended_route").eqNullSafe(F.lit(route))).alias("other"))
    row = ids.agg(F.count_if((F.col("lo") != F.col("hi")) | ((F.col("none") > 0) & F.col("lo").isNotNull())).alias("mixed"), F.sum("other").alias("other"), F.count("*").alias("n")).first()
    if not row["n"] or row["mixed"]:
        raise ContractError("a batch holds one document")
    if row["other"]:
        raise ContractError(f"a batch holds pages of the route {route} only")
    return df


def parse_policy(text: str):
    """A review policy in JSON; what it leaves out keeps its default."""
    from ..operators.evidence import Policy

    raw, p = json.loads(text), Policy()
    auto, bands = raw.get("auto_accept", {}), raw.get("priority_thresholds", {})
    return Policy(
        tuple(raw.get("identity_fields", p.identity_fields)),
        tuple(raw.get("risk_fields", p.risk_fields)),
        raw.get("tier_rank", p.tier_rank),
        auto.get("maximum_candidate_values", auto.get("max_candidate_values", p.max_values)),
        auto.get("minimum_tier_rank", p.min_rank),
        auto.get("minimum_confidence", p.min_confidence),
        bands.get("high", p.high),
        bands.get("medium", p.medium),
    )


def parse_taxonomy(text: str) -> list[tuple[str, str, str, list[str]]]:
    """A taxonomy in YAML as (class, priority, route, keywords), in its order; raises on a malformed one."""
    import yaml

    from ..operators.pages import PRIORITY_RANK, ROUTE_RANK

    classes = (yaml.safe_load(text) or {}).get("classes")
    if not isinstance(classes, dict) or not classes:
        raise ContractError("a taxonomy has classes")
    out = []
    for name, spec in classes.items():
        if spec.get("priority") not in PRIORITY_RANK or spec.get("route") not in ROUTE_RANK or not spec.get("keywords"):
            raise ContractError(f"class {name} needs a priority, a route and keywords")
        out.append((name, spec["priority"], spec["route"], [str(k) for k in spec["keywords"]]))
    return out


def parse_decisions(spark: SparkSession, text: str) -> DataFrame:
    """``tag, equipment_name`` of the decisions in YAML that accept a name."""
    import yaml

    raw = yaml.safe_load(text) or {}
    found = [(str(k).strip().upper(), v.get("decision"), str(v.get("equipment_name") or "").strip()) for k, v in (raw.get("decisions") or raw).items() if isinstance(v, dict)]
    rows = [(tag, name) for tag, decision, name in found if decision == "accept_equipment_name" and name]
    return spark.createDataFrame(rows, "tag string, equipment_name string")


def _text(path: str, spark: SparkSession | None) -> str:
    """A small file's text: from the session's file systems, or from the driver's disk if there is no session."""
    return files.get_text(spark, path) if spark else Path(path).read_text()


def load_policy(path: str, spark: SparkSession | None = None):
    return parse_policy(_text(path, spark))


def load_taxonomy(path: str, spark: SparkSession | None = None) -> list[tuple[str, str, str, list[str]]]:
    return parse_taxonomy(_text(path, spark))


def load_decisions(spark: SparkSession, path: str) -> DataFrame:
    return parse_decisions(spark, _text(path, spark))
