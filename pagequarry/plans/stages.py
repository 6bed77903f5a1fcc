"""The stage plan: named builders, slices of it, and stage tables to start from."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..sources.readers import MissingInput
from ..streaming.progress import watched

Frames = dict[str, DataFrame]
Made = dict[str, DataFrame | Callable[[Frames], DataFrame]]


@dataclass(frozen=True)
class Stage:
    """A step that makes tables from tables. ``optional`` inputs may be missing.

    ``build`` may give a function in place of a table, which makes it of the tables
    there are by then, so that what is made of a stage's earlier table reads that.
    """

    name: str
    needs: tuple[str, ...]
    makes: tuple[str, ...]
    build: Callable[[SparkSession, Frames], Made]
    aliases: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()


class Catalog:
    """Stage tables in a folder, one Parquet table each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.rows: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def has(self, name: str) -> bool:
        return files.exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def load(self, name: str) -> DataFrame:
        if not self.has(name):
            raise MissingInput(f"there is no table {name} in {self.folder}")
        return self.spark.read.parquet(self.path(name))

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table; how many rows it has is counted on the way."""
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        self.rows[name] = seen.get["rows"]
        files.tidy_up(self.spark)
        return self.load(name)

    def known_rows(self, name: str) -> int | None:
        """The rows of a table that this catalog, or an earlier run by its ``status.json``, wrote."""
        if name not in self.rows and files.exists(self.spark, f"{self.folder}/status.json"):
            said = json.loads(files.get_text(self.spark, f"{self.folder}/status.json"))
            self.rows = {t: n for s in said.values() for t, n in s.get("rows_out", {}).items()} | self.rows
        return self.rows.get(name)

    def first_of(self, *names: str) -> DataFrame:
        """The first of several tables that exists."""
        for n in names:
            if self.has(n):
                return self.load(n)
        raise MissingInput(f"none of {', '.join(names)} is there")


def selected(stages: list[Stage], start: str | None = None, stop: str | None = None) -> list[Stage]:
    """The stages from ``start`` to ``stop``, by name or alias."""
    place = {k: i for i, s in enumerate(stages) for k in (s.name, *s.aliases)}
    for k in (start, stop):
        if k is not None and k not in place:
            raise KeyError(f"there is no stage {k}")
    a, z = place.get(start, 0), place.get(stop, len(stages) - 1)
    if a > z:
        raise ValueError(f"stage {start} comes after {stop}")
    return stages[a : z + 1]


def _within(spark: SparkSession, seconds: float | None, work: Callable[[], None]) -> None:
    """Run ``work``; after ``seconds`` its jobs are cancelled, which makes it raise."""
    if seconds is None:
        return work()
    sc, tag = spark.sparkContext, f"stage-{uuid.uuid4().hex}"
    sc.addJobTag(tag)
    sc.setInterruptOnCancel(True)
    timer = threading.Timer(seconds, sc.cancelJobsWithTag, [tag])
    timer.start()
    try:
        work()
    finally:
        timer.cancel()
        sc.removeJobTag(tag)


def run(
    stages: list[Stage],
    catalog: Catalog,
    inputs: Frames | None = None,
    start: str | None = None,
    stop: str | None = None,
    force: bool | tuple[str, ...] = False,
    keep_going: bool = False,
    timeout: float | dict[str, float] | None = None,
) -> dict[str, str]:
    """Run stages in order and save their tables; stages whose tables are all there are skipped unless forced.

    ``force`` is for all stages or names some. Returns what was done for each: ran,
    skipped, failed, or blocked by a failed one. The catalog's ``status.json`` says
    the same with seconds, errors, and the rows of the tables read (where a stage
    wrote them) and written, and is replaced after each stage; while a stage runs,
    ``progress.json`` says how many of its tasks are done. A failure
    ends the run, unless ``keep_going`` lets stages go on that don't need what
    failed; so does a stage that takes more than ``timeout`` seconds, which may be
    given for stages by name or alias; those not named have no limit then.
    """
    have, done, status, lost = dict(inputs or {}), {}, {}, set()
    for s in selected(stages, start, stop):
        began, error = time.time(), None
        forced = force is True or (isinstance(force, tuple) and bool({s.name, *s.aliases} & set(force)))
        limit = min((timeout[n] for n in (s.name, *s.aliases) if n in timeout), default=None) if isinstance(timeout, dict) else timeout

        def work(s: Stage = s) -> None:
            for n in (*s.needs, *s.optional):
                if n not in have and (n in s.needs or catalog.has(n)):
                    have[n] = catalog.load(n)
            made = s.build(catalog.spark, {n: have[n] for n in (*s.needs, *s.optional) if n in have})
            for m in s.makes:
                have[m] = catalog.save(m, made[m](have) if callable(made[m]) else made[m])

        if lost & set(s.needs):
            done[s.name] = "blocked"
        elif not forced and all(catalog.has(m) for m in s.makes):
            done[s.name] = "skipped"
        else:
            try:
                with watched(catalog.spark, f"{catalog.folder}/progress.json", stage=s.name):
                    _within(catalog.spark, limit, work)
                done[s.name] = "ran"
            except Exception as e:
                done[s.name], error = "failed", e
        if done[s.name] in ("failed", "blocked"):
            lost |= set(s.makes)
        rows = lambda names: {n: catalog.known_rows(n) for n in names if catalog.known_rows(n) is not None}
        status[s.name] = {"status": done[s.name], "seconds": round(time.time() - began, 3), "error": str(error)[:500] if error else "", "rows_in": rows((*s.needs, *s.optional)), "rows_out": rows(s.makes) if done[s.name] in ("ran", "skipped") else {}}
        files.put_text(catalog.spark, f"{catalog.folder}/status.json", json.dumps(status, indent=1))
        if error and not keep_going:
            raise error
    return done


def progress(stages: list[Stage], catalog: Catalog) -> DataFrame:
    """``position, stage, table_name, there, n_rows``: which tables of a plan exist by now, and their rows as far as known; for a view of a run that goes on elsewhere."""
    rows = [(k, s.name, m, catalog.has(m), catalog.known_rows(m)) for k, s in enumerate(stages) for m in s.makes]
    return catalog.spark.createDataFrame(rows, "position int, stage string, table_name string, there boolean, n_rows long")


def table_batch_stages(least: float = 0.8) -> list[Stage]:
    """From page images and OCR pages of a batch to accepted and unresolved rows.

    Rendering and OCR themselves are outside: the first two stages check and read
    what they left.
    """
    from ..functions import text as t
    from ..operators import tables as tb
    from ..sources import readers as rd

    row = [*tb.TABLE, "record_no"]

    def render(_, f):
        return {"rendered_pages": rd.image_pages(f["images"])}

    def image_ocr(_, f):
        lines = rd.parsed_ocr_pages(f["ocr_pages"]).join(f["rendered_pages"].select("page"), "page", "left_semi")
        return {"ocr_lines": lines.withColumnRenamed("table_index", "table_id")}

    def visual(_, f):
        return {"visual_rows": tb.visual_rows(tb.deduplicated(tb.by_source(f["ocr_lines"], "prefer_crop")))}

    def logical(_, f):
        return {"logical_rows": tb.logical_rows(f["visual_rows"])}

    def queue(_, f):
        rows = f["logical_rows"].filter("status = 'needs_review'")
        review_id = t.short_id("ROW-", *[F.col(c).cast("string") for c in row])
        return {"review_queue": rows.select("*", review_id.alias("review_id"), tb.review_priority(F.col("reason"), F.col("confidence")).alias("priority"))}

    def crops(_, f):
        parts = f["review_queue"].select("review_id", *tb.TABLE, F.explode(F.split("source_rows", ",")).alias("row_no"))
        boxes = f["visual_rows"].select(*tb.TABLE, F.col("row_no").cast("string").alias("row_no"), "x1", "y1", "x2", "y2")
        hull = [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]
        return {"review_crops": parts.join(boxes, [*tb.TABLE, "row_no"]).groupBy("review_id").agg(*hull).withColumn("crop", F.concat(F.col("review_id"), F.lit(".png")))}

    def review(_, f):
        rows = f["review_queue"].join(f["review_crops"].select("review_id", "crop"), "review_id", "left")
        return {"auto_review": tb.auto_review(rows, least)}

    def export(_, f):
        accepted = F.startswith("decision", F.lit("auto_accepted"))
        a = f["auto_review"]
        counts = a.groupBy("decision").agg(F.count("*").alias("n"))
        return {"accepted_rows": a.filter(accepted), "unresolved_rows": a.filter(~accepted), "export_summary": counts}

    return [
        Stage("render", ("images",), ("rendered_pages",), render),
        Stage("image_ocr", ("ocr_pages", "rendered_pages"), ("ocr_lines",), image_ocr),
        Stage("visual_rows", ("ocr_lines",), ("visual_rows",), visual),
        Stage("logical_rows", ("visual_rows",), ("logical_rows",), logical),
        Stage("review_queue", ("logical_rows",), ("review_queue",), queue),
        Stage("review_crops", ("review_queue", "visual_rows"), ("review_crops",), crops),
        Stage("auto_review", ("review_queue", "review_crops"), ("auto_review",), review),
        Stage("decision_export", ("auto_review",), ("accepted_rows", "unresolved_rows", "export_summary"), export),
    ]


def evidence_stages() -> list[Stage]:
    """From evidence to a reviewed registry."""
    from ..operators import evidence as ev

    def promote(_, f):
        return {"promoted": ev.promotion(f["evidence"]), "registry": ev.identity_registry(f["evidence"])}

    def queue(_, f):
        decided = ev.decide(ev.best_evidence(f["evidence"]))
        part = lambda rule: lambda have: have["decided"].filter(rule)
        return {"decided": decided, "review_queue": part("not auto_accepted"), "auto_accepted": part("auto_accepted"), "summary": lambda have: ev.summary(have["decided"])}

    def patterns(_, f):
        return {"patterns": ev.patterns(f["evidence"])}

    def final(_, f):
        checked = ev.identity_checks(f["registry"])
        return {"final_registry": checked}

    return [
        Stage("promote_evidence", ("evidence",), ("promoted", "registry"), promote, ("6g",)),
        Stage("pattern_queue", ("evidence",), ("patterns",), patterns, ("7a",)),
        Stage("review_queue", ("evidence",), ("decided", "review_queue", "auto_accepted", "summary"), queue, ("7b",)),
        Stage("final_registry", ("registry",), ("final_registry",), final, ("7g",)),
    ]
