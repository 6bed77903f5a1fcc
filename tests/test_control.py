from __future__ import annotations

import json

import pytest
from pagequarry.plans import stages as st
from pagequarry.sources import binary, named
from pagequarry.streaming import ledger as lg
from pagequarry.streaming import progress as pr

from .test_stages import page


def folder_of(tmp_path, texts):
    tmp_path.mkdir(exist_ok=True)
    for n, text in texts.items():
        (tmp_path / f"page_{n:03d}.json").write_text(text)
    return f"file://{tmp_path}"


def test_named_readers_plan_files_and_skip_broken_ones(spark, tmp_path):
    folder = folder_of(tmp_path / "in", {1: page(1, ["a", "b"]), 2: page(2, ["c"]), 3: "{broken", 4: '{"page": "x"}', 5: page(6, ["d"])})
    (tmp_path / "in" / "notes.txt").write_text("no page")
    fmt = named.use(spark, "ocr_page_lines")
    lines = spark.read.format(fmt).option("partBytes", 1).load(folder)
    assert sorted((r["page"], r["line_no"], r["text"]) for r in lines.collect()) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (6, 0, "d")]
    assert lines.rdd.getNumPartitions() == 5
    one = spark.read.format(fmt).option("partBytes", 1).load(folder).filter("page in (1, 5)")
    # files of other pages are not opened; a file of another page than its name says has no row
    assert one.rdd.getNumPartitions() == 2 and sorted(r["text"] for r in one.collect()) == ["a", "b"]
    assert spark.read.format(fmt).load(folder).filter("page = 99").count() == 0
    with pytest.raises(KeyError):
        named.use(spark, "nothing")


def test_own_readers_come_before_the_fallback(spark, tmp_path):
    text = "intro\nTag | Serial\nA | 1\nB | 2\nend"
    (tmp_path / "page_7.txt").write_text(text)
    fallback = named.read_tables(spark, f"file://{tmp_path}").collect()
    assert [(r["page"], r["n_lines"]) for r in fallback] == [(7, 3)]

    @named.reader("own_tables", "page int, size int")
    def own(number, text):
        yield number, len(text)

    try:
        assert [tuple(r) for r in named.read_tables(spark, f"file://{tmp_path}").collect()] == [(7, len(text))]
    finally:
        named.READERS.pop("own_tables")


def pages_of(spark, tmp_path, **options):
    return lg.Pages(spark, f"file://{tmp_path}/in", *(f"file://{tmp_path}/{n}" for n in ("rows", "ledger", "mark")), **options)


def test_a_stopped_run_goes_on_and_equals_one_run(spark, tmp_path):
    texts = {n: page(n, [f"line {n}", "x"]) for n in range(1, 7)} | {8: "{broken"}
    for name in ("once", "stopped"):
        folder_of(tmp_path / name, {})
        folder_of(tmp_path / name / "in", texts)
    once = pages_of(spark, tmp_path / "once", files_at_once=2)
    once.run()

    calls = []

    def work(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return lg.ocr_page_work(batch)

    stopped = pages_of(spark, tmp_path / "stopped", files_at_once=2, work=work)
    with pytest.raises(Exception, match="stopped"):
        stopped.run()
    half = stopped.rows().count()
    assert 0 < half < 12
    stopped.run()
    rows = lambda p: sorted((r["page"], r["text"]) for r in p.rows().collect())
    assert rows(stopped) == rows(once) and len(rows(once)) == 12
    said = lambda p: sorted((r["path"].rpartition("/")[2], r["outcome"]) for r in p.latest().collect())
    assert said(stopped) == said(once) and ("page_008.json", "failed") in said(once)


def test_failed_pages_come_again_finished_ones_do_not(spark, tmp_path):
    folder_of(tmp_path / "in", {1: page(1, ["a"]), 2: "{broken", 3: '{"tables": []}'})
    pages = pages_of(spark, tmp_path, tries=3)
    pages.run()
    (tmp_path / "in" / "page_002.json").write_text(page(2, ["b"]))
    for _ in range(4):
        pages.run()
    got = {r["path"][-8:-5]: (r["outcome"], r["attempt"], r["error"]) for r in pages.latest().collect()}
    assert got == {"001": ("done", 1, None), "002": ("done", 2, None), "003": ("failed", 3, "no page number")}
    assert sorted(r["text"] for r in pages.rows().collect()) == ["a", "b"]
    # a batch that was written but not told is no result, and is replaced when it runs again
    spark.createDataFrame([("z",)], "text string").write.parquet(f"file://{tmp_path}/rows/batch=new-000099")
    assert sorted(r["text"] for r in pages.rows().collect()) == ["a", "b"]


def test_listener_tells_batches(spark, tmp_path):
    import time

    folder_of(tmp_path / "in", {n: page(n, ["a"]) for n in (1, 2, 3)})
    with pr.listened(spark) as seen:
        pages_of(spark, tmp_path, files_at_once=1).run()
        for _ in range(50):
            if len(seen.ended) and sum(b["rows"] for b in seen.batches) == 3:
                break
            time.sleep(0.2)
    assert sum(b["rows"] for b in seen.batches) == 3 and len(seen.batches) >= 3 and seen.ended


def test_stages_tell_their_rows_and_tasks(spark, tmp_path, monkeypatch):
    told = []
    put = pr.files.put_text
    monkeypatch.setattr(pr.files, "put_text", lambda s, path, text: (told.append(json.loads(text)) if path.endswith("progress.json") else None, put(s, path, text)))
    slow = spark.range(400, numPartitions=8)
    plan = [st.Stage("a", ("given",), ("x",), lambda _, f: {"x": slow}), st.Stage("b", ("x",), ("y", "z"), lambda _, f: {"y": f["x"].filter("id < 10"), "z": f["x"].limit(0)})]
    catalog = st.Catalog(spark, f"file://{tmp_path}/t")
    st.run(plan, catalog, {"given": spark.range(3)})
    said = json.loads((tmp_path / "t/status.json").read_text())
    assert said["a"]["rows_out"] == {"x": 400} and said["b"]["rows_in"] == {"x": 400} and said["b"]["rows_out"] == {"y": 10, "z": 0}
    assert {t["stage"] for t in told} == {"a", "b"} and not told[-1]["running"]
    # another process, and a run that skips all, know the same
    later = st.Catalog(spark, f"file://{tmp_path}/t")
    assert set(st.run(plan, later).values()) == {"skipped"}
    assert [r["n_rows"] for r in st.progress(plan, later).orderBy("position", "table_name").collect()] == [400, 10, 0]


def test_files_are_whole_and_named_once(spark, tmp_path):
    rows = spark.createDataFrame([("a.bin", b"\x00" * 100_000), ("b.bin", b""), ("c.bin", None), (None, b"x")], "name string, content binary")
    kept = {r["name"]: r["bytes"] for r in binary.write_files(rows, f"file://{tmp_path}/out").collect()}
    assert kept == {"a.bin": 100_000, "b.bin": 0, "c.bin": 0}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.bin", "b.bin", "c.bin"]


def test_pages_come_together_once_and_are_read_in_batches(spark):
    import pyarrow as pa

    from pagequarry.plans import storage_queries
    from pagequarry.plans.registry import Inputs

    plan = storage_queries._page_texts(Inputs(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("- Exchange ") == 2 and "ENSURE_REQUIREMENTS" not in plan
    lines = [{"text": str(k), "confidence": 1, "bbox": {"x1": k}} for k in range(named.BATCH_ROWS + 1)]
    found = list(named.ocr_page_lines(0, json.dumps({"page": 3, "tables": [{"lines": lines}]})))
    assert [type(b) for b in found] == [pa.RecordBatch] * 2 and sum(b.num_rows for b in found) == len(lines)
    assert found[1].to_pylist() == [{"document_id": None, "page": 3, "table_index": 0, "line_no": named.BATCH_ROWS, "text": str(named.BATCH_ROWS), "confidence": 1.0, "x1": float(named.BATCH_ROWS), "x2": None, "y1": None, "y2": None, "source_kind": None}]


def test_ledger_parses_a_page_as_its_lines_are(spark):
    texts = spark.createDataFrame([("a", '{"page": 4, "tables": []}'), ("b", '{"page": "4"}'), ("c", '{"page": 4'), ("d", '{"no": 4}')], "path string, value string")
    _, told = lg.ocr_page_work(texts)
    assert {r["path"]: (r["page"], r["error"]) for r in told.collect()} == {"a": (4, None), "b": (None, "broken page"), "c": (None, "broken page"), "d": (None, "no page number")}


def test_a_page_in_parts_has_the_same_lines(spark):
    """Texts of parts of pages are shorter, whole in themselves, and hold the same lines; broken pages are broken in all parts."""
    from pyspark.sql import functions as F

    from pagequarry.plans import storage_queries
    from pagequarry.plans.registry import Inputs
    from pagequarry.sources.readers import parsed_ocr_pages

    i = Inputs(spark, "/root/testdata/sf0.001")
    one, some = storage_queries._page_texts(i).cache(), storage_queries._page_texts(i, parts=5).cache()
    longest = lambda texts: texts.agg(F.max(F.length("value"))).first()[0]
    assert some.count() > 2 * one.count() and longest(some) < longest(one) * 0.7
    a, b = (sorted(map(tuple, parsed_ocr_pages(t.select("value")).collect()), key=str) for t in (one, some))
    assert a == b and a and all(r[1] % 7 for r in a)
    one.unpersist(), some.unpersist()
