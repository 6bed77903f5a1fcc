from __future__ import annotations

import json
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from pagequarry.plans import stages as st
from pagequarry.plans.registry import Inputs
from pagequarry.sources import readers as rd
from pagequarry.sources import documents, sinks, workbook
from pagequarry.streaming.resume import ingest

SF = "/root/testdata/sf0.001"


def page(n, texts):
    lines = [{"text": t, "confidence": 0.9, "bbox": {"x1": 1, "y1": k, "x2": 2, "y2": k + 1}, "source_kind": "detected_table_crop", "table_index": 0, "page_rotation_degrees": 0} for k, t in enumerate(texts)]
    return json.dumps({"document_id": "d", "page": n, "tables": [{"table_index": 0, "lines": lines}]}, indent=1)


def test_ocr_pages(spark, tmp_path):
    (tmp_path / "page_001.json").write_text(page(1, ["a", "b"]))
    (tmp_path / "page_002.json").write_text(page(2, ["c"]))
    (tmp_path / "page_003.json").write_text("{broken")
    (tmp_path / "other.json").write_text(page(9, ["z"]))
    assert sorted(r["text"] for r in rd.read_ocr_pages(spark, str(tmp_path)).collect()) == ["a", "b", "c"]
    assert [r["text"] for r in rd.read_ocr_pages(spark, str(tmp_path), [2]).collect()] == ["c"]


def test_ingestion_takes_up_where_it_ended(spark, tmp_path):
    src, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    src.mkdir()
    for n in (1, 2):
        (src / f"page_00{n}.json").write_text(page(n, ["x"]))
        ingest(spark, str(src), out, mark)
    ingest(spark, str(src), out, mark)
    assert sorted(r["page"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_csv_keeps_empty_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text('﻿a,b\n"p, ""q""",\n,"two\nlines"\n', encoding="utf-8")
    df = rd.read_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["a", "b"] and sorted(map(tuple, df.collect())) == [("", "two\nlines"), ('p, "q"', "")]
    sinks.write_csv(df, str(tmp_path / "y"), ["b"])
    assert rd.read_csv(spark, str(tmp_path / "y")).columns == ["b"]


def test_lists_and_contracts(spark):
    lines = spark.createDataFrame([(x,) for x in ("# 1", " 2 ", "2", "0", "x3", "004")], "value string")
    assert sorted(r["page"] for r in rd.page_numbers(lines).collect()) == [2, 4]
    batch = spark.createDataFrame([("d", 1, "table_extraction", "r")], "document_id string, page int, recommended_route string, reason string")
    assert rd.checked_batch(batch) is batch
    for bad in (batch.drop("reason"), batch.unionAll(batch.selectExpr("'e'", "page", "recommended_route", "reason")), batch.selectExpr("document_id", "page", "'other' as recommended_route", "reason")):
        with pytest.raises(rd.ContractError):
            rd.checked_batch(bad)
    with pytest.raises(rd.ContractError):
        rd.image_pages(spark.createDataFrame([("a/page_01.png",), ("b/page-1.png",)], "path string"))
    named = rd.resolve_columns(spark.createDataFrame([(1,)], "Tag_No int"), {"tag": ["tag", "tag_no"]})
    assert named.columns == ["tag"]
    with pytest.raises(rd.ContractError):
        rd.resolve_columns(named, {"serial": ["serial"]})
    last = rd.last_wins(spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, n int"), ["k"], "n")
    assert [r["v"] for r in last.collect()] == ["b"]


def test_policy_and_taxonomy(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"auto_accept": {"minimum_confidence": 0.5}}')
    p = rd.load_policy(str(tmp_path / "p.json"))
    assert p.min_confidence == 0.5 and p.high == 70
    assert rd.load_policy(f"file://{tmp_path}/p.json", spark) == p
    (tmp_path / "d.yaml").write_text("a1: {decision: accept_equipment_name, equipment_name: Pump}")
    assert [tuple(r) for r in rd.load_decisions(spark, f"file://{tmp_path}/d.yaml").collect()] == [("A1", "Pump")]
    (tmp_path / "t.yaml").write_text("classes:\n  index:\n    priority: high\n    route: native_text\n    keywords: [contents, contents]\n")
    assert rd.load_taxonomy(str(tmp_path / "t.yaml")) == [("index", "high", "native_text", ["contents", "contents"])]
    (tmp_path / "u.yaml").write_text("classes:\n  index:\n    priority: no\n")
    with pytest.raises(rd.ContractError):
        rd.load_taxonomy(str(tmp_path / "u.yaml"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(7, "x", "p"), (8, "x", "q")], "page int, kind string, text string")
    sinks.write_page_list(df, str(tmp_path / "list"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "list")).collect()) == ["007", "008"]
    s = sinks.summary(df, ["kind"], stage="s").first()
    assert (s["n_rows"], s["by_kind"], s["stage"]) == (2, {"x": 2}, "s") and "n_rows: 2" in sinks.report(sinks.summary(df, ["kind"]))
    sinks.write_jsonl(sinks.enveloped(df, ["text"]), str(tmp_path / "j"))
    assert sorted(r["text"] for r in rd.unwrapped(spark.read.json(str(tmp_path / "j"))).collect()) == ["p", "q"]
    assert sinks.header_only(spark, ["a"]).columns == ["a"]
    sinks.write_package({"rows": df}, str(tmp_path / "pkg"))
    assert rd.read_csv(spark, str(tmp_path / "pkg/lineage")).first()["n_rows"] == "2"


def test_stages_run_resume_and_slice(spark, tmp_path):
    plan, catalog = st.evidence_stages(), st.Catalog(spark, str(tmp_path / "tables"))
    inputs = {"evidence": Inputs(spark, SF).evidence}
    assert set(st.run(plan, catalog, inputs).values()) == {"ran"}
    assert set(st.run(plan, catalog, inputs).values()) == {"skipped"}
    assert list(st.run(plan, catalog, inputs, "7a", "7b", force=True)) == ["pattern_queue", "review_queue"]
    n = {t: catalog.load(t).count() for t in ("decided", "review_queue", "auto_accepted")}
    assert n["decided"] == n["review_queue"] + n["auto_accepted"] and n["auto_accepted"]
    with pytest.raises(rd.MissingInput):
        st.run(plan, st.Catalog(spark, str(tmp_path / "none")), {}, "7a", "7a")
    with pytest.raises(KeyError):
        st.selected(plan, "nothing")
    with pytest.raises(ValueError):
        st.selected(plan, "7b", "7a")
    assert catalog.first_of("missing", "decided").count() == n["decided"]


def test_plan_goes_on_without_what_failed(spark, tmp_path):
    few = spark.range(2)

    def broken(_, f):
        raise ValueError("no good")

    make = lambda name, needs, build: st.Stage(name, needs, (name,), build)
    plan = [make("a", (), broken), make("b", ("a",), lambda _, f: {"b": f["a"]}), make("c", (), lambda _, f: {"c": few})]
    catalog = st.Catalog(spark, f"file://{tmp_path}")
    assert st.run(plan, catalog, keep_going=True) == {"a": "failed", "b": "blocked", "c": "ran"}
    said = json.loads((tmp_path / "status.json").read_text())
    assert said["a"]["error"] == "no good" and said["c"]["status"] == "ran" and not (tmp_path / "status.json.partial").exists()
    assert [r["there"] for r in st.progress(plan, catalog).orderBy("position").collect()] == [False, False, True]
    with pytest.raises(ValueError):
        st.run(plan, catalog)
    assert st.run(plan[2:], catalog, force=("c",)) == {"c": "ran"} and st.run(plan[2:], catalog) == {"c": "skipped"}


def test_workbook_is_read_again(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a & b", 1), (' "x" <y>', None)], "name string, n int").coalesce(1)
    path = f"file://{tmp_path}/x.xlsx"
    for _ in range(2):
        workbook.write_workbook({"one & two": df, "none": df.limit(0)}, path)
    got = sorted((r["sheet"], r["row_no"], r["cells"]) for r in workbook.read_workbook(spark, path).collect())
    assert got == [("none", 1, ["name", "n"]), ("one & two", 1, ["name", "n"]), ("one & two", 2, ["a & b", "1"]), ("one & two", 3, [' "x" <y>', ""])]
    # many fragments, in the order of the frame
    monkeypatch.setattr(workbook, "FRAGMENT", 20_000)
    many = spark.range(30_000).select((30_000 - F.col("id")).alias("k"), F.concat(F.lit("été "), F.col("id")).alias("a.b")).orderBy("k")
    workbook.write_workbook({"many": many}, path)
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        assert z.testzip() is None
        assert 'ref="A1:B30001"' in z.read("xl/worksheets/sheet1.xml").decode()
    rows = sorted((r["row_no"], *r["cells"]) for r in workbook.read_workbook(spark, path).collect())
    assert rows == [(1, "k", "a.b")] + [(i + 1, str(i), f"été {30_000 - i}") for i in range(1, 30_001)]
    monkeypatch.setattr(workbook, "SHEET_ROWS", 100)
    with pytest.raises(ValueError):
        workbook.write_workbook({"many": many}, path)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["x.xlsx"]


def test_large_members_are_zip64(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "_LARGE", 10)
    zipped = workbook._Zip(spark, f"file://{tmp_path}/x.zip")
    texts = {"a": "x" * 1000, "b": "", "c": "y" * 5}
    for name, text in texts.items():
        zipped.add(name, [workbook._piece(text[:3]), workbook._piece(text[3:])])
    zipped.close()
    monkeypatch.undo()
    data = bytearray((tmp_path / "x.zip").read_bytes())
    # a field that holds the mark of the small limit is one of the large limit
    assert data.count(b"PK\x06\x06") == 1
    for a, b in ((b"x" * 70, b"y" * 9), (b"", b"abc"), (b"abc", b"")):
        assert workbook.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_full_texts_are_written_in_parts(spark, tmp_path):
    rows = [("d", p, f"page {p} é") for p in range(200)] + [("e", 1, ""), ("e", 2, None), ("e", 3, "end"), (None, 5, "no name")]
    pages = spark.createDataFrame(rows, "document_id string, page int, text string").repartition(3)
    folder = f"file://{tmp_path}/texts"
    index = documents.write_full_text(pages, folder)
    by_path = {}
    for r in index.collect():
        by_path.setdefault(r["document_id"], {}).setdefault(r["path"], []).append(r)
    for name, parts in by_path.items():
        whole = b"".join((tmp_path / "texts" / p).read_bytes() for p in sorted(parts))
        want = "\n".join(t or "" for d, _, t in rows if d == name).encode()
        assert whole == want
        for r in (r for p in parts.values() for r in p):
            text = next(t or "" for d, n, t in rows if (d, n) == (name, r["page"]))
            assert whole[r["offset"] : r["offset"] + r["bytes"]].decode() == text
    assert len(by_path["d"]) > 1
    assert {(r["document_id"], r["page"], r["text"]) for r in documents.read_pages(index, folder).collect()} == {(d, p, t or "") for d, p, t in rows}


def test_decisions_and_json_lines(spark, tmp_path):
    names = rd.parse_decisions(spark, "a1: {decision: accept_equipment_name, equipment_name: ' Pump '}\nb2: {decision: accept_equipment_name}\nc3: 4\n")
    assert [tuple(r) for r in names.collect()] == [("A1", "Pump")]
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n[2]\n{"a": \n  {"a": 3}\n')
    rows = rd.read_jsonl(spark, str(tmp_path / "x.jsonl"), spark.createDataFrame([], "a int").schema)
    assert sorted(r["a"] for r in rows.collect()) == [1, 3]


def test_timeouts_of_single_stages(spark, tmp_path):
    def waiting(batches):
        import time

        time.sleep(4)
        yield from batches

    make = lambda name, build: st.Stage(name, (), (name,), build)
    slow = lambda n: (lambda _, f: {n: spark.range(3).coalesce(1).mapInArrow(waiting, "id long")})
    catalog = st.Catalog(spark, f"file://{tmp_path}")
    done = st.run([make("long", slow("long")), make("limited", slow("limited"))], catalog, keep_going=True, timeout={"limited": 1})
    assert done == {"long": "ran", "limited": "failed"} and catalog.load("long").count() == 3


def test_workbook_frame_goes_on_in_further_sheets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "SHEET_ROWS", 1001)
    path, df = f"file://{tmp_path}/x.xlsx", spark.range(2500).select(F.col("id").alias("n")).orderBy("n")
    workbook.write_workbook({"many": df, "full": df.limit(1000), "few": df.limit(1)}, path, further=True)
    got = {(r["sheet"], r["row_no"]): r["cells"] for r in workbook.read_workbook(spark, path).collect()}
    want = {(s, k + 2): [str(k)] for s, n in (("many", 2500), ("full", 1000), ("few", 1)) for k in range(n)}
    assert got == want | {(s, 1): ["n"] for s in ("many", "full", "few")}
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        book = z.read("xl/workbook.xml").decode()
        assert z.testzip() is None and [book.count(f'name="{n}"') for n in ("many", "many (2)", "many (3)", "full", "few")] == [1] * 5
        assert z.read("xl/worksheets/sheet3.xml").decode().count("<row ") == 501


def test_batches_of_many_documents(spark):
    route = "table_extraction"
    row = "document_id string, page int, recommended_route string, reason string, b int"
    make = lambda *more: spark.createDataFrame([("a", 1, route, "", 1), ("a", 2, route, "", 1), ("b", 1, route, "", 2), *more], row)
    assert rd.checked_batches(make(), F.col("b")).count() == 3
    for bad in (("c", 1, route, "", 2), (None, 1, route, "", 2), ("c", 1, "ocr", "", 3), ("c", 1, None, "", 3)):
        with pytest.raises(rd.ContractError):
            rd.checked_batches(make(bad), F.col("b"))
    from pagequarry import plans

    got = plans.queries()["s20_batch_contract"](spark, SF)
    assert got.select("document_id").distinct().count() == Inputs(spark, SF).page_text.select("document_id").distinct().count() > 1


def test_evidence_comes_together_once_with_its_ids(spark, tmp_path):
    """Ids of any form come back as they were; rows are shuffled once, and stage tables made of the decisions read these."""
    from pagequarry.operators import evidence as ev

    ids = ["0a1b", "0A1B", "xyz", "abc", "", None, "0a1b"]
    rows = [("E1", "T1", "S1", "model", "v", i, p, "text", "tier_1_direct_tag_row", 0.99, 1.0) for p, i in enumerate(ids)]
    columns = "equipment_id string, equipment_tag string, serial_number string, field_name string, field_value string, evidence_id string, source_page int, source_text string, evidence_tier string, confidence double, selection_score double"
    evidence = spark.createDataFrame(rows, columns)
    best = ev.best_evidence(evidence)
    got = best.first()
    assert got["evidence_ids"] == ["0A1B", "0a1b", "abc", "xyz"] and got["n_rows"] == 7 and got["source_pages"] == list(range(7))
    assert best._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
    catalog = st.Catalog(spark, f"file://{tmp_path}/stages")
    read = []

    class Seen(st.Catalog):
        def save(self, name, df):
            read.append((name, sorted(f.rpartition("/")[0].rpartition("/")[2] for f in set(df.inputFiles()))))
            return super().save(name, df)

    st.run(st.evidence_stages(), Seen(spark, catalog.folder), {"evidence": evidence}, start="7b", stop="7b")
    assert [n for n, _ in read] == ["decided", "review_queue", "auto_accepted", "summary"]
    assert all(set(places) == {"decided"} for _, places in read[1:])
