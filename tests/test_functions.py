from __future__ import annotations

import itertools
import random
import time

from pyspark.sql import functions as F

from pagequarry.functions import geometry as g
from pagequarry.functions import sequence as sq
from pagequarry.functions import text as t
from pagequarry.operators import evidence as ev
from pagequarry.operators import measure as ms
from pagequarry.operators import pages as pg
from pagequarry.operators import tables as tb


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def doubles(values):
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def test_mean_clusters(spark):
    assert one(spark, sq.mean_clusters(doubles([1, 2, 10, 11]), F.lit(3.0))) == [1, 1, 2, 2]
    assert one(spark, sq.mean_clusters(F.array().cast("array<double>"), F.lit(3.0))) == []


def test_rising_subsequence_is_longest(spark):
    rnd = random.Random(3)
    for _ in range(25):
        v = [rnd.randint(0, 9) for _ in range(rnd.randint(1, 9))]
        path = one(spark, sq.rising_subsequence(doubles(v)))
        got = [v[i] for i in path]
        assert path == sorted(path) and all(a < b for a, b in itertools.pairwise(got))
        best = max(k for k in range(1, len(v) + 1) if any(all(a < b for a, b in itertools.pairwise(c)) for c in itertools.combinations(v, k)))
        assert len(got) == best
    assert one(spark, sq.rising_subsequence(doubles([0, 20, 20, 15, 40, 60, 5]))) == [0, 1, 4, 5]


def test_greedy_keeps_what_does_not_overlap(spark):
    kept = one(spark, sq.greedy(doubles([1, 1.5, 3, 3.2, 9]), lambda k, x: F.abs(k - x) < 1, "array<double>"))
    assert kept == [1, 3, 9]


def test_replacement_takes_the_place_of_the_first_match(spark):
    got = one(spark, sq.replace_matching(doubles([1.0, 5.0, 1.4, 5.2]), lambda k, x: F.abs(k - x) < 1, lambda x, k: x > k, "array<double>"))
    assert got == [1.4, 5.2]


def test_sessions_look_back_to_the_lowest_row(spark):
    items = F.array(*[F.struct(F.lit(a).alias("y1"), F.lit(b).alias("y2")) for a, b in [(0.0, 300.0), (10.0, 20.0), (400.0, 410.0), (700.0, 710.0)]])
    assert one(spark, sq.sessions(items, lambda r, y2: r["y1"] - y2 > 180)) == [1, 1, 1, 2]


def test_merged_boxes_reach_a_fixed_point(spark):
    box = lambda *v: F.struct(*[F.lit(float(x)).alias(k) for k, x in zip(("x1", "y1", "x2", "y2"), v, strict=True)])
    got = one(spark, sq.merged_boxes(F.array(box(0, 0, 10, 10), box(200, 0, 210, 10), box(0, 30, 10, 40), box(0, 80, 10, 90))))
    assert sorted(map(tuple, got)) == [(0, 0, 10, 90), (200, 0, 210, 10)]


def test_geometry(spark):
    b = lambda *v: g.box(*[F.lit(float(x)) for x in v])
    assert one(spark, g.iou(b(0, 0, 10, 10), b(5, 0, 15, 10))) == 50 / 150
    assert one(spark, g.iou(b(0, 0, 0, 0), b(0, 0, 0, 0))) == 0
    assert tuple(one(spark, g.parse_box(F.lit("[1, 2, 3.5, 4]")))) == (1, 2, 3.5, 4)
    assert one(spark, g.parse_box(F.lit("[1, 2]"))) is None
    assert one(spark, g.tile_starts(F.lit(1800)))[0] == 0


def test_tags(spark):
    tags = lambda s: one(spark, t.equipment_tags(F.lit(s)))
    assert tags("see 863-ACS-101/102 and 863-acs-101") == ["863-ACS-101", "863-ACS-102"]
    assert tags("515-PCS-401, 515-PCS-501") == ["515-PCS-401", "515-PCS-501"] and tags("none") == []


def test_identifiers_and_numbers(spark):
    assert one(spark, ms.identifier_form(F.lit("003656-0001"))) == "3656-1"
    assert one(spark, ms.identifier_form(F.lit("pt-101"))) == "PT-101"
    for s, want in [("20,5", 20.5), ("+3", 3.0), ("1e3", None), ("", None), ("2d", None)]:
        assert one(spark, t.number(F.lit(s))) == want
    for s, want in [("7", 7), (" 007 ", 7), ("3.0", 0), ("x", 0), ("99999999999", 0)]:
        assert one(spark, t.whole(F.lit(s))) == want
    assert one(spark, t.general(F.lit(20.0))) == "20" and one(spark, t.general(F.lit(1e-7))) == "1e-07"
    assert tuple(one(spark, ms.range_of(F.lit("0 to 160 Bar / Psi")))) == (0, 160)
    assert one(spark, ms.unit(F.lit("0 to 160 mbar"))) == "mbar" and one(spark, ms.unit(F.lit("barometer"))) == ""
    assert one(spark, ms.direction(F.lit("Descending values"))) == "decreasing"
    assert one(spark, ms.canonical_direction(F.lit("decreasing"))) == "falling"


def test_row_kinds(spark):
    for s, want in [("1. start", "numbered_start"), ("12) xy", "numbered_start"), ("12) x", "continuation"), ("7", "number_only"), ("- item", "bullet"), ("", "blank"), ("text", "continuation")]:
        assert one(spark, tb.row_kind(F.lit(s))) == want


def test_key_values(spark):
    assert tuple(one(spark, tb.key_value(F.lit("Serial No: 123456")))) == ("Serial No", "123456")
    for s in ("ends with:", "no colon", ": x", "a: ..."):
        assert one(spark, tb.key_value(F.lit(s))) is None


def test_casefold(spark):
    assert one(spark, t.casefold(F.lit("Straße"))) == "strasse"
    assert one(spark, t.norm_alnum(F.lit(" A-b 1"))) == "ab1" and one(spark, t.text(F.lit(None))) == ""


# ---------------------------------------------------------------- tag scan


def scanned(spark, *texts):
    rows = spark.createDataFrame([(1, 90 * k, x) for k, x in enumerate(texts)], "page long, rotation int, text string")
    found = pg.tag_evidence(rows)
    return [r.asDict() for r in found.orderBy("rotation").collect()], pg.merged_rotations(found).first().asDict()


def test_neighbouring_tags_are_all_found(spark):
    (e,), _ = scanned(spark, "Tag no PT-101 PT-102,TT – 7|FE_12AB 100PT200 300 FT 4")
    assert e["tags"] == sorted(["PT-101", "PT-102", "TT-7", "FE12AB", "100PT200", "300FT4", "FT4"])
    assert e["equipment_score"] == 7 * (5 + 5)
    assert [r for r in e["reasons"] if r.startswith("compact")] == ["compact_instrument_tag:100PT200", "compact_instrument_tag:300FT4"]


def test_short_tags_need_a_context_within_220_characters(spark):
    far = "x " * 150
    (a, b), m = scanned(spark, f"ZS-1 {far} valve", f"ZS-1 and FS5 {'x ' * 20} valve")
    assert a["tags"] == [] and "short_tag_rejected_without_context:ZS-1" in a["reasons"] and a["equipment"]
    assert b["tags"] == ["FS5", "ZS-1"] and b["equipment_score"] == 2 * (5 + 2) and b["near"]
    assert m["decision"] == "tag_detected_with_context" and m["selected"] and m["strong_rotations"] == "90"


def test_repeated_tags_score_once_but_for_what_is_near(spark):
    (e,), _ = scanned(spark, "level PSV-4410 PSV-4410")
    assert e["tags"] == ["PSV-4410"] and e["equipment_score"] == 5 + 2 + 2


def test_broad_identifiers_count_near_a_tag_field(spark):
    (a, b), m = scanned(spark, "item tag 4321 QQQ 55 4321QQQ55", "4321QQQ55")
    assert a["tags"] == ["4321QQQ55"] and a["equipment_score"] == 3 and b["tags"] == []
    assert m["decision"] == "tag_like_text_without_supporting_context" and not m["selected"]


def test_fields_references_and_decisions(spark):
    (e,), m = scanned(spark, "Serial no 123-4-5 9999/1 data sheet drawing set point ÉTAG")
    assert e["serials"] == ["123-4", "9999/1"] and not e["tag_field"] and e["review_score"] == 2 + 1 + 1 + 2
    assert m["decision"] == "serial_or_document_reference_only"
    assert m["reasons"].split(" | ")[0] == "0deg:serial_or_reference:123-4"
    assert scanned(spark, "equipment tag")[1]["decision"] == "tag_field_with_equipment_context"
    assert scanned(spark, "packing")[1]["decision"] == "document_or_table_context_only"
    assert scanned(spark, None)[1]["decision"] == "no_tag_evidence"


def test_equipment_id_with_several_tags_is_one_group(spark):
    row = "equipment_id string, equipment_tag string, serial_number string, field_name string, field_value string, evidence_tier string, confidence double, selection_score double, source_page int, evidence_id string, source_text string"
    tier = "tier_1_dense_record_evidence"
    e = [("EQ-1", tag, tag + tag, "model", "X", tier, c, 1.0, k, f"e{k}", "t") for k, (tag, c) in enumerate((("a", 0.96), ("b", 0.99), ("b", 0.97)))]
    (g,) = ev.decide(ev.best_evidence(spark.createDataFrame(e, row))).collect()
    assert (g.equipment_tag, g.serial_number, g.n_values, g.confidence, g.auto_accepted) == ("b", "bb", 2, 0.99, False)
    assert g.evidence_ids == ["e0", "e1", "e2"]


def test_evidence_is_normalised_once(spark, monkeypatch):
    kind = "equipment_id string, equipment_tag string, serial_number string, field_name string, field_value string, source_page int, confidence double, source_text string, evidence_tier string, selection_status string, registry_id string"
    rest = ("tier_1_direct_or_linked_row", "selected", "r")
    rows = [
        ("e1", "a-1", " 7", "Model", " x\t y", 3, 0.5, "Line  X y", *rest),
        ("e2", "A 1", "7 ", "model", "X Y ", 2, 0.9, "line x y", *rest),
        ("e2", "A 1", "7 ", "model", "X Y ", None, 0.1, "line x y", *rest),
        ("e2", "A 1", "7 ", "model", "x y", 2, 0.1, "x y", *rest),
        ("e3", None, None, "mo-del", "Mo del", 11, 0.4, None, *rest),
        ("e3", None, "8", "model", "\x0b \f", 1, 0.4, "z", *rest),
        ("e3", None, "8", "model", "--", 1, 0.4, "z", *rest[:2], "\n"),
    ]
    e = spark.createDataFrame(rows, kind)
    texts = spark.createDataFrame([(x,) for x in ("", " ", "a", " a  b ", "\ta", "a\r\n b", "\x0b\f", "\u00a0 a", "é \u2003 b", None)], "t string")
    assert texts.filter((t.tidy("t") != t.clean("t")) | (t.blank("t") != (t.clean("t") == ""))).count() == 0

    p = ev.promotion(e)
    assert p.columns == [*e.columns, "promotion_status", "promotion_reason"]
    repeats, blank = "value repeats the field name", "blank field name or value"
    assert p.filter("promotion_reason = 'selected row'").count() == 4
    assert sorted(r["promotion_reason"] for r in p.filter("equipment_id = 'e3'").collect()) == [blank, "unmatched equipment identity", repeats]
    # one pattern each for the field's name and its value
    assert p._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 2

    found = [tuple(r)[1:] for r in ev.patterns(e).orderBy("norm_value").collect()]
    assert found == [
        ("model", "--", "z", 1, 0.4, 1, "1", "review_equipment_specific"),
        ("mo-del", "mo del", "", 1, 0.4, 1, "11", "review_equipment_specific"),
        ("model", "x y", "line x y", 2, 0.9, 3, "2,3", "review_once_then_propagate"),
    ]
    seen = []
    monkeypatch.setattr(ev, "written", lambda df, name: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    assert [tuple(r)[1:] for r in ev.identity_registry(e).orderBy("registry_id").collect()] == [("::", None, None, "11"), ("::8", None, "8", "1"), ("A1::7", "A 1", " 7", "2,3")]
    # keys are made of different pairs, not of all rows
    (plan,) = seen
    pairs = plan.split("\n")[1:]
    assert "- Aggregate [equipment_tag#" in pairs[0] and "regexp_replace" not in "".join(pairs[1:])


def test_inherited_equals_all_with_all(spark):
    sizes = set()
    for seed in range(2):
        rnd = random.Random(seed)
        pick = lambda n: rnd.choice(["", "", *"abcdef"[:n]])
        rows = [(f"t{rnd.randrange(25)}", f"s{rnd.randrange(2)}", pick(6), pick(6), pick(6), pick(1), pick(2)) for _ in range(60)]
        refs = {(t_, s, k, r[k]) for r in rows for t_, s in [r[:2]] for k in (2, 3, 4) if r[k]}
        want = {}
        for tag, serial, f in {(r[0], r[1], f) for r in rows for f in (5, 6) if not r[f]}:
            mine = {(k, v) for t_, s, k, v in refs if (t_, s) == (tag, serial)}
            found = {(t_, r[f]) for t_, s, k, v in refs if (k, v) in mine and t_ != tag for r in rows if r[:2] == (t_, s) and r[f]}
            if len({v for _, v in found}) == 1:
                want[tag, serial, "vw"[f - 5]] = (found.pop()[1], len({t_ for t_, _ in found} | {t_ for t_, s, k, v in refs if (k, v) in mine and t_ != tag for r in rows if r[:2] == (t_, s) and r[f]}))
                sizes.add(min(len(mine), 3))
        df = spark.createDataFrame(rows, "equipment_tag string, serial_number string, x string, y string, z string, v string, w string")
        got = {tuple(r[:3]): tuple(r[3:]) for r in ev.inherited(df, ("x", "y", "z"), ("v", "w")).collect()}
        assert got == want
    assert sizes == {1, 2, 3}


def test_inherited_of_a_shared_reference(spark):
    began, n = time.time(), spark.range(40_000)
    rows = n.select(F.col("id").cast("string").alias("equipment_tag"), F.lit("").alias("serial_number"), F.lit("PO").alias("x"), F.when(F.col("id") % 2 == 0, "v").otherwise("").alias("v"))
    assert ev.inherited(rows, ("x",), ("v",)).filter("inherited_value = 'v' and n_donors = 20000").count() == 20_000
    assert time.time() - began < 60


def test_nearest_slots_keep_cells_where_they_are(spark):
    cells = spark.createDataFrame([(1, "up", 12.0, "a"), (2, "up", 15.0, "b"), (3, "down", 90.0, "c"), (4, "none", 1.0, "d")], "cell_id int, direction string, x double, tag string")
    schema = spark.createDataFrame([("up", 1, 10.0, 0.0), ("up", 2, 20.0, 5.0), ("down", 1, 300.0, 7.0)], "direction string, slot int, x double, value double")
    near = ms.nearest_slots(cells, schema, keep=("tag",))
    assert sorted(map(tuple, near.collect())) == [(1, "up", 1, 0.0, 2.0, True, "a"), (2, "up", 1, 0.0, 5.0, True, "b"), (3, "down", 1, 7.0, 210.0, False, "c")]


def test_tags_found_by_their_digits_are_those_of_the_plain_pattern(spark):
    import random
    import re

    from pyspark.sql import functions as F

    from pagequarry.functions import text as t
    from pagequarry.operators import pages as pg

    assert pg.ISA_TAG.startswith(r"(?=\d)")
    plain = rf"(?<![A-Z0-9])(?:{pg.ISA_FUNCTIONS})\s*-?\s*\d{{1,8}}(?:[A-Z]{{1,4}})?(?![A-Z0-9])"
    rnd = random.Random(3)
    parts = ["PT", "PIC", "XV", "FSHH", "ABC", "A", "-", " - ", " ", " \n", "_", "|", "–", "1", "123456789", "12345678", "7A", "Z", "é", "Ü", ".", "TAG", "tag no", "valve", "PT1PT2"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string").withColumn("s", t.scan_text("text"))
    got = df.select("s", t.near_matches(F.col("s"), pg.ISA_TAG, pg._NEAR, window=5, headed=True).alias("m")).collect()
    word = {n: rf"(?<![^\W])(?:{w})(?![^\W])" for n, w in (("near_tag", pg.TAG_FIELD), ("near_equipment", pg.EQUIPMENT_CONTEXT))}
    n = 0
    for r in got:
        assert r["s"] == re.sub(r"[\s\x1c-\x1f\x85]+", " ", r["s"]).strip(" ")
        found = list(re.finditer(plain, r["s"], re.ASCII))
        want = [(m[0], *[bool(re.search(w, r["s"][max(0, m.start() - 5) : m.end() + 5])) for w in word.values()]) for m in found]
        assert [tuple(m) for m in r["m"]] == want, r["s"]
        n += len(found)
    assert n > 200


def test_words_are_looked_for_where_three_characters_fit(spark):
    from pagequarry.functions import text as t

    assert t.worded("TAG|SET ?POINT|S/N").startswith("(?=[ST][/AE][GNT])")
    assert t.worded("AB?|CDE").startswith("(?=[AC])(?<!")
