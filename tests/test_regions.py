from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import regions as rg


def plain_near(a, b, gap=60.0, share=0.5):
    ox, oy = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    wide, high = min(a[2] - a[0], b[2] - b[0]), min(a[3] - a[1], b[3] - b[1])
    return (ox > 0 and oy > 0) or (ox > wide * share and -oy < gap) or (oy > high * share and -ox < gap)


def plain_merged(boxes):
    """Rounds in which all that is near each other, also over others, becomes one hull."""
    boxes = sorted(set(boxes))
    while True:
        left, hulls = list(boxes), []
        while left:
            group, queue = [], [left.pop()]
            while queue:
                a = queue.pop()
                group.append(a)
                queue += [b for b in left if plain_near(a, b)]
                left = [b for b in left if b not in queue]
            hulls.append((min(b[0] for b in group), min(b[1] for b in group), max(b[2] for b in group), max(b[3] for b in group)))
        if len(hulls) == len(boxes):
            return sorted(boxes)
        boxes = sorted(set(hulls))


def test_merged_regions_equal_a_plain_version(spark):
    rnd, rows = random.Random(2), []
    for page in range(4):
        for _ in range((0, 5, 60, 120)[page]):
            x, y = rnd.randrange(4000), rnd.randrange(4000)
            rows.append((page, float(x), float(y), float(x + rnd.randint(1, 300)), float(y + rnd.randint(1, 120))))
    rows += [(9, 0.0, 0.0, 5.0, 5.0)] * 3 + [(8, float(10 * i), float(i * 30), float(10 * i + 100), float(i * 30 + 5)) for i in range(80)]
    df = spark.createDataFrame(rows, "page int, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in rg.merged_regions(df, ["page"]).collect():
        got.setdefault(r["page"], []).append(tuple(r)[1:])
    assert {p: sorted(b) for p, b in got.items()} == {p: plain_merged([r[1:] for r in rows if r[0] == p]) for p in {r[0] for r in rows}}
    assert len(got[8]) == len(got[9]) == 1
    assert rg.merged_regions(df.limit(0), ["page"]).count() == 0


def test_a_page_of_many_boxes(spark):
    # 100,000 boxes of one page in 100 blocks
    i = F.col("id")
    x, y = (i % 10) * 1000 + F.floor(i / 100) % 30 * 20, F.floor(i / 10) % 10 * 1000 + F.floor(i / 3000) * 20
    df = spark.range(100_000).select(F.lit(1).alias("page"), x.alias("x1"), y.alias("y1"), (x + 15).alias("x2"), (y + 15).alias("y2"))
    got = rg.merged_regions(df, ["page"]).collect()
    want = df.groupBy(F.floor(F.col("x1") / 1000), F.floor(F.col("y1") / 1000)).agg(F.min("x1"), F.min("y1"), F.max("x2"), F.max("y2")).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(tuple(map(float, tuple(r)[2:])) for r in want) and len(got) == 100


def plain_regions(image, min_width, min_height):
    """The same on a whole array of grey values, pixel by pixel."""
    height, width = image.shape
    ink = 255 - image.astype(int)
    padded = np.pad(ink, 15)
    on = np.array([[(ink[y, x] - 8) * 961 > padded[y : y + 31, x : x + 31].sum() if ink[y, x] else False for x in range(width)] for y in range(height)])
    kept = np.zeros_like(on)
    for d in (30, 45, 60, 80):
        for lines, k, flip in ((on, max(12, width // d), False), (on.T, max(12, height // d), True)):
            for r, row in enumerate(lines):
                run = 0
                for c in range(len(row) + 1):
                    if c < len(row) and row[c]:
                        run += 1
                        continue
                    if run >= k:
                        (kept.T if flip else kept)[r, c - run : c] = True
                    run = 0
    wide = np.zeros_like(kept)
    for y, x in zip(*np.nonzero(kept), strict=True):
        wide[max(0, y - 18) : y + 19, max(0, x - 18) : x + 19] = True
    seen, out = np.zeros_like(wide), []
    for y, x in zip(*np.nonzero(wide), strict=True):
        if seen[y, x]:
            continue
        stack, seen[y, x], found = [(y, x)], True, []
        while stack:
            a, b = stack.pop()
            found.append((a, b))
            for c in range(max(0, a - 1), min(height, a + 2)):
                for d in range(max(0, b - 1), min(width, b + 2)):
                    if wide[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        stack.append((c, d))
        ys, xs = zip(*found, strict=True)
        x1, y1, w, h = min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1
        if w >= int(width * min_width) and h >= int(height * min_height) and w * h >= width * height * 0.04:
            px, py = max(12, int(w * 0.02)), max(12, int(h * 0.02))
            out.append(tuple(map(float, (max(0, x1 - px), max(0, y1 - py), min(width, x1 + w + px), min(height, y1 + h + py)))))
    return plain_merged(out)


def as_runs(image):
    rows = []
    for y, row in enumerate(image.tolist()):
        x = 0
        while x < len(row):
            e = x
            while e < len(row) and row[e] == row[x]:
                e += 1
            if row[x] != 255:
                rows.append((y, x, e, row[x]))
            x = e
    return rows


def test_regions_equal_a_raster_version(spark):
    rng, images = np.random.default_rng(4), []
    for page in range(5):
        image = np.full((300, 420) if page % 2 else (530, 270), 255, np.uint8)
        height, width = image.shape
        for _ in range(page * 2):
            x, y, w, h = rng.integers(0, width - 40), rng.integers(0, height - 40), rng.integers(20, 200), rng.integers(20, 200)
            for line in (image[y, x : x + w], image[min(y + h, height - 1), x : x + w], image[y : y + h, x], image[y : y + h, min(x + w, width - 1)]):
                line[:] = rng.integers(0, 240)
        for _ in range(page * 20):
            # words: specks too short for a rule, and a grey area that is no darker than what is around it
            x, y = rng.integers(0, width - 9), rng.integers(0, height - 9)
            image[y : y + rng.integers(1, 6), x : x + rng.integers(1, 9)] = rng.integers(0, 255)
        if page == 4:
            image[100:180, 60:160] = 120
        images.append(image)
    runs = spark.createDataFrame([("d", p, *r) for p, im in enumerate(images) for r in as_runs(im)], "document_id string, page int, y int, x1 int, x2 int, grey int")
    pages = spark.createDataFrame([("d", p, im.shape[1], im.shape[0]) for p, im in enumerate(images)], "document_id string, page int, width int, height int")
    got = {}
    for r in rg.table_regions(runs, pages, ["document_id", "page"], 0.2, 0.1).collect():
        got.setdefault(r["page"], []).append(tuple(r)[2:])
    want = {p: plain_regions(im, 0.2, 0.1) for p, im in enumerate(images)}
    assert {p: sorted(b) for p, b in got.items()} == {p: b for p, b in want.items() if b} and len(got) > 1


@pytest.mark.parametrize("band", [7, 256])
def test_bands_and_strips_change_nothing(spark, monkeypatch, band):
    monkeypatch.setattr(rg, "BAND", band)
    # groups that go on in the next batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37" if band == 7 else "10000")
    rng = np.random.default_rng(5)
    image = np.where(rng.random((60, 80)) < 0.3, rng.integers(0, 255, (60, 80)), 255).astype(np.uint8)
    runs = spark.createDataFrame([(1, *r) for r in as_runs(image)], "page int, y int, x1 int, x2 int, grey int")
    pages = spark.createDataFrame([(1, 80, 60)], "page int, width int, height int")
    on = rg.window_ink(255 - image.astype(np.int32))
    ink = rg.thresholded(runs, pages, ["page"])
    got = np.zeros_like(on)
    for r in ink.collect():
        got[r["y"], r["x1"] : r["x2"]] = True
    assert (got == on).all() and on.any()
    back = np.zeros_like(on)
    for r in rg.column_runs(ink, pages, ["page"]).collect():
        assert not back[r["y1"] : r["y2"], r["x"]].any() and (r["y1"] == 0 or not on[r["y1"] - 1, r["x"]])
        back[r["y1"] : r["y2"], r["x"]] = True
    assert (back == on).all()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_drawn_outlines_and_odd_pages(spark):
    boxes = spark.createDataFrame([(1, 2.0, 3.0, 6.0, 7.0), (1, 4.0, 3.0, 9.0, 5.0), (1, 5.0, 5.0, 5.0, 9.0)], "page int, x1 double, y1 double, x2 double, y2 double")
    image = np.full((9, 12), " ")
    for x1, y1, x2, y2 in ((2, 3, 6, 7), (4, 3, 9, 5)):
        image[y1:y2, x1] = image[y1:y2, x2 - 1] = "x"
        image[y1, x1:x2] = image[y2 - 1, x1:x2] = "x"
    got = np.full((9, 12), " ")
    for r in rg.drawn(boxes, ["page"]).collect():
        assert (got[r["y"], r["x1"] : r["x2"]] == " ").all()
        got[r["y"], r["x1"] : r["x2"]] = "x"
    assert (got == image).all()
    pages = spark.createDataFrame([(1, 12, 9), (2, 0, 0)], "page int, width int, height int")
    assert rg.table_regions(rg.drawn(boxes, ["page"]), pages, ["page"]).count() == 0
    outside = spark.createDataFrame([(1, -5, -3, 400, 0), (1, 2, 500, 900, 0), (1, 400, 0, 900, 0), (7, 1, 0, 5, 0)], "page int, y int, x1 int, x2 int, grey int")
    assert rg.table_regions(outside, pages, ["page"]).count() == 0


def test_row_crops_are_the_same_pixels(spark, tmp_path):
    from pagequarry.sources import binary as bn

    rng = np.random.default_rng(8)
    images = [np.where(rng.random((90, 70)) < 0.4, rng.integers(0, 255, (90, 70)), 255).astype(np.uint8), np.full((40, 50), 255, np.uint8)]
    runs = spark.createDataFrame([(p, *r) for p, im in enumerate(images) for r in as_runs(im)], "page int, y int, x1 int, x2 int, grey int")
    pages = spark.createDataFrame([(p, im.shape[1], im.shape[0]) for p, im in enumerate(images)], "page int, width int, height int")
    boxes = [("a b/1", 0, 10.0, 20.0, 30.0, 40.0, 0), ("a2", 0, 10.0, 20.0, 30.0, 40.0, 90), ("a3", 0, 0.0, 0.0, 70.0, 90.0, 180), ("a4", 0, 60.0, 80.0, 69.0, 89.0, 270), ("b", 1, 5.0, 5.0, 9.0, 9.0, 0), ("out", 1, 500.0, 5.0, 600.0, 9.0, 0), ("c", 7, 1.0, 1.0, 2.0, 2.0, 0)]
    queue = spark.createDataFrame(boxes, "crop_id string, page int, x1 double, y1 double, x2 double, y2 double, rotation int")
    folder = f"file://{tmp_path}/crops"
    crops = bn.row_crops(runs, pages, queue, ["page"], (7, 3))
    kept = bn.write_files(crops, folder)
    # once more: files are replaced
    assert bn.write_files(crops, folder).count() == kept.count() == 5
    assert sorted(p.name for p in (tmp_path / "crops").iterdir() if not p.name.endswith(".crc")) == ["a2.png", "a3.png", "a4.png", "a_b_1.png", "b.png"]
    for name, page, x1, y1, x2, y2, rotation in boxes[:5]:
        px, py = (7, 3) if rotation % 180 == 0 else (3, 7)
        im = images[page]
        want = np.rot90(im[max(0, int(y1) - py) : int(y2) + py, max(0, int(x1) - px) : int(x2) + px], rotation // 90)
        data = (tmp_path / "crops" / (name.replace(" ", "_").replace("/", "_") + ".png")).read_bytes()
        assert (bn.pixels(data) == want).all(), name
    with pytest.raises(ValueError):
        bn.pixels(data[:-6] + b"x" + data[-5:])


def test_many_small_rasters_are_neither_joined_nor_groups_of_their_own(spark):
    from pagequarry.sources import binary as bn

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    boxes = spark.createDataFrame([(p, 10.0 * (p % 5), 20.0, 10.0 * (p % 5) + 60, 40.0) for p in range(300)], "page int, x1 double, y1 double, x2 double, y2 double")
    pages = spark.range(300).select(F.col("id").cast("int").alias("page"), F.lit(120).alias("width"), F.lit(80).alias("height"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    runs = rg.drawn(boxes, ["page"])
    assert "Window" not in plan(runs)
    ink = rg.thresholded(runs, pages, ["page"])
    assert "Join" not in plan(ink) and "Join" not in plan(rg.column_runs(ink, pages, ["page"]))
    queue = boxes.withColumn("crop_id", F.concat(F.lit("c"), "page")).withColumn("rotation", F.lit(0))
    crops = bn.row_crops(runs, pages, queue, ["page"], (5, 5))
    assert "FlatMapGroupsInPandas" not in plan(crops)
    got = crops.select("crop_id", "left", "top", "right", "bottom", "content").collect()
    assert len(got) == 300
    for r in got:
        left = 10 * (int(r["crop_id"][1:]) % 5)
        image = bn.pixels(bytes(r["content"]))
        assert image.shape == (30, left + 65 - max(0, left - 5)) and (image == 0).sum() == 2 * 60 + 2 * 18
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("band", [16, 512])
def test_components_of_boxes_go_on_over_bands(spark, monkeypatch, band):
    monkeypatch.setattr(rg, "BAND", band)
    # two that touch at a corner once widened, one that does not, one at the page's end, and pages without sizes or boxes
    rows = [(1, 10, 10, 20, 12), (1, 24, 16, 30, 60), (1, 50, 10, 55, 12), (1, 90, 90, 100, 100), (3, 1, 1, 5, 5), (None, 1, 1, 5, 5)]
    boxes = spark.createDataFrame(rows, "page int, x1 int, y1 int, x2 int, y2 int")
    pages = spark.createDataFrame([(1, 100, 100), (2, 100, 100), (4, 0, 0)], "page int, width int, height int")
    got = sorted(tuple(r) for r in rg.components(boxes, pages, ["page"], 2).collect())
    assert got == [(1, 8, 8, 32, 62), (1, 48, 8, 57, 14), (1, 88, 88, 100, 100)]


def test_rasters_are_packed_and_give_the_same(spark, monkeypatch):
    """A row for each band of a raster, not for each run; whole pages and pages by bands have the same regions and crops."""
    from pagequarry.plans import storage_queries as sqs
    from pagequarry.plans.registry import Inputs
    from pagequarry.sources import binary as bn

    _, runs, pages = sqs._rasters(Inputs(spark, "/root/testdata/sf0.001"))
    assert rg.is_packed(runs) and runs.count() == pages.count()
    rng = np.random.default_rng(6)
    image = np.where(rng.random((60, 80)) < 0.1, rng.integers(0, 255, (60, 80)), 255).astype(np.uint8)
    image[5:50, 10:13] = image[5:8, 10:70] = image[47:50, 10:70] = 0
    rows = spark.createDataFrame([(1, *r) for r in as_runs(image)] + [(None, 1, 0, 4, 0)], "page int, y int, x1 int, x2 int, grey int")
    pages = spark.createDataFrame([(1, 80, 60), (2, 80, 60)], "page int, width int, height int")
    queue = spark.createDataFrame([("a", 1, 3.0, 2.0, 70.0, 55.0, 0), ("b", 2, 3.0, 2.0, 9.0, 30.0, 0)], "crop_id string, page int, x1 double, y1 double, x2 double, y2 double, rotation int")
    want = [plain_regions(image, 0.2, 0.1), image[1:56, 2:71]]
    assert want[0]
    for band, whole in ((512, 1 << 22), (7, 1 << 22), (7, 0)):
        for module in (rg, bn):
            monkeypatch.setattr(module, "BAND", band)
        monkeypatch.setattr(rg, "WHOLE", whole)
        table = rg.packed(rows, ["page"])
        assert sorted(map(tuple, rg.unpacked(table, ["page"]).collect())) == sorted((1, *r) for r in as_runs(image))
        for given in (rows, table):
            assert sorted(tuple(r)[1:] for r in rg.table_regions(given, pages, ["page"], 0.2, 0.1).collect()) == want[0]
            crops = {r["crop_id"]: bn.pixels(bytes(r["content"])) for r in bn.row_crops(given, pages, queue, ["page"], (1, 1)).collect()}
            assert (crops["a"] == want[1]).all() and (crops["b"] == 255).all() and crops["b"].shape == (30, 8)


def test_files_are_read_by_name(spark, tmp_path):
    from pagequarry.sources import binary as bn

    rows = spark.createDataFrame([("a.png", b"1"), ("b.png", b"")], "name string, content binary")
    kept = bn.write_files(rows, f"file://{tmp_path}/f")
    assert sorted((r["name"], bytes(r["content"])) for r in bn.read_files(kept, f"file://{tmp_path}/f").collect()) == [("a.png", b"1"), ("b.png", b"")]
    (tmp_path / "f" / "b.png").unlink()
    with pytest.raises(Exception, match="b.png"):
        bn.read_files(kept, f"file://{tmp_path}/f").collect()
