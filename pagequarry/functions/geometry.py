"""Boxes as structs of x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def area(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(0.0)) * F.greatest(b["y2"] - b["y1"], F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where there is no area."""
    both = overlap(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def overlap_ratio(a: Column, b: Column) -> Column:
    """Intersection over the smaller area."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, overlap(a, b) / least).otherwise(0.0)


def centre_x(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2


def centre_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2


def parse_box(c: Column) -> Column:
    """A box from text such as ``[1, 2, 3.5, 4]``; null where it has not four numbers."""
    n = F.regexp_extract_all(c, F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1))
    return F.when(F.size(n) == 4, box(*[n[i].try_cast("double") for i in range(4)]))


def polygon_box(points: Column) -> Column:
    """The hull of an array of points, each an array of x and y."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def moved(b: Column, dx: Column, dy: Column) -> Column:
    return box(b["x1"] + dx, b["y1"] + dy, b["x2"] + dx, b["y2"] + dy)


def turned(b: Column, degrees: Column, width: Column, height: Column) -> Column:
    """Where a box of a page that was turned by ``degrees`` lies on the page of ``width`` by ``height``."""
    return (
        F.when(degrees == 90, box(b["y1"], height - b["x2"], b["y2"], height - b["x1"]))
        .when(degrees == 180, box(width - b["x2"], height - b["y2"], width - b["x1"], height - b["y1"]))
        .when(degrees == 270, box(width - b["y2"], b["x1"], width - b["y1"], b["x2"]))
        .otherwise(b)
    )


def padded(b: Column, pad: Column, width: Column, height: Column) -> Column:
    zero = F.lit(0.0)
    return box(F.greatest(b["x1"] - pad, zero), F.greatest(b["y1"] - pad, zero), F.least(b["x2"] + pad, width), F.least(b["y2"] + pad, height))


def stretched(b: Column, width: Column, height: Column) -> Column:
    """Wide flat regions grow downwards, tall narrow ones to the right."""
    w, h = b["x2"] - b["x1"], b["y2"] - b["y1"]
    grow = lambda side: F.greatest(F.lit(40.0), F.floor(side * 0.3).cast("double"))
    zero = F.lit(0.0)
    flat = box(b["x1"], F.greatest(zero, b["y1"] - grow(h)), b["x2"], F.least(height, b["y2"] + F.floor(height * 0.55)))
    tall = box(F.greatest(zero, b["x1"] - grow(w)), b["y1"], F.least(width, b["x2"] + F.floor(width * 0.55)), b["y2"])
    return F.when((w >= width * 0.7) & (h <= height * 0.35), flat).when((h >= height * 0.7) & (w <= width * 0.35), tall).otherwise(b)


def tile_width(width: Column, tiles: int = 5, share: float = 0.3) -> Column:
    return F.floor(width / (tiles - (tiles - 1) * share))


def tile_starts(width: Column, tiles: int = 5, share: float = 0.3) -> Column:
    """Left edges of overlapping tiles over a crop."""
    tile = tile_width(width, tiles, share)
    step = F.floor(tile * (1 - share))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(tiles - 1)), lambda i: F.least(i * step, width - tile)))


def overlapping(boxes: DataFrame, keys: list[str], number: str, height: float = 64.0) -> DataFrame:
    """Pairs of boxes of one group that overlap: ``keys, left_no, right_no, left, right``, the lesser number first.

    ``boxes`` has the keys, a number and a box ``b``. Boxes meet by the horizontal
    bands that they cover, in the first band that both have.
    """
    first, last = F.floor(F.col("b.y1") / height), F.floor(F.col("b.y2") / height)
    banded = boxes.select(*keys, F.col(number).alias("no"), "b", first.alias("first"), F.explode(F.sequence(first, F.greatest(first, last))).alias("band"))
    left, right = banded.toDF(*keys, "left_no", "left", "left_first", "band"), banded.toDF(*keys, "right_no", "right", "right_first", "band")
    j = left.join(right, [*keys, "band"]).filter("left_no < right_no and band = greatest(left_first, right_first)")
    return j.select(*keys, "left_no", "right_no", "left", "right").filter(overlap_ratio(F.col("left"), F.col("right")) > 0)
