"""Sequential operators over sorted arrays, as higher-order functions.

Each takes an array column that is sorted already; groups are one table, column
or run of text, so the arrays are short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind


def mean_clusters(values: Column, tolerance: Column) -> Column:
    """Cluster numbers from 1 of sorted doubles: a value joins the cluster whose running mean is within the tolerance."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(0).alias("cid"), F.array().cast("array<int>").alias("ids"))

    def step(s: Column, v: Column) -> Column:
        joins = (s["n"] > 0) & (F.abs(v - s["total"] / F.greatest(s["n"], F.lit(1))) <= tolerance)

        def put(total: Column, n: Column, cid: Column) -> Column:
            return F.struct(total.alias("total"), n.alias("n"), cid.alias("cid"), F.concat(s["ids"], F.array(cid)).alias("ids"))

        # one look at the tolerance for each value
        return F.when(joins, put(s["total"] + v, s["n"] + 1, s["cid"])).otherwise(put(v, F.lit(1), s["cid"] + 1))

    return F.aggregate(values, start, step, lambda s: s["ids"])


def anchor_clusters(values: Column, tolerance: Column) -> Column:
    """Anchors of sorted doubles: a value starts a new one if it is further than the tolerance from the last anchor."""
    start = F.array().cast("array<double>")
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(values, start, lambda a, v: F.when((F.size(a) == 0) | (v - F.when(F.size(a) > 0, last(a)) > tolerance), F.concat(a, F.array(v))).otherwise(a))


def nearest_index(anchors: Column, value: Column) -> Column:
    """The number, from 0, of the nearest anchor; the first on ties."""
    return F.array_min(F.transform(anchors, lambda a, i: F.struct(F.abs(a - value).alias("d"), i.alias("i"))))["i"]


def greedy(items: Column, same: Callable[[Column, Column], Column], kind: str) -> Column:
    """Items, best first, without those for which ``same`` holds with one that is kept; ``kind`` is the array's type."""
    return F.aggregate(items, F.array().cast(kind), lambda kept, x: F.when(F.exists(kept, lambda k: same(k, x)), kept).otherwise(F.concat(kept, F.array(x))))


def replace_matching(items: Column, same: Callable[[Column, Column], Column], better: Callable[[Column, Column], Column], kind: str) -> Column:
    """Items in order; one that matches a kept item takes the place of the first such if it is better, and is dropped if not."""

    def step(kept: Column, x: Column) -> Column:
        first = F.array_position(F.transform(kept, lambda k: same(k, x)), F.lit(True))
        put = lambda at: F.transform(kept, lambda k, i: F.when((i + 1 == at) & better(x, k), x).otherwise(k))
        # bound, so that it is not looked for again at each kept item
        return bind(first, lambda at: F.when(at == 0, F.concat(kept, F.array(x))).otherwise(put(at)))

    return F.aggregate(items, F.array().cast(kind), step)


def rising_subsequence(values: Column) -> Column:
    """Places, from 0, of the longest strictly rising subsequence of doubles; the first found on ties."""
    kind = "array<struct<len: int, prev: int, v: double>>"

    def step(s: Column, v: Column) -> Column:
        prior = F.filter(F.transform(s, lambda e, i: F.struct(e["len"].alias("len"), (-i).alias("i"), e["v"].alias("v"))), lambda e: e["v"] < v)
        best = F.array_max(F.transform(prior, lambda e: F.struct(e["len"], e["i"].alias("i"))))
        return F.concat(s, F.array(F.struct((F.coalesce(best["len"], F.lit(0)) + 1).cast("int").alias("len"), F.coalesce(-best["i"], F.lit(-1)).cast("int").alias("prev"), v.cast("double").alias("v"))))

    def path(states: Column) -> Column:
        end = F.array_max(F.transform(states, lambda e, i: F.struct(e["len"].alias("len"), (-i).alias("i"))))
        start = F.struct(F.coalesce(-end["i"], F.lit(-1)).cast("int").alias("at"), F.array().cast("array<int>").alias("path"))

        def back(s: Column, _: Column) -> Column:
            more = s["at"] >= 0
            at = F.when(more, F.get(states, s["at"])["prev"]).otherwise(-1)
            return F.struct(at.cast("int").alias("at"), F.when(more, F.concat(F.array(s["at"]), s["path"])).otherwise(s["path"]).alias("path"))

        return F.aggregate(values, start, back, lambda s: s["path"])

    # bound, so that the way back does not compute it again at each step
    return bind(F.aggregate(values, F.array().cast(kind), step), path)


def sessions(rows: Column, starts: Callable[[Column, Column], Column]) -> Column:
    """Group numbers from 1 of rows with ``y2``: a row starts a group if ``starts(row, largest y2 of the group)``."""
    state = F.struct(F.lit(0).alias("gid"), F.lit(None).cast("double").alias("y2"), F.array().cast("array<int>").alias("ids"))

    def step(s: Column, r: Column) -> Column:
        new = (s["gid"] == 0) | F.coalesce(starts(r, s["y2"]), F.lit(False))
        gid = F.when(new, s["gid"] + 1).otherwise(s["gid"])
        y2 = F.when(new, r["y2"]).otherwise(F.greatest(s["y2"], r["y2"]))
        return F.struct(gid.alias("gid"), y2.alias("y2"), F.concat(s["ids"], F.array(gid)).alias("ids"))

    return F.aggregate(rows, state, step, lambda s: s["ids"])


def upper_median(values: Column) -> Column:
    """The middle of an array of doubles, the higher of two middles."""
    return F.element_at(F.array_sort(values), (F.floor(F.size(values) / 2) + 1).cast("int"))


def merged_boxes(boxes: Column, gap: float = 60.0, share: float = 0.5, kind: str = "array<struct<x1: double, y1: double, x2: double, y2: double>>") -> Column:
    """Boxes that overlap, or lie closer than ``gap`` with spans overlapping by more than ``share``, merged until none do."""

    def near(a: Column, b: Column) -> Column:
        ox = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
        oy = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
        wide = F.least(a["x2"] - a["x1"], b["x2"] - b["x1"])
        high = F.least(a["y2"] - a["y1"], b["y2"] - b["y1"])
        return ((ox > 0) & (oy > 0)) | ((ox > wide * share) & (-oy < gap)) | ((oy > high * share) & (-ox < gap))

    def hull(a: Column, b: Column) -> Column:
        return F.struct(F.least(a["x1"], b["x1"]).alias("x1"), F.least(a["y1"], b["y1"]).alias("y1"), F.greatest(a["x2"], b["x2"]).alias("x2"), F.greatest(a["y2"], b["y2"]).alias("y2"))

    def absorb(kept: Column, b: Column) -> Column:
        grown = F.aggregate(kept, b, lambda acc, k: F.when(near(acc, k), hull(acc, k)).otherwise(acc))
        return bind(grown, lambda x: F.concat(F.filter(kept, lambda k: ~near(x, k)), F.array(x)))

    def step(acc: Column, _: Column) -> Column:
        once = F.aggregate(acc["boxes"], F.array().cast(kind), absorb)
        after = bind(once, lambda x: F.struct(x.alias("boxes"), (F.size(x) < F.size(acc["boxes"])).alias("more")))
        return F.when(acc["more"], after).otherwise(acc)

    # a pass that merges nothing is the last; each other one takes a box away, so as many passes as boxes are enough
    start = F.struct(boxes.cast(kind).alias("boxes"), F.lit(True).alias("more"))
    return F.aggregate(boxes, start, step, lambda acc: acc["boxes"])
