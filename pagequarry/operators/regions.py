"""Table regions from page rasters, and the merging of regions.

A raster is a table of run-length rows: ``y, x1, x2, grey`` says that pixels from
``x1`` to before ``x2`` of row ``y`` have a grey value; pixels without a run are
white (255). Rules are found on runs: thresholding against the mean of a window is
done in bands of rows, opening keeps runs of the kernel's length, in rows and in
strips of columns, and dilation widens them. Runs of neighbouring rows that touch
are one component, whose box is a region if it is large enough.

Runs may come packed: a row for each band of rows of a page (``keys, band``), with
``y, x1, x2, grey`` as arrays. Pages that are not too large are worked on as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import delete, written

# fixed values: window and offset of the threshold, divisors of the page's sides for kernels, least kernel
WINDOW, OFFSET = 31, 8
DIVISORS = (30, 45, 60, 80)
LEAST_KERNEL = 12
#: Pixels by which 19 x 19 dilation, done twice, widens on each side.
WIDEN = 18
MIN_AREA = 0.04
#: Rows of a band and columns of a strip that one group of a task holds.
BAND = 512
#: Pixels of a page that is worked on as a whole; larger ones are dealt out by bands and strips.
WHOLE = 1 << 22
#: Rows of packed runs in an Arrow batch.
PACKED_ROWS = 256
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Side of the cells in which boxes meet.
CELL = 128
SIDES = ("x1", "y1", "x2", "y2")
RUN = ("y", "x1", "x2", "grey")


# ---------------------------------------------------------------- merging


def near(a: str, b: str, gap: float, share: float) -> Column:
    """Whether boxes overlap, or lie closer than ``gap`` with spans that overlap by more than ``share`` of the smaller one."""
    low = lambda s: F.least(F.col(f"{a}.{s}2"), F.col(f"{b}.{s}2"))
    high = lambda s: F.greatest(F.col(f"{a}.{s}1"), F.col(f"{b}.{s}1"))
    side = lambda s: F.least(F.col(f"{a}.{s}2") - F.col(f"{a}.{s}1"), F.col(f"{b}.{s}2") - F.col(f"{b}.{s}1"))
    ox, oy = low("x") - high("x"), low("y") - high("y")
    return ((ox > 0) & (oy > 0)) | ((ox > side("x") * share) & (-oy < gap)) | ((oy > side("y") * share) & (-ox < gap))


def _met(boxes: DataFrame, keys: list[str], gap: float, share: float) -> DataFrame:
    """``id, to``: for each label (``label``) the least other one of a box that one of its boxes is near, if that is less."""
    reach = lambda low, high: F.sequence(F.floor((F.col(low) - gap / 2) / CELL), F.floor((F.col(high) + gap / 2) / CELL))
    cells = boxes.withColumn("cx", F.explode(reach("x1", "x2"))).withColumn("cy", F.explode(reach("y1", "y2")))
    cells = cells.select(*keys, "cx", "cy", F.col("label").alias("id"), F.struct(*SIDES).alias("b"))
    other = cells.select(*keys, "cx", "cy", F.col("id").alias("to"), F.col("b").alias("o"))
    return cells.join(other, [*keys, "cx", "cy"]).filter((F.col("to") < F.col("id")) & near("b", "o", gap, share)).groupBy("id").agg(F.min("to").alias("to"))


def followed(pointers: DataFrame) -> DataFrame:
    """``id, root`` of ``id, to``, whose ``to`` is less than ``id``: each round doubles the way."""
    now = written(pointers.select("id", F.col("to").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        after = written(now.join(ahead, "root", "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        _drop(now)
        now = after.drop("_moved")
        if after.filter("_moved").isEmpty():
            return now


def _drop(table: DataFrame) -> None:
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        delete(table.sparkSession, folder)


def merged_regions(boxes: DataFrame, keys: list[str], gap: float = 60.0, share: float = 0.5) -> DataFrame:
    """``keys, x1, y1, x2, y2``: boxes of one key that are ``near`` each other merged into their hull, until none are.

    In each round all boxes that are near each other, directly or over others, grow
    into one hull, so the order of boxes does not matter. They meet in the cells of
    a grid that they and half the gap around them cover, and take the least label of
    what they meet; labels are followed to their end, so that a chain of boxes needs
    few steps. The number of boxes on a page is not limited.
    """
    start = boxes.select(*keys, *[F.col(s).cast("double").alias(s) for s in SIDES]).distinct()
    now, grew = written(start.withColumn("label", F.monotonically_increasing_id()), "regions"), False
    while True:
        joins = written(_met(now, keys, gap, share), "joins")
        if joins.isEmpty() and not grew:
            return now.drop("label")
        if joins.isEmpty():
            hull = [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]
            after = now.groupBy(*keys, "label").agg(*hull)
        else:
            after = now.join(followed(joins).withColumnRenamed("id", "label"), "label", "left").select(*keys, *SIDES, F.coalesce("root", "label").alias("label"))
        grew = not joins.isEmpty()
        after = written(after, "regions")
        _drop(now)
        now = after


# ---------------------------------------------------------------- rasters


def dealt_out(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt out by hash to as many tasks as shuffles have; few bytes of packed runs are much work, so tasks are not put together by bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def is_packed(runs: DataFrame) -> bool:
    return isinstance(runs.schema["y"].dataType, T.ArrayType)


def packed(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, band, y, x1, x2, grey``: the runs of each band of rows of a page as arrays; packed ones stay as they are."""
    if is_packed(runs):
        return runs.select(*keys, "band", *RUN)
    whole = runs.dropna(subset=[*keys, *RUN]).select(*keys, F.floor(F.col("y") / BAND).cast("int").alias("band"), F.struct(*[F.col(c).cast("int").alias(c) for c in RUN]).alias("_r"))
    return whole.groupBy(*keys, "band").agg(F.collect_list("_r").alias("_r")).select(*keys, "band", *[F.col(f"_r.{c}").alias(c) for c in RUN])


def unpacked(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Run-length rows ``keys, y, x1, x2, grey``."""
    return runs.select(*keys, F.inline(F.arrays_zip(*RUN))) if is_packed(runs) else runs.select(*keys, *RUN)


def listed(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of an Arrow column of lists one after the other, and where each list starts, with the end."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    return column.values.slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False), at - at[0]


def lists(values: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))


def ink_rows(rows: DataFrame, keys: list[str], run: Callable[[pa.RecordBatch], dict[str, pa.Array]], out: str) -> DataFrame:
    """``keys`` and what ``run`` makes of batches of few rows each, by ``at``: the row of the batch that each row made comes from."""
    # a packed row may hold a megabyte; buffers are as large as a batch of them
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= PACKED_ROWS:
        conf.set(_BATCH, PACKED_ROWS)
    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    names = [c.split()[0] for c in out.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                made = run(b)
                at = pa.array(made["at"])
                told = [b.column(b.schema.get_field_index(k)).take(at) for k in keys]
                yield pa.RecordBatch.from_arrays([*told, *[made[n] for n in names]], names=[*keys, *names])

    return rows.mapInArrow(work, ", ".join([*kinds, out]))


def outlined(boxes: DataFrame, keys: list[str], grey: int = 0, thick: int = 1) -> DataFrame:
    """Packed runs of the outlines of boxes with whole pixels ``x1, y1, x2, y2`` (the last ones outside); dealt out by bands of rows."""
    c = {s: F.col(s).cast("int") for s in SIDES}
    band = F.explode(F.sequence(F.floor(c["y1"] / BAND).cast("int"), F.floor(F.greatest(c["y1"], c["y2"] - 1) / BAND).cast("int"))).alias("band")
    dealt = boxes.dropna(subset=keys).filter("x2 > x1 and y2 > y1").select(*keys, F.struct(*[c[s].alias(s) for s in SIDES]).alias("_b"), band)
    groups = dealt_out(dealt, *keys, "band").groupBy(*keys, "band").agg(F.collect_list("_b").alias("_b")).select(*keys, "band", *[F.col(f"_b.{s}").alias(s) for s in SIDES])
    rows = BAND

    def outlines(b: pa.RecordBatch) -> dict[str, pa.Array]:
        (x1, at), (y1, _), (x2, _), (y2, _) = (listed(b.column(b.schema.get_field_index(s))) for s in SIDES)
        group = np.repeat(np.arange(b.num_rows), np.diff(at))
        bands = b.column(b.schema.get_field_index("band")).to_numpy().astype(np.int64)
        x1, x2, y1, y2 = (v.astype(np.int64) for v in (x1, x2, y1, y2))
        start = bands[group] * rows
        first = np.maximum(y1, start)
        count = np.minimum(np.maximum(y2, y1 + 1), start + rows) - first
        i = np.repeat(np.arange(len(count)), count)
        y = np.arange(len(i)) - np.repeat(np.cumsum(count) - count - first, count)
        edge = (y < y1[i] + thick) | (y >= y2[i] - thick)
        a, z, left = x1[i], x2[i], np.where(edge, x2[i], np.minimum(x1[i] + thick, x2[i]))
        side = ~edge
        # rows of all groups are counted on, so that runs are joined in one go
        line = y - start[i] + group[i] * rows
        made = _joined(np.r_[line, line[side]], np.r_[a, np.maximum(z - thick, a)[side]], np.r_[left, z[side]])
        of = made["y"] // rows
        ends = np.searchsorted(of, np.arange(b.num_rows + 1))
        y = made["y"] - of * rows + bands[of] * rows
        return {"at": np.arange(b.num_rows), "band": b.column(b.schema.get_field_index("band"))} | {n: lists(v, ends) for n, v in (("y", y), ("x1", made["x1"]), ("x2", made["x2"]), ("grey", np.full(len(y), grey)))}

    return ink_rows(groups, keys, outlines, "band int, y array<int>, x1 array<int>, x2 array<int>, grey array<int>")


def drawn(boxes: DataFrame, keys: list[str], grey: int = 0, thick: int = 1) -> DataFrame:
    """Run-length rows of the outlines of boxes, as ``outlined`` has them packed."""
    return unpacked(outlined(boxes, keys, grey, thick), keys)


def _joined(y: np.ndarray, x1: np.ndarray, x2: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of a row that overlap or touch as one. Places are counted on through the rows, with a gap between them."""
    top, low = y.min(), x1.min()
    wide = x2.max() - low + 2
    first = (y - top) * wide + x1 - low
    order = np.argsort(first)
    first, last = first[order], np.maximum.accumulate(first[order] + (x2 - x1)[order])
    starts = np.flatnonzero(np.r_[True, first[1:] > last[:-1]])
    begin, end = first[starts], last[np.r_[starts[1:], len(y)] - 1]
    row = begin // wide
    return {"y": row + top, "x1": begin - row * wide + low, "x2": end - row * wide + low}


def _spans(on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of the maximal runs in the rows of a boolean array."""
    n, m = on.shape
    # all rows in one, with a gap after each
    flat = np.zeros(n * (m + 1) + 1, bool)
    flat[1:].reshape(n, m + 1)[:, :m] = on
    edges = np.flatnonzero(flat[1:] != flat[:-1])
    start, stop = edges[::2], edges[1::2]
    at = start // (m + 1)
    return at, start - at * (m + 1), stop - at * (m + 1)


def _painted(y: np.ndarray, x1: np.ndarray, x2: np.ndarray, value: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """An array with the runs' values; runs of a row don't overlap."""
    long = np.maximum(x2 - x1, 0).astype(np.int64)
    ends = np.cumsum(long)
    if len(y) and ends[-1] * 4 < shape[0] * shape[1]:
        # few pixels are set one by one
        image = np.zeros(shape[0] * shape[1], np.int32)
        image[np.arange(ends[-1]) + np.repeat(y.astype(np.int64) * shape[1] + x1 - ends + long, long)] = np.repeat(value, long)
        return image.reshape(shape)
    steps = np.zeros((shape[0], shape[1] + 1), np.int32)
    flat, row, value = steps.reshape(-1), y.astype(np.int64) * (shape[1] + 1), value.astype(np.int32)
    np.add.at(flat, row + x1, value)
    np.add.at(flat, row + x2, -value)
    np.cumsum(flat, out=flat)
    return steps[:, :-1]


def in_groups(rows: DataFrame, by: list[str], keys: list[str], run: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], out: str) -> DataFrame:
    """``keys`` and what ``run`` makes of the columns of each group of ``by``, as arrays; ``out`` is the schema of that.

    Groups are dealt out by hash and sorted, and come one after the other, so that
    many small ones cost little. One group is held at a time, and a batch. Rows
    without a value of ``by`` are left out.
    """
    kinds = {k: rows.schema[k].dataType.simpleString() for k in keys}
    names = [c.split()[0] for c in out.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
            columns = {c: frame[c].to_numpy() for c in frame.columns}
            made = [run({c: v[i:j] for c, v in columns.items()}) for i, j in zip(starts, [*starts[1:], len(frame)], strict=True)]
            sizes = [len(m[names[0]]) for m in made]
            told = {k: np.repeat(columns[k][starts], sizes) for k in keys}
            return pd.DataFrame(told | {n: np.concatenate([m[n] for m in made]) for n in names})

        for b in batches:
            if not len(b):
                continue
            fresh = np.zeros(len(b), bool)
            for c in by:
                v = b[c].to_numpy()
                fresh[1:] |= v[1:] != v[:-1]
            last = int(np.flatnonzero(fresh)[-1]) if fresh.any() else 0
            same = held and all(held[0][c].iloc[0] == b[c].iloc[0] for c in by)
            if last or (held and not same):
                whole = pd.concat([*held, b.iloc[:last]]) if last and same else pd.concat(held) if held else b.iloc[:0]
                if len(whole):
                    ends = np.flatnonzero(fresh[:last]) + (len(whole) - last) if last and same else np.zeros(0, int)
                    yield done(whole, np.r_[0, ends])
                if last and not same:
                    yield done(b.iloc[:last], np.r_[0, np.flatnonzero(fresh[:last])])
                held = [b.iloc[last:]] if last or not same else [*held, b]
            else:
                held.append(b)
        if held:
            yield done(pd.concat(held), np.zeros(1, int))

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join([f"`{k}` {t}" for k, t in kinds.items()] + [out])
    return rows.dropna(subset=by).repartition(n, *by).sortWithinPartitions(*by).mapInPandas(work, schema)


def window_ink(ink: np.ndarray, window: int = WINDOW, offset: int = OFFSET) -> np.ndarray:
    """Where an array exceeds the mean of the window around by more than ``offset``; outside is nothing.

    Sums are differences of prefix sums, taken only where there is something.
    """
    half, (n, m) = window // 2, ink.shape
    wide = np.int32 if ink.size * 255 < 1 << 31 else np.int64
    total = np.zeros((n + 1, m + 1), wide)
    np.cumsum(ink, axis=0, dtype=wide, out=total[1:, 1:])
    np.cumsum(total[1:, 1:], axis=1, out=total[1:, 1:])
    at = np.flatnonzero(ink != 0)
    y = at // m
    x = at - y * m
    top, stop = np.maximum(y - half, 0) * (m + 1), np.minimum(y + half + 1, n) * (m + 1)
    left, right = np.maximum(x - half, 0), np.minimum(x + half + 1, m)
    flat = total.reshape(-1)
    on = np.zeros(ink.shape, bool)
    on.reshape(-1)[at] = (ink[y, x] - offset) * window * window > flat[stop + right] - flat[top + right] - flat[stop + left] + flat[top + left]
    return on


def _sized(rows: DataFrame, pages: DataFrame, keys: list[str], part: str, side: str) -> DataFrame:
    """``rows`` of parts of pages (``part``, along ``side``), and one of each part with -1 for ``y`` and the page's width and height for ``x1, x2``.

    A part gets its page's sizes with its rows, so the rows need not be joined to pages first.
    """
    last = F.floor((F.col(side) - 1) / BAND).cast("int")
    sizes = pages.filter("width > 0 and height > 0").select(*keys, F.explode(F.sequence(F.lit(0), last)).alias(part), F.lit(-1).alias("y"), F.col("width").cast("int").alias("x1"), F.col("height").cast("int").alias("x2"))
    more = [c for c in rows.columns if c not in sizes.columns]
    return rows.unionByName(sizes.select("*", *[F.lit(0).alias(c) for c in more]))


def _with_size(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], int, int]:
    """The other rows of a part, and its page's width and height; 0 for a page that is not known."""
    at = np.flatnonzero(rows["y"] < 0)
    if not len(at):
        return rows, 0, 0
    inside = rows["y"] >= 0
    return {c: v[inside] for c, v in rows.items()}, int(rows["x1"][at[0]]), int(rows["x2"][at[0]])


_NONE = np.zeros(0, np.int64)


def thresholded(runs: DataFrame, pages: DataFrame, keys: list[str], window: int = WINDOW, offset: int = OFFSET) -> DataFrame:
    """``keys, y, x1, x2``: runs of pixels that are darker than the mean of the window around them by more than ``offset``.

    Work is dealt out by bands of rows; a band also gets the rows of half a window around it.
    """
    half = window // 2
    first, last = F.floor(F.greatest(F.col("y") - half, F.lit(0)) / BAND), F.floor((F.col("y") + half) / BAND)
    inside = runs.filter("x1 < x2 and x2 > 0 and y >= 0")
    banded = inside.select(*keys, F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("band"), "y", "x1", "x2", "grey")

    def band(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        start = int(rows["band"][0]) * BAND
        rows, width, height = _with_size(rows)
        kept = (rows["y"] < height) & (rows["x1"] < width)
        if not kept.any():
            return {"y": _NONE, "x1": _NONE, "x2": _NONE}
        y, x1, x2, grey = (rows[c][kept] for c in ("y", "x1", "x2", "grey"))
        shape = (min(BAND, height - start) + 2 * half, width)
        ink = _painted(y - start + half, np.maximum(x1, 0), np.minimum(x2, width), 255 - grey, shape)
        y, x1, x2 = _spans(window_ink(ink, window, offset)[half:-half])
        return {"y": y + start, "x1": x1, "x2": x2}

    return in_groups(_sized(banded, pages, keys, "band", "height"), [*keys, "band"], keys, band, "y int, x1 int, x2 int")


def column_runs(runs: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, x, y1, y2``: maximal runs of the columns, from those of the rows; dealt out by strips of columns."""
    strip = F.explode(F.sequence(F.floor(F.col("x1") / BAND).cast("int"), F.floor((F.col("x2") - 1) / BAND).cast("int"))).alias("strip")
    dealt = runs.select(*keys, strip, "y", "x1", "x2")

    def columns(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        start = int(rows["strip"][0]) * BAND
        rows, _, height = _with_size(rows)
        if not height or not len(rows["y"]):
            return {"x": _NONE, "y1": _NONE, "y2": _NONE}
        x1, x2 = np.maximum(rows["x1"] - start, 0), np.minimum(rows["x2"] - start, BAND)
        x, y1, y2 = _spans((_painted(rows["y"], x1, x2, np.ones(len(x1), np.int32), (height, int(x2.max()))) > 0).T)
        return {"x": x + start, "y1": y1, "y2": y2}

    return in_groups(_sized(dealt, pages, keys, "strip", "width"), [*keys, "strip"], keys, columns, "x int, y1 int, y2 int")


def rules(ink: DataFrame, pages: DataFrame, keys: list[str], divisors: tuple[int, ...] = DIVISORS) -> DataFrame:
    """``keys, x1, y1, x2, y2``: runs of rows and columns that opening by some kernel leaves.

    A kernel is a line as long as the page's side divided by a divisor. Opening by
    a line leaves the runs of its length or more, so the shortest kernel tells.
    """
    kernel = lambda side: F.greatest(F.lit(LEAST_KERNEL), F.least(*[F.floor(F.col(side) / d) for d in (*divisors, divisors[0])]))
    sizes = pages.select(*keys, kernel("width").alias("_kw"), kernel("height").alias("_kh"))
    long = lambda rows, a, b: rows.filter(F.col(b) - F.col(a) >= LEAST_KERNEL).join(sizes, keys)
    across = long(ink, "x1", "x2").filter(F.col("x2") - F.col("x1") >= F.col("_kw")).select(*keys, "x1", F.col("y").alias("y1"), "x2", (F.col("y") + 1).alias("y2"))
    down = long(column_runs(ink, pages, keys), "y1", "y2").filter(F.col("y2") - F.col("y1") >= F.col("_kh")).select(*keys, F.col("x").alias("x1"), "y1", (F.col("x") + 1).alias("x2"), "y2")
    return across.unionByName(down)


def _labelled(y: np.ndarray, x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
    """Components of runs, sorted by row and place, that touch those of the next row, at corners too."""
    n, label = len(y), np.arange(len(y))
    pairs = []
    for back in (False, True):
        # the first and the last run of the next row that a run may touch
        key = (y + 1) * (1 << 32) + (x1 if not back else x2)
        at = np.searchsorted(y * (1 << 32) + x2, (y + 1) * (1 << 32) + x1) if not back else np.searchsorted(y * (1 << 32) + x1, key, side="right")
        pairs.append(at)
    first, stop = pairs
    count = np.maximum(stop - first, 0)
    i = np.repeat(np.arange(n), count)
    j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    while len(i):
        least = np.minimum(label[i], label[j])
        before = label.copy()
        for side in (label[i], label[j], i, j):
            np.minimum.at(label, side, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _hulls(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, width: int, height: int, widen: int) -> tuple[np.ndarray, ...]:
    """The hulls of connected sets of boxes, widened within the page.

    Between the places where boxes begin and end nothing changes, so that each such
    stretch is painted as one pixel; bands of these are held one at a time.
    """
    x1, y1, x2, y2 = np.maximum(x1 - widen, 0), np.maximum(y1 - widen, 0), np.minimum(x2 + widen, width), np.minimum(y2 + widen, height)
    inside = (x1 < x2) & (y1 < y2)
    if not inside.any():
        return _NONE, _NONE, _NONE, _NONE
    x1, y1, x2, y2 = (v[inside] for v in (x1, y1, x2, y2))
    xs, ys = (np.unique(np.r_[a, b]) for a, b in ((x1, x2), (y1, y2)))
    left, right, top, low = (np.searchsorted(s, v) for s, v in ((xs, x1), (xs, x2), (ys, y1), (ys, y2)))
    found, wide = [], len(xs)
    for start in range(0, len(ys) - 1, BAND):
        at = np.flatnonzero((top < start + BAND) & (low > start))
        steps = np.zeros((min(BAND, len(ys) - 1 - start) + 1, wide), np.int32)
        first, stop = (np.clip(v[at] - start, 0, len(steps) - 1) * wide for v in (top, low))
        for row, x, step in ((first, left, 1), (first, right, -1), (stop, left, -1), (stop, right, 1)):
            np.add.at(steps.reshape(-1), row + x[at], np.int32(step))
        np.cumsum(steps, axis=0, out=steps)
        y, a, b = _spans(np.cumsum(steps, axis=1, out=steps)[:-1, :-1] > 0)
        found.append((y + start, a, b))
    y, a, b = (np.concatenate(v) for v in zip(*found, strict=True))
    label = _labelled(y, a, b)
    by = np.argsort(label, kind="stable")
    starts = np.flatnonzero(np.r_[True, label[by][1:] != label[by][:-1]])
    least, most = np.minimum.reduceat, np.maximum.reduceat
    return xs[least(a[by], starts)], ys[least(y[by], starts)], xs[most(b[by], starts)], ys[most(y[by], starts) + 1]


def _kernel(side: int, divisors: tuple[int, ...] = DIVISORS) -> int:
    return max(LEAST_KERNEL, min(side // d for d in divisors))


def page_components(runs: DataFrame, pages: DataFrame, keys: list[str], widen: int = WIDEN) -> DataFrame:
    """``keys, width, height, x1, y1, x2, y2``: what ``components`` makes of ``rules``, for pages each of which is in one row of a task.

    ``runs`` are packed; one page is held as pixels at a time.
    """
    sized = runs.join(pages.filter("width > 0 and height > 0").select(*keys, F.col("width").cast("int"), F.col("height").cast("int")), keys)
    whole = dealt_out(sized, *keys).groupBy(*keys, "width", "height").agg(*[F.collect_list(c).alias(c) for c in RUN]).select(*keys, "width", "height", *[F.flatten(c).alias(c) for c in RUN])

    def regions(b: pa.RecordBatch) -> dict[str, pa.Array]:
        widths, heights = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("width", "height"))
        (y, at), (x1, _), (x2, _), (grey, _) = (listed(b.column(b.schema.get_field_index(c))) for c in RUN)
        found, sizes = [], []
        for k, (width, height) in enumerate(zip(widths.tolist(), heights.tolist(), strict=True)):
            part = slice(at[k], at[k + 1])
            boxes = _rules(y[part], x1[part], x2[part], grey[part], width, height)
            found.append(_hulls(*boxes, width, height, widen))
            sizes.append(len(found[-1][0]))
        row = np.repeat(np.arange(b.num_rows), sizes)
        sides = {s: pa.array(np.concatenate(v), pa.int32()) for s, v in zip(SIDES, zip(*found, strict=True), strict=True)}
        return {"at": row, "width": pa.array(widths[row], pa.int32()), "height": pa.array(heights[row], pa.int32())} | sides

    return ink_rows(whole, keys, regions, "width int, height int, x1 int, y1 int, x2 int, y2 int")


def _rules(y: np.ndarray, x1: np.ndarray, x2: np.ndarray, grey: np.ndarray, width: int, height: int) -> tuple[np.ndarray, ...]:
    """``x1, y1, x2, y2``: the runs that ``rules`` finds on one page."""
    kept = (y >= 0) & (y < height) & (x1 < x2) & (x2 > 0) & (x1 < width)
    y, x1, x2, grey = (v[kept] for v in (y, x1, x2, grey))
    if not len(y):
        return _NONE, _NONE, _NONE, _NONE
    on = window_ink(_painted(y, np.maximum(x1, 0), np.minimum(x2, width), 255 - grey, (height, width)))
    row, a, b = _spans(on)
    at, c, d = _spans(on.T)
    across, down = b - a >= _kernel(width), d - c >= _kernel(height)
    row, a, b, at, c, d = *(v[across] for v in (row, a, b)), *(v[down] for v in (at, c, d))
    return np.r_[a, at], np.r_[row, c], np.r_[b, at + 1], np.r_[row + 1, d]


def components(boxes: DataFrame, pages: DataFrame, keys: list[str], widen: int = WIDEN) -> DataFrame:
    """``keys, x1, y1, x2, y2``: the hulls of connected sets of boxes with whole pixels, widened on all sides within the page.

    A page is painted in bands of rows, of which one is held at a time, and its run-length rows.
    """
    sizes = pages.filter("width > 0 and height > 0").select(*keys, F.col("width").cast("int").alias("x1"), F.lit(-1).alias("y1"), F.col("height").cast("int").alias("x2"), F.lit(-1).alias("y2"))
    dealt = boxes.filter("y2 >= 0").select(*keys, *SIDES).unionByName(sizes)

    def page(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        size, boxed = np.flatnonzero(rows["y2"] < 0), rows["y2"] >= 0
        if not len(size) or not boxed.any():
            return {s: _NONE for s in SIDES}
        found = _hulls(*(rows[s][boxed].astype(np.int64) for s in SIDES), int(rows["x1"][size[0]]), int(rows["x2"][size[0]]), widen)
        return dict(zip(SIDES, found, strict=True))

    return in_groups(dealt, keys, keys, page, "x1 int, y1 int, x2 int, y2 int")


def table_regions(runs: DataFrame, pages: DataFrame, keys: list[str], min_width: float = 0.25, min_height: float = 0.05, gap: float = 60.0) -> DataFrame:
    """``keys, x1, y1, x2, y2``: regions of ruled tables on page rasters.

    ``runs`` are run-length rows (``keys, y, x1, x2, grey``; those of a row don't
    overlap), or these packed; ``pages`` has ``keys, width, height`` in pixels. Sets of rules that
    touch, once widened, are regions if they have at least ``min_width`` and
    ``min_height`` of the page's sides and 4 % of its area; these are padded by 2 %
    or 12 pixels and merged. What lies outside of the page is ignored; pages
    without runs have no regions.
    """
    pages = written(pages.select(*keys, F.col("width").cast("int"), F.col("height").cast("int")), "pages")
    small = F.col("width").cast("long") * F.col("height") <= WHOLE
    found = page_components(packed(runs, keys), pages.filter(small), keys)
    large = pages.filter(~small)
    if not large.isEmpty():
        ink = written(thresholded(unpacked(runs, keys), large, keys), "ink")
        parts = components(rules(ink, large, keys), large, keys).join(large, keys)
        found = found.unionByName(parts)
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    large = (w >= F.floor(F.col("width") * min_width)) & (h >= F.floor(F.col("height") * min_height)) & (w * h >= F.col("width") * F.col("height") * MIN_AREA)
    px, py = (F.greatest(F.lit(12), F.floor(s * 0.02)) for s in (w, h))
    zero = F.lit(0)
    padded = found.filter(large).select(*keys, F.greatest(F.col("x1") - px, zero).alias("x1"), F.greatest(F.col("y1") - py, zero).alias("y1"), F.least(F.col("x2") + px, F.col("width")).alias("x2"), F.least(F.col("y2") + py, F.col("height")).alias("y2"))
    return merged_regions(padded, keys, gap)
