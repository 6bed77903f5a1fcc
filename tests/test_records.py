"""Dense records against versions that compare all lines of a page, and on crowded pages."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from pagequarry.operators import records as rc

LINE = "page int, line_no long, text string, confidence double, x1 double, y1 double, x2 double, y2 double"


def lines(seed, n=150):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        text = rnd.choice([f"Serial No: {10000 + k}", f"{700 + k}LT01", f"Setpoint: {k % 7} BAR", f"Serial No: {20000 + k} or {300 + k}PT22"])
        x, y = rnd.randrange(0, 60, 20) * 1.0, rnd.randrange(0, 400, 13) * 1.0
        out.append((k % 2, k, text, rnd.choice([0.5, 0.9, 70.0]), x, y, x + rnd.choice([20.0, 45.0]), y + rnd.choice([10.0, 40.0])))
    return out


def test_pairs_equal_all_with_all(spark):
    own = 0
    for seed in range(3):
        rows = lines(seed)
        want = set()
        for page, no, text, _, _, y1, x2, y2 in rows:
            if "Serial" not in text:
                continue
            reach, found = max(26.0, (y2 - y1) * 1.15), []
            for p, n, other, _, x, y, *_ in rows:
                tag = other.split()[-1]
                if p == page and ("LT" in tag or "PT" in tag) and abs(y - y1) <= reach and x >= x2 - 30:
                    own += n == no
                    if n != no:
                        found.append((x, abs(y - y1), n, tag))
            if found:
                want.add((page, no, text.split()[2], min(found)[3]))
        got = rc.pairs(spark.createDataFrame(rows, LINE)).select("page", "line_no", "serial", "tag").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    # there are lines that would be their own neighbour
    assert own


def test_set_points_equal_all_with_all(spark):
    rows = lines(7)
    df = spark.createDataFrame(rows, LINE)
    want = set()
    for page, no, text, _, _, y1, *_ in rows:
        near = [(abs(y - y1), n, t.split(": ")[1]) for p, n, t, _, _, y, *_ in rows if p == page and t.startswith("Setpoint") and abs(y - y1) <= 120]
        if "Serial" in text and near:
            want.add((page, no, min(near)[2], min(near)[0]))
    got = rc.nearest_set_points(df.filter("text like 'Serial%'"), df).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def crowded(spark, text):
    """A page with 60,000 lines of records and as many of ``text`` in few places."""
    n = spark.range(120_000)
    k = F.col("id") % 2
    words = F.when(k == 0, F.concat(F.lit("Serial No: "), (F.col("id") + 100_000).cast("string"))).otherwise(F.lit(text))
    y = (F.col("id") % 3).cast("double")
    return n.select(F.lit(1).alias("page"), F.col("id").alias("line_no"), words.alias("text"), F.lit(0.9).alias("confidence"), (k * 200.0).alias("x1"), y.alias("y1"), (k * 200.0 + 150).alias("x2"), (y + 20).alias("y2"))


def test_crowded_page_of_set_points(spark):
    began, page = time.time(), crowded(spark, "Setpoint: 5 BAR")
    assert rc.nearest_set_points(page.filter("line_no % 2 = 0"), page).filter("set_point = '5 BAR'").count() == 60_000
    assert time.time() - began < 60


def test_crowded_page_of_pairs(spark):
    began = time.time()
    assert rc.pairs(crowded(spark, "7000LT01")).filter("tag = '7000LT01'").count() == 60_000
    assert time.time() - began < 60
