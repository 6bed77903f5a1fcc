from __future__ import annotations

import random

from pyspark.sql import functions as F

from pagequarry.operators.numbering import medians, ranked
from pagequarry.sources import files


def test_places_equal_those_of_a_sort(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, "a", "a", "a", "b"]), f"same-prefix-{rnd.randrange(10**6)}", i) for i in range(3000)] + [("c", None, -1)]
    df = spark.createDataFrame(rows, "g string, k string, i int")
    got = {(r["g"], r["place"], r["i"]) for r in ranked(df, ["k", "i"], ["g"]).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
        want |= {(g, n, r[2]) for n, r in enumerate(mine)}
    assert got == want
    assert {r["place"] for r in ranked(df, ["k", "i"]).collect()} == set(range(len(rows)))
    assert ranked(df.limit(0), ["k"], ["g"]).count() == 0


def test_ranges_are_even_where_keys_have_one_prefix(spark):
    df = spark.range(40_000).select(F.format_string("EQUIPMENT-%09d", F.col("id") * 7).alias("k"))
    out = ranked(df, ["k"], parts=8)
    sizes = [r["n"] for r in out.withColumn("i", F.floor(F.col("place") / 5000)).groupBy("i").agg(F.count("*").alias("n")).collect()]
    assert sizes == [5000] * 8
    # each range is a file of the dealt table
    files_of = [f for f in out.inputFiles() if "/ranged-" in f]
    assert len(files_of) == 8 and max(spark.read.parquet(f).count() for f in files_of) < 2 * 40_000 / 8


def test_medians_are_exact_however_the_group_is_dealt(spark):
    rnd = random.Random(6)
    rows = [(None, float(rnd.randrange(50))) for _ in range(101)] + [("a", rnd.random()) for _ in range(4000)] + [("b", 2.0), ("b", 3.0), ("c", None), ("d", 1.5), ("e", None), ("e", 7.0)]
    # a third of a group is one value
    rows += [("a", 0.5)] * 2000
    df = spark.createDataFrame(rows, "g string, v double")
    for parts in (1, 7):
        got = {r["g"]: (r["middle"], r["upper_middle"], r["n"]) for r in medians(df, ["g"], "v", parts).collect()}
        want = {}
        for g in {r[0] for r in rows}:
            v = sorted(r[1] for r in rows if r[0] == g and r[1] is not None)
            if v:
                want[g] = ((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2, v[len(v) // 2], len(v))
        assert got == want
    assert medians(df.limit(0), ["g"], "v").count() == 0


def test_control_files_are_replaced_in_one_step(spark, tmp_path):
    path = f"file://{tmp_path}/status.json"
    for text in ("one", "two"):
        files.put_text(spark, path, text)
        assert files.get_text(spark, path) == text
    assert not list(tmp_path.glob("*.partial"))
