"""Each query against its SQL twin on the smallest tables, by DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

from pagequarry import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or (not isinstance(v, (list, str)) and pd.isna(v)):
            return "~"
        if isinstance(v, bool) or str(type(v)).find("bool") >= 0:
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = plans.queries()[name](spark, SF).toPandas(), duck.sql(plans.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want) and len(got)


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())


def test_fixtures_hold_all_orders(spark):
    from pagequarry.plans.registry import Inputs

    i = Inputs(spark, SF)
    assert i.cells.select("table_id").distinct().count() == i.orders.count()
    assert i.cert_lines.count() == 3 * i.base_lines.count()
    # what is to have no match has other values, and is not left out
    assert i.layer.count() == i.primary_cells.count() == i.cells.count()
    assert i.decisions.count() == i.part.count() and i.candidates.count() == i.page_text.count() == i.documents.count()
    assert i.ruled_lines.count() == i.page_lines.count() == i.ocr_lines.count()


def test_contexts_hold_whole_texts(spark):
    from pyspark.sql import functions as F

    from pagequarry.plans.registry import Inputs

    i = Inputs(spark, SF)
    longest = i.candidates.agg(F.max(F.length("context"))).first()[0]
    assert longest >= i.page_text.filter("page % 7 in (0, 5, 6)").agg(F.max(F.length("text"))).first()[0]


def test_scanned_texts_are_whole(spark):
    from pyspark.sql import functions as F

    from pagequarry.plans.registry import Inputs

    i = Inputs(spark, SF)
    whole = i.page_text.select("page", F.length("text").alias("n"))
    for name in ("rotations", "table_text"):
        short = getattr(i, name).join(whole, "page").filter(F.length("text") < F.col("n"))
        assert short.isEmpty(), name


def test_work_on_orders_is_dealt_out_once(spark):
    """Cells, lines and their groups stay in the task of their order, and there are more tasks for more orders."""
    from pagequarry.plans.registry import Inputs

    i = Inputs(spark, SF)
    assert i.n_parts("orders") == 1 and i.by_order.cells.count() == i.cells.count()
    for name in ("g11_slot_emission", "j22_unique_band", "g04_replace_dedup", "a07_ordered_text"):
        plan = plans.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan, name


def test_numbers_are_made_text_once_for_each_group(spark):
    from pyspark.sql import functions as F

    from pagequarry.functions import text as t
    from pagequarry.operators import measure as ms

    rows_ = spark.createDataFrame([("a", 0.0, 1), ("a", -0.0, 2), ("a", 1.5, 3), ("a", 1.5, 4), ("a", None, 5)], "tag string, value double, seq int")
    once = ms.per_number(rows_, ["tag"], ["value"], F.max("seq").alias("seq")).withColumn("shown", t.general(F.col("value")))
    assert sorted((r["shown"], r["seq"]) for r in once.collect()) == [("-0", 2), ("0", 1), ("1.5", 4), ("null", 5)]
    # a filter on the text stays above the groups
    plan = once.filter("shown <> 'x'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("format_string") < plan.index("Aggregate")
