from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthtide.functions import (
    in_month,
    month_in_zone,
    month_key,
    normalize_column_names,
    normalize_name,
    normalized,
    snake_case_columns,
)


def test_snake_case(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "VendorID int, PULocationID int, RatecodeID int, Airport_fee int")
    assert snake_case_columns(df).columns == ["vendor_id", "pulocation_id", "ratecode_id", "airport_fee"]


@pytest.mark.parametrize(
    "name, expected", [(" a-b ", "a_b"), ("", "field"), ("1x", "f_1x"), ("x" * 301, "x" * 300), ("  ", "field")]
)
def test_normalize_name(name, expected):
    assert normalize_name(name) == expected


def test_normalize_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `2c` int")
    assert normalize_column_names(df).columns == ["a_b", "f_2c"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x7FF, exclude_categories=["Cs", "Cn"]), max_size=6), min_size=50))
def test_names_in_data_follow_the_same_rule(session, names):
    # Letters newer than the Unicode version of the JVM are left out.
    names += ["²x", "①", "\x1ca\x85", "é\u0301b", "9", " _ "]
    rows = session.createDataFrame([(n,) for n in names], "n string").select("n", normalized(F.col("n")).alias("out"))
    assert [r for r in rows.collect() if r.out != normalize_name(r.n)] == []


def test_month_keys(spark):
    df = spark.createDataFrame([(datetime(2025, 6, 30, 16, 0),), (None,)], "ts timestamp")
    rows = df.select(month_key(F.col("ts")).alias("utc"), month_in_zone(F.col("ts"), "Asia/Taipei").alias("there")).collect()
    assert [(r.utc, r.there) for r in rows] == [("202506", "202507"), ("000000", "000000")]


@pytest.mark.parametrize("month, expected", [("199712", 2), ("199801", 1), ("199711", 0)])
def test_in_month(spark, month, expected):
    times = [(datetime(1997, 12, 1),), (datetime(1997, 12, 31, 23, 59, 59, 999999),), (datetime(1998, 1, 1),), (None,)]
    for sql_type in ("timestamp", "timestamp_ntz"):
        assert spark.createDataFrame(times, f"ts {sql_type}").where(in_month(F.col("ts"), month)).count() == expected
    with pytest.raises(ValueError):
        in_month(F.col("ts"), "199813")


def test_in_month_reaches_the_reader(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = lineitem.where(in_month(F.col("l_shipdate"), "199803"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed
