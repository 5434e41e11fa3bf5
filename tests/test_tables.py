from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide import YELLOW, load_partitions, replace_partition, work_folder
from monthtide.operators import (
    add_column,
    clear_partition,
    ensure_database,
    ensure_main,
    ensure_staging,
    ensure_table,
    filled_partitions,
    partitions,
)

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


@pytest.fixture
def database(spark):
    name, location = f"t_{uuid.uuid4().hex}", work_folder(spark, "database")
    ensure_database(spark, name, location)
    ensure_database(spark, name, location)
    return name


@pytest.fixture
def staged(spark, database):
    name = f"{database}.staged"
    ensure_table(spark, name, SCHEMA, work_folder(spark, "staged"), ["load_month"])
    load_partitions(rows(spark, (1, "x", "202501"), (2, "y", "202501"), (3, "z", "202502")), name, ["202501", "202502"])
    return name


def rows(spark, *values):
    return spark.createDataFrame(list(values), "a bigint, b string, load_month string")


def contents(spark, table):
    return sorted((r.a, r.load_month) for r in spark.table(table).collect())


def test_tables_are_created_once_and_found_again(spark, database):
    root = work_folder(spark, "tables")
    staging, main = ensure_staging(spark, YELLOW, database, root), ensure_main(spark, YELLOW, database, root)
    assert staging == f"{database}.yellow_taxi_staging" and main == f"{database}.yellow_taxi"
    assert spark.table(staging).columns == [*YELLOW.schema.names, "load_month", "load_id"]
    assert spark.table(main).columns == [*YELLOW.schema.names, "trip_hash", "load_id", "pickup_month"]
    assert not ensure_table(spark, main, YELLOW.schema, f"{root}/yellow_taxi", ["load_id", "pickup_month"])
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {main}").collect()}
    assert properties["clustered_by"] == "VendorID,tpep_pickup_datetime"


def test_files_outlast_the_catalog_entry(spark, database, staged):
    location = spark.sql(f"DESCRIBE FORMATTED {staged}").where("col_name = 'Location'").first().data_type
    before = contents(spark, staged)
    spark.sql(f"DROP TABLE {staged}")
    assert ensure_table(spark, staged, SCHEMA, location, ["load_month"])
    assert contents(spark, staged) == before


def test_added_column_reads_null_in_older_rows(spark, staged):
    assert add_column(spark, staged, "trip_hash", T.StringType())
    assert not add_column(spark, staged, "trip_hash", T.StringType())
    assert spark.table(staged).where("trip_hash is null").count() == 3
    more = rows(spark, (9, "n", "202503")).withColumn("trip_hash", F.lit("h"))
    load_partitions(more, staged, ["202503"])
    assert spark.table(staged).where("trip_hash = 'h'").count() == 1


def test_months_default_to_those_of_the_rows(spark, staged):
    assert load_partitions(rows(spark, (7, "q", "202501"), (8, "r", "202504")), staged) == ["202501", "202504"]
    assert contents(spark, staged) == [(3, "202502"), (7, "202501"), (8, "202504")]


def test_replace_touches_only_the_given_months(spark, staged):
    assert load_partitions(rows(spark, (7, "q", "202501"), (8, "r", "202502")), staged, ["202501"]) == ["202501"]
    assert contents(spark, staged) == [(3, "202502"), (7, "202501")]


def test_replacing_twice_is_replacing_once(spark, staged):
    for _ in range(2):
        load_partitions(rows(spark, (7, "q", "202501"), (7, "q", "202501")), staged, ["202501"])
    assert contents(spark, staged) == [(3, "202502"), (7, "202501"), (7, "202501")]


def test_replace_by_nothing_empties_the_month(spark, staged):
    load_partitions(rows(spark, (5, "s", "202502")), staged, ["202501", "202502"])
    assert contents(spark, staged) == [(5, "202502")]
    assert filled_partitions(spark, staged, ["202501", "202502"]) == {"202502"}


def test_month_of_the_file_not_of_the_row(spark, staged):
    strays = spark.createDataFrame([(4, "2024-12-31")], "a bigint, b string")
    replace_partition(spark, strays, staged, "202502")
    assert contents(spark, staged) == [(1, "202501"), (2, "202501"), (4, "202502")]


def test_write_if_empty_skips_filled_months(spark, staged):
    batch = rows(spark, (7, "q", "202501"), (8, "r", "202503"))
    assert load_partitions(batch, staged, ["202501", "202503"], mode="if_empty") == ["202503"]
    assert contents(spark, staged) == [(1, "202501"), (2, "202501"), (3, "202502"), (8, "202503")]
    assert load_partitions(batch, staged, ["202501", "202503"], mode="if_empty") == []


def test_write_if_empty_fills_an_emptied_month(spark, staged):
    clear_partition(spark, staged, {"load_month": "202501"})
    assert replace_partition(spark, rows(spark, (6, "t", "x")), staged, "202501", mode="if_empty") == ["202501"]
    assert contents(spark, staged) == [(3, "202502"), (6, "202501")]


def test_append_keeps_duplicates(spark, staged):
    replace_partition(spark, rows(spark, (1, "x", "x")), staged, "202501", mode="append")
    assert contents(spark, staged) == [(1, "202501"), (1, "202501"), (2, "202501"), (3, "202502")]


def test_unknown_mode_is_refused(spark, staged):
    with pytest.raises(ValueError, match="mode"):
        replace_partition(spark, rows(spark, (1, "x", "x")), staged, "202501", mode="merge")


def test_cleared_partition_is_gone_with_its_files(spark, staged):
    clear_partition(spark, staged, {"load_month": "202501"})
    assert partitions(spark, staged) == [{"load_month": "202502"}]
    spark.catalog.recoverPartitions(staged)
    assert contents(spark, staged) == [(3, "202502")]


def test_month_filter_prunes_partitions(spark, staged):
    scan = spark.table(staged).where("load_month = '202502'").select("a")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "(load_month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<a:bigint>" in plan
