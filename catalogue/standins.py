"""The test tables in the roles the library works with.

``lineitem`` and ``orders`` play two kinds of monthly files. The main table of a
merge holds the lineitem rows of status F; the batch is the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide import Kind, fingerprint
from monthtide.functions import month_key
from monthtide.kinds import schema_from_text

LINEITEM = Kind(
    name="lineitem",
    schema=schema_from_text(
        "l_orderkey INTEGER, l_partkey INTEGER, l_suppkey INTEGER, l_linenumber INTEGER, l_quantity FLOAT, "
        "l_extendedprice FLOAT, l_discount FLOAT, l_tax FLOAT, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP REQUIRED"
    ),
    pickup="l_shipdate",
    identity=(
        "l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
    ),
    merge_keys=("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"),
    cluster=("l_suppkey", "l_shipdate"),
    omitted=("l_tax",),
)

ORDERS = Kind(
    name="orders",
    schema=schema_from_text(
        "o_orderkey INTEGER, o_custkey INTEGER, o_orderstatus STRING, o_totalprice FLOAT, "
        "o_orderdate TIMESTAMP REQUIRED, o_orderpriority STRING"
    ),
    pickup="o_orderdate",
    identity=("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice", "o_orderstatus"),
    merge_keys=("o_orderkey", "o_orderdate"),
    cluster=("o_custkey", "o_orderdate"),
    omitted=("o_orderpriority",),
)

EVENT_IDENTITY = ("event_id", "ts", "user_id", "event_type", "value")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "lineitem"), LINEITEM.identity)


def loaded(batch: DataFrame) -> DataFrame:
    """The part of lineitem that is in the main table already."""
    return batch.where("l_linestatus = 'F'")


def by_ship_month(df: DataFrame) -> DataFrame:
    return df.withColumn("load_month", month_key(F.col("l_shipdate")))


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as in the test tables."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema
        ]
    )
