"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def use_utc(spark: SparkSession) -> SparkSession:
    """Fix the session zone: month keys and casts from zone-less time follow it.

    Timestamps are written in the form for which Parquet keeps ranges, without
    which no row group could be skipped by pickup.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; call use_utc(spark) first")


def tune(spark: SparkSession) -> SparkSession:
    """Settings for large loads; all may be changed at run time.

    Shuffles start with several partitions per core, so that each fits in memory
    however large the month is, and AQE merges those that turn out small.
    """
    cores = spark.sparkContext.defaultParallelism
    initial = max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
    return use_utc(spark)


def local_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few driver-side rows (assets, report lines) as a DataFrame.

    Handed over as Arrow they become part of the plan; plain Python rows would
    start Python workers on the executors just to be read.
    """
    schema = T.StructType.fromDDL(ddl)
    columns = zip(*rows) if rows else [()] * len(schema)
    table = pa.table([pa.array(list(values)) for values in columns], names=schema.names)
    return spark.createDataFrame(table, schema)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame of ``schema``."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="monthtide-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one every executor shares.

    The cluster names that folder in ``spark.checkpoint.dir``. A local session
    without the setting gets a temporary folder; a cluster session must set it,
    since a folder on one machine is invisible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/monthtide/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` read back from a table in the work folder: computed once, and its
    lineage cut there, so that a lost executor does not mean doing it again.
    Fingerprints, digits of 4 bits each, take half the room by this compression."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
