"""Partitioned Parquet tables: create, extend, and write by month."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.kinds import Kind
from monthtide.session import no_rows

LOAD_MONTH = "load_month"
LOAD_ID = "load_id"
PICKUP_MONTH = "pickup_month"

MODES = ("truncate", "if_empty", "append")


def _quoted(names: Iterable[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _columns_ddl(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def ensure_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    partitioned_by: Sequence[str] = (),
    clustered_by: Sequence[str] = (),
) -> bool:
    """Create ``table`` unless it exists; True if it was created.

    The files live at ``location`` and outlast the catalog: partitions found
    there are registered. ``clustered_by`` is recorded as a property; writers
    sort by it, which lets Parquet min/max statistics skip row groups.
    """
    if spark.catalog.tableExists(table):
        return False
    partition_fields = [T.StructField(c, T.StringType()) for c in partitioned_by]
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl([*schema, *partition_fields])}) USING parquet"
    if partitioned_by:
        statement += f" PARTITIONED BY ({_quoted(partitioned_by)})"
    statement += f" LOCATION '{location}'"
    if clustered_by:
        statement += f" TBLPROPERTIES ('clustered_by' = '{','.join(clustered_by)}')"
    if partitioned_by:
        # Appending nothing makes sure that the folder is there to be listed.
        nothing = no_rows(spark, T.StructType([*schema, *partition_fields]))
        nothing.write.mode("append").partitionBy(*partitioned_by).parquet(location)
    spark.sql(statement)
    if partitioned_by:
        spark.catalog.recoverPartitions(table)
    return True


def ensure_staging(spark: SparkSession, kind: Kind, database: str, root: str) -> str:
    """Staging table of ``kind``: by month of the *file* and by load of it."""
    table = f"{database}.{kind.staging_table}"
    ensure_table(spark, table, kind.schema, f"{root}/{kind.staging_table}", [LOAD_MONTH, LOAD_ID], kind.cluster)
    if LOAD_ID not in partition_columns(spark, table):
        raise ValueError(f"{table} was made before staged rows named their load; drop it and its files, it is filled anew")
    return table


def ensure_main(spark: SparkSession, kind: Kind, database: str, root: str) -> str:
    """Main table of ``kind``, by load and by month of the *pickup*.

    The fingerprint column is added in a second step, so that tables which
    predate it get it too; their rows read NULL there.
    """
    table = f"{database}.{kind.main_table}"
    ensure_table(spark, table, kind.schema, f"{root}/{kind.main_table}", [LOAD_ID, PICKUP_MONTH], kind.cluster)
    add_column(spark, table, kind.hash_column, T.StringType())
    return table


def add_column(spark: SparkSession, table: str, column: str, data_type: T.DataType) -> bool:
    """Add ``column`` unless the table has it; True if it was added."""
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{column}` {data_type.simpleString()})")
    return True


def location_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partition values known to the catalog. One entry per partition."""
    listed = [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return [dict(part.split("=", 1) for part in spec.split("/")) for spec in listed]


def filled_partitions(spark: SparkSession, table: str, months: Iterable[str]) -> set[str]:
    """Those of ``months`` whose partition holds at least one row."""
    known = {p[LOAD_MONTH] for p in partitions(spark, table)} & set(months)
    if not known:
        return set()
    # Only the partition column is read: row counts come from the footers.
    found = spark.table(table).where(F.col(LOAD_MONTH).isin(sorted(known))).select(LOAD_MONTH).distinct()
    return {r[LOAD_MONTH] for r in found.collect()}


def clear_partition(spark: SparkSession, table: str, spec: dict[str, str]) -> None:
    """Delete the rows of one partition (every partition column given)."""
    where = ", ".join(f"`{c}` = '{v}'" for c, v in spec.items())
    data_columns = [c for c in spark.table(table).columns if c not in spec]
    empty = no_rows(spark, spark.table(table).select(*data_columns).schema)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({where}) SELECT * FROM {{empty}}", empty=empty)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({where})")


def append_rows(df: DataFrame, table: str, order_by: Sequence[str] = ()) -> None:
    """Append ``df``, sorted inside each partition by ``order_by``."""
    spark = df.sparkSession
    target = spark.table(table).columns
    slices = partition_columns(spark, table)
    if slices or order_by:
        # Partition columns first: the sort the partitioned writer needs anyway.
        df = df.sortWithinPartitions(*slices, *order_by)
    df.select(*target).write.mode("append").insertInto(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _replace_months(df: DataFrame, table: str, months: Sequence[str], order_by: Sequence[str]) -> None:
    spark = df.sparkSession
    target = spark.table(table).columns
    (
        df.sortWithinPartitions(LOAD_MONTH, *order_by)
        .select(*target)
        .write.mode("overwrite")
        # Per write, not per session: other partitions must survive.
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_MONTH)
        .parquet(location_of(spark, table))
    )
    added = " ".join(f"PARTITION (`{LOAD_MONTH}` = '{m}')" for m in months)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(table)


def load_partitions(
    df: DataFrame,
    table: str,
    months: Sequence[str] | None = None,
    mode: str = "truncate",
    order_by: Sequence[str] = (),
    rebalance: bool = True,
    has_rows: Callable[[str], bool] | None = None,
) -> list[str]:
    """Write ``df`` into the ``load_month`` partitions ``months``.

    Without ``months`` these are the ones ``df`` has rows for. ``truncate`` replaces these partitions and no others (a month without rows
    ends up empty), ``if_empty`` leaves alone those that hold rows, ``append``
    adds to them. Returns the months written. ``rebalance`` gathers each month
    into files of good size first (AQE splits a month that is too large); turn it
    off when the input is one file per month already. ``has_rows`` tells whether
    ``df`` has rows for a month to be replaced, if the caller can say so without
    the pass over its month column that is made otherwise.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = df.sparkSession
    if months is None:
        months = [r[LOAD_MONTH] for r in df.select(LOAD_MONTH).distinct().collect()]
        has_rows = lambda _: True
    months = sorted(set(months))
    if mode == "if_empty":
        full = filled_partitions(spark, table, months)
        months = [m for m in months if m not in full]
    if not months:
        return []
    df = df.where(F.col(LOAD_MONTH).isin(months))
    emptied: set[str] = set()
    if mode == "truncate":
        replaced = {p[LOAD_MONTH] for p in partitions(spark, table)} & set(months)
        if has_rows:
            emptied = {m for m in replaced if not has_rows(m)}
        elif replaced:
            found = df.where(F.col(LOAD_MONTH).isin(sorted(replaced))).select(LOAD_MONTH).distinct()
            emptied = replaced - {r[LOAD_MONTH] for r in found.collect()}
    if rebalance and len(months) > 1:
        df = df.hint("rebalance", LOAD_MONTH)
    if mode == "truncate":
        _replace_months(df, table, months, order_by)
        for month in sorted(emptied):
            clear_partition(spark, table, {LOAD_MONTH: month})
    else:
        append_rows(df, table, order_by)
    return months


def replace_partition(
    spark: SparkSession, df: DataFrame, table: str, month: str, mode: str = "truncate", order_by: Sequence[str] = ()
) -> list[str]:
    """Load all of ``df`` into the partition of one month, whatever its dates."""
    return load_partitions(df.withColumn(LOAD_MONTH, F.lit(month)), table, [month], mode, order_by)
