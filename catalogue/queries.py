"""One query per operator, over whole tables.

Queries about tables write real ones, in a new folder below the shared work
folder, and return what a reader then sees.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from unittest import mock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.standins import (
    EVENT_IDENTITY,
    LINEITEM,
    ORDERS,
    by_ship_month,
    hashed_lineitem,
    loaded,
    table,
    zoneless,
)
from monthtide import Config, catch_up, conform, fingerprint, gate, manifest, merge_insert, run, use_utc, work_folder
from monthtide.functions import identity_json, in_month, month_in_zone, month_key, normalized, snake_case_columns
from monthtide.operators import (
    add_column,
    append_rows,
    bloom_filters,
    ensure_database,
    ensure_table,
    load_partitions,
    new_keys,
    new_keys_by_filter,
    pending_rows,
    publish,
    write_pending,
)
from monthtide.plans import monthly_run as monthly_run_module
from monthtide.plans import plan_assets
from monthtide.session import stored
from monthtide.sources import changed_landing, pending_landing, read_files, row_digest

# A month of orders that lands with a column nobody declared.
_BAD_MONTH = "199603"

Query = Callable[[SparkSession, str], DataFrame]


# -- fingerprints, filters and names ------------------------------------------


def fingerprint_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("identity", identity_json(LINEITEM.identity))
    return fingerprint(rows, LINEITEM.identity).select("l_orderkey", "l_linenumber", "identity", "trip_hash")


def fingerprint_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("identity", identity_json(ORDERS.identity))
    return fingerprint(rows, ORDERS.identity).select("o_orderkey", "identity", "trip_hash")


def fingerprint_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("identity", identity_json(EVENT_IDENTITY))
    return fingerprint(rows, EVENT_IDENTITY).select("event_id", "identity", "trip_hash")


def partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(in_month(F.col("l_shipdate"), "199803"))


def month_in_time_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    # Late enough in the day that the month turns in the other zone.
    placed = F.col("o_orderdate") + F.expr("interval 17 hours")
    return orders.select("o_orderkey", month_in_zone(placed, "Asia/Taipei").alias("month_there"))


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", normalized(F.col("p_name")).alias("name"), normalized(F.col("p_type")).alias("type"))


def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("VendorID"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_suppkey").alias("RatecodeID"),
        F.col("l_tax").alias("Airport_fee"),
        F.col("l_linenumber").alias("lineNumber"),
    )
    return snake_case_columns(renamed)


# -- landing ------------------------------------------------------------------


def asset_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_assets(_spans(spark, sf_dir), "source", "landing")


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    placed = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    both = shipped.withColumn("kind", F.lit("lineitem")).unionByName(placed.withColumn("kind", F.lit("orders")))
    return both.select("kind", F.to_date("first").alias("first"), F.to_date("last").alias("last"))


def catchup_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipping = _spans(spark, sf_dir).where("kind = 'lineitem'").withColumn("kind", F.lit("orders"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    landed = (
        table(spark, sf_dir, "orders")
        .groupBy(F.format_string("orders_tripdata_%s.parquet", month).alias("file_name"))
        .agg(F.count("*").alias("size"))
    )
    return pending_landing(plan_assets(shipping), landed, larger_than=0).select("file_name", "load_month")


def ready_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file_name"))
    listing = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("file_name"), F.octet_length("html").cast("bigint").alias("size")
    )
    return gate(plan, listing, min_size=5_000)


def text_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.encode("text", "UTF-8")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(content).cast("bigint").alias("size"), F.md5(content).alias("md5")
    )


def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("md5", F.md5("text"))
    return row_digest(documents, by=["source"], columns=["doc_id", "md5", "lang", "n_chars"])


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("file_name"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.md5("text").alias("checksum"),
    )


def landing_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = _documents(spark, sf_dir)
    landed = candidates.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return pending_landing(candidates, landed, larger_than=1_000).select("file_name", "size")


def landing_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # The landed version of a document of low quality had other contents.
    version = F.when(F.col("quality") == 1, F.col("text")).otherwise(F.concat("text", F.lit("\n")))
    landed = documents.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("file_name"), F.md5(version).alias("checksum")
    )
    return changed_landing(_documents(spark, sf_dir), landed).select("file_name", "checksum")


# -- schema and tables --------------------------------------------------------

_ALL_INTEGERS = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_shipdate", T.TimestampType(), False),
        T.StructField("l_linenumber", T.LongType()),
        T.StructField("l_quantity", T.LongType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_partkey", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("surcharge", T.DoubleType()),
    ]
)


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = [f.name for f in _ALL_INTEGERS if f.name != "surcharge"]
    return zoneless(conform(table(spark, sf_dir, "lineitem").select(*present), _ALL_INTEGERS, strict=True))


def conform_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in a required column are let through and share one month."""
    lineitem = table(spark, sf_dir, "lineitem")
    unknown = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    fitted = conform(lineitem.withColumn("l_shipdate", unknown), LINEITEM.schema)
    return zoneless(fitted.withColumn("pickup_month", month_key(F.col("l_shipdate"))))


def _new_table(df: DataFrame, purpose: str, partitioned_by: tuple[str, ...] = ()) -> str:
    """An empty table with the columns of ``df``."""
    spark, folder = df.sparkSession, work_folder(df.sparkSession, purpose)
    database = f"{purpose}_{uuid.uuid4().hex}"
    ensure_database(spark, database, folder)
    data = T.StructType([f for f in df.schema if f.name not in partitioned_by])
    ensure_table(spark, f"{database}.{purpose}", data, f"{folder}/{purpose}", partitioned_by)
    return f"{database}.{purpose}"


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = by_ship_month(table(spark, sf_dir, "lineitem"))
    name = _new_table(staged, "replace", ("load_month",))
    load_partitions(staged, name)
    load_partitions(staged.where("l_returnflag = 'A' and year(l_shipdate) = 1998"), name)
    return spark.table(name)


def write_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = by_ship_month(table(spark, sf_dir, "lineitem"))
    name = _new_table(staged, "if_empty", ("load_month",))
    load_partitions(staged.where("l_returnflag = 'A' and year(l_shipdate) < 1996"), name)
    load_partitions(staged, name, mode="if_empty")
    return spark.table(name)


def append_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = by_ship_month(table(spark, sf_dir, "lineitem"))
    name = _new_table(staged, "append", ("load_month",))
    load_partitions(staged, name)
    load_partitions(staged, name, mode="append")
    return spark.table(name)


def add_hash_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    name = _new_table(orders, "add_column")
    append_rows(orders, name)
    for _ in range(2):  # the second call finds the column there
        add_column(spark, name, "trip_hash", T.StringType())
    return spark.table(name)


# -- merge --------------------------------------------------------------------


def merge_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = hashed_lineitem(spark, sf_dir)
    any_new = new_keys(batch, loaded(batch)).select(F.lit(1).alias("one")).limit(1)
    return any_new.agg((F.count("*") > 0).alias("has_new"))


def merge_insert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a merge of lineitem appends, as main sees them."""
    batch = hashed_lineitem(spark, sf_dir)
    return merge_insert(batch, loaded(batch), insert_columns=LINEITEM.insert_columns, alike=LINEITEM.identity)


def merge_insert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(hashed_lineitem(spark, sf_dir)).unionByName(merge_insert_rows(spark, sf_dir))


def merge_rerun_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = stored(hashed_lineitem(spark, sf_dir), "batch")
    new = merge_insert(batch, loaded(batch), insert_columns=LINEITEM.insert_columns)
    main = stored(loaded(batch).unionByName(new), "main")
    return main.unionByName(merge_insert(batch, main, insert_columns=LINEITEM.insert_columns))


def merge_keeps_batch_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = hashed_lineitem(spark, sf_dir)
    return merge_insert(once.unionByName(once), loaded(once), alike=LINEITEM.identity)


def merge_null_target_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = hashed_lineitem(spark, sf_dir)
    older = F.when(F.col("l_returnflag") != "R", F.col("trip_hash"))
    return merge_insert(batch, loaded(batch).withColumn("trip_hash", older), alike=LINEITEM.identity)


def merge_on_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = table(spark, sf_dir, "lineitem")
    return merge_insert(batch, loaded(batch), keys=LINEITEM.merge_keys)


def _hot_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem under a key that a few values have for a third of all rows."""
    own = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("hot-"), F.col("l_returnflag")))
    return table(spark, sf_dir, "lineitem").withColumn("k", F.coalesce(hot, own))


def merge_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _hot_keyed(spark, sf_dir)
    return merge_insert(batch, loaded(batch), keys=("k",))


def merge_check_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check by filters of main's fingerprints per ship month, kept in a table; main is joined with possible hits only."""
    batch = hashed_lineitem(spark, sf_dir).withColumn("pickup_month", month_key(F.col("l_shipdate")))
    main = loaded(batch)
    filters = stored(bloom_filters(main, ["trip_hash"], ["pickup_month"]), "filters")
    surely, others = new_keys_by_filter(batch, main, filters, ["trip_hash"], ["pickup_month"])
    any_new = surely.limit(1).unionByName(others.limit(1))
    return any_new.agg((F.count("*") > 0).alias("has_new"))


def new_keys_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys that a merge inserts, found by the filters or by the join after them."""
    batch = hashed_lineitem(spark, sf_dir).withColumn("pickup_month", month_key(F.col("l_shipdate")))
    main = loaded(batch)
    filters = stored(bloom_filters(main, ["trip_hash"], ["pickup_month"]), "filters")
    surely, others = new_keys_by_filter(batch, main, filters, ["trip_hash"], ["pickup_month"])
    return surely.unionByName(others)


def merge_months_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = by_ship_month(table(spark, sf_dir, "lineitem"))
    return merge_insert(batch, loaded(batch), keys=("l_orderkey", "l_linenumber"), order="load_month")


# -- monthly runs -------------------------------------------------------------


def _land(rows: DataFrame, kind: str, month: str, folder: str, mode: str = "append") -> None:
    """Write one folder of part files per month, named as a landed asset."""
    # Rows are gathered by the first day of their month, and named after that.
    gathered = rows.withColumn("_month", F.trunc(month, "month")).drop("_closing").hint("rebalance", "_month")
    label = F.coalesce(F.date_format("_month", "yyyy-MM"), F.lit("null"))
    assets = gathered.withColumn("asset", F.concat(F.lit(f"{kind}_tripdata_"), label, F.lit(".parquet"))).drop("_month")
    writer = assets.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("asset").parquet(folder)


def _config(spark: SparkSession, purpose: str, **options) -> Config:
    root = work_folder(spark, purpose)
    folders = {"root": f"{root}/tables", "landing": f"{root}/landing"}
    return Config(database=f"runs_{uuid.uuid4().hex}", min_size=1, **folders, **options)


def _land_lineitem(spark: SparkSession, sf_dir: str, config: Config) -> None:
    lineitem = table(spark, sf_dir, "lineitem")
    # Files close five days early, so each holds pickups of two months, and
    # returned rows are reported again a month later.
    closing = F.col("l_shipdate") + F.expr("interval 5 days")
    on_time = lineitem.withColumn("_closing", closing)
    again = lineitem.where("l_returnflag = 'R'").withColumn("_closing", F.add_months(closing, 1).cast("timestamp_ntz"))
    _land(on_time.unionByName(again), "lineitem", "_closing", config.landing)


def _land_orders(spark: SparkSession, sf_dir: str, config: Config) -> None:
    _land(table(spark, sf_dir, "orders"), "orders", "o_orderdate", config.landing)


def _span(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last month any of the landed files may be for."""
    bounds = _spans(spark, sf_dir).agg(F.min("first").alias("first"), F.add_months(F.max("last"), 2).alias("last")).first()
    return f"{bounds['first']:%Y-%m}", f"{bounds['last']:%Y-%m}"


def _main_after_runs(spark: SparkSession, sf_dir: str, runs: int, **options) -> DataFrame:
    config = _config(spark, "run", **options)
    _land_lineitem(spark, sf_dir, config)
    for _ in range(runs):
        run(spark, [LINEITEM], config, *_span(spark, sf_dir), refresh="all").collect()
    main = spark.table(f"{config.database}.{LINEITEM.main_table}")
    return zoneless(main)


def monthly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _main_after_runs(spark, sf_dir, runs=1)


def monthly_run_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the ways that large months take: nothing counts as few."""
    return _main_after_runs(spark, sf_dir, runs=1, probe_rows=0)


def monthly_run_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files; the second asks the filters of what main has before main itself."""
    return _main_after_runs(spark, sf_dir, runs=2, probe_rows=500, filters=True)


def run_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files; the second finds every month filled."""
    return _main_after_runs(spark, sf_dir, runs=2, write_mode="if_empty")


def run_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files; the second stages all rows again and adds none."""
    return _main_after_runs(spark, sf_dir, runs=2, write_mode="append")


def load_report_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(spark, sf_dir, probe_rows=0)


def load_report(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Report of a run over two kinds at once."""
    config = _config(spark, "report", **options)
    _land_lineitem(spark, sf_dir, config)
    _land_orders(spark, sf_dir, config)
    report = run(spark, [LINEITEM, ORDERS], config, *_span(spark, sf_dir))
    return report.where("reason is null or reason <> 'missing'").select(
        "kind", "load_month", "status", "rows_read", "rows_new", "fingerprint_version"
    )


def load_report_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the second of two runs over the same files: what each load read itself, not what the month then holds."""
    config = _config(spark, "report", write_mode="append")
    _land_lineitem(spark, sf_dir, config)
    for _ in range(2):
        report = run(spark, [LINEITEM], config, *_span(spark, sf_dir), refresh="all")
    return report.where("reason is null or reason <> 'missing'").select("load_month", "status", "reason", "rows_read", "rows_new")


def file_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of landed files, as the manifest of the folder says, and as the loads noted on their way into staging."""
    config = _config(spark, "checksum")
    _land_orders(spark, sf_dir, config)
    run(spark, [ORDERS], config, *_span(spark, sf_dir)).collect()
    noted = spark.table(f"{config.database}.{ORDERS.ledger_table}").select("file_name", F.col("checksum").alias("checksum_noted"))
    return manifest(spark, config.landing).join(noted, "file_name").select("kind", "load_month", "checksum", "checksum_noted")


def scan_mixed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One asset whose parts have two physical schemas: other types, and a column that only one has."""
    config = _config(spark, "mixed")
    lineitem = table(spark, sf_dir, "lineitem")
    path = f"{config.landing}/lineitem_tripdata_1998-01.parquet"
    one = lineitem.where("l_linestatus = 'F'").withColumns({"l_linenumber": F.col("l_linenumber").cast("double"), "l_orderkey": F.col("l_orderkey").cast("int")})
    one.drop("l_tax").write.parquet(path)
    lineitem.where("l_linestatus <> 'F'").write.mode("append").parquet(path)
    return zoneless(read_files(spark, [path], LINEITEM.schema))


def publish_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of a table see while rows are written and checked, and what they see once these are published."""
    rows = by_ship_month(table(spark, sf_dir, "lineitem"))
    name = _new_table(rows, "swap", ("load_month",))
    early = F.col("load_month") < "199601"
    publish(spark, name, write_pending(rows.where(early), name))
    folder = write_pending(rows.where(~early), name)
    written = pending_rows(spark, name, folder).count()
    seen = stored(spark.table(name).groupBy("load_month").agg(F.count("*").alias("n_rows")), "seen")
    publish(spark, name, folder)
    after = spark.table(name).groupBy("load_month").agg(F.count("*").alias("n_rows"))
    moments = {"written": after.where(early).union(seen.where(~early)), "published": after}
    found = [df.withColumns({"moment": F.lit(moment), "pending": F.lit(written).cast("long")}) for moment, df in moments.items()]
    return found[0].unionByName(found[1])


class _Died(BaseException):
    """Stands for a driver that is lost: nothing handles it."""


def _dying(step: str) -> Callable:
    """Stands for a step of the run that never comes to its end."""

    def died(*_):
        raise _Died(step)

    return died


#: In each write mode, the step at which a run dies, and that at which the next one does, after a file was replaced.
_LOST_AT = {"truncate": ("_append", "_record"), "if_empty": ("_merge", "_merge"), "append": ("_merge", "_record")}


def _recovered(spark: SparkSession, sf_dir: str, write_mode: str) -> DataFrame:
    """Main after runs that died before staging was noted, while merging or before the ledger."""
    config = _config(spark, "recovered", write_mode=write_mode)
    span, orders = _span(spark, sf_dir), table(spark, sf_dir, "orders")
    # What lands first is a month with other rows, which no load may leave behind.
    first = orders.agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("month")).first()["month"]
    wrong = orders.where(F.date_format("o_orderdate", "yyyy-MM") == first).withColumn("o_custkey", F.lit(-1).cast("bigint"))
    for landed, mode, step in zip((wrong, orders), ("append", "overwrite"), _LOST_AT[write_mode]):
        _land(landed, "orders", "o_orderdate", config.landing, mode)
        with mock.patch.object(monthly_run_module, step, _dying(step)), contextlib.suppress(_Died):
            run(spark, [ORDERS], config, *span).collect()
    run(spark, [ORDERS], config, *span).collect()
    return zoneless(spark.table(f"{config.database}.{ORDERS.main_table}")).withColumn("write_mode", F.lit(write_mode))


def run_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_recovered(spark, sf_dir, mode) for mode in _LOST_AT]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two starts of the stream: a month that doesn't fit holds up neither its batch nor later ones."""
    config = _config(spark, "quarantine")
    orders = table(spark, sf_dir, "orders")
    good = F.date_format("o_orderdate", "yyyyMM") != _BAD_MONTH
    late = F.year("o_orderdate") >= 1997
    _land(orders.where(~good).withColumn("surprise", F.lit(1)), "orders", "o_orderdate", config.landing)
    for some in (orders.where(good & ~late), orders.where(good & late)):
        _land(some, "orders", "o_orderdate", config.landing)
        catch_up(spark, [ORDERS], config, f"{config.root}/checkpoint").awaitTermination()
    return zoneless(spark.table(f"{config.database}.{ORDERS.main_table}"))


def stream_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "stream")
    _land_orders(spark, sf_dir, config)
    catch_up(spark, [ORDERS], config, f"{config.root}/checkpoint").awaitTermination()
    return zoneless(spark.table(f"{config.database}.{ORDERS.main_table}"))


def _utc(query: Query) -> Query:
    return lambda spark, sf_dir: query(use_utc(spark), sf_dir)


QUERIES: dict[str, Query] = {
    name: _utc(query)
    for name, query in {
        "fingerprint_lineitem": fingerprint_lineitem,
        "fingerprint_orders": fingerprint_orders,
        "fingerprint_events": fingerprint_events,
        "partition_filter": partition_filter,
        "month_in_time_zone": month_in_time_zone,
        "normalize_names": normalize_names,
        "snake_case_columns": snake_case_names,
        "asset_plan": asset_plan,
        "catchup_pending": catchup_pending,
        "ready_gate": ready_gate,
        "text_md5": text_md5,
        "file_checksum": file_checksum,
        "scan_mixed_parts": scan_mixed_parts,
        "content_digest": content_digest,
        "landing_skip": landing_skip,
        "landing_changed": landing_changed,
        "conform_schema": conform_schema,
        "conform_relaxed": conform_relaxed,
        "partition_replace": partition_replace,
        "write_if_empty": write_if_empty,
        "append_partition": append_partition,
        "add_column": add_hash_column,
        "publish_swap": publish_swap,
        "merge_check": merge_check,
        "merge_check_bloom": merge_check_bloom,
        "new_keys_bloom": new_keys_bloom,
        "merge_insert": merge_insert_all,
        "merge_hot_key": merge_hot_key,
        "merge_rerun_noop": merge_rerun_noop,
        "merge_keeps_batch_dups": merge_keeps_batch_dups,
        "merge_null_target_hash": merge_null_target_hash,
        "merge_on_keys": merge_on_keys,
        "merge_months_in_order": merge_months_in_order,
        "monthly_run": monthly_run,
        "monthly_run_shuffled": monthly_run_shuffled,
        "monthly_run_filtered": monthly_run_filtered,
        "run_if_empty": run_if_empty,
        "run_append": run_append,
        "run_recovered": run_recovered,
        "load_report": load_report,
        "load_report_append": load_report_append,
        "load_report_shuffled": load_report_shuffled,
        "stream_catch_up": stream_catch_up,
        "stream_quarantine": stream_quarantine,
    }.items()
}
