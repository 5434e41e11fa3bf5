"""Catch-up with Structured Streaming: what arrived since the last run.

The stream carries file arrivals, not rows. Its checkpoint remembers which files
were seen, and each micro-batch hands the months concerned to the same run that
the batch form uses. A micro-batch that is replayed after a failure finds its
loads in the ledger, or redoes them under the same load ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthtide.kinds import Kind
from monthtide.plans.monthly_run import Config, run, worth_another_try
from monthtide.session import use_utc
from monthtide.sources.files import asset_part

# The schema Spark gives to files read whole. Contents are never selected.
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of ``kind, month, path, length`` of landed files."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = F.col("path")
    return (
        reader.load(folder)
        .select(asset_part(path, 2).alias("kind"), asset_part(path, 3).alias("month"), "path", "length")
        .where("kind <> ''")
    )


def catch_up(
    spark: SparkSession,
    kinds: Sequence[Kind],
    config: Config,
    checkpoint: str,
    report_path: str | None = None,
    refresh: str = "changed",
    files_per_batch: int | None = None,
    first: str | None = None,
) -> StreamingQuery:
    """Start a query that loads all files that arrived, then stops.

    Each micro-batch appends its report below ``report_path``. If a load fails in a
    way that may pass, the query fails once all kinds have had their turn, and the
    next start does that micro-batch again; what was loaded meanwhile is not loaded
    twice. A file that doesn't fit, lies in two places, or has failed
    ``config.max_attempts`` times holds up nothing: the report names it, and it is
    tried again when it has changed. An asset of
    several parts may arrive over several micro-batches; ``refresh='changed'``
    picks up the later ones. A file counts as arrived once, complete or not:
    with ``first`` every micro-batch looks at all months from there on again, and
    so finds files that were too small when they arrived.
    """
    use_utc(spark)
    by_name = {k.name: k for k in kinds}

    def load(batch: DataFrame, batch_id: int) -> None:
        bounds = (
            batch.where(F.col("kind").isin(list(by_name)))
            .groupBy("kind")
            .agg(F.min("month").alias("first"), F.max("month").alias("last"))
            .collect()
        )
        failed = []
        for row in bounds:
            since = min(first or row["first"], row["first"])
            report = run(batch.sparkSession, [by_name[row.kind]], config, since, row["last"], refresh)
            if report_path:
                report.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(report_path)
            reasons = {r.load_month: r.reason for r in report.where("status = 'failed'").collect()}
            again = worth_another_try(batch.sparkSession, by_name[row.kind], list(reasons), config) if reasons else []
            failed += [f"{row.kind} {month}: {reasons[month]}" for month in again]
        if failed:
            raise RuntimeError("; ".join(failed))

    return (
        arrivals(spark, config.landing, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
