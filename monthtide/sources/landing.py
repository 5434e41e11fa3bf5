"""The landing folder: what is there, is it complete, was it loaded before.

All of these work on listings with one row per file. Contents are read only
for checksums, and only of the files asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthtide.functions.fingerprint import identity_json
from monthtide.sources.files import alike_files, asset_part, list_files, load_month_of, scans

# Fixed value: smaller files count as not (yet) complete.
MIN_SIZE = 1_000_000

LOAD_MONTH = "load_month"
_DIGEST = "_row_md5"
# The MD5 of a row in numbers of 32 bits, whose sums are longs.
_WORDS = {f"w{k}": f"_row_md5_{k}" for k in range(4)}


def list_landing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per landed asset below ``folder``, without opening any file.

    An asset is a single file or a folder of part files with the asset's name;
    its size is the sum of its parts. Other files are left out.
    """
    path = F.col("path")
    return (
        list_files(spark, folder)
        .select(asset_part(path, 1).alias("asset"), "path", "length", "modificationTime")
        .where("asset <> ''")
        .groupBy(F.col("asset").alias("path"))
        .agg(
            F.count("*").alias("parts"),
            F.bool_or(path != F.col("asset")).alias("in_parts"),
            F.sum("length").alias("size"),
            F.max("modificationTime").alias("modified_at"),
        )
        .select(
            asset_part(path, 2).alias("kind"),
            load_month_of(path).alias("load_month"),
            F.regexp_extract(path, r"([^/=]+)$", 1).alias("file_name"),
            "path",
            "parts",
            "in_parts",
            "size",
            "modified_at",
        )
    )


def gate(plan: DataFrame, listing: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """``plan`` with ``size``, ``status`` and ``reason`` from the listing.

    A file is ready from ``min_size`` bytes on. One that is absent or smaller is
    skipped, not failed: it may be complete at the next run.
    """
    size = F.col("size")
    reason = F.when(size.isNull(), "missing").when(size < min_size, "too small")
    extra = [c for c in listing.columns if c not in plan.columns]
    return (
        plan.join(listing.select("file_name", *extra), "file_name", "left")
        .withColumn("reason", reason)
        .withColumn("status", F.when(F.col("reason").isNull(), "ready").otherwise("skipped"))
    )


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether the writer of an asset in parts is done: it leaves ``_SUCCESS``.

    A write partitioned by file name has one for all assets, in the folder above.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if "=" in path.getName():
        path = path.getParent()
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def pending_landing(candidates: DataFrame, landed: DataFrame, larger_than: int = MIN_SIZE) -> DataFrame:
    """Candidates not landed yet; a landed file counts only above ``larger_than``."""
    kept = landed.where(F.col("size") > larger_than).select("file_name").distinct()
    return candidates.join(kept, "file_name", "left_anti")


def changed_landing(candidates: DataFrame, landed: DataFrame, by: Sequence[str] = ("checksum",)) -> DataFrame:
    """Candidates that are new, or differ from every landed version in ``by``."""
    same = ["file_name", *by]
    return candidates.join(landed.select(*same).distinct(), same, "left_anti")


def _hash_aggregates(text: Column) -> list[Column]:
    """Count of the rows and sums of both halves of the MD5 of ``text``: independent of row order."""
    halves = [F.conv(F.substring(F.md5(text), start, 16), 16, 10).cast("decimal(20,0)") for start in (1, 17)]
    return [F.count("*").alias("n_rows"), F.sum(halves[0]).alias("_first"), F.sum(halves[1]).alias("_second")]


def _combined() -> Column:
    return F.md5(F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in ("n_rows", "_first", "_second")]))


def row_digest(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Digest of the rows of each group, independent of their order.

    Every task reduces its own rows, so no group is ever gathered anywhere.
    """
    columns = list(columns or [c for c in df.columns if c not in by])
    reduced = df.groupBy(*by).agg(*_hash_aggregates(identity_json(columns)))
    return reduced.select(*by, "n_rows", _combined().alias("digest"))


def checksums(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, checksum`` of each asset: the digest of its rows, by one definition at every size.

    How the rows are ordered or cut into parts does not count. Files with the same
    physical schema share a scan, and all tasks take part in the digest of a large
    file; an asset without rows has a checksum, too.
    """
    rows = [
        scan.select(F.col("_metadata.file_path").alias("path"), identity_json(scan.columns).alias("body"))
        for scan in scans(spark, alike_files(spark, paths))
    ]
    reduced = reduce(DataFrame.unionByName, rows).groupBy("path").agg(*_hash_aggregates(F.col("body")))
    scanned = asset_part(_as_listed(F.col("path")), 1)
    sums = reduced.groupBy(scanned.alias("_asset")).agg(*[F.sum(c).alias(c) for c in ("n_rows", "_first", "_second")])
    assets = list_files(spark, list(paths)).select(asset_part(F.col("path"), 1).alias("path")).where("path <> ''").distinct()
    return assets.join(sums, F.col("path") == F.col("_asset"), "left").select("path", _combined().alias("checksum"))


def observed(scan: DataFrame, months: Sequence[str], digest: bool = True) -> tuple[DataFrame, Observation]:
    """``scan`` of some months' files with ``load_month``, and where the counts and digests of each month will be.

    Whichever job reads the rows makes them on the way. Each row is compared with
    each month, so there should be few; a single month is not looked for.
    """
    names, alone = scan.columns, len(months) == 1
    rows = scan.withColumn(LOAD_MONTH, F.lit(months[0]) if alone else load_month_of(F.col("_metadata.file_path")))
    aggregates = [(F.count("*") if alone else F.count_if(F.col(LOAD_MONTH) == m)).alias(f"n_{m}") for m in months]
    if digest:
        rows = rows.withColumn(_DIGEST, F.md5(identity_json(names)))
        rows = rows.withColumns({column: F.conv(F.substring(_DIGEST, 8 * k + 1, 8), 16, 10).cast("bigint") for k, column in enumerate(_WORDS.values())})
        of_month = lambda column, m: F.col(column) if alone else F.when(F.col(LOAD_MONTH) == m, F.col(column))
        aggregates += [F.sum(of_month(column, m)).alias(f"{word}_{m}") for word, column in _WORDS.items() for m in months]
    observation = Observation()
    return rows.observe(observation, *aggregates).drop(_DIGEST, *_WORDS.values()), observation


def told(observations: Sequence[Observation], month: str, digest: bool = True) -> tuple[int, str | None]:
    """Number of rows and checksum of a month's file, from what was observed of all its scans."""
    found = [o.get for o in observations]
    rows = sum(f[f"n_{month}"] for f in found)
    if not digest:
        return rows, None
    words = [sum(f[f"{word}_{month}"] or 0 for f in found) for word in _WORDS]
    halves = [(high << 32) + low for high, low in (words[:2], words[2:])]
    return rows, hashlib.md5("-".join(map(str, (rows, *halves))).encode()).hexdigest()


def _as_listed(path: Column) -> Column:
    """A path of a scan as listings write it: not escaped, and local ones with one slash."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def file_md5s(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, md5`` of the bytes of each file; a task holds one whole file."""
    return list_files(spark, list(paths)).select("path", F.md5("content").alias("md5"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Listing of ``folder`` with the checksum of every asset in it."""
    return list_landing(spark, folder).join(checksums(spark, [folder]), "path")
