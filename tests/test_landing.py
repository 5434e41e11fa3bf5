from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from monthtide import due_spans, gate, manifest, plan_assets
from monthtide.sources import changed_landing, checksums, file_md5s, list_landing, pending_landing, row_digest

FILE = "yellow_tripdata_2025-07.parquet"


@pytest.fixture
def landing(spark, tmp_path):
    """Two single files, one asset of parts, and a file that is no asset."""
    rows = spark.range(100).withColumn("v", F.rand(1))
    folder = tmp_path / "landing"
    folder.mkdir()
    for number, name in enumerate((FILE, "green_tripdata_2025-07.parquet", "notes.parquet")):
        rows.where(F.col("id") % 3 == number).coalesce(1).write.parquet(str(tmp_path / f"w{number}"))
        (part,) = (tmp_path / f"w{number}").glob("part-*.parquet")
        (folder / name).write_bytes(part.read_bytes())
    rows.repartition(3).write.parquet(str(folder / "yellow_tripdata_2025-08.parquet"))
    return folder


def size_of(path: Path) -> int:
    return path.stat().st_size if path.is_file() else sum(p.stat().st_size for p in path.glob("part-*"))


def test_listing_has_one_row_per_asset(spark, landing):
    found = {r.file_name: r for r in list_landing(spark, str(landing)).collect()}
    assert {(n, r.kind, r.load_month, r.parts, r["size"]) for n, r in found.items()} == {
        (FILE, "yellow", "202507", 1, size_of(landing / FILE)),
        ("green_tripdata_2025-07.parquet", "green", "202507", 1, size_of(landing / "green_tripdata_2025-07.parquet")),
        ("yellow_tripdata_2025-08.parquet", "yellow", "202508", 3, size_of(landing / "yellow_tripdata_2025-08.parquet")),
    }


def test_listing_opens_no_file(spark, landing):
    plan = list_landing(spark, str(landing))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_manifest_has_a_checksum_for_every_asset(spark, landing):
    found = {Path(r.path).name: r.checksum for r in manifest(spark, str(landing)).collect()}
    assert len(found) == len(set(found.values())) == 3 and None not in found.values()


def test_md5_is_that_of_the_bytes(spark, landing):
    found = {Path(r.path).name: r.md5 for r in file_md5s(spark, [str(landing)]).collect()}
    assert found[FILE] == hashlib.md5((landing / FILE).read_bytes()).hexdigest()


def test_checksum_follows_the_rows_and_not_how_they_lie(spark, tmp_path):
    rows = spark.range(100).withColumn("v", F.col("id") % 7)
    def digest(name, rows, parts):
        path = str(tmp_path / name / "a b+c%20d=" / FILE)
        rows.coalesce(parts).write.parquet(path)
        return checksums(spark, [path]).first().checksum
    whole = digest("a", rows, 1)
    assert digest("b", rows.repartition(5), 5) == whole
    assert digest("c", rows.orderBy(F.desc("id")), 1) == whole
    assert digest("d", rows.union(rows.limit(1)), 1) != whole
    assert digest("e", rows.withColumn("v", F.col("v").cast("double")), 1) != whole
    assert len(digest("f", rows.limit(0), 1)) == 32


def test_plan_of_checksums_does_not_grow_with_the_files(spark, tmp_path):
    def scans(months):
        folder = str(tmp_path / f"m{months}")
        for month in range(1, months + 1):
            spark.range(10).write.parquet(f"{folder}/yellow_tripdata_2025-{month:02}.parquet")
        return checksums(spark, [folder])._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans(2) == scans(6)


def test_row_digest_ignores_order_but_not_nulls_or_copies(spark):
    def digest(rows):
        return row_digest(spark.createDataFrame(rows, "a int, b int")).first().digest
    assert digest([(1, 2), (3, 4)]) == digest([(3, 4), (1, 2)])
    assert digest([(1, None)]) != digest([(None, 1)])
    assert digest([(1, 2)]) != digest([(1, 2), (1, 2), (1, 2)])


@pytest.mark.parametrize(
    "size, status, reason",
    [(999_999, "skipped", "too small"), (1_000_000, "ready", None), (0, "skipped", "too small"), (None, "skipped", "missing")],
)
def test_gate(spark, size, status, reason):
    plan = plan_assets(due_spans(spark, ["yellow"], "2025-07", "2025-07"))
    listing = spark.createDataFrame([(FILE, size)] if size is not None else [], "file_name string, size bigint")
    (row,) = gate(plan, listing).collect()
    assert (row.status, row.reason) == (status, reason)


@pytest.mark.parametrize("size, lands_again", [(1_000_000, True), (1_000_001, False)])
def test_landed_files_count_only_above_the_threshold(spark, size, lands_again):
    candidates = spark.createDataFrame([(FILE,)], "file_name string")
    landed = spark.createDataFrame([(FILE, size), (FILE, 5)], "file_name string, size bigint")
    assert pending_landing(candidates, landed).count() == int(lands_again)


def test_changed_landing(spark):
    candidates = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "file_name string, checksum string")
    landed = spark.createDataFrame([("a", "1"), ("b", "9")], "file_name string, checksum string")
    assert sorted(r.file_name for r in changed_landing(candidates, landed).collect()) == ["b", "c"]


def test_plan_has_every_month_of_every_kind(spark):
    plan = plan_assets(due_spans(spark, ["yellow", "green"], "2025-11", "2026-01"), "https://src", "gs://b/d").collect()
    assert len(plan) == 6
    row = next(r for r in plan if r.kind == "green" and r.load_month == "202601")
    assert row.asDict() == {
        "kind": "green", "year": 2026, "month": 1, "load_month": "202601",
        "file_name": "green_tripdata_2026-01.parquet",
        "source_path": "https://src/green_tripdata_2026-01.parquet",
        "landing_path": "gs://b/d/green_tripdata_2026-01.parquet",
        "staging_table": "green_taxi_staging", "main_table": "green_taxi",
    }


def test_a_month_is_due_once_it_is_over(spark):
    spans = due_spans(spark, ["yellow"])
    here = F.add_months(F.trunc(F.from_utc_timestamp(F.current_timestamp(), "Asia/Taipei"), "MM"), -1)
    assert spans.where(F.col("last") == here).count() == 1
    assert plan_assets(due_spans(spark, ["yellow"], "2025-09", "2025-08")).count() == 0
