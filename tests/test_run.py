from __future__ import annotations

import random
from collections import Counter
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from monthtide import GREEN, YELLOW, run
from monthtide.operators import append_rows, ensure_database, ensure_table, partitions
from monthtide.operators import merge
from monthtide.plans import monthly_merge, monthly_run
from monthtide.plans.monthly_merge import Cell, profile, split_cells
from monthtide.sources import checksums
from tests.trips import config, frame, land, trip

JUNE_30, JULY_5, AUGUST_9 = datetime(2025, 6, 30, 23), datetime(2025, 7, 5), datetime(2025, 8, 9)


def go(spark, where, kinds=(YELLOW,), first="2025-07", last="2025-08", **options):
    rows = run(spark, kinds, where, first, last, **options).collect()
    return {(r.kind, r.load_month): (r.status, r.reason, r.rows_read, r.rows_new) for r in rows}


def main(spark, where, kind=YELLOW):
    return spark.table(f"{where.database}.{kind.main_table}")


def ids(spark, where):
    return Counter((r.VendorID, r.load_id, r.pickup_month) for r in main(spark, where).collect())


def test_both_kinds_load_and_a_second_run_does_nothing(spark):
    where = config(spark)
    land(frame(spark, [trip(), trip()]), YELLOW, "2025-07", where)
    land(frame(spark, [trip(GREEN)], GREEN), GREEN, "2025-07", where)
    assert go(spark, where, (YELLOW, GREEN)) == {
        ("yellow", "202507"): ("loaded", None, 2, 2),
        ("yellow", "202508"): ("skipped", "missing", None, None),
        ("green", "202507"): ("loaded", None, 1, 1),
        ("green", "202508"): ("skipped", "missing", None, None),
    }
    assert go(spark, where, (YELLOW, GREEN))["yellow", "202507"][:2] == ("skipped", "already loaded")
    assert main(spark, where).count() == 2
    (row,) = main(spark, where, GREEN).collect()
    assert (row.tolls_amount, row.store_and_fwd_flag, row.trip_type) == (None, None, 1)


def test_reloading_everything_adds_nothing(spark):
    where = config(spark)
    land(frame(spark, [trip(), trip(VendorID=2)]), YELLOW, "2025-07", where)
    go(spark, where)
    assert go(spark, where, refresh="all")["yellow", "202507"] == ("skipped", "nothing new", 2, 0)
    assert main(spark, where).count() == 2


def add_part(spark, rows, path, ddl=None):
    frame(spark, rows, ddl=ddl).coalesce(1).write.mode("append").parquet(path)


def test_parts_of_one_asset_may_differ(spark):
    where = config(spark)
    path = land(frame(spark, [trip()], ddl={"cbd_congestion_fee": None}), YELLOW, "2025-07", where)
    add_part(spark, [trip(VendorID=2, cbd_congestion_fee=9.5, passenger_count=3.0)], path, {"passenger_count": "double"})
    assert go(spark, where)["yellow", "202507"] == ("loaded", None, 2, 2)
    found = {r.VendorID: (r.cbd_congestion_fee, r.passenger_count) for r in main(spark, where).collect()}
    assert found == {1: (None, 2), 2: (9.5, 3)}


def test_an_undeclared_column_in_any_part_fails_the_asset(spark):
    where = config(spark)
    path = land(frame(spark, [trip()]), YELLOW, "2025-07", where)
    add_part(spark, [trip(surprise=1)], path, {"surprise": "int"})
    land(frame(spark, [trip(pickup=AUGUST_9)]), YELLOW, "2025-08", where)
    found = go(spark, where)
    assert found["yellow", "202507"][0] == "failed" and "surprise" in found["yellow", "202507"][1]
    assert found["yellow", "202508"] == ("loaded", None, 1, 1)


def test_an_asset_in_parts_waits_for_its_writer(spark):
    where = config(spark)
    path = Path(land(frame(spark, [trip(), trip(VendorID=2)]), YELLOW, "2025-07", where, parts=2))
    (path / "_SUCCESS").unlink()
    assert go(spark, where)["yellow", "202507"][:2] == ("skipped", "incomplete")
    (path / "_SUCCESS").touch()
    assert go(spark, where)["yellow", "202507"] == ("loaded", None, 2, 2)


def test_a_second_copy_fails_its_asset_only(spark):
    where = config(spark)
    for folder in ("", "/old"):
        frame(spark, [trip()]).write.parquet(f"{where.landing}{folder}/yellow_tripdata_2025-07.parquet")
    land(frame(spark, [trip(GREEN)], GREEN), GREEN, "2025-07", where)
    found = go(spark, where, (YELLOW, GREEN))
    assert found["yellow", "202507"][:2] == ("failed", "landed in more than one place")
    assert found["green", "202507"] == ("loaded", None, 1, 1)


def test_a_small_file_is_skipped_until_it_is_complete(spark):
    where = config(spark, min_size=100_000_000)
    path = land(frame(spark, [trip()]), YELLOW, "2025-07", where)
    assert path
    assert go(spark, where)["yellow", "202507"] == ("skipped", "too small", None, None)


def test_a_changed_file_adds_what_is_new(spark):
    where = config(spark)
    land(frame(spark, [trip(), trip()]), YELLOW, "2025-07", where)
    go(spark, where)
    land(frame(spark, [trip(tip_amount=50.0), trip(VendorID=2)]), YELLOW, "2025-07", where)
    assert go(spark, where)["yellow", "202507"][:2] == ("skipped", "already loaded")
    assert go(spark, where, refresh="changed")["yellow", "202507"] == ("loaded", None, 2, 1)
    assert ids(spark, where) == {(1, "202507", "202507"): 2, (2, "202507-1", "202507"): 1}
    assert go(spark, where, refresh="changed")["yellow", "202507"][:2] == ("skipped", "already loaded")
    staging = spark.table(f"{where.database}.{YELLOW.staging_table}")
    assert sorted(r.VendorID for r in staging.collect()) == [1, 2]


def test_strays_stay_in_the_partition_of_their_file(spark):
    where = config(spark)
    land(frame(spark, [trip(pickup=JUNE_30), trip(pickup=JULY_5)]), YELLOW, "2025-07", where)
    land(frame(spark, [trip(pickup=JULY_5), trip(pickup=AUGUST_9)]), YELLOW, "2025-08", where)
    found = go(spark, where)
    assert found["yellow", "202507"] == ("loaded", None, 2, 2)
    assert found["yellow", "202508"] == ("loaded", None, 2, 1)
    staging = spark.table(f"{where.database}.{YELLOW.staging_table}")
    assert Counter(r.load_month for r in staging.collect()) == {"202507": 2, "202508": 2}
    assert {p["pickup_month"] for p in partitions(spark, f"{where.database}.yellow_taxi")} == {"202506", "202507", "202508"}


def test_null_pickups_are_relaxed_and_still_meet(spark):
    where = config(spark)
    land(frame(spark, [trip(pickup=None)]), YELLOW, "2025-07", where)
    land(frame(spark, [trip(pickup=None), trip(pickup=None, VendorID=7)]), YELLOW, "2025-08", where)
    report = run(spark, [YELLOW], where, "2025-07", "2025-08").collect()
    assert [(r.load_month, r.rows_new, r.relaxed) for r in report] == [
        ("202507", 1, "tpep_pickup_datetime"), ("202508", 1, "tpep_pickup_datetime"),
    ]
    assert ids(spark, where) == {(1, "202507", "000000"): 1, (7, "202508", "000000"): 1}


def test_one_bad_file_does_not_hold_up_the_others(spark):
    where = config(spark, strict=True)
    land(frame(spark, [trip(pickup=None)]), YELLOW, "2025-07", where)
    land(frame(spark, [trip(pickup=AUGUST_9)]), YELLOW, "2025-08", where)
    found = go(spark, where)
    assert found["yellow", "202507"][0] == "failed" and found["yellow", "202508"] == ("loaded", None, 1, 1)
    assert go(spark, where)["yellow", "202507"][0] == "failed"


def test_an_unfitting_file_fails_with_its_reason(spark):
    where = config(spark)
    land(frame(spark, [trip(surprise=1)], ddl={"surprise": "int"}), YELLOW, "2025-07", where)
    status, reason, *_ = go(spark, where)["yellow", "202507"]
    assert status == "failed" and "surprise" in reason


def test_files_of_different_physical_types_load_together(spark):
    where = config(spark)
    land(frame(spark, [trip(passenger_count=2.0)], ddl={"passenger_count": "double"}), YELLOW, "2025-07", where)
    land(frame(spark, [trip(), trip(VendorID=2)], ddl={"passenger_count": "int", "tpep_pickup_datetime": "timestamp_ntz"}),
         YELLOW, "2025-08", where)
    assert go(spark, where)["yellow", "202508"] == ("loaded", None, 2, 1)


def test_write_if_empty_leaves_a_filled_month(spark):
    where = config(spark, write_mode="if_empty")
    land(frame(spark, [trip()]), YELLOW, "2025-07", where)
    go(spark, where)
    land(frame(spark, [trip(VendorID=2)]), YELLOW, "2025-07", where)
    assert go(spark, where, refresh="all")["yellow", "202507"] == ("skipped", "partition full", None, None)
    assert main(spark, where).count() == 1


def test_append_mode_keeps_what_is_staged(spark):
    where = config(spark, write_mode="append")
    land(frame(spark, [trip()]), YELLOW, "2025-07", where)
    go(spark, where)
    assert go(spark, where, refresh="all")["yellow", "202507"] == ("skipped", "nothing new", 1, 0)
    assert spark.table(f"{where.database}.{YELLOW.staging_table}").count() == 2


def test_rows_older_than_the_hash_column_are_inserted_again(spark):
    where = config(spark)
    name, slices = f"{where.database}.yellow_taxi", ["load_id", "pickup_month"]
    ensure_database(spark, where.database, where.root)
    ensure_table(spark, name, YELLOW.schema, f"{where.root}/yellow_taxi", slices)
    old = frame(spark, [trip()]).withColumn("load_id", F.lit("old")).withColumn("pickup_month", F.lit("202507"))
    append_rows(old, name)
    land(frame(spark, [trip()]), YELLOW, "2025-07", where)
    assert go(spark, where)["yellow", "202507"] == ("loaded", None, 1, 1)
    assert sorted((r.load_id, r.trip_hash is None) for r in main(spark, where).collect()) == [("202507", False), ("old", True)]


def test_files_are_sorted_by_the_cluster_columns(spark):
    where = config(spark)
    chance = random.Random(3)
    rows = [trip(VendorID=chance.randrange(4), pickup=datetime(2025, 7, 1 + chance.randrange(28))) for _ in range(200)]
    land(frame(spark, rows), YELLOW, "2025-07", where)
    go(spark, where)
    for table in ("yellow_taxi", "yellow_taxi_staging"):
        files = list(Path(f"{where.root}/{table}".removeprefix("file:")).rglob("*.parquet"))
        assert files
        for file in files:
            stored = pq.ParquetFile(file).read(columns=list(YELLOW.cluster)).to_pylist()
            order = [tuple(r.values()) for r in stored]
            assert order == sorted(order)


def test_a_load_that_died_before_the_ledger_is_done_again(spark, monkeypatch):
    where = config(spark)
    land(frame(spark, [trip(), trip(), trip(VendorID=2, pickup=JUNE_30)]), YELLOW, "2025-07", where)

    def crash(*_):
        raise SystemExit("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(monthly_run, "_record", crash)
        with pytest.raises(SystemExit):
            go(spark, where)
    assert main(spark, where).count() == 3
    land(frame(spark, [trip(), trip()]), YELLOW, "2025-07", where)
    assert go(spark, where)["yellow", "202507"] == ("loaded", None, 2, 2)
    assert ids(spark, where) == {(1, "202507", "202507"): 2}


def test_a_failed_load_leaves_nothing_in_main(spark, monkeypatch):
    where = config(spark)
    land(frame(spark, [trip()]), YELLOW, "2025-07", where)

    def fail(*_):
        raise RuntimeError("no ledger")

    with monkeypatch.context() as patch:
        patch.setattr(monthly_run, "_record", fail)
        status, reason, *_ = go(spark, where)["yellow", "202507"]
    assert (status, reason) == ("failed", "RuntimeError: no ledger")
    assert main(spark, where).isEmpty()


@pytest.mark.parametrize("probe_rows", [0, 12])
def test_all_months_at_once_equal_month_by_month(spark, probe_rows):
    chance = random.Random(probe_rows)
    pickups = [JUNE_30, JULY_5, AUGUST_9, None]
    months = {
        m: [trip(VendorID=chance.randrange(6), pickup=chance.choice(pickups), tip_amount=float(chance.randrange(2)))
            for _ in range(25)]
        for m in ("2025-07", "2025-08")
    }
    outcomes = []
    for at_once in (True, False):
        where = config(spark, probe_rows=probe_rows)
        for month, rows in months.items():
            land(frame(spark, rows), YELLOW, month, where)
        for last in ["2025-08"] if at_once else ["2025-07", "2025-08"]:
            go(spark, where, last=last)
        outcomes.append(Counter((r.trip_hash, r.tip_amount, r.load_id, r.pickup_month) for r in main(spark, where).collect()))
    assert outcomes[0] == outcomes[1]


def test_cells_are_split_by_what_has_to_be_broadcast():
    strays, july, july_again, august = cells = [
        Cell("202507", "202506", 5), Cell("202507", "202507", 900),
        Cell("202508", "202507", 700), Cell("202508", "202508", 800),
    ]
    split = split_cells(cells, {"202506": 10_000, "202508": 90}, probe_rows=100)
    assert (split.few_rows, set(split.few_before), split.others) == ((strays,), {july, august}, (july_again,))
    split = split_cells(cells, {"202507": 1, "202508": 101}, probe_rows=100)
    assert (split.few_rows, split.few_before, set(split.others)) == ((strays,), (july,), {july_again, august})
    assert set(split_cells(cells, {}, probe_rows=10_000).few_rows) == set(cells)
    assert sum(c.rows for c in split_cells(cells, {}, probe_rows=750).few_rows) <= 750


def test_a_month_with_little_before_it_is_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    where = config(spark, probe_rows=1)
    land(frame(spark, [trip(pickup=AUGUST_9)]), YELLOW, "2025-07", where)
    land(frame(spark, [trip(pickup=AUGUST_9), trip(pickup=AUGUST_9, VendorID=2)]), YELLOW, "2025-08", where)
    assert go(spark, where, last="2025-07")["yellow", "202507"][3] == 1
    staged = spark.table(f"{where.database}.{YELLOW.staging_table}")
    cells = [Cell("202508", "202508", 2)]
    staged = staged.where("load_month = '202508'")
    new = monthly_run.merge_staged(staged, main(spark, where), YELLOW, cells, {"202508": 1}, 1)
    new.collect()
    plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "SortMergeJoin" not in plan
    assert go(spark, where)["yellow", "202508"] == ("loaded", None, 2, 1)


def test_merge_reads_only_the_months_and_columns_it_needs(spark):
    where = config(spark, probe_rows=0)
    land(frame(spark, [trip(pickup=JUNE_30), trip(pickup=JULY_5)]), YELLOW, "2025-07", where)
    go(spark, where)
    staged = spark.table(f"{where.database}.{YELLOW.staging_table}")
    new = monthly_run.merge_staged(staged, main(spark, where), YELLOW, [Cell("202507", "202507", 1)], {"202507": 0}, 0)
    plan = new._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "yellow_taxi[" in line]
    assert scans and all("ReadSchema: struct<trip_hash:string>" in line for line in scans)
    assert all("pickup_month" in line.split("PartitionFilters: [")[1] and "202507" in line for line in scans)


@pytest.mark.parametrize("step", ["_merge", "_record"])
@pytest.mark.parametrize("mode", ["truncate", "if_empty", "append"])
def test_a_transient_error_costs_and_doubles_nothing(spark, monkeypatch, mode, step):
    where = config(spark, write_mode=mode)
    land(frame(spark, [trip(), trip(), trip(VendorID=2)]), YELLOW, "2025-07", where)
    real, calls = getattr(monthly_run, step), []

    def flaky(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("transient")
        return real(*args)

    monkeypatch.setattr(monthly_run, step, flaky)
    assert go(spark, where)["yellow", "202507"][0] == "failed"
    assert main(spark, where).count() == 0
    assert go(spark, where)["yellow", "202507"] == ("loaded", None, 3, 3)
    assert go(spark, where).get(("yellow", "202507"), ("skipped",))[0] == "skipped"
    assert main(spark, where).count() == 3


def test_no_pass_over_the_rows_looks_for_heavy_keys(spark, monkeypatch):
    """A third of the rows are one trip, of which August's file has more copies."""
    monkeypatch.setattr(merge, "heavy_keys", None)
    where = config(spark, probe_rows=0)
    july, august = ([trip(pickup=JULY_5)] * 10 + [trip(pickup=JULY_5, VendorID=v) for v in some] for some in (range(2, 22), range(12, 32)))
    land(frame(spark, july), YELLOW, "2025-07", where)
    land(frame(spark, [*august, *[trip(pickup=JUNE_30)] * 7]), YELLOW, "2025-08", where)
    assert go(spark, where)["yellow", "202508"] == ("loaded", None, 37, 17)
    assert Counter(ids(spark, where).values()) == Counter({1: 30, 10: 1, 7: 1})


@pytest.mark.parametrize("most_bytes", [0, 10**9])
def test_large_files_are_counted_and_digested_in_scans_of_their_own(spark, monkeypatch, most_bytes):
    monkeypatch.setattr(monthly_run, "_OBSERVED_BYTES", most_bytes)
    scanned = []
    real = monthly_run.observed
    monkeypatch.setattr(monthly_run, "observed", lambda scan, months, *a: scanned.append(months) or real(scan, months, *a))
    where = config(spark, write_mode="append")
    paths = [land(frame(spark, [trip(VendorID=v) for v in range(n)]), YELLOW, m, where) for m, n in (("2025-07", 3), ("2025-08", 5))]
    land(frame(spark, []), YELLOW, "2025-06", where)
    for _ in range(2):
        done = go(spark, where, first="2025-06", refresh="all")
    assert [done["yellow", f"20250{k}"][2] for k in (6, 7, 8)] == [0, 3, 5]
    assert scanned == 2 * ([["202506"], ["202507"], ["202508"]] if not most_bytes else [["202506", "202507", "202508"]])
    ledger = spark.table(f"{where.database}.{YELLOW.ledger_table}").where("load_id like '%-1'")
    noted = {r.file_name: r.checksum for r in ledger.collect() if r.load_month != "202506"}
    assert noted == {r.path.rsplit("/", 1)[1]: r.checksum for r in checksums(spark, paths).collect()}
    ids_staged = spark.table(f"{where.database}.{YELLOW.staging_table}").groupBy("load_month", "load_id").count().collect()
    assert {(r.load_month, r.load_id): r["count"] for r in ids_staged} == {(m, m + s): n for m, n in (("202507", 3), ("202508", 5)) for s in ("", "-1")}


def test_only_loads_that_are_split_are_told_by_the_month_of_each_row(spark):
    rows = [("202507", 1, JULY_5), ("202507", 2, JUNE_30), ("202508", 3, JULY_5), ("202508", 4, AUGUST_9), ("202508", 5, None)]
    staged = spark.createDataFrame(rows, "load_month string, VendorID long, tpep_pickup_datetime timestamp")
    staged = staged.withColumns({c: F.lit("x") for c in YELLOW.required if c not in staged.columns})
    cells = profile(staged, YELLOW)
    staged = staged.withColumn("pickup_month", monthly_merge.month_key(F.col(YELLOW.pickup)))
    found = lambda some: monthly_merge._in_cells(staged, some, YELLOW.pickup, cells)
    for k in range(1 << len(cells)):
        some = [c for n, c in enumerate(cells) if k >> n & 1]
        wanted = {(c.load_month, c.pickup_month) for c in some}
        if some:
            assert {(r.load_month, r.pickup_month) for r in found(some).collect()} == wanted
    whole = found([c for c in cells if c.load_month == "202507"])._jdf.queryExecution().optimizedPlan().toString()
    assert "concat" not in whole.split("LocalRelation")[0].split("Filter")[-1]
