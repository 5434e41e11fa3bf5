from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from monthtide import YELLOW, fingerprint, has_new, merge_insert
from monthtide.operators import (
    first_seen,
    heavy_keys,
    merge,
    new_keys,
    rows_of_keys,
    unseen,
    unseen_among_few,
    unseen_by_probe,
    unseen_keys,
)
from tests.trips import frame, trip

ROW = "k string, load string, v int"


def hashed(spark, rows):
    return fingerprint(frame(spark, rows), YELLOW.identity)


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


def one_by_one(batch, main):
    """What merging load after load inserts, by plain iteration."""
    known = {k for k, *_ in main if k is not None}
    inserted = []
    for load in sorted({row[1] for row in batch}):
        fresh = [row for row in batch if row[1] == load and row[0] not in known]
        inserted += fresh
        known |= {row[0] for row in fresh if row[0] is not None}
    return Counter(inserted)


def test_equal_rows_of_one_batch_are_both_inserted(spark):
    new = merge_insert(hashed(spark, [trip(), trip()]), hashed(spark, []))
    assert new.count() == 2


def test_known_rows_are_neither_inserted_nor_updated(spark):
    main = hashed(spark, [trip(tip_amount=1.0)])
    batch = hashed(spark, [trip(tip_amount=9.0), trip(VendorID=2)])
    assert [r.VendorID for r in merge_insert(batch, main).collect()] == [2]


def test_null_hash_in_main_never_matches(spark):
    batch = hashed(spark, [trip()])
    main = batch.withColumn("trip_hash", F.lit(None).cast("string"))
    assert merge_insert(batch, main).count() == 1


def test_columns_left_out_are_null(spark):
    batch = hashed(spark, [trip()])
    row = merge_insert(batch, batch.limit(0), insert_columns=YELLOW.insert_columns).first()
    assert (row.tolls_amount, row.store_and_fwd_flag) == (None, None)
    assert row.fare_amount == 15.0
    assert merge_insert(batch, batch.limit(0)).first().tolls_amount == 5.0


def test_result_has_the_columns_of_main(spark):
    main = hashed(spark, []).withColumn("note", F.lit("x"))
    new = merge_insert(hashed(spark, [trip()]), main)
    assert new.columns == main.columns and new.first().note is None


def test_second_merge_adds_nothing(spark):
    batch, main = hashed(spark, [trip(), trip(), trip(VendorID=2)]), hashed(spark, [])
    merged = main.unionByName(merge_insert(batch, main))
    assert merged.count() == 3
    assert not has_new(batch, merged)
    assert merge_insert(batch, merged).isEmpty()


def test_declared_keys_with_null_never_match(spark):
    batch = frame(spark, [trip(PULocationID=None), trip()])
    new = merge_insert(batch, batch, keys=YELLOW.merge_keys)
    assert [r.PULocationID for r in new.collect()] == [None]
    assert has_new(batch, batch, keys=YELLOW.merge_keys)


def test_key_types_must_agree(spark):
    batch = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(TypeError, match="conform"):
        merge_insert(batch, spark.createDataFrame([(1,)], "k int"), keys=["k"])


def test_new_keys_reads_only_the_keys(spark, tmp_path):
    hashed(spark, [trip()]).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = new_keys(rows, rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<trip_hash:string>") == 2


def test_without_heavy_keys_the_final_plan_is_one_anti_join(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("load"))
    rows.write.parquet(str(tmp_path / "rows"))
    batch = spark.read.parquet(str(tmp_path / "rows"))
    new = merge_insert(batch, batch.where("k < '5'"), keys=["k"])
    new.collect()
    final = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert final.count("LeftAnti") == 1 and "Union" not in final and "CartesianProduct" not in final


@pytest.mark.parametrize("hot_is_known", [True, False])
def test_a_key_with_a_third_of_all_rows(spark, hot_is_known):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    batch = spark.range(30_000).select(key.alias("k"), F.lit("1").alias("load"), F.col("id").cast("int").alias("v"))
    assert heavy_keys(batch, ["k"]).count() == 1
    main_rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot" if hot_is_known else "other"))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.lit("0").alias("load"), F.lit(0).alias("v"),
    )
    found = multiset(merge_insert(batch, main_rows, keys=["k"]))
    expected = one_by_one([tuple(r) for r in batch.collect()], [tuple(r) for r in main_rows.collect()])
    assert found == expected
    assert (found.total() < 20_000) is hot_is_known


def test_null_key_may_be_heavy(spark):
    key = F.when(F.col("id") % 3 > 0, F.col("id").cast("string"))
    batch = spark.range(9_000).select(key.alias("k"))
    assert merge_insert(batch, batch, keys=["k"]).count() == 3_000


@pytest.mark.parametrize("seed", range(4))
def test_every_way_to_merge_equals_one_load_after_the_other(spark, seed):
    chance = random.Random(seed)
    keys = [None, "hot", "hot", "hot", *(f"k{i}" for i in range(40))]
    batch = [(chance.choice(keys), chance.choice("345"), chance.randrange(3)) for _ in range(600)]
    main = [(chance.choice(keys), "1", 0) for _ in range(chance.choice([0, 10, 60]))]
    expected = one_by_one(batch, main)
    rows, known = spark.createDataFrame(batch, ROW), spark.createDataFrame(main, ROW)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", chance.choice(["-1", "10MB"]))
    assert multiset(merge_insert(rows, known, keys=["k"], order="load")) == expected
    assert multiset(merge_insert(rows, known, keys=["k"], order="load", alike=["k", "v"])) == expected
    assert multiset(unseen_by_probe(rows, known, ["k"], rows, "load")) == expected
    assert multiset(unseen_among_few(rows, known, ["k"], rows, "load")) == expected
    keyed = rows.dropna(subset=["k"])
    wanted = unseen_keys(keyed, known, ["k"], keyed, "load")
    for few in (True, False):
        by_key = multiset(rows_of_keys(keyed, wanted, ["k"], "load", few=few))
        assert by_key == Counter({row: n for row, n in expected.items() if row[0] is not None})
    single = one_by_one([(k, "3", v) for k, _, v in batch], main)
    first_load = rows.withColumn("load", F.lit("3"))
    assert multiset(unseen(first_load, first_seen(known, ["k"]), ["k"])) == single
    assert multiset(unseen_by_probe(first_load, known, ["k"])) == single


def test_splitting_batches_without_shared_identities_changes_nothing(spark):
    rows = [trip(VendorID=i, tip_amount=float(n)) for i in range(6) for n in range(2)]
    main = hashed(spark, [trip(VendorID=0)])
    whole = main.unionByName(merge_insert(hashed(spark, rows), main))
    for cut in (4, 8):
        first = main.unionByName(merge_insert(hashed(spark, rows[:cut]), main))
        both = first.unionByName(merge_insert(hashed(spark, rows[cut:]), first))
        assert multiset(both.select("trip_hash")) == multiset(whole.select("trip_hash"))


def test_sketches_are_combined_in_groups(spark):
    rows = spark.range(0, 50_000, 1, 200).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    found = heavy_keys(rows, ["k"])
    assert found.collect() == spark.range(1).select(F.xxhash64(F.lit("hot")).alias("_heavy")).collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k_combine" in plan and "hashpartitioning(" in plan
    assert heavy_keys(rows.limit(0), ["k"]).collect() == []


def test_the_list_of_heavy_keys_is_read_and_not_found_again(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    batch = spark.range(9_000).select(key.alias("k"))
    plan = merge_insert(batch, batch.where("k <> 'hot'"), keys=["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" not in plan and "heavy_keys" in plan or "_heavy" in plan


def test_packed_keys_differ_as_their_texts_do_and_come_back(spark):
    hashed = "0123456789abcdef" * 4
    texts = ["", "a", "a" * 31, "a" * 31 + "\2", "a" * 30 + "\2", "a" * 32, "a" * 31 + "\1", hashed, hashed.upper(), hashed[:-1], hashed + "\n", "ü" * 16]
    rows = spark.createDataFrame([(t,) for t in texts], "k string").withColumn("p", merge.packed(F.col("k")))
    found = rows.withColumn("back", merge.unpacked(F.col("p"))).collect()
    assert [r.back for r in found] == texts
    assert len({bytes(r.p) for r in found}) == len(texts)
    assert [len(r.p) for r in found if r.k == hashed] == [32]


def test_a_merge_shuffles_fingerprints_as_bytes(spark):
    hashed = lambda n: [(f"{k:064x}", k) for k in range(n)]
    batch, main_rows = (spark.createDataFrame(hashed(n), "trip_hash string, v int") for n in (30, 20))
    new = merge_insert(batch, main_rows)
    assert "unhex" in new._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.trip_hash for r in new.collect()) == [f"{k:064x}" for k in range(20, 30)]


def test_first_loads_meet_in_one_aggregation_that_does_not_sort(spark):
    hashed = lambda k: f"{k:064x}"
    main_rows = spark.createDataFrame([(hashed(1),), (None,), ("other",)], "k string")
    rows = [(1, 4), (2, 4), (2, 6), (3, 5), (3, 6), (4, 6), (4, 6)]
    batch = spark.createDataFrame([(bytes.fromhex(hashed(k)), rank) for k, rank in rows], "k binary, r int")
    found = merge.unseen_packed(batch, main_rows, "k", "r")
    assert sorted((int(bytes(a).hex(), 16), b) for a, b in found.collect()) == [(2, 4), (4, 6)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Join" not in plan


def test_heavy_keys_are_told_by_the_comparison_itself(spark):
    """Inserted or not: rows of keys that main has are not sent to one task either."""
    hashed = lambda k: f"{k:064x}"
    main_rows = spark.createDataFrame([(hashed(1),)] * 9 + [(None,)], "k string")
    ranks = [(1, 4)] * 3 + [(2, 4)] * 2 + [(3, 4)] * 3 + [(3, 6)] + [(4, 5)] * 3 + [(4, 6)] * 2 + [(5, 7)] * 4
    batch = spark.createDataFrame([(bytes.fromhex(hashed(k)), rank) for k, rank in ranks], "k binary, r int")
    told = merge.unseen_packed(batch, main_rows, "k", "r", heavy_from=3)
    wanted, heavy = merge.wanted_among(told), merge.heavy_among(told)
    number = lambda key: int(bytes(key).hex(), 16)
    assert sorted((number(k), r) for k, r in wanted.collect()) == [(2, 4), (3, 4)]
    assert sorted(number(k) for (k,) in heavy.collect()) == [1, 3]
    rows = rows_of_keys(batch, wanted, ["k"], "r", heavy=heavy)
    assert "approx_top_k" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert Counter((number(k), r) for k, r in rows.collect()) == Counter({(2, 4): 2, (3, 4): 3})
