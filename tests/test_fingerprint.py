from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from monthtide import GREEN, YELLOW, conform, fingerprint
from tests.trips import frame, trip


def hashes(df, kind=YELLOW):
    return [r.trip_hash for r in fingerprint(df, kind.identity).select("trip_hash").collect()]


def test_hash_is_sha256_of_the_pinned_json(spark):
    text = json.dumps(
        {
            "VendorID": 1, "tpep_pickup_datetime": "2025-07-10T08:00:00.000000Z",
            "tpep_dropoff_datetime": "2025-07-10T08:30:00.000000Z", "PULocationID": 10, "DOLocationID": 20,
            "passenger_count": None, "trip_distance": 3.5, "total_amount": 24.0, "payment_type": 1,
        },
        separators=(",", ":"),
    )
    (found,) = hashes(frame(spark, [trip(passenger_count=None)]))
    assert found == hashlib.sha256(text.encode()).hexdigest()


def test_golden_hashes(spark):
    """A change here means that every load would insert its history again."""
    yellow = "9a9e3639b42e45f6e20fff76926dec7aec671ec46edf67ca1dfaf7f1282f6165"
    green = "461381646171dabd5b68bd9b995c770d289cf0f0d56a3d8a9bf40b6b48b6be3b"
    assert hashes(frame(spark, [trip()])) == [yellow]
    assert hashes(frame(spark, [trip(GREEN)], GREEN), GREEN) == [green]


@pytest.mark.parametrize(
    "changes, same",
    [
        ({"passenger_count": 0}, False),
        ({"passenger_count": None}, False),
        ({"payment_type": 2}, False),
        ({"tpep_pickup_datetime": datetime(2025, 7, 10, 8, 0, 0, 1)}, False),
        ({"tip_amount": 99.0, "Airport_fee": None, "store_and_fwd_flag": "Y"}, True),
    ],
)
def test_only_the_identity_columns_count(spark, changes, same):
    first, second = hashes(frame(spark, [trip(), trip(**changes)]))
    assert (first == second) is same


def test_null_is_equal_to_null(spark):
    first, second = hashes(frame(spark, [trip(passenger_count=None)] * 2))
    assert first == second and first is not None


def test_microseconds_count(spark):
    early, late = (datetime(2025, 7, 1, 0, 0, 3, us) for us in (120000, 120001))
    assert len(set(hashes(frame(spark, [trip(pickup=early), trip(pickup=late)])))) == 2


def test_session_zone_does_not_count(spark):
    rows = frame(spark, [trip()])
    in_utc = hashes(rows)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    assert hashes(rows) == in_utc


def test_kinds_differ(spark):
    assert hashes(frame(spark, [trip()])) != hashes(frame(spark, [trip(GREEN)], GREEN), GREEN)


def test_physical_type_does_not_count_after_conforming(spark):
    as_double = frame(spark, [trip(passenger_count=2.0)], ddl={"passenger_count": "double"})
    assert hashes(conform(as_double, YELLOW.schema)) == hashes(frame(spark, [trip()]))


def test_hash_is_known_not_to_be_null(spark):
    df = fingerprint(frame(spark, [trip()]), YELLOW.identity)
    assert not df.schema["trip_hash"].nullable
    assert df.where(F.col("trip_hash").isNull()).count() == 0
