"""Small trip files for the tests."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from monthtide import GREEN, YELLOW, Config, Kind, work_folder

_START = datetime(2025, 7, 10, 8, 0, 0)


def trip(kind: Kind = YELLOW, pickup: datetime | None = _START, **values) -> dict:
    """One row of ``kind`` with every declared column."""
    dropoff = next(c for c in kind.schema.names if c.endswith("dropoff_datetime"))
    row = {
        "VendorID": 1, kind.pickup: pickup, dropoff: datetime(2025, 7, 10, 8, 30, 0), "passenger_count": 2,
        "trip_distance": 3.5, "store_and_fwd_flag": "N", "RatecodeID": 1, "PULocationID": 10, "DOLocationID": 20,
        "payment_type": 1, "fare_amount": 15.0, "extra": 0.5, "mta_tax": 0.5, "tip_amount": 2.0, "tolls_amount": 5.0,
        "improvement_surcharge": 1.0, "total_amount": 24.0, "congestion_surcharge": 2.5, "cbd_congestion_fee": 0.75,
    }
    if kind is GREEN:
        row |= {"ehail_fee": 0.0, "trip_type": 1}
    else:
        row |= {"Airport_fee": 1.75}
    return row | values


def frame(spark: SparkSession, rows: list[dict], kind: Kind = YELLOW, ddl: dict[str, str] | None = None) -> DataFrame:
    """Rows as a DataFrame; ``ddl`` changes the type of a column, or drops it (None)."""
    changed = ddl or {}
    types = {f.name: f.dataType.simpleString() for f in kind.schema} | changed
    names = [n for n, t in types.items() if t is not None]
    schema = ", ".join(f"`{n}` {types[n]}" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def config(spark: SparkSession, **options) -> Config:
    root = work_folder(spark, "test")
    settings = {"min_size": 1} | options
    return Config(database=f"t_{uuid.uuid4().hex}", root=f"{root}/tables", landing=f"{root}/landing", **settings)


def land(df: DataFrame, kind: Kind, month: str, where: Config, parts: int = 1) -> str:
    path = f"{where.landing}/{kind.name}_tripdata_{month}.parquet"
    df.coalesce(parts).write.mode("overwrite").parquet(path)
    return path
