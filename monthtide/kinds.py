"""What a kind of monthly file looks like: schema, identity, layout.

A kind is declared once and drives the generic load and merge code; adding a
kind means adding a declaration, never a new statement.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# Field types a declaration may use.
FIELD_TYPES = {
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}

# Table names are the kind followed by one of these.
MAIN_SUFFIX = "_taxi"
STAGING_SUFFIX = "_taxi_staging"
LEDGER_SUFFIX = "_taxi_loads"
STAGED_SUFFIX = "_taxi_staged"
ATTEMPTS_SUFFIX = "_taxi_attempts"
SCHEMAS_SUFFIX = "_taxi_schemas"
FILTERS_SUFFIX = "_taxi_filters"


@dataclass(frozen=True)
class Kind:
    """Declaration of one kind.

    ``identity`` is what the fingerprint covers, in hash order. ``merge_keys``
    is the smaller declared key. ``cluster`` orders rows inside files.
    ``omitted`` columns stay NULL in the main table.
    """

    name: str
    schema: T.StructType
    pickup: str
    identity: tuple[str, ...]
    merge_keys: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    omitted: tuple[str, ...] = ()
    hash_column: str = "trip_hash"

    def __post_init__(self) -> None:
        declared = set(self.schema.names)
        for role in ("identity", "merge_keys", "cluster", "omitted"):
            unknown = set(getattr(self, role)) - declared
            if unknown:
                raise ValueError(f"{self.name}: {role} names undeclared columns {sorted(unknown)}")
        if self.pickup not in declared:
            raise ValueError(f"{self.name}: pickup column {self.pickup!r} is not declared")

    @property
    def main_table(self) -> str:
        return self.name + MAIN_SUFFIX

    @property
    def staging_table(self) -> str:
        return self.name + STAGING_SUFFIX

    @property
    def ledger_table(self) -> str:
        return self.name + LEDGER_SUFFIX

    @property
    def staged_table(self) -> str:
        """What each staged load came from."""
        return self.name + STAGED_SUFFIX

    @property
    def attempts_table(self) -> str:
        """Loads that failed."""
        return self.name + ATTEMPTS_SUFFIX

    @property
    def schemas_table(self) -> str:
        """Versions of the schema."""
        return self.name + SCHEMAS_SUFFIX

    @property
    def filters_table(self) -> str:
        """Bloom filters of the fingerprints of each load, by pickup month."""
        return self.name + FILTERS_SUFFIX

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def insert_columns(self) -> list[str]:
        """Columns a merge fills in the main table."""
        return [c for c in self.schema.names if c not in self.omitted] + [self.hash_column]


def schema_from_fields(fields: list[Mapping[str, str]]) -> T.StructType:
    """Spark schema of a declared field list (name, type, mode)."""
    return T.StructType(
        [T.StructField(f["name"], FIELD_TYPES[f["type"]], f.get("mode", "NULLABLE") != "REQUIRED") for f in fields]
    )


def kinds_from_json(text: str, identity: Mapping[str, tuple[str, ...]], **common) -> dict[str, Kind]:
    """Kinds from a JSON document of ``{kind: {schema_fields, cluster_fields, …}}``.

    The document does not say which columns identify a row, so ``identity``
    does. The first REQUIRED column is taken as the pickup time. Only monthly
    partitioning exists; any other unit is refused.
    """
    kinds = {}
    for name, entry in json.loads(text).items():
        unit = entry.get("time_partitioning", {}).get("type", "MONTH")
        if unit != "MONTH":
            raise ValueError(f"{name}: only monthly partitions are supported, not {unit}")
        schema = schema_from_fields(entry["schema_fields"])
        kinds[name] = Kind(
            name=name,
            schema=schema,
            pickup=next(f.name for f in schema if not f.nullable),
            identity=tuple(identity[name]),
            merge_keys=tuple(entry.get("merge_keys", ())),
            cluster=tuple(entry.get("cluster_fields", ())),
            **common,
        )
    return kinds


# The two declared trip kinds, their columns in declared order.
_YELLOW = """
    VendorID INTEGER, tpep_pickup_datetime TIMESTAMP REQUIRED, tpep_dropoff_datetime TIMESTAMP REQUIRED,
    passenger_count INTEGER, trip_distance FLOAT, store_and_fwd_flag STRING, RatecodeID INTEGER,
    PULocationID INTEGER, DOLocationID INTEGER, payment_type INTEGER, fare_amount FLOAT, extra FLOAT,
    mta_tax FLOAT, tip_amount FLOAT, tolls_amount FLOAT, improvement_surcharge FLOAT,
    total_amount FLOAT, congestion_surcharge FLOAT, Airport_fee FLOAT, cbd_congestion_fee FLOAT
"""
_GREEN = """
    VendorID INTEGER, lpep_pickup_datetime TIMESTAMP REQUIRED, lpep_dropoff_datetime TIMESTAMP REQUIRED,
    store_and_fwd_flag STRING, RatecodeID INTEGER, PULocationID INTEGER, DOLocationID INTEGER,
    passenger_count INTEGER, trip_distance FLOAT, fare_amount FLOAT, extra FLOAT, mta_tax FLOAT,
    tip_amount FLOAT, tolls_amount FLOAT, ehail_fee FLOAT, improvement_surcharge FLOAT,
    total_amount FLOAT, payment_type INTEGER, trip_type INTEGER, congestion_surcharge FLOAT,
    cbd_congestion_fee FLOAT
"""
_NOT_INSERTED = ("store_and_fwd_flag", "tolls_amount")


def schema_from_text(declaration: str) -> T.StructType:
    """``"a INTEGER REQUIRED, b FLOAT"`` to a schema."""
    parts = [column.split() for column in declaration.split(",")]
    return schema_from_fields([dict(zip(("name", "type", "mode"), part)) for part in parts])


def _trips(name: str, declaration: str, prefix: str) -> Kind:
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    key = ("VendorID", pickup, dropoff, "PULocationID", "DOLocationID")
    return Kind(
        name=name,
        schema=schema_from_text(declaration),
        pickup=pickup,
        identity=(*key, "passenger_count", "trip_distance", "total_amount", "payment_type"),
        merge_keys=key,
        cluster=("VendorID", pickup),
        omitted=_NOT_INSERTED,
    )


YELLOW = _trips("yellow", _YELLOW, "tpep")
GREEN = _trips("green", _GREEN, "lpep")
KINDS = {kind.name: kind for kind in (YELLOW, GREEN)}
