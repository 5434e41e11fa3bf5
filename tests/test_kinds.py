from __future__ import annotations

import json

import pytest

from monthtide import GREEN, KINDS, YELLOW, kinds_from_json
from monthtide.kinds import Kind, schema_from_text

DOCUMENT = {
    "bike": {
        "schema_fields": [
            {"name": "id", "type": "INTEGER", "mode": "NULLABLE"},
            {"name": "started", "type": "TIMESTAMP", "mode": "REQUIRED"},
            {"name": "fare", "type": "FLOAT", "mode": "NULLABLE"},
        ],
        "cluster_fields": ["id", "started"],
        "time_partitioning": {"type": "MONTH"},
        "merge_keys": ["id", "started"],
    }
}


def test_the_two_kinds():
    assert set(KINDS) == {"yellow", "green"}
    assert (len(YELLOW.schema), len(GREEN.schema)) == (20, 21)
    assert len(YELLOW.insert_columns) == 19 and len(GREEN.insert_columns) == 20
    for kind, prefix in ((YELLOW, "tpep"), (GREEN, "lpep")):
        assert kind.required == [f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"]
        assert len(kind.identity) == 9 and kind.merge_keys == kind.identity[:5]
        assert not {"store_and_fwd_flag", "tolls_amount"} & set(kind.insert_columns)


def test_kinds_can_be_declared_in_json():
    kind = kinds_from_json(json.dumps(DOCUMENT), {"bike": ("id", "started")})["bike"]
    assert kind.schema == schema_from_text("id INTEGER, started TIMESTAMP REQUIRED, fare FLOAT")
    assert (kind.pickup, kind.cluster, kind.merge_keys) == ("started", ("id", "started"), ("id", "started"))
    assert kind.main_table == "bike_taxi"


def test_only_months_partition():
    DOCUMENT["bike"]["time_partitioning"] = {"type": "DAY"}
    with pytest.raises(ValueError, match="monthly"):
        kinds_from_json(json.dumps(DOCUMENT), {"bike": ("id",)})


def test_roles_must_name_declared_columns():
    with pytest.raises(ValueError, match="identity"):
        Kind("bike", schema_from_text("id INTEGER"), "id", ("nope",))
    with pytest.raises(ValueError, match="pickup"):
        Kind("bike", schema_from_text("id INTEGER"), "nope", ("id",))
