"""Repeatable monthly loads of Parquet files into partitioned tables."""

from monthtide.functions import fingerprint, normalize_column_names, snake_case_columns
from monthtide.kinds import GREEN, KINDS, YELLOW, Kind, kinds_from_json
from monthtide.operators import has_new, load_partitions, merge_insert, replace_partition
from monthtide.plans import due_spans, plan_assets
from monthtide.plans.monthly_run import Config, run
from monthtide.session import tune, use_utc, work_folder
from monthtide.sources import conform, gate, manifest, relax
from monthtide.streaming import catch_up

__all__ = [
    "Config",
    "GREEN",
    "KINDS",
    "Kind",
    "YELLOW",
    "catch_up",
    "conform",
    "due_spans",
    "fingerprint",
    "gate",
    "has_new",
    "kinds_from_json",
    "load_partitions",
    "manifest",
    "merge_insert",
    "normalize_column_names",
    "plan_assets",
    "relax",
    "replace_partition",
    "run",
    "snake_case_columns",
    "tune",
    "use_utc",
    "work_folder",
]
