"""Column-level helpers: fingerprints, month keys and column names."""

from monthtide.functions.fingerprint import FINGERPRINT_VERSION, fingerprint, identity_hash, identity_json
from monthtide.functions.months import in_month, month_in_zone, month_key, month_label
from monthtide.functions.names import normalize_column_names, normalized, normalize_name, snake_case_columns

__all__ = [
    "FINGERPRINT_VERSION",
    "fingerprint",
    "identity_hash",
    "identity_json",
    "in_month",
    "month_in_zone",
    "month_key",
    "month_label",
    "normalize_column_names",
    "normalize_name",
    "normalized",
    "snake_case_columns",
]
