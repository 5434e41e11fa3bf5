"""Row identity: SHA-256 over the JSON text of the identifying columns.

Every option that changes a byte of the JSON is pinned, because a changed
fingerprint would make a merge insert the whole history again. Raise
``FINGERPRINT_VERSION`` (it is part of each load report) if one ever has to
change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT_VERSION = 1

# to_json drops NULL fields, cuts timestamps to milliseconds and prints them in
# the session zone unless told otherwise; each of these would alter identity.
_MICROSECONDS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": _MICROSECONDS_UTC,
    "timestampNTZFormat": _MICROSECONDS_UTC,
}


def identity_json(columns: Sequence[str]) -> Column:
    """JSON object of ``columns`` in the given order, NULLs kept as ``null``."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), _JSON_OPTIONS)


def identity_hash(columns: Sequence[str]) -> Column:
    """Lowercase hex SHA-256 of :func:`identity_json`; never NULL.

    The plan is told so, too: for a column that might be NULL, Spark adds a null
    check to every join on it, and would hash each row again to evaluate it.
    """
    return F.coalesce(F.sha2(identity_json(columns), 256), F.lit(""))


def fingerprint(df: DataFrame, columns: Sequence[str], out: str = "trip_hash") -> DataFrame:
    """``df`` with the identity hash of ``columns`` added as ``out``."""
    return df.withColumn(out, identity_hash(columns))
