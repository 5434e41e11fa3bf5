"""Column-name clean-up. Renaming is metadata only and costs no job."""

from __future__ import annotations

import re
import sys
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the target naming rules.
EMPTY_NAME = "field"
DIGIT_PREFIX = "f_"
MAX_NAME_LENGTH = 300

_CASE_BOUNDARY = re.compile(r"([a-z0-9])([A-Z])")


def _snake(name: str) -> str:
    return _CASE_BOUNDARY.sub(r"\1_\2", name).lower().strip()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename ``VendorID`` to ``vendor_id`` and the like."""
    return df.toDF(*map(_snake, df.columns))


def normalize_name(name: str) -> str:
    """A name the warehouse accepts: word characters only, no leading digit."""
    words = re.sub(r"\W+", "_", name.strip()) or EMPTY_NAME
    prefix = DIGIT_PREFIX if words[0].isdigit() else ""
    return (prefix + words)[:MAX_NAME_LENGTH]


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Apply :func:`normalize_name` to every column of ``df``."""
    return df.toDF(*map(normalize_name, df.columns))


@cache
def _digits() -> str:
    """Regex class of what counts as a digit in Python: \\d and the likes of ``²``."""
    others = (chr(i) for i in range(sys.maxunicode + 1) if chr(i).isdigit() and not chr(i).isdecimal())
    return r"[\p{Nd}" + "".join(others) + "]"


def normalized(value: Column) -> Column:
    """:func:`normalize_name` as an expression, for names held in data."""
    # The classes spell out what strip() and \W mean in Python.
    space, other = r"[\s\x1c-\x1f]+", r"[^\p{L}\p{N}_]+"
    stripped = F.regexp_replace(value, f"(?U)^{space}|{space}$", "")
    words = F.regexp_replace(stripped, other, "_")
    named = F.when(words == "", F.lit(EMPTY_NAME)).otherwise(words)
    prefixed = F.when(named.rlike("^" + _digits()), F.concat(F.lit(DIGIT_PREFIX), named)).otherwise(named)
    return F.substring(prefixed, 1, MAX_NAME_LENGTH)
