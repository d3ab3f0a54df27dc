"""Size checks that stand before a broadcast."""

from __future__ import annotations

import weakref
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest lookup we broadcast, in rows and in estimated bytes; bigger lookups
# use the shuffle join the optimizer picks (AQE may still broadcast a side
# whose measured runtime size turns out small).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 ** 2
_STRING_BYTES = 64          # assumed width of a string / binary value


# Widths of fixed-size values; anything else (strings, nested) counts as _STRING_BYTES.
_FIXED_BYTES = {"BooleanType": 1, "ByteType": 1, "ShortType": 2, "IntegerType": 4, "LongType": 8,
                "FloatType": 4, "DoubleType": 8, "DateType": 4, "TimestampType": 8,
                "TimestampNTZType": 8, "DecimalType": 16}


def row_bytes(df: DataFrame) -> int:
    """Conservative width of one row from the schema (strings at 64 bytes)."""
    return max(1, sum(_FIXED_BYTES.get(type(f.dataType).__name__, _STRING_BYTES) for f in df.schema.fields))


# Row counts known from how a frame was built (e.g. a fixed list of literal rows).
_KNOWN_ROWS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def mark_row_count(df: DataFrame, rows: int) -> DataFrame:
    """Record that ``df`` holds exactly ``rows`` rows (known by construction)."""
    _KNOWN_ROWS[df] = rows
    return df


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows.

    Uses the recorded count when the frame's size is known by construction;
    otherwise counts the rows.  Each task sends its count, never rows.
    """
    known = _KNOWN_ROWS.get(df)
    if known is None:
        known = df.agg(F.count(F.lit(1))).first()[0]
    return known <= max_rows


def broadcast_row_limit(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                        max_bytes: int = BROADCAST_MAX_BYTES) -> int:
    """Rows of ``df`` that fit both the row and the byte budget."""
    return min(max_rows, max_bytes // row_bytes(df))
