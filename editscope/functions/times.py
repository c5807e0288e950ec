"""Event-time helpers that give the same number in every session time zone."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000


def event_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch for a ``timestamp`` or ``timestamp_ntz`` column."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(F.col(name))


def floor_div(number: Column, by: int) -> Column:
    """Integer quotient rounded down, exact for any bigint."""
    return F.call_function("div", number - F.pmod(number, F.lit(by)), F.lit(by))


def duration_micros(text: str) -> int:
    """Length of a duration such as ``15 minutes``."""
    return pd.Timedelta(text).value // 1000


def pane_width(size: str, slide: str) -> str:
    """Widest tumbling pane every window edge falls on."""
    return f"{math.gcd(duration_micros(size), duration_micros(slide))} microseconds"
