"""Column helpers whose null, zero and text rules differ from Spark's defaults."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str


def as_date(value: AsOf) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def days_before(as_of: AsOf, n: int) -> Column:
    """A literal date, so the comparison reaches the parquet scan as a pushed filter."""
    return F.lit(as_date(as_of) - dt.timedelta(days=n))


def div0(a: Column, b: Column) -> Column:
    """0 for a zero divisor, NULL for a NULL one."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def ratio(a: Column, b: Column) -> Column:
    """NULL for a zero divisor."""
    return a / F.nullif(b, F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def sunday0(ts: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(ts) - 1


def money(x: Column, places: int = 2) -> Column:
    """Fixed-point text; plain casts would print large doubles in scientific notation."""
    return F.format_string(f"%.{places}f", x)


def joined_text(*parts: Column | str) -> Column:
    """Concatenation that is NULL as soon as one part is NULL; str parts are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def epoch_to_ntz(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def case_map(key: Column, mapping: dict, default=None) -> Column:
    """Searched CASE over a small code table."""
    out = None
    for code, label in mapping.items():
        out = F.when(key == code, F.lit(label)) if out is None else out.when(key == code, F.lit(label))
    return out.otherwise(F.lit(default))
