"""Durations between wall-clock times.

`timestamp_ntz` values are subtracted as they are, so the session time zone plays no part. Casting them to
zoned timestamps first would shift trips that cross a daylight-saving change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY_MICROS = 86_400 * MICROS

# Counting seconds from here keeps them positive, so that cutting off a fraction always rounds down.
FIRST_MOMENT = "0001-01-01"


def _second_number(ts: Column) -> Column:
    since = ts - F.lit(FIRST_MOMENT).cast("timestamp_ntz")
    return since.cast("interval second").cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed: 00:00:00.9 to 00:00:01.1 is 1."""
    return _second_number(end) - _second_number(start)


def micros_between(start: Column, end: Column) -> Column:
    """Elapsed microseconds; exact for spans below 285 years."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return F.rint(seconds.cast("double") * float(MICROS)).cast("bigint")


def to_minutes(seconds: str) -> Column:
    """`seconds / 60` to two places, as a double, from a column of whole seconds.

    seconds * 5 / 3 is the number of hundredths of a minute. Thirds are never halfway, so integer
    arithmetic rounds exactly and no row pays for a decimal rounding call.
    """
    size = f"(10 * abs({seconds}) + 3) div 6"
    return F.expr(f"if({seconds} < 0, -({size}), {size}) / 100D")


def with_interval_text(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Add elapsed time as text: `1 day 02:00:00`, `-00:00:00.25`, `60 days`.

    Whole days first, then the clock part unless it is zero; each part carries its own sign. Every step is a
    column of its own, so each is computed once per row and the generated code stays small. The clock's
    digits come from one number: 1083005 is 08:30:05 behind a leading 1.
    """
    micros, days, rest, digits, clock = (f"{name}_{part}" for part in ("micros", "days", "rest", "digits", "clock"))
    seconds = f"(abs({rest}) div {MICROS})"
    fraction = f"substr(cast({MICROS} + abs({rest}) % {MICROS} AS string), 2)"
    steps = (
        {micros: micros_between(F.col(start), F.col(end))},
        {days: F.expr(f"{micros} div {DAY_MICROS}"), rest: F.expr(f"{micros} % {DAY_MICROS}")},
        {digits: F.expr(f"cast(1000000 + {seconds} div 3600 * 10000 + {seconds} div 60 % 60 * 100 + {seconds} % 60 AS string)")},
        {
            clock: F.expr(
                f"concat(if({rest} < 0, '-', ''), substr({digits}, 2, 2), ':', substr({digits}, 4, 2), ':', "
                f"substr({digits}, 6, 2), if({rest} % {MICROS} = 0, '', concat('.', trim(TRAILING '0' FROM {fraction}))))"
            )
        },
        {
            name: F.expr(
                f"CASE WHEN {days} = 0 THEN {clock} ELSE concat({days}, if(abs({days}) = 1, ' day', ' days'), "
                f"if({rest} = 0, '', concat(' ', {clock}))) END"
            )
        },
    )
    for step in steps:
        df = df.withColumns(step)
    return df.drop(micros, days, rest, digits, clock)
