"""Cleaning: sentinels to NULL, conditional NULLs, defaults, case changes, date-time parsing.

Every function is one projection of built-in expressions (no UDF, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import in_set


def _string_cols(df: DataFrame):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def sentinel_to_null(df: DataFrame, value: str = "Z") -> DataFrame:
    """``mutate_all(na_if, value)``: a cell exactly equal to ``value`` becomes NULL.

    Only text columns can hold the text sentinel, so only they are rewritten.
    """
    cols = _string_cols(df)
    if not cols:
        return df
    return df.withColumns({c: F.nullif(F.col(c), F.lit(value)) for c in cols})


def zero_to_null(df: DataFrame, cols) -> DataFrame:
    """``ifelse(x == 0, NA, x)`` on the listed measure columns."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in present})


def value_to_null(df: DataFrame, mapping: dict) -> DataFrame:
    """One value -> NULL per column, e.g. ``{"ray_ct": "N"}``; ``{"*": v}`` for every text column."""
    out = {}
    for c, v in mapping.items():
        targets = _string_cols(df) if c == "*" else [c]
        for t in targets:
            out[t] = F.nullif(F.col(t), F.lit(v))
    return df.withColumns(out)


def keep_if_in(df: DataFrame, col: str, key: str, values) -> DataFrame:
    """``col = ifelse(key %in% values, col, NA)`` (a NULL key is not in the set)."""
    return df.withColumn(col, F.when(in_set(key, values), F.col(col)))


def null_default(df: DataFrame, mapping: dict) -> DataFrame:
    """NULL -> default per column (``coalesce``)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in mapping.items()})


def change_case(df: DataFrame, upper=(), lower=()) -> DataFrame:
    cols = {c: F.upper(F.col(c)) for c in upper}
    cols.update({c: F.lower(F.col(c)) for c in lower})
    return df.withColumns(cols)


def _int_part(parts: Column, i: int) -> Column:
    """The i-th (1-based) piece as an int, NULL when missing or not a number."""
    return F.try_element_at(parts, F.lit(i)).try_cast("int")


def _hms(time: Column):
    """(hour, minute, second, ok) of clock text ``H:M[:S[.f]]`` on a 24-hour clock."""
    parts = F.split(F.trim(time), ":")
    n = F.size(parts)
    hh, mm = _int_part(parts, 1), _int_part(parts, 2)
    ss = F.when(n == 2, F.lit(0).cast("decimal(16,6)")).otherwise(
        F.try_element_at(parts, F.lit(3)).try_cast("decimal(16,6)"))
    ok = (n.isin(2, 3) & hh.between(0, 23) & mm.between(0, 59) & (ss >= 0) & (ss < 60))
    return hh, mm, ss, ok


def date_time(date: Column, time: Column) -> Column:
    """Calendar date + clock text (``H:M[:S]``) -> TIMESTAMP_NTZ; NULL when either is
    NULL or malformed. Time-zone free: the wall-clock time is added to the date as a
    day-time interval."""
    hh, mm, ss, ok = _hms(time)
    ts = date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hh, mm, ss)
    return F.when(ok, ts)


def mdy(date_text: Column) -> Column:
    """lubridate's ``mdy``: month/day/year text -> DATE; separators ``/ - .``; a
    two-digit year is 20yy up to 68 and 19yy from 69; NULL when not a calendar date."""
    norm = F.translate(F.trim(date_text), "-.", "//")
    ytxt = F.substring_index(norm, "/", -1)
    ylen = F.length(ytxt)
    y2 = ytxt.try_cast("int")
    full = F.concat(F.substring_index(norm, "/", 2), F.lit("/"),
                    F.when(y2 <= 68, y2 + 2000).otherwise(y2 + 1900).cast("string"))
    return F.try_to_date(F.when(ylen == 4, norm).when(ylen == 2, full), "M/d/yyyy")


def mdy_time(date_text: Column, time_text: Column) -> Column:
    """``as.POSIXct(paste(mdy(date), time))`` without a session time zone."""
    return date_time(mdy(date_text), time_text)


def mile_correction(col: Column, reach: Column, reaches=("DESO", "ECHO"), offset: float = 120) -> Column:
    """River-mile correction: ``x + offset`` where reach is listed, else ``x``."""
    return F.when(in_set(reach, reaches), col + F.lit(offset)).otherwise(col)


def _wall_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 00:00 of a wall-clock (NTZ) time, read from its fields."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.extract(F.lit("SECOND"), ts).cast("double"))


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds for TIMESTAMP_NTZ values, independent of any time zone.

    ``timestamp_diff`` converts through the session time zone, so across a daylight
    saving change it counts the shifted hour; wall-clock times must not.
    """
    return _wall_seconds(end) - _wall_seconds(start)
