"""Pseudonyms, date shifts and age jitter on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from studyloom.functions.text import UNKNOWN

# Largest shift of a date in days and of an age in years.
MAX_DAYS = 730
MAX_YEARS = 2


def series_hash(patient: Column, date: Column, series: Column, institution: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the series identity."""
    parts = [F.coalesce(c, F.lit("")) for c in (patient, date, series, institution)]
    return F.substring(F.sha2(F.concat_ws("_", *parts), 256), 1, 16)


def error_key(key: Column, failed: Column) -> Column:
    return F.when(failed, F.concat(F.lit("Er_"), key)).otherwise(key)


def _drawn(patient: Column, salt: str, first: int, values: int) -> Column:
    digits = F.substring(F.sha2(F.concat(F.coalesce(patient, F.lit("")), F.lit(salt)), 256),
                         first, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(values)).cast("int")


def shift_days(patient: Column, salt: str) -> Column:
    """Constant number of days per patient, from -730 to 730; the salt must stay secret."""
    return _drawn(patient, salt, 1, 2 * MAX_DAYS + 1) - MAX_DAYS


def shift_years(patient: Column, salt: str) -> Column:
    """Constant number of years per patient, from -2 to 2."""
    return _drawn(patient, salt, 9, 2 * MAX_YEARS + 1) - MAX_YEARS


def shifted_date(date: Column, days: Column) -> Column:
    """Shifted `yyyyMMdd` text; missing or bad dates are returned as they are."""
    moved = F.date_format(F.date_add(F.try_to_date(date, "yyyyMMdd"), days), "yyyyMMdd")
    return F.coalesce(F.when(date.rlike("^[0-9]{8}$"), moved), date)


def jittered_age(age: Column, years: Column) -> Column:
    """Shifted `NNNY` age of at least one year; missing or bad ages are returned as they are."""
    number = F.rtrim(age, F.lit("Y"))
    value = F.when(number.rlike("^[+-]?[0-9]+$"), number.try_cast("int"))
    moved = F.format_string("%03dY", F.greatest(F.lit(1), value + years))
    return F.when(value.isNull() | (age == UNKNOWN), age).otherwise(moved)
