"""Calendar and clock expressions shared by dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_sk(at: Column) -> Column:
    """Calendar key, e.g. 20241027."""
    return (F.year(at) * 10000 + F.month(at) * 100 + F.dayofmonth(at)).cast("int")


def time_sk(hour: Column, minute: Column, second: Column) -> Column:
    """Clock key, e.g. 133005 for 13:30:05."""
    return (hour * 10000 + minute * 100 + second).cast("int")


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; negative when ``end`` comes first, null when either is null."""
    return (F.unix_seconds(end) - F.unix_seconds(start)).cast("int")


def instant(text: str) -> Column:
    """A literal timestamp from ISO-8601 text that names its zone."""
    return F.lit(text).cast("timestamp")
