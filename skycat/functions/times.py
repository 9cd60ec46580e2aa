"""Times of the survey: MJD, JD and year / day-of-year stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import col

JD_OFFSET = 2400000.5  # fixed value: JD of MJD 0
MJD_OF_1970 = 40587  # fixed value: MJD of 1970-01-01


def mjd_to_jd(mjd) -> Column:
    return col(mjd) + JD_OFFSET


def doy_timestamp(text) -> Column:
    """``2026.365:07:22:37`` as a timestamp."""
    return F.to_timestamp(col(text), "yyyy.DDD:HH:mm:ss")


def timestamp_to_jd(ts) -> Column:
    """Julian date of a UTC timestamp."""
    return F.unix_micros(col(ts).cast("timestamp")) / 86400.0e6 + (MJD_OF_1970 + JD_OFFSET)


def seconds_between(start, end) -> Column:
    """Elapsed seconds as a double."""
    return (F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))) / 1.0e6
