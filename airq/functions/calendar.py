"""Calendar attributes as native column expressions (time zone: that of the session, UTC here)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS_PER_DAY = 96

# Public holidays of Baden-Wuerttemberg.
FIXED_HOLIDAYS = ("01-01", "01-06", "05-01", "10-03", "11-01", "12-25", "12-26")
EASTER_OFFSETS = (-2, 1, 39, 50, 60)
SINGLE_HOLIDAYS = ("2017-10-31",)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def bin_start(ts: str | Column, step_seconds: int) -> Column:
    """Start of the regular bin (counted from the epoch) that holds ``ts``."""
    seconds = F.unix_seconds(_col(ts).cast("timestamp"))
    return F.timestamp_seconds(F.floor(seconds / F.lit(step_seconds)) * step_seconds)


def packed_hour(c: str | Column) -> Column:
    """``yyyyMMddHH`` held as a number or text, to a timestamp; null when malformed."""
    return F.try_to_timestamp(_col(c).cast("string"), F.lit("yyyyMMddHH"))


def hour_from_parts(year: Column, month: Column, day: Column, hour: Column) -> Column:
    return F.make_timestamp(year, month, day, hour, F.lit(0), F.lit(0))


def time_bin(ts: str | Column, bins_per_day: int = BINS_PER_DAY) -> Column:
    width = _bin_minutes(bins_per_day)
    c = _col(ts)
    return F.floor((F.hour(c) * 60 + F.minute(c)) / F.lit(width)).cast("int")


def time_num(ts: str | Column, bins_per_day: int = BINS_PER_DAY) -> Column:
    """Centre of the time bin as a fraction of the day."""
    width = _bin_minutes(bins_per_day)
    c = _col(ts)
    minute_of_bin = (time_bin(c, bins_per_day) * width) % 60
    return (F.hour(c) * F.lit(60.0) + minute_of_bin + F.lit(width / 2.0)) / F.lit(1440.0)


def _bin_minutes(bins_per_day: int) -> int:
    width, rest = divmod(1440, bins_per_day)
    if rest or 60 % width:
        raise ValueError(f"{bins_per_day} bins per day do not divide an hour evenly")
    return width


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous algorithm."""
    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b))

    golden = year % 19
    century = div(year, 100)
    of_century = year % 100
    epact = (golden * 19 + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    weekday = (F.lit(32) + (century % 4) * 2 + div(of_century, 4) * 2 - epact - of_century % 4) % 7
    late = div(golden + epact * 11 + weekday * 22, 451)
    code = epact + weekday - late * 7 + 114
    return F.make_date(year, div(code, 31).cast("int"), (code % 31 + 1).cast("int"))


def is_holiday(ts: str | Column) -> Column:
    """1 on a public holiday, else 0; null for a null timestamp."""
    date = F.to_date(_col(ts))
    flag = (
        F.date_format(date, "MM-dd").isin(*FIXED_HOLIDAYS)
        | F.datediff(date, easter_sunday(F.year(date))).isin(*EASTER_OFFSETS)
        | date.cast("string").isin(*SINGLE_HOLIDAYS)
    )
    return flag.cast("int")


def calendar_struct(ts: str | Column, bins_per_day: int = BINS_PER_DAY) -> Column:
    """The 18 calendar attributes of a timestamp; all of them null for a null timestamp.

    Shared terms are computed once per row only as long as no conditional encloses the struct.
    """
    c = _col(ts)
    width = _bin_minutes(bins_per_day)
    bin_index = time_bin(c, bins_per_day)
    minute_of_bin = ((bin_index * width) % 60).cast("int")
    fraction = time_num(c, bins_per_day)
    weekday = F.weekday(c).cast("int")
    week_fraction = (weekday + fraction) / F.lit(7.0)
    turn = F.lit(2.0 * math.pi)
    return F.struct(
        F.year(c).alias("year"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day"),
        weekday.alias("day_of_week"),
        F.dayofyear(c).alias("day_of_year"),
        (weekday >= 5).cast("int").alias("weekend"),
        is_holiday(c).alias("holiday"),
        F.date_format(c, "EEEE").alias("day_cat"),
        week_fraction.alias("day_num"),
        F.cos(week_fraction * turn).alias("day_cos"),
        F.sin(week_fraction * turn).alias("day_sin"),
        F.concat(_two_digits(F.hour(c)), F.lit(":"), _two_digits(minute_of_bin)).alias("time_cat"),
        bin_index.alias("time_bin"),
        F.hour(c).alias("hour_bin"),
        minute_of_bin.alias("min_bin"),
        fraction.alias("time_num"),
        F.cos(fraction * turn).alias("time_cos"),
        F.sin(fraction * turn).alias("time_sin"),
    )


def add_calendar(df: DataFrame, ts: str = "timestamp", out: str = "datedim", bins_per_day: int = BINS_PER_DAY) -> DataFrame:
    return df.withColumn(out, calendar_struct(ts, bins_per_day))
