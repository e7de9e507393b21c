"""Archive-name dates, arrival schedules and calendar fields as Columns (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The archive-name format, the two-day tolerance and the ISO date-time shapes.
# \z rather than $: a Java $ would also accept a trailing newline.
DATED_ARCHIVE_NAME = r"\Adrt_dq_[0-9]{6}_[0-9]{6}_[0-9]{4}\.zip\z"
SUSPICIOUS_AFTER_MILLIS = 2 * 24 * 60 * 60 * 1000
USUAL_SCHEDULE = "yyyy-MM-dd'T'HH:mm[:ss]X"
CALENDAR_DATE = r"\A(?:([+-]?[0-9]{1,9})(?:-([0-9]{1,2})(?:-([0-9]{1,2}))?)?)?T"
ORDINAL_DATE = r"\A([+-]?[0-9]{1,9})-([0-9]{3})T"
WEEK_DATE = r"\A([+-]?[0-9]{1,9})-W([0-9]{1,2})(?:-([0-9]))?T"
TIME_OF_DAY = r"T(?:([0-9]{1,2})(?::([0-9]{1,2})(?::([0-9]{1,2}))?)?(?:[.,]([0-9]{1,9}))?)?Z\z"


def _two_digit_date(name: Column) -> Column:
    return F.concat(
        F.lit("20"), F.substring(name, 8, 2),
        F.lit("-"), F.substring(name, 10, 2),
        F.lit("-"), F.substring(name, 12, 2),
    )


def created_on(zip_file_name: Column) -> Column:
    """Date text held by a dated archive name, null for any other name; not checked against a calendar."""
    return F.when(zip_file_name.rlike(DATED_ARCHIVE_NAME), _two_digit_date(zip_file_name))


def created_on_by_position(zip_file_name: Column) -> Column:
    """Date text read from fixed positions, whatever the rest of the name; null if no calendar date."""
    text = _two_digit_date(zip_file_name)
    return F.when(
        text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date").cast("string")
    )


def schedule_text(date: Column, time: Column) -> Column:
    return F.concat(date, F.lit("T"), time, F.lit("Z"))


def _number(text: Column, pattern: str, group: int, default: int) -> Column:
    return F.coalesce(F.regexp_extract(text, pattern, group).try_cast("int"), F.lit(default))


def _written_date(text: Column) -> Column:
    """Midnight of 2022-06-01, 2022-6-1, 2022-06, 2022, 2022-152 or 2022-W22-3; null for no such date.
    What is left out is its first: January, day one, Monday; without any date it is 1970-01-01."""
    def day(year: Column, month: Column, of_month: Column) -> Column:
        zero = F.lit(0)
        return F.try_make_timestamp(year, month, of_month, zero, zero, zero, F.lit("UTC"))

    def later(start: Column, days: Column) -> Column:
        return F.date_add(start.cast("date"), days).cast("timestamp")

    one = F.lit(1)
    calendar = day(
        _number(text, CALENDAR_DATE, 1, 1970), _number(text, CALENDAR_DATE, 2, 1), _number(text, CALENDAR_DATE, 3, 1)
    )
    year = _number(text, ORDINAL_DATE, 1, 0)
    ordinal = later(day(year, one, one), _number(text, ORDINAL_DATE, 2, 0) - 1)
    week_year, week, weekday = (
        _number(text, WEEK_DATE, 1, 0), _number(text, WEEK_DATE, 2, 0), _number(text, WEEK_DATE, 3, 1),
    )
    first_monday = F.date_trunc("week", day(week_year, one, F.lit(4)))
    by_week = later(first_monday, (week - 1) * 7 + weekday - 1)
    return (
        F.when(text.rlike(CALENDAR_DATE), calendar)
        .when(text.rlike(ORDINAL_DATE), F.when(F.year(ordinal) == year, ordinal))
        .when(
            text.rlike(WEEK_DATE) & weekday.between(1, 7) & (F.weekofyear(by_week) == week), by_week
        )
    )


def _unusual_schedule(text: Column) -> Column:
    """Other ISO forms, loosely padded or reduced: 2022-6-1T9:05, 2022-06T10, 2022-06-01T, T10:00."""
    hours, minutes, seconds = (_number(text, TIME_OF_DAY, group, 0) for group in (1, 2, 3))

    def present(group: int) -> Column:
        return F.regexp_extract(text, TIME_OF_DAY, group) != ""

    # A decimal part belongs to the smallest unit written.
    unit = F.when(present(3), 1_000).when(present(2), 60_000).otherwise(3_600_000)
    digits = F.regexp_extract(text, TIME_OF_DAY, 4)
    fraction = F.coalesce(
        F.concat(F.lit("0."), digits).try_cast("decimal(10,9)"), F.lit(0).cast("decimal(10,9)")
    )
    millis = (hours * 3_600_000 + minutes * 60_000 + seconds * 1_000) + F.floor(fraction * unit).cast("long")
    # With a single T, the date before it and the time after it are the whole text.
    one_t = ~text.rlike(r"(?s)T.*T") & (text != F.lit("TZ"))
    shape_ok = one_t & text.rlike(TIME_OF_DAY) & (hours < 24) & (minutes < 60) & (seconds < 60)
    return F.when(shape_ok, F.timestamp_millis(F.unix_millis(_written_date(text)) + millis))


def scheduled(date: Column, time: Column) -> Column:
    """Arrival instant, null where date and time do not form an ISO date-time.

    The first branch reads what nearly every document holds; the second runs only where that fails.
    """
    text = schedule_text(date, time)
    return F.coalesce(F.try_to_timestamp(text, F.lit(USUAL_SCHEDULE)), _unusual_schedule(text))


def or_epoch(instant: Column) -> Column:
    return F.coalesce(instant, F.timestamp_millis(F.lit(0)))


def is_suspicious(scheduled_at: Column, created_on_text: Column) -> Column:
    """True when the arrival lies more than two days after midnight of the archive's date."""
    midnight = created_on_text.try_cast("date").cast("timestamp")
    ahead = F.unix_millis(scheduled_at) - F.unix_millis(midnight)
    return F.coalesce(ahead > SUSPICIOUS_AFTER_MILLIS, F.lit(False))


def day_of_week(instant: Column) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(instant) - 1


def iso_day_of_week(instant: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(instant) + 1


def week_of_year(instant: Column) -> Column:
    return F.weekofyear(instant)


def shifted(instant: Column, seconds: int) -> Column:
    return instant + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def yymmdd(instant: Column) -> Column:
    return F.date_format(instant, "yyMMdd")


def iso_date(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd")


def retention_cutoff(as_of: Column, years: int) -> Column:
    """A retained year is 365 days, leap years included."""
    return shifted(as_of, -365 * years * 24 * 60 * 60)


def is_beyond_retention(created_on_text: Column, as_of: Column, years: int) -> Column:
    """Null where the text is no date, so that such rows are never treated as expired."""
    return created_on_text.try_cast("date").cast("timestamp") < retention_cutoff(as_of, years)
