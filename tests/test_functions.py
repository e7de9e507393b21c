from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall.functions import dates, passengers, values
from samples import at


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def over(spark, texts, make):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in frame.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def test_created_on_needs_the_whole_name(spark):
    names = [
        "drt_dq_240415_134518_2296.zip", "drt_dq_249915_134518_2296.zip", "xdrt_dq_240415_134518_2296.zip",
        "drt_dq_240415_134518_2296.zip\n", "drt_dq_240415_134518_2296_zip", "test.zip", "",
    ]
    assert over(spark, names, dates.created_on) == ["2024-04-15", "2024-99-15", None, None, None, None, None]


def test_created_on_by_position_needs_a_calendar_date(spark):
    names = ["drt_dq_240415_x", "abcdefg210203", "drt_dq_249915_134518_2296.zip", "legacy_3.zip"]
    assert over(spark, names, dates.created_on_by_position) == ["2024-04-15", "2021-02-03", None, None]


@pytest.mark.parametrize(
    "date, time, expected",
    [
        ("2016-03-02", "07:30:00", datetime(2016, 3, 2, 7, 30)),
        ("2016-03-02", "06:00", datetime(2016, 3, 2, 6, 0)),
        ("2016-03-02", "06:00:01.250", datetime(2016, 3, 2, 6, 0, 1, 250000)),
        ("2016-03-02", "06:00:01,9999", datetime(2016, 3, 2, 6, 0, 1, 999000)),
        ("2016-03-02", "06.5", datetime(2016, 3, 2, 6, 30)),
        ("2016-03-02", "06", datetime(2016, 3, 2, 6, 0)),
        ("2016-3-2", "6:5", datetime(2016, 3, 2, 6, 5)),
        ("2016-03", "06:00", datetime(2016, 3, 1, 6, 0)),
        ("2016-03-02", "", datetime(2016, 3, 2)),
        ("", "06:00", datetime(1970, 1, 1, 6, 0)),
        ("", "", None),
        ("2022-152", "10:00", datetime(2022, 6, 1, 10, 0)),
        ("2020-366", "", datetime(2020, 12, 31)),
        ("2022-366", "10:00", None),
        ("2022-000", "10:00", None),
        ("2022-W22-3", "10:00", datetime(2022, 6, 1, 10, 0)),
        ("2022-W22", "", datetime(2022, 5, 30)),
        ("2020-W53-7", "", datetime(2021, 1, 3)),
        ("2022-W53-1", "10:00", None),
        ("2022-W00-1", "10:00", None),
        ("2022-W22-8", "10:00", None),
        ("2022-13", "10:00", None),
        ("2022-06-01T", "10:00", None),
        ("2022", "06:00", datetime(2022, 1, 1, 6, 0)),
        ("2016-03-02", "06:00.5", datetime(2016, 3, 2, 6, 0, 30)),
        ("2022x06x01", "10x00", None),
        ("2022-06-31", "10:00", None),
        ("2022-06-01", "24:00", None),
        ("2022-06-01", "10:60", None),
        ("2022-06-01", "10:00:60", None),
        (" 2022-06-01", "10:00", None),
        ("2022-06-01", "10:00Z", None),
        (None, "10:00", None),
    ],
)
def test_scheduled(spark, date, time, expected):
    assert one(spark, dates.scheduled(F.lit(date).cast("string"), F.lit(time))) == expected


def test_suspicious_is_strictly_more_than_two_days_ahead(spark):
    def flag(scheduled, created):
        return one(spark, dates.is_suspicious(at(scheduled), F.lit(created).cast("string")))

    assert flag("2022-06-03 00:00:00.001", "2022-06-01") is True
    assert flag("2022-06-03 00:00:00", "2022-06-01") is False
    assert flag("2020-01-01 00:00:00", "2022-06-01") is False
    assert flag("2022-06-09 00:00:00", None) is False


@pytest.mark.parametrize(
    "day, dow, week",
    [("2019-04-20", 6, 16), ("2019-04-21", 0, 16), ("2019-01-01", 2, 1), ("2024-04-22", 1, 17)],
)
def test_calendar(spark, day, dow, week):
    assert one(spark, dates.day_of_week(at(day))) == dow
    assert one(spark, dates.week_of_year(at(day))) == week
    assert one(spark, dates.iso_day_of_week(at(day))) == (dow or 7)


def test_instants(spark):
    assert one(spark, dates.shifted(at("2021-01-01"), 86_400)) == datetime(2021, 1, 2)
    assert one(spark, dates.shifted(at("2021-01-01"), -60)) == datetime(2020, 12, 31, 23, 59)
    assert one(spark, dates.yymmdd(at("2021-02-03"))) == "210203"
    assert one(spark, dates.iso_date(at("2021-02-03"))) == "2021-02-03"
    assert one(spark, dates.or_epoch(F.lit(None).cast("timestamp"))) == datetime(1970, 1, 1)


def test_retention_counts_365_days_per_year(spark):
    def expired(date, years=1):
        return one(spark, dates.is_beyond_retention(F.lit(date), at("2021-01-01"), years))

    # 2020 is a leap year: one retained year before 2021-01-01 is 2020-01-02.
    assert expired("2020-01-01") is True
    assert expired("2020-01-02") is False
    assert expired("2020-12-31") is False
    assert expired("2020-99-99") is None


def test_numbers(spark):
    texts = ["0123", "+5", "-7", "12A", "", " 12", "12\n", "2147483647", "2147483648", None]
    assert over(spark, texts, values.strict_int) == [123, 5, -7, None, None, None, None, 2147483647, None, None]
    assert over(spark, ["21", "unknown", None], values.age_or_default) == [21, -1, -1]


def test_transit_flags(spark):
    flags = ["Y", "XY", "N", "", None]
    assert over(spark, flags, values.in_transit) == [True, False, False, False, False]
    assert over(spark, flags, values.mentions_transit) == [True, True, False, False, False]


def lists(spark, *people):
    frame = spark.createDataFrame(
        [([*people],)], "l array<struct<PassengerIdentifier: string, InTransitFlag: string>>"
    )
    pick = lambda column: [p.PassengerIdentifier for p in frame.select(column.alias("v")).first().v]
    l = F.col("l")
    counts = frame.select(*[c.alias(n) for n, c in passengers.ingest_counts(l).items()]).first()
    return (
        pick(passengers.interactive(l)), pick(passengers.non_interactive(l)), pick(passengers.best(l)),
        frame.select(passengers.has_interactive(l)).first()[0], list(counts),
    )


def test_passenger_lists(spark):
    mixed = [("00001", "N"), ("00002", "XY"), ("", "Y"), (None, "N")]
    assert lists(spark, *mixed) == (
        ["00001", "00002"], ["", None], ["00001", "00002"], True, [2, 1, 2, 1],
    )
    assert lists(spark, ("", "N"), (None, "Y")) == ([], ["", None], ["", None], False, [2, 1, 0, 0])
    assert lists(spark) == ([], [], [], False, [0, 0, 0, 0])
