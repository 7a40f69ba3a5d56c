import datetime as dt

from pyspark.sql import functions as F

from pledgeline.functions.fiscal import (
    add_months_eom,
    as_date,
    fiscal_day,
    fiscal_day_of,
    fiscal_year,
    fiscal_year_of,
    is_ytd,
)
from pledgeline.functions.values import display_name, listed_name, ratio

DAYS = ["2021-06-30", "2021-07-01", "2022-06-30", "2024-02-29", "2020-06-30"]


def _days(spark, days):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")


def test_fiscal_year_and_day(spark):
    d = F.col("d")
    got = [tuple(r) for r in _days(spark, DAYS).select(fiscal_year(d), fiscal_day(d)).collect()]
    assert got == [(2021, 365), (2022, 1), (2022, 365), (2024, 244), (2020, 366)]
    # the parameter-side versions agree
    assert got == [
        (fiscal_year_of(as_date(x)), fiscal_day_of(as_date(x))) for x in DAYS
    ]


def test_year_to_date_compares_positions_in_the_year(spark):
    as_of = dt.date(2021, 12, 31)
    got = _days(spark, ["2015-12-31", "2016-01-01", "2015-07-01", "2016-06-30"]).select(
        is_ytd(F.col("d"), as_of)
    )
    assert [r[0] for r in got.collect()] == [True, False, True, False]


def test_add_months_keeps_month_ends(spark):
    got = _days(spark, ["2021-02-28", "2021-02-27", "2020-08-31", "2020-02-29"]).select(
        add_months_eom(F.col("d"), 6).cast("string")
    )
    assert [r[0] for r in got.collect()] == [
        "2021-08-31",
        "2021-08-27",
        "2021-02-28",
        "2020-08-31",
    ]


def test_ratio_is_null_without_divisor(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 1)], "a int, b int")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None, None, None]


def test_display_name_leaves_no_stray_punctuation(spark):
    people = [
        ("Doe", "Ann", "Beth", "Jr", "PhD", "Doe Jr PhD, Ann B."),
        ("Doe", None, None, None, None, "Doe"),
        ("Doe", "  ", " ", " ", None, "Doe"),
        ("Doe", "Ann", None, None, "PhD", "Doe PhD, Ann"),
        ("Doe", None, "Beth", "Jr", None, "Doe Jr B."),
    ]
    df = spark.createDataFrame(people, "l string, f string, m string, p string, q string, w string")
    got = df.select(display_name(*[F.col(c) for c in "lfmpq"]), "w").collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_listed_name_reads_missing_as_empty(spark):
    df = spark.createDataFrame([("Doe", "Ann"), (None, "Ann"), ("Doe", None)], "l string, f string")
    got = [r[0] for r in df.select(listed_name(F.col("l"), F.col("f"))).collect()]
    assert got == ["Doe, Ann", ", Ann", "Doe, "]
