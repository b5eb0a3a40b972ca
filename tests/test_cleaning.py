import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.functions import cleaning as c
from tillmark.functions.calendar import calendar_columns, month_label
from tillmark.functions.filenames import batch_ts
from tillmark.plans.gold import dim_date
from tillmark.specs import TABLES


def evaluate(spark, rule, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.out for r in rows.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_number_spellings(spark):
    given = ["1653765,0", " 12 ", "1.234,56", "inf", "nan", "2.5d", "1e5", "-3", ".5", "5.", "", "  ", "x", None, "0x1p3"]
    want = [1653765.0, 12.0, None, None, None, None, 100000.0, -3.0, 0.5, 5.0, None, None, None, None, None]
    assert evaluate(spark, c.parse_number, given) == want


def test_money_rounds_half_up_and_drops_what_does_not_fit(spark):
    def rule(v):
        return c.to_money(c.non_negative(c.parse_number(v)))

    given = ["1.00005", "1.00015", "0", "-0.01", "-0.0", "99999999999999", "999999999999999", "1e400"]
    want = [Decimal("1.0001"), Decimal("1.0002"), Decimal("0.0000"), None, Decimal("0.0000"),
            Decimal("99999999999999.0000"), None, None]
    assert evaluate(spark, rule, given) == want


def test_counts_round_half_even_after_the_bounds(spark):
    def rule(v):
        return c.to_count(c.within(c.non_negative(c.parse_number(v)), 1, 5))

    assert evaluate(spark, rule, ["0.5", "2.5", "3.5", "5", "5.4", "6", "1", "-1"]) == [
        None, 2, 4, 5, None, None, 1, None
    ]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2026-07-08", dt.datetime(2026, 7, 8)),
        ("2026-07-08 13:25:10", dt.datetime(2026, 7, 8, 13, 25, 10)),
        ("08/07/2026", dt.datetime(2026, 7, 8)),
        ("25/07/2026 10:11:12", dt.datetime(2026, 7, 25, 10, 11, 12)),
        (" 2026-07-08\t", dt.datetime(2026, 7, 8)),
        ("2026-07-08 13:25", dt.datetime(2026, 7, 8, 13, 25)),
        ("2026-07-08T13:25:10Z", dt.datetime(2026, 7, 8, 13, 25, 10)),
        ("2026-07-08T13:25:10.123456789+00:00", dt.datetime(2026, 7, 8, 13, 25, 10, 123456)),
        ("8/7/2026", dt.datetime(2026, 7, 8)),
        ("08-07-2026 9:05", dt.datetime(2026, 7, 8, 9, 5)),
        ("8.7.2026", dt.datetime(2026, 7, 8)),
        ("2026/07/08", dt.datetime(2026, 7, 8)),
        ("20260708", dt.datetime(2026, 7, 8)),
        ("7/13/2026", dt.datetime(2026, 7, 13)),
        ("07-31-2026 08:00", dt.datetime(2026, 7, 31, 8)),
        ("13/13/2026", None),
        ("08 Jul 2026", dt.datetime(2026, 7, 8)),
        ("8-July-2026 13:25", dt.datetime(2026, 7, 8, 13, 25)),
        ("Jul 8, 2026", dt.datetime(2026, 7, 8)),
        ("SEPTEMBER 30 2026 1:25 pm", dt.datetime(2026, 9, 30, 13, 25)),
        ("08 Foo 2026", None),
        ("2026-07-08 1:25 PM", dt.datetime(2026, 7, 8, 13, 25)),
        ("2026-07-08 12:05 AM", dt.datetime(2026, 7, 8, 0, 5)),
        ("2026-07-08 12:05:06 PM", dt.datetime(2026, 7, 8, 12, 5, 6)),
        ("2026-07-08T13:25:10+07:00", dt.datetime(2026, 7, 8, 6, 25, 10)),
        ("2026-07-08 01:00-0330", dt.datetime(2026, 7, 8, 4, 30)),
        ("8/7/2026 23:30 -05", dt.datetime(2026, 7, 9, 4, 30)),
        ("2026-07-08+07:00", None),
        ("2026-07-08 13:25:10.5", dt.datetime(2026, 7, 8, 13, 25, 10, 500000)),
        ("20260708 13:25:10", dt.datetime(2026, 7, 8, 13, 25, 10)),
        ("2026-7-123", None),
        ("2026-07-08 13:2", None),
        ("202607081", None),
        ("07/25/2026", dt.datetime(2026, 7, 25)),
        ("2026-02-30", None),
        ("2026", None),
        ("tomorrow", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, want):
    assert evaluate(spark, c.parse_moment, [text]) == [want]


def test_text_loses_white_space_of_any_kind(spark):
    assert evaluate(spark, c.clean_text, [" \t a b  ", "　x ", " \r\n ", "", None, "NA"]) == [
        "a b", "x", None, None, None, "NA"
    ]


def test_columns_are_cleaned_by_kind(spark):
    raw = spark.createDataFrame(
        [(" R1 ", "C1", "", "6", " fine ", "08/07/2026"), ("R2", "", "P1", "5,0", "", "bad")],
        "review_id string, customer_id string, product_id string, rating string, review_text string, review_date string",
    )
    rows = [tuple(r) for r in c.clean_columns(raw, TABLES["product_reviews"]).collect()]
    assert rows == [
        ("R1", "C1", None, None, "fine", dt.datetime(2026, 7, 8)),
        ("R2", None, "P1", 5, None, None),
    ]


def test_silver_types_follow_the_layout(spark):
    for spec in TABLES.values():
        raw = spark.createDataFrame([], spec.bronze_schema())
        got = c.clean_columns(raw, spec, "_source_file", "_loaded_at").schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in spec.silver_schema()]


def test_file_name_time(spark):
    given = [
        "file:///a/orders/orders_20260708_141106.csv",
        "/a/orders_20260708_141106.csv/part-0.csv",
        "/a/orders_latest.csv",
        "/a/orders_20261308_141106.csv",
        "/a/reorders_20260708_141106.csv",
    ]
    moment = dt.datetime(2026, 7, 8, 14, 11, 6)
    assert evaluate(spark, lambda v: batch_ts(v, "orders"), given) == [moment, moment, None, None, None]


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 7670
    row = days.where("date_key = 20260704").first()
    assert tuple(row) == (20260704, dt.date(2026, 7, 4), 2026, 3, 7, "July", 4, "Saturday", True)
    assert days.where("date_key = 20260706").first().is_weekend is False
    label = spark.range(1).select(month_label(F.lit(2026), F.lit(7)).alias("l")).first().l
    assert label == "2026-07"
    assert calendar_columns(F.lit(dt.date(2026, 1, 1)))
