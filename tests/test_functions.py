from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sendstats.functions import events, mail, rates
from sendstats.sources.scans import check_window


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(row) for row in df.select(*columns).collect()]


def test_event_names(spark):
    names = [
        (".m4500000000000001",),
        (".m4500000000000001 ",),
        (".m4500000000000001 Open",),
        (".m4500000000000001.Marked as spam",),
        (".mbadidbadidbadid1 Open",),
        ("session end",),
        (".M4500000000000001 Open",),
        (None,),
    ]
    name = F.col("name")
    found = values(
        spark, names, "name string",
        events.is_message_event(name), events.event_message_id(name), events.event_label(name),
    )
    assert found == [
        (True, 4500000000000001, "Sent"),
        (True, 4500000000000001, "Sent"),
        (True, 4500000000000001, "Open"),
        (True, 4500000000000001, "Marked as spam"),
        (True, None, "Open"),
        (False, None, "Sent"),
        (False, 4500000000000001, "Open"),
        (None, None, None),
    ]


def test_utc_day_cuts_the_fraction_and_ignores_the_session_zone(spark):
    midnight = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc).timestamp()
    rows = [(midnight - 0.1,), (midnight,), (midnight + 86399.9,), (None,), (float("nan"),)]
    found = values(spark, rows, "t double", events.day_text(events.utc_day(F.col("t"))))
    assert [v for v, in found] == ["2024-01-01", "2024-01-02", "2024-01-02", None, None]


def test_utc_day_of_stamps_in_other_units_is_missing(spark):
    rows = [(1.7e15,), (1.7e12,), (-1e18,), (253402300799.0,), (253402300800.0,)]
    found = values(spark, rows, "t double", events.day_text(events.utc_day(F.col("t"))))
    assert [v for v, in found] == [None, None, None, "9999-12-31", None]


def test_start_date_is_utc(spark):
    late = dt.datetime(2024, 3, 1, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp()
    found = values(
        spark, [(int(late),), (None,)], "s bigint",
        events.start_date(F.timestamp_seconds("s")),
    )
    assert found == [("2024-03-01",), ("Unknown",)]


def test_recipient_domain(spark):
    rows = [
        ("a@gmail.com", "gmail.com"),
        ("a@b@gmail.com", "Other"),
        ("a@GMAIL.com", "Other"),
        ("no-at-sign", "Other"),
        ("a@", "Other"),
        (None, "Other"),
        ("x@yahoo.co.uk", "yahoo.co.uk"),
        ("x@sub.gmail.com", "Other"),
    ]
    found = values(spark, rows, "email string, d string", mail.recipient_domain("email"), "d")
    assert all(got == want for got, want in found)
    assert len(mail.LISTED_DOMAINS) == len(set(mail.LISTED_DOMAINS)) == 22


def test_sender_domain_and_delivery_type(spark):
    rows = [("a@b@c.org", 0), ("none", 5), ("", 6), (None, None), ("x@", -1)]
    found = values(
        spark, rows, "s string, c int",
        mail.sender_domain(F.col("s")), mail.delivery_type(F.col("c")),
    )
    assert found == [
        ("c.org", "Immediate"), (None, "Recurring"), (None, "Unknown"), (None, "Unknown"), ("", "Unknown"),
    ]


def test_category_takes_the_first_match(spark):
    rows = [
        ([(1, "News"), (2, "Promo"), (1, "Late")], 1, "News"),
        ([(1, "News"), (2, "Promo")], 2, "Promo"),
        ([(1, "News")], 3, "Default"),
        ([(1, "News")], None, "Default"),
        (None, 1, "Default"),
        ([], 1, "Default"),
    ]
    schema = "c array<struct<id bigint, name string>>, id bigint, want string"
    found = values(spark, rows, schema, mail.category_name(F.col("c"), F.col("id")), "want")
    assert all(got == want for got, want in found)


def test_percent_text_is_the_start_of_the_plain_decimal(spark):
    pairs = [(part, base) for part in range(0, 60, 7) for base in range(0, 50, 3)]
    pairs += [(1, 3_000_000), (123_456_789, 1), (12_345_678_901, 7), (1, 1_000), (1, 99_999)]
    found = values(
        spark, pairs, "a bigint, b bigint", "a", "b",
        rates.percent("a", "b"),
        rates.percent_text(rates.percent("a", "b")),
    )
    for a, b, pct, text in found:
        want = a / b * 100.0 if b else 0.0
        assert pct == want
        plain = "0.00" if 0 < want < 1e-3 else str(want)
        assert text == plain[:4] + "%"


def test_message_texts(spark):
    found = values(
        spark, [("a/b", 7, 9)], "n string, app bigint, m bigint",
        mail.file_safe(F.col("n")),
        mail.message_link("https://x/d", F.col("app"), F.col("m")),
        mail.message_name(F.col("n"), F.lit("me@x")),
        mail.variant_subject(F.col("n"), F.col("m")),
    )
    assert found == [("a-b", "https://x/d?appId=7#/7/messaging/9", "a/b (me@x)", "a/b --Variant 9")]


def test_window_guard():
    check_window("20240101", "20240101", "20240101")
    check_window("20240101", "20240202", "20240301")
    for start, end, as_of in [
        ("20240102", "20240101", "20240102"),
        ("20240101", "20240203", "20240203"),
        ("20240101", "20240110", "20240302"),
    ]:
        with pytest.raises(ValueError):
            check_window(start, end, as_of)
