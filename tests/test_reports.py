from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import scenario as s
from sendstats.operators import sizing
from sendstats.plans.domain import domain_report
from sendstats.plans.inputs import Inputs, read_inputs
from sendstats.plans.messages import with_live_message
from sendstats.plans.push import push_report
from sendstats.plans.subject import ab_report, subject_report


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return s.write(spark, str(tmp_path_factory.mktemp("world")))


@pytest.fixture(params=["few ids", "many ids"])
def inputs(spark, root, request, monkeypatch):
    if request.param == "many ids":
        monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", -1)
    return read_inputs(spark, root)


class Rows(list):
    """Rows in any order."""

    def __eq__(self, other):
        return sorted(self, key=str) == sorted(other, key=str)


def picked(df, *columns):
    return Rows(tuple(r) for r in df.select(*columns).collect())


def test_domain_report(inputs):
    report = domain_report(inputs, s.START, s.END)
    columns = ("message_id", "Domain", "Sent", "Delivered", "Open", "Unique_Open", "Unique_Click", "Bounce")
    assert picked(report, *columns) == [
        # gmail: two opens on day 1 count once, the one on day 2 again. The mail
        # opened under the other address is in Other, where one mail was sent.
        (s.MAIL, "All", 2, 1, 4, 3, 1, 1),
        (s.MAIL, "Other", 1, 0, 1, 1, 1, 1),
        (s.MAIL, "gmail.com", 1, 1, 3, 2, 0, 0),
        (s.MAIL_B, "All", 1, 1, 2, 2, 0, 0),
        (s.MAIL_B, "Other", 1, 1, 2, 2, 0, 0),
        # Sent but not delivered: no base for an All row.
        (s.UNDELIVERED, "qq.com", 1, 0, 0, 0, 0, 0),
        (s.OTHER_APP, "All", 1, 1, 0, 0, 0, 0),
        (s.OTHER_APP, "qq.com", 1, 1, 0, 0, 0, 0),
    ]
    texts = ("message_id", "App", "MessageName", "SenderDomain", "StartDate", "Type", "Category", "MessageLink")
    assert picked(report.where("Domain IN ('All', 'qq.com') AND message_id <> 4500000000000013"), *texts) == [
        (s.MAIL, "Shop-EU", 'Hello, "again" (me@here@new.example)', "new.example", "2024-03-01",
         "Triggered Server", "News", " "),
        (s.MAIL_B, "Shop-EU", "tie b (d1@shop.example)", "shop.example", "Unknown", "Immediate", "Default", " "),
        (s.UNDELIVERED, "Shop-EU", "lost (d1@shop.example)", "shop.example", "2024-03-01", "Unknown", "Default",
         f"https://dashboard.example.com/dashboard?appId=1#/1/messaging/{s.UNDELIVERED}"),
    ]
    assert picked(report.where(F.col("message_id") == s.OTHER_APP), "MessageName", "SenderDomain") == [
        ("other (plain-name)", None)] * 2
    rates = picked(report.where(F.col("message_id") == s.MAIL), "Domain", "Delivered_PCT", "Open_PCT", "Bounce_PCT")
    assert rates == [("All", 50.0, 400.0, 50.0), ("Other", 0.0, 0.0, 100.0), ("gmail.com", 100.0, 300.0, 0.0)]


def test_all_rows_are_the_sum_of_their_domains(inputs):
    report = domain_report(inputs, s.START, s.END).cache()
    counters = ["Sent", "Delivered", "Open", "Unique_Open", "Unique_Click", "Bounce", "Spam"]
    parts = report.where("Domain <> 'All'").groupBy("message_id").agg(*[F.sum(c).alias(c) for c in counters])
    whole = report.where("Domain = 'All'").select("message_id", *counters)
    assert whole.join(parts, "message_id").count() == whole.count() == 3
    assert picked(whole, "message_id", *counters) == picked(
        parts.where("Delivered > 0"), "message_id", *counters)
    assert report.where("Unique_Open > Open").count() == 0
    report.unpersist()


def test_subject_report_repeats_counts_per_subject(inputs):
    report = subject_report(inputs, s.START, s.END)
    columns = ("message_id", "Subject", "Sent", "Open", "Unique_Open", "Unique_Click", "StartDate", "Category")
    assert picked(report, *columns) == [
        # Without the address in the key, user 1 opened once on each day.
        (s.MAIL, "Hi", 2, 4, 2, 1, "2024-03-01", "News"),
        (s.MAIL, "Hi 2", 2, 4, 2, 1, "2024-03-01", "News"),
        (s.MAIL_B, "B", 1, 2, 2, 0, "Unknown", "Default"),
        (s.LATE, "L", 1, 0, 0, 0, "2024-03-01", "Default"),
        (s.UNDELIVERED, "U", 1, 0, 0, 0, "2024-03-01", "Default"),
        (s.OTHER_APP, "O", 1, 0, 0, 0, "2024-03-01", "Default"),
    ]


def test_ab_report_replaces_the_rows_of_an_experimented_message(inputs):
    report = ab_report(inputs, s.START, s.END)
    columns = ("message_id", "Subject", "variant_id", "Sent", "Delivered", "Open", "Unique_Open", "Unique_Click")
    assert picked(report, *columns) == [
        # 71 stands twice in one session, so its open there counts twice. A
        # variant row appears once although the message has two subjects.
        (s.MAIL, "Arm A --Variant 71", 71, 1, 1, 4, 2, 0),
        (s.MAIL, "Hi 2 --Variant 72", 72, 1, 0, 1, 1, 1),
        (s.MAIL_B, "B", None, 1, 1, 2, 2, 0),
        (s.LATE, "L", None, 1, 0, 0, 0, 0),
        (s.UNDELIVERED, "U", None, 1, 0, 0, 0, 0),
        (s.OTHER_APP, "O", None, 1, 1, 0, 0, 0),
    ]


def test_push_report(inputs):
    report = push_report(inputs, s.START, s.END)
    columns = ("message_id", "MessageName", "StartDate", "Sent", "Open", "Held_Back", "Bounce", "Open_PCT")
    # The live name is empty, so the newest name of the window is shown.
    assert picked(report, *columns) == [(s.PUSH, "ping 2", "2024-03-01", 3, 1, 1, 1, 1 / 3 * 100.0)]


def test_scope(inputs):
    def messages(**scope):
        return {r.message_id for r in subject_report(inputs, s.START, s.END, **scope).collect()}

    first = {s.MAIL, s.MAIL_B, s.LATE, s.UNDELIVERED}
    assert messages(company_id=50) == first
    assert messages(company_id=51) == {s.OTHER_APP}
    assert messages(app_id=1) == first
    assert messages(app_id=77) == messages(company_id=77) == set()
    # By app the current name counts, by company the name of the last day.
    by_app = domain_report(inputs, s.START, s.END, app_id=1)
    by_company = domain_report(inputs, s.START, s.END, company_id=50)
    assert {r.App for r in by_app.collect()} == {"Shop live"}
    assert {r.App for r in by_company.collect()} == {"Shop-EU"}
    drop = [c for c in by_app.columns if c != "App"]
    assert picked(by_app, *drop) == picked(by_company, *drop)
    with pytest.raises(ValueError):
        domain_report(inputs, s.START, s.END, company_id=50, app_id=1)


def test_single_day_window(inputs):
    report = push_report(inputs, "20240303", "20240303")
    assert picked(report, "MessageName", "Sent", "Bounce") == [("ping 2", 2, 1)]


def test_messages_of_another_type_are_dropped_and_missing_ones_kept(inputs):
    rows = inputs.live_study.select("message_id").limit(0).sparkSession.createDataFrame(
        [(s.MAIL,), (s.MOVED,), (1,)], "message_id bigint")
    found = with_live_message(rows, inputs.live_study, "__Email")
    assert picked(found, "message_id", "StartDate") == [(1, "Unknown"), (s.MAIL, "2024-03-01")]


def test_one_message_with_a_third_of_all_events(spark, root, inputs):
    """Many copies of one session change its own message only, by the right amount."""
    copies = 5000
    hot = inputs.sessions.where("user_id = 4").crossJoin(spark.range(copies)).drop("id")
    more = Inputs(inputs.sessions.unionByName(hot), inputs.study, inputs.experiment, inputs.app)
    found = push_report(more, s.START, s.END)
    assert picked(found, "message_id", "Sent", "Open", "Held_Back") == [
        (s.PUSH, 3 * (copies + 1), copies + 1, copies + 1)]
    mails = subject_report(more, s.START, s.END)
    assert picked(mails, *mails.columns) == picked(subject_report(inputs, s.START, s.END), *mails.columns)
