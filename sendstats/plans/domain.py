"""Recipient-domain report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendstats.functions.events import EMAIL_COUNTERS
from sendstats.functions.mail import EMAIL, message_link, message_name, sender_domain
from sendstats.functions.rates import EMAIL_RATES, with_rates
from sendstats.operators.counts import counters_of_messages
from sendstats.operators.dims import newest_definition, sender_or_default, senders
from sendstats.operators.nesting import message_events, with_email
from sendstats.plans.inputs import Inputs, Scope
from sendstats.plans.messages import DEFAULT_LINK_BASE, with_category, with_live_message

KEYS = ("app_id", "message_id", "Domain")
ALL_DOMAINS = "All"
COUNTERS = (
    "Sent", "Delivered", "Open", "Unique_Open", "Unique_Click", "Bounce",
    "Dropped", "Unsubscribe", "Spam",
)
COLUMNS = (
    "App", "app_id", "message_id",
    "MessageName", "SenderDomain", "Domain", "StartDate", "Sent",
    "Delivered", "Delivered_PCT", "Open", "Open_PCT",
    "Unique_Open", "Unique_Open_PCT", "Unique_Click", "Unique_Click_PCT",
    "Bounce", "Bounce_PCT", "Dropped", "Unsubscribe", "Spam", "Spam_PCT",
    "Type", "Category", "MessageLink",
)


def with_all_rows(counters: DataFrame) -> DataFrame:
    """Add each message's sum over its domains as Domain ``All``.

    A message of which nothing was delivered has no base for its rates and gets
    no such row.
    """
    by_domain = ["app_id", "message_id", "Domain"]
    by_message = ["app_id", "message_id"]
    sets = counters.groupingSets([by_domain, by_message], *by_domain).agg(
        *[F.sum(c).alias(c) for c in COUNTERS], F.grouping("Domain").alias("is_all")
    )
    is_all = F.col("is_all") == 1
    return (
        sets.where(~is_all | (F.col("Delivered") > 0))
        .withColumn("Domain", F.when(is_all, ALL_DOMAINS).otherwise(F.col("Domain")))
        .drop("is_all")
    )


def domain_report(
    inputs: Inputs, start, end, company_id=None, app_id=None, link_base=DEFAULT_LINK_BASE
) -> DataFrame:
    """One row per email message and recipient domain with sent mails, and one
    ``All`` row per message."""
    window = inputs.window(start, end)
    live = inputs.live_study
    scope = Scope(inputs, end, company_id, app_id)

    sessions = scope.of_app(window.sessions.select("user_id", "app_id", "states", "attrs"))
    events = message_events(with_email(sessions, scope.email_positions()), inputs.watch)
    counters = counters_of_messages(
        events.where(F.col("label").isin(*EMAIL_COUNTERS)),
        scope.ids(live, EMAIL), KEYS, EMAIL_COUNTERS, ["user_id", "email", "day"],
    )
    return report_of_counters(counters, inputs, start, end, scope, link_base)


def report_of_counters(
    counters: DataFrame, inputs: Inputs, start, end, scope: Scope, link_base=DEFAULT_LINK_BASE
) -> DataFrame:
    """The report's rows from the counters by app, message and domain, wherever they come from."""
    window, live = inputs.window(start, end), inputs.live_study
    rows = with_all_rows(counters.where(F.col("Sent") > 0))
    defined = rows.join(newest_definition(window.study), "message_id")
    current = with_live_message(defined, live, EMAIL)
    addressed = current.join(senders(window.experiment), "message_id", "left")
    complete = addressed.join(scope.apps(), "app_id")
    sender = sender_or_default(F.col("sender"), F.col("default_sender"))
    link = message_link(link_base, F.col("app_id"), F.col("message_id"))
    return (
        with_category(with_rates(complete, EMAIL_RATES))
        .withColumn("sender", sender)
        .withColumn("MessageName", message_name(F.col("name"), F.col("sender")))
        .withColumn("SenderDomain", sender_domain(F.col("sender")))
        .withColumn("MessageLink", F.when(F.col("Domain") == ALL_DOMAINS, " ").otherwise(link))
        .select(*COLUMNS)
    )
