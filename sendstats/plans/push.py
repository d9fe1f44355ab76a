"""Push notification report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendstats.functions.events import PUSH_COUNTERS
from sendstats.functions.mail import PUSH, message_link
from sendstats.functions.rates import PUSH_RATES, with_rates
from sendstats.operators.counts import counters_of_messages
from sendstats.operators.dims import push_names
from sendstats.operators.nesting import message_events
from sendstats.plans.inputs import Inputs, Scope
from sendstats.plans.messages import DEFAULT_LINK_BASE, with_live_message

COLUMNS = (
    "App", "app_id", "message_id",
    "MessageName", "StartDate", "Sent", "Open", "Open_PCT", "Held_Back",
    "Bounce", "Bounce_PCT", "MessageLink",
)


def push_report(
    inputs: Inputs, start, end, company_id=None, app_id=None, link_base=DEFAULT_LINK_BASE
) -> DataFrame:
    """One row per push message that was sent in the window."""
    window = inputs.window(start, end)
    live = inputs.live_study
    scope = Scope(inputs, end, company_id, app_id)

    sessions = scope.sessions(window.sessions.select("app_id", "states"))
    events = message_events(sessions, inputs.watch).where(F.col("label").isin(*PUSH_COUNTERS))
    counters = counters_of_messages(
        events, scope.ids(live, PUSH), ["app_id", "message_id"], PUSH_COUNTERS
    )
    sent = counters.where(F.col("Sent") > 0)

    named = sent.join(push_names(window.study, PUSH), ["app_id", "message_id"])
    current = with_live_message(named, live, PUSH).join(scope.apps(), "app_id")
    return (
        with_rates(current, PUSH_RATES)
        .withColumn("MessageName", F.coalesce(F.nullif("live_name", F.lit("")), "name"))
        .withColumn("MessageLink", message_link(link_base, F.col("app_id"), F.col("message_id")))
        .select(*COLUMNS)
    )
