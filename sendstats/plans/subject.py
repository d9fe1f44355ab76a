"""Subject-line report, plain and split by A/B variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sendstats.functions.events import EMAIL_COUNTERS
from sendstats.functions.mail import EMAIL, message_link, variant_subject
from sendstats.functions.rates import EMAIL_RATES, with_rates
from sendstats.operators.counts import collapsed, counters_of_groups, counters_of_messages
from sendstats.operators.dims import (
    newest_subject,
    subject_lines,
    variant_messages,
    variant_subjects,
)
from sendstats.operators.nesting import message_events, spread_variant_sets, with_variant_set
from sendstats.operators.sizing import few_rows
from sendstats.plans.inputs import Inputs, Scope
from sendstats.plans.messages import DEFAULT_LINK_BASE, with_category, with_live_message

MESSAGE = ["app_id", "message_id"]
UNIQUE_KEYS = ["user_id", "day"]
COLUMNS = (
    "App", "app_id", "message_id",
    "Subject", "StartDate", "Sent", "Delivered", "Delivered_PCT",
    "Open", "Open_PCT", "Unique_Open", "Unique_Open_PCT",
    "Unique_Click", "Unique_Click_PCT", "Bounce", "Bounce_PCT",
    "Dropped", "Unsubscribe", "Spam", "Spam_PCT", "Category", "MessageLink",
)


def subject_report(
    inputs: Inputs, start, end, company_id=None, app_id=None, link_base=DEFAULT_LINK_BASE
) -> DataFrame:
    """One row per sent email message and distinct subject line."""
    window = inputs.window(start, end)
    live = inputs.live_study
    scope = Scope(inputs, end, company_id, app_id)

    events = _events(scope.sessions(window.sessions.select("user_id", "app_id", "states")), inputs.watch)
    counters = counters_of_messages(
        events, scope.ids(live, EMAIL), MESSAGE, EMAIL_COUNTERS, UNIQUE_KEYS
    )
    rows = counters.where(F.col("Sent") > 0).join(subject_lines(window.experiment), "message_id")
    return _finish(rows, live, scope, link_base)


def ab_report(
    inputs: Inputs, start, end, company_id=None, app_id=None, link_base=DEFAULT_LINK_BASE
) -> DataFrame:
    """The subject report in which an experimented message shows one row per
    variant instead of its own rows."""
    window = inputs.window(start, end)
    live = inputs.live_study
    scope = Scope(inputs, end, company_id, app_id)

    sessions = scope.sessions(window.sessions.select("user_id", "app_id", "states", "experiments"))
    counters = variant_counters(
        _events(sessions), scope.ids(live, EMAIL), variant_messages(window.experiment)
    )

    # Whether a message shows at all is decided on its own row (the one without
    # a variant), whether it shows variants on the others.
    message = Window.partitionBy(*MESSAGE)
    is_variant = F.col("variant_id").isNotNull()
    own_sent = F.max(F.when(~is_variant, F.col("Sent"))).over(message)
    variants = F.count("variant_id").over(message)
    shown = (
        counters.withColumns({"own_sent": own_sent, "variants": variants})
        .where((F.col("own_sent") > 0) & (is_variant | (F.col("variants") == 0)))
    )

    # A plain row repeats per subject; a variant row is written once, under its
    # own subject or else the message's newest.
    plain = F.col("l.variant_id").isNull() & (F.col("l.message_id") == F.col("r.message_id"))
    own = shown.join(newest_subject(window.experiment), "message_id").alias("l")
    rows = own.join(subject_lines(window.experiment).alias("r"), plain, "left").select("l.*", "Subject")
    named = rows.join(variant_subjects(window.experiment), ["message_id", "variant_id"], "left")
    text = F.coalesce("variant_subject", "newest_subject")
    labelled = named.withColumn(
        "Subject",
        F.when(is_variant, variant_subject(text, F.col("variant_id"))).otherwise(F.col("Subject")),
    )
    return _finish(labelled, live, scope, link_base, extra=["variant_id"])


def variant_counters(events: DataFrame, ids: DataFrame, variants: DataFrame) -> DataFrame:
    """Counters per message (variant NULL) and per (message, variant), for the
    pairs in ``variants``, out of one pass over the events.

    Sessions of a message have few different sets of variants. Events are collapsed by
    set first, so that what is shuffled does not grow with the variants of a session; only
    the collapsed groups are then spread over the variants of their set and brought
    together again, as a user may have met one variant in several sets on a day.

    The wanted rows are one list, and as with plain messages a short one filters
    the events and a long one the finished counters.
    """
    keys = [*MESSAGE, "variant_id"]
    own = ids.withColumn("variant_id", F.lit(None).cast("bigint"))
    wanted = own.unionByName(ids.join(variants, "message_id"))
    short = few_rows(wanted)
    kept = events.join(F.broadcast(ids), MESSAGE, "left_semi") if short else events
    sets = collapsed(with_variant_set(kept), [*MESSAGE, "variants"], UNIQUE_KEYS)
    spread = spread_variant_sets(sets)
    if short:
        spread = _wanted(spread, F.broadcast(wanted))
    groups = spread.groupBy(*keys, "label", *UNIQUE_KEYS).agg(F.sum("occurrence").alias("occurrence"))
    counters = counters_of_groups(groups, keys, EMAIL_COUNTERS, UNIQUE_KEYS)
    return counters if short else _wanted(counters, wanted)


def _wanted(df: DataFrame, wanted: DataFrame) -> DataFrame:
    left, right = df.alias("l"), wanted.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in MESSAGE]
    same.append(F.col("l.variant_id").eqNullSafe(F.col("r.variant_id")))
    return left.join(right, same, "left_semi")


def _events(sessions: DataFrame, watch=None) -> DataFrame:
    return message_events(sessions, watch).where(F.col("label").isin(*EMAIL_COUNTERS))


def _finish(rows, live, scope, link_base, extra=()) -> DataFrame:
    current = with_live_message(rows, live, EMAIL).join(scope.apps(), "app_id")
    link = message_link(link_base, F.col("app_id"), F.col("message_id"))
    return (
        with_category(with_rates(current, EMAIL_RATES))
        .withColumn("MessageLink", link)
        .select(*COLUMNS, *extra)
    )
