"""Flattening of nested sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sendstats.functions.events import event_causes, event_label, event_message_id, is_message_event, utc_day
from sendstats.functions.mail import recipient_domain
from sendstats.operators.sizing import join_few


def explode_events(sessions: DataFrame) -> DataFrame:
    """One row per event of ``states[].events[]``, other columns carried along.

    Two explodes rather than one over ``flatten``: a NULL ``events`` array then
    loses only its own state, not the whole session.
    """
    carried = [c for c in sessions.columns if c != "states"]
    per_state = sessions.select(*carried, F.explode("states.events").alias("events"))
    per_event = per_state.select(*carried, F.explode("events").alias("event"))
    return per_event.select(*carried, "event.*")


def message_events(sessions: DataFrame, watch: Observation | None = None) -> DataFrame:
    """Message events only, decoded: ``message_id``, ``label``, and ``day``.

    ``watch`` gets the counts of what is dropped or cannot be decoded, by cause, when the
    result is first worked out, in the same pass.
    """
    events = explode_events(sessions)
    if watch is not None:
        events = events.observe(watch, *event_causes("time" in events.columns))
    events = events.where(is_message_event(F.col("name")))
    decoded = {
        "message_id": event_message_id(F.col("name")),
        "label": event_label(F.col("name")),
    }
    if "time" in events.columns:
        decoded["day"] = utc_day(F.col("time"))
    return events.withColumns(decoded).drop("name", "time")


def explode_variants(df: DataFrame) -> DataFrame:
    """One row per variant of the session; a session without any keeps one row
    with a NULL variant."""
    carried = [c for c in df.columns if c != "experiments"]
    return df.select(*carried, F.explode_outer("experiments.variant").alias("variant_id"))


def with_variant_set(df: DataFrame) -> DataFrame:
    """Replace ``experiments`` by ``variants``, the variants of the session in order; repeated ones stay."""
    found = F.coalesce(F.col("experiments.variant"), F.array().cast("array<bigint>"))
    ordered = F.array_sort(F.filter(found, lambda v: v.isNotNull()))
    return df.withColumn("variants", ordered).drop("experiments")


def spread_variant_sets(df: DataFrame) -> DataFrame:
    """Each row once with a NULL variant, plus once per variant of its set.

    The NULL row stands for the events themselves, so message totals and variant
    totals come out of one scan.
    """
    carried = [c for c in df.columns if c != "variants"]
    none = F.array(F.lit(None).cast("bigint"))
    return df.select(*carried, F.explode(F.concat(none, F.col("variants"))).alias("variant_id"))


def with_variants(df: DataFrame) -> DataFrame:
    """Each row once with a NULL variant, plus once per variant of its session."""
    return spread_variant_sets(with_variant_set(df))


def email_position(app: DataFrame) -> DataFrame:
    """Zero-based position of each app's email attribute.

    An app whose attribute is unset or not among its columns gets a position
    outside of every attribute list, which reads as NULL.
    """
    place = F.array_position("attribute_columns", F.col("email_user_attribute"))
    return app.select("app_id", (F.coalesce(place, F.lit(0)) - 1).cast("int").alias("email_at"))


def with_email(sessions: DataFrame, positions: DataFrame, how: str = "inner") -> DataFrame:
    """Replace ``attrs`` by the recipient's lower-case ``email`` and its ``Domain``,
    for the sessions of the apps in ``positions`` or, with a left join, for all.

    Runs before the events are exploded, so the look-up and the regular
    expression cost one call per session.
    """
    carried = [c for c in sessions.columns if c != "attrs"]
    email = F.lower(F.get("attrs", F.col("email_at")))
    located = join_few(sessions, positions, ["app_id"], how)
    return located.select(*carried, email.alias("email")).withColumn(
        "Domain", recipient_domain("email")
    )
