"""Every operator and report as a query over the driver's tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendstats.functions.events import (
    EMAIL_COUNTERS,
    PUSH_COUNTERS,
    day_text,
    event_causes,
    event_label,
    event_message_id,
    is_message_event,
    start_date,
)
from sendstats.functions.mail import EMAIL, PUSH, delivery_type, message_link, sender_domain
from sendstats.functions.rates import EMAIL_RATES, with_display, with_rates
from sendstats.operators.counts import counters_of_messages, event_counts, of_messages
from sendstats.operators.dims import (
    SENDER_VAR,
    SUBJECT_VAR,
    ids_from_literals,
    latest,
    message_ids,
    newest_definition,
    push_names,
    sender_or_default,
    senders,
    subject_lines,
    variant_messages,
    variant_subjects,
    vars_named,
)
from sendstats.operators.nesting import (
    email_position,
    explode_events,
    explode_variants,
    message_events,
    with_email,
)
from sendstats.plans.daystate import refresh, stored_domain_report
from sendstats.plans.domain import KEYS, domain_report, with_all_rows
from sendstats.plans.inputs import Inputs, Scope, company_apps
from sendstats.plans.messages import DEFAULT_LINK_BASE, with_category
from sendstats.plans.push import push_report
from sendstats.plans.subject import MESSAGE, UNIQUE_KEYS, ab_report, subject_report, variant_counters
from sendstats.functions.mail import file_safe
from sendstats.sources.ingest import ingest_snapshots
from sendstats.sources.intervals import Intervals, read_intervals, refresh_intervals
from sendstats.sources.layout import write_sessions
from sendstats.sources.scans import (
    MODELS,
    app_asof,
    check_window,
    read_sessions,
    read_snapshots,
    scan_sessions,
    scan_snapshots,
)
from sendstats.sources.sink import read_report, write_report
from verification import fixtures as fx

RAW = {"Study": fx.raw_study, "Experiment": fx.raw_experiment, "App": fx.raw_app}
VARIANT = [*MESSAGE, "variant_id"]
DOMAIN_UNIQUE = ["user_id", "email", "day"]


def scratch(spark: SparkSession) -> str:
    """A fresh folder that all executors see: below the cluster's shared
    checkpoint folder, or a local one in local mode (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="sendstats-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def plan(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(fx.DerivedInputs(spark, sf_dir))


# Sources and sinks


def src_sessions_range(spark, sf_dir):
    path = scratch(spark)
    fx.sessions(spark, sf_dir).write.partitionBy("dt").parquet(path)
    start, end = "20240105", "20240124"
    check_window(start, end, as_of="20240205")
    per_session = F.expr("aggregate(states, 0L, (n, s) -> n + coalesce(array_size(s.events), 0))")
    counts = scan_sessions(spark, path, start, end).groupBy("dt", "app_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(per_session).alias("events")
    )
    return counts.withColumn("dt", day_text(F.col("dt")))


def src_snapshots_range(spark, sf_dir):
    path = scratch(spark)
    fx.raw_study(spark, sf_dir, dealt=True).write.partitionBy("dt").parquet(path)
    return scan_snapshots(spark, path, "Study", fx.START, fx.END).select(
        "message_id", "app_id", "name", "action_type",
        F.col("delivery_type").cast("bigint").alias("delivery_type"),
        "category_id", day_text(F.col("dt")).alias("dt"),
    )


def src_app_asof(spark, sf_dir):
    path = scratch(spark)
    fx.raw_app(spark, sf_dir, dealt=True).write.partitionBy("dt").parquet(path)
    return app_asof(spark, path, fx.END).select("app_id", "company_id", "name", "email_from_address")


def src_ingest_snapshots(spark, sf_dir):
    """Daily files of all models, one day of one model twice: that one is not
    loaded. The second call finds everything loaded already."""
    root = scratch(spark)
    for day in fx.SNAPSHOT_DAYS:
        for model in MODELS:
            rows = RAW[model](spark, sf_dir, dealt=True).where(F.col("dt") == F.lit(day)).drop("dt")
            copies = ["a", "b"] if (model, f"{day}") == ("App", "2024-01-11") else ["a"]
            for copy in copies:
                rows.write.parquet(f"{root}/in/{day:%Y%m%d}120000/{copy}_{model.lower()}.parquet")
    for _ in range(2):
        ingest_snapshots(spark, f"{root}/in", f"{root}/out", "20240101", "20240205")
    text = {
        "Study": F.col("name"),
        "Experiment": F.filter("vars", lambda v: v["name"] == SUBJECT_VAR)[0]["value"]["text"],
        "App": F.col("email_from_address"),
    }
    key = {"Study": "message_id", "Experiment": "variant_id", "App": "app_id"}
    loaded = [
        read_snapshots(spark, f"{root}/out/{model}", model).select(
            F.lit(model).alias("model"), day_text(F.col("dt")).alias("dt"),
            F.col(key[model]).alias("id"), text[model].alias("text"),
        )
        for model in MODELS
    ]
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


def src_unnest_ids(spark, sf_dir):
    wanted = ids_from_literals(spark, [fx.FIRST_MESSAGE + k for k in range(fx.HOT_MESSAGES)])
    events = message_events(fx.sessions(spark, sf_dir).select("app_id", "states"))
    return event_counts(events.join(wanted, "message_id", "left_semi"), ["message_id"])


def sink_report_csv(spark, sf_dir):
    path = scratch(spark)
    report = domain_report(fx.DerivedInputs(spark, sf_dir), fx.START, fx.END)
    write_report(report, "domain", fx.START, fx.END, path)
    written = read_report(spark, path, "domain")
    return written.select([F.col(c).cast("string").alias(c) for c in written.columns])


def domain_report_stored(spark, sf_dir):
    """The domain report from day counters that are built in three goes, over all days."""
    inputs, root = fx.DerivedInputs(spark, sf_dir), scratch(spark)
    fx.sessions(spark, sf_dir).write.partitionBy("dt").parquet(f"{root}/sessions")
    for end in ("20240103", "20240117", fx.END):
        refresh(spark, root, inputs, fx.START, end)
    return stored_domain_report(spark, root, inputs, fx.START, fx.END)


def sink_rerun(spark, sf_dir):
    """The domain report of all apps, then again without the messages of odd apps: their files go."""
    path, inputs = scratch(spark), fx.DerivedInputs(spark, sf_dir)
    report = domain_report(inputs, fx.START, fx.END)
    write_report(report, "domain", fx.START, fx.END, path)
    write_report(report.where("app_id % 2 = 0"), "domain", fx.START, fx.END, path)
    written = read_report(spark, path, "domain")
    return written.select([F.col(c).cast("string").alias(c) for c in written.columns])


def _stored_studies(spark, sf_dir) -> Intervals:
    """The intervals of the message snapshots: of two days at once, then day by day."""
    root = scratch(spark)
    raw = fx.raw_study(spark, sf_dir, dealt=True)
    for day in ([F.lit(d) for d in fx.SNAPSHOT_DAYS[:2]], *[[F.lit(d)] for d in fx.SNAPSHOT_DAYS[2:]]):
        raw.where(F.col("dt").isin(*day)).write.mode("append").partitionBy("dt").parquet(f"{root}/Study")
        refresh_intervals(spark, root, "Study")
    return read_intervals(spark, root, "Study")


def interval_latest(spark, sf_dir):
    """``dim_study_latest`` from stored intervals."""
    found = latest(_stored_studies(spark, sf_dir).on(fx.SNAPSHOT_DAYS[-1]), ["message_id"])
    return found.select("message_id", "app_id", "name", "action_type", day_text(F.col("dt")).alias("dt"))


def interval_definition(spark, sf_dir):
    """``win_latest_study`` from stored intervals."""
    return newest_definition(_stored_studies(spark, sf_dir).between(fx.START, fx.END))


def interval_as_of(spark, sf_dir):
    """Events by message and day, with what the snapshot of that day said of the message."""
    events = message_events(fx.sessions(spark, sf_dir).select("app_id", "states"))
    counted = events.groupBy("app_id", "message_id", "day").agg(F.count(F.lit(1)).alias("occurrence"))
    met = _stored_studies(spark, sf_dir).joined(counted, ["app_id", "message_id"], "day")
    return met.select(
        "app_id", "message_id", day_text(F.col("day")).alias("day"), "occurrence", "name", "action_type", "category_id"
    )


def sessions_clustered(spark, sf_dir):
    """Sessions and events by day and app, read from the clustered layout."""
    path = scratch(spark)
    write_sessions(fx.sessions(spark, sf_dir), path)
    per_session = F.expr("aggregate(states, 0L, (n, s) -> n + coalesce(array_size(s.events), 0))")
    counts = read_sessions(spark, path).groupBy("dt", "app_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(per_session).alias("events")
    )
    return counts.withColumn("dt", day_text(F.col("dt")))


# Dimensions


def dim_study_latest(inputs):
    return inputs.live_study.select(
        "message_id", "app_id", "name", "action_type", day_text(F.col("dt")).alias("dt")
    )


def dim_message_ids(inputs):
    named = [("email", EMAIL), ("push", PUSH)]
    email, push = (
        message_ids(inputs.live_study, channel).select(F.lit(name).alias("channel"), "*")
        for name, channel in named
    )
    return email.unionByName(push)


def dim_category(inputs):
    apps = inputs.live_app.select("app_id", "unsubscribe_categories")
    return with_category(inputs.live_study.join(apps, "app_id", "left")).select("message_id", "Category")


def window(inputs):
    return inputs.window(fx.START, fx.END)


def dim_push_names(inputs):
    return push_names(window(inputs).study, PUSH)


def win_latest_study(inputs):
    return newest_definition(window(inputs).study)


def join_sender(inputs):
    ids = Scope(inputs, fx.END).ids(inputs.live_study, EMAIL)
    own = ids.join(senders(window(inputs).experiment), "message_id", "left")
    return own.join(Scope(inputs, fx.END).apps(), "app_id").select(
        "message_id", "app_id",
        sender_or_default(F.col("sender"), F.col("default_sender")).alias("sender"),
    )


def nest_vars(inputs):
    named = vars_named(inputs.experiment, lambda name: name.isin(SUBJECT_VAR, SENDER_VAR))
    return named.withColumn("dt", day_text(F.col("dt")))


def ab_variant_messages(inputs):
    return variant_messages(window(inputs).experiment)


def ab_variant_subjects(inputs):
    return variant_subjects(window(inputs).experiment)


def flt_company_apps(inputs):
    return company_apps(inputs.app, fx.END).select(
        "company_id", "app_id", file_safe(F.col("AppName")).alias("App")
    )


def flt_scope(inputs):
    company = push_report(inputs, fx.START, fx.END, company_id=15)
    app = push_report(inputs, fx.START, fx.END, app_id=1)
    return company.withColumn("scope", F.lit("company")).unionByName(
        app.withColumn("scope", F.lit("app"))
    )


# Events


def nest_events(inputs):
    return explode_events(inputs.sessions.select("user_id", "app_id", "dt", "states")).select(
        "user_id", "app_id", day_text(F.col("dt")).alias("dt"),
        "name", F.floor("time").alias("second"),
    )


def nest_event_variants(inputs):
    sessions = inputs.sessions.select("user_id", "app_id", "states", "experiments")
    return explode_variants(message_events(sessions).drop("day"))


def nest_email_attr(inputs):
    located = _with_any_email(inputs, inputs.sessions.select("user_id", "app_id", "dt", "attrs"))
    return located.select("user_id", "app_id", "email", day_text(F.col("dt")).alias("dt"))


def str_domain(inputs):
    located = _with_any_email(inputs, inputs.sessions.select("app_id", "attrs"))
    return located.groupBy("email", "Domain").agg(F.count(F.lit(1)).alias("sessions"))


def _with_any_email(inputs, sessions):
    """Emails of all sessions, NULL for those of an app without an entity."""
    return with_email(sessions, email_position(inputs.live_app), "left")


def evt_causes(inputs):
    """Events by what becomes of them: counted, or not and why."""
    return explode_events(inputs.sessions.select("app_id", "states")).groupBy("app_id").agg(*event_causes(timed=True))


def flt_message_events(inputs):
    events = explode_events(inputs.sessions.select("states"))
    kept = events.where(is_message_event(F.col("name")))
    return kept.groupBy("name").agg(F.count(F.lit(1)).alias("events"))


def str_parse_event(inputs):
    return flt_message_events(inputs).select(
        "name", "events",
        event_message_id(F.col("name")).alias("message_id"),
        event_label(F.col("name")).alias("label"),
    )


def dt_event_day(inputs):
    events = message_events(inputs.sessions.select("states"))
    days = events.groupBy("day", "label").agg(F.count(F.lit(1)).alias("events"))
    return days.withColumn("day", day_text(F.col("day")))


def all_events(inputs, *columns):
    sessions = window(inputs).sessions.select("app_id", "states", *columns)
    return message_events(sessions)


def email_domain_events(inputs):
    sessions = window(inputs).sessions.select("app_id", "user_id", "states", "attrs")
    return message_events(_with_any_email(inputs, sessions))


def email_ids(inputs):
    return message_ids(inputs.live_study, EMAIL)


def push_ids(inputs):
    return message_ids(inputs.live_study, PUSH)


# Counts


def own_counts(events, ids, keys):
    return of_messages(events, ids, lambda own: event_counts(own, keys))


def join_email_events(inputs):
    return own_counts(all_events(inputs), email_ids(inputs), MESSAGE)


def join_push_events(inputs):
    return own_counts(all_events(inputs), push_ids(inputs), MESSAGE)


def agg_events_by_email(inputs):
    return event_counts(email_domain_events(inputs), [*MESSAGE, "email"])


def agg_push_events(inputs):
    return event_counts(all_events(inputs), MESSAGE)


def agg_events_by_day(inputs):
    counts = event_counts(all_events(inputs), [*MESSAGE, "day"])
    return counts.withColumn("day", day_text(F.col("day")))


def agg_domain_events(inputs):
    return own_counts(email_domain_events(inputs), email_ids(inputs), list(KEYS))


def pivot_domain(inputs):
    return counters_of_messages(email_domain_events(inputs), email_ids(inputs), KEYS, EMAIL_COUNTERS)


def pivot_subject(inputs):
    return counters_of_messages(all_events(inputs), email_ids(inputs), MESSAGE, EMAIL_COUNTERS)


def pivot_push(inputs):
    return counters_of_messages(all_events(inputs), push_ids(inputs), MESSAGE, PUSH_COUNTERS)


def uniq_domain(inputs):
    events = email_domain_events(inputs)
    counters = counters_of_messages(events, email_ids(inputs), KEYS, EMAIL_COUNTERS, DOMAIN_UNIQUE)
    return counters.select(*KEYS, "Unique_Open", "Unique_Click")


def uniq_subject(inputs):
    return subject_counters(inputs).select(*MESSAGE, "Unique_Open", "Unique_Click")


def variants_only(inputs):
    events = all_events(inputs, "user_id", "experiments")
    counters = variant_counters(events, email_ids(inputs), ab_variant_messages(inputs))
    return counters.where(F.col("variant_id").isNotNull())


def ab_totals(inputs):
    return variants_only(inputs).select(*VARIANT, *EMAIL_COUNTERS.values())


def uniq_ab(inputs):
    return variants_only(inputs).select(*VARIANT, "Unique_Open", "Unique_Click")


def join_domain_study(inputs):
    return pivot_domain(inputs).join(win_latest_study(inputs), "message_id")


def join_subject_lines(inputs):
    return pivot_subject(inputs).join(subject_lines(window(inputs).experiment), "message_id")


def subject_counters(inputs):
    return counters_of_messages(
        all_events(inputs, "user_id"), email_ids(inputs), MESSAGE, EMAIL_COUNTERS, UNIQUE_KEYS
    )


def num_rates(inputs):
    return with_rates(subject_counters(inputs), EMAIL_RATES).select(*MESSAGE, *EMAIL_RATES)


def str_pct_display(inputs):
    return with_display(num_rates(inputs)).drop(*EMAIL_RATES)


def domain_all_rows(inputs):
    sessions = window(inputs).sessions.select("app_id", "user_id", "states", "attrs")
    counters = counters_of_messages(
        message_events(with_email(sessions, Scope(inputs, fx.END).email_positions())),
        email_ids(inputs), KEYS, EMAIL_COUNTERS, DOMAIN_UNIQUE,
    )
    return with_all_rows(counters.where(F.col("Sent") > 0))


# Scalars over dimensions


def str_delivery_type(inputs):
    code = F.col("delivery_type")
    return inputs.study.select(
        "message_id", code.cast("bigint").alias("delivery_type"), delivery_type(code).alias("Type")
    ).distinct()


def str_sender_domain(inputs):
    found = senders(window(inputs).experiment)
    return found.withColumn("SenderDomain", sender_domain(F.col("sender")))


def dt_start_date(inputs):
    return inputs.live_study.select("message_id", start_date(F.col("active_since")).alias("StartDate"))


def str_message_link(inputs):
    link = message_link(DEFAULT_LINK_BASE, F.col("app_id"), F.col("message_id"))
    return inputs.live_study.select("app_id", "message_id", link.alias("MessageLink"))


def report(build):
    return plan(lambda inputs: build(inputs, fx.START, fx.END))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    over_tables = [
        src_sessions_range, src_snapshots_range, src_app_asof, src_ingest_snapshots,
        src_unnest_ids, sink_report_csv, domain_report_stored, sink_rerun,
        interval_latest, interval_definition, interval_as_of, sessions_clustered,
    ]
    over_inputs = [
        dim_study_latest, dim_message_ids, dim_category, dim_push_names, win_latest_study,
        join_sender, nest_vars, ab_variant_messages, ab_variant_subjects, flt_company_apps,
        flt_scope, nest_events, nest_event_variants, nest_email_attr, str_domain,
        flt_message_events, str_parse_event, dt_event_day, join_email_events, join_push_events,
        agg_events_by_email, agg_push_events, agg_events_by_day, agg_domain_events,
        pivot_domain, pivot_subject, pivot_push, uniq_domain, uniq_subject, ab_totals, uniq_ab,
        join_domain_study, join_subject_lines, num_rates, str_pct_display, domain_all_rows,
        str_delivery_type, str_sender_domain, dt_start_date, str_message_link, evt_causes,
    ]
    reports = [domain_report, subject_report, ab_report, push_report]
    return {
        **{f.__name__: f for f in over_tables},
        **{f.__name__: plan(f) for f in over_inputs},
        **{f.__name__: report(f) for f in reports},
    }
