"""One call per report: load snapshots, build the report, write it."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession

from sendstats.plans.domain import domain_report
from sendstats.plans.inputs import Scope, read_inputs
from sendstats.plans.messages import DEFAULT_LINK_BASE
from sendstats.plans.push import push_report
from sendstats.plans.subject import ab_report, subject_report
from sendstats.sources.ingest import ingest_snapshots, remove_snapshots
from sendstats.sources.scans import check_window
from sendstats.sources.sink import write_report

# Report codes -> (plan, session columns it reads, CSV layout).
REPORTS = {
    "d": (domain_report, "domain", "domain"),
    "s0": (subject_report, "subject", "subject"),
    "s1": (ab_report, "ab", "subject"),
    "p": (push_report, "push", "push"),
}
DELETE = "delete"
ALL_APPS = "all"
APP_PREFIX = "__A"  # marks an app id, anything else is a company id


def run_report(
    spark: SparkSession, root: str, report_id: str, start, end, report_type: str,
    out: str, as_of, snapshot_source: str | None = None, link_base: str = DEFAULT_LINK_BASE,
    watch: Observation | None = None,
) -> None:
    """Run one report for a company, an app or all apps and write its CSV files to ``out``.

    With ``snapshot_source`` the window's snapshot files are loaded first. ``watch`` gets
    the counts of events that are not counted, by cause, in the report's own pass. The
    report type ``delete`` removes the window's loaded snapshots instead.
    """
    if report_type == DELETE:
        remove_snapshots(spark, root, start, end)
        return
    check_window(start, end, as_of)
    plan, columns, layout = REPORTS[report_type]
    if snapshot_source:
        ingest_snapshots(spark, snapshot_source, root, start, end)
    if report_id.startswith(APP_PREFIX):
        scope = {"app_id": int(report_id.removeprefix(APP_PREFIX))}
    elif report_id == ALL_APPS:
        scope = {}
    else:
        scope = {"company_id": int(report_id)}
    inputs = read_inputs(spark, root, columns)
    inputs.watch = watch
    report = plan(inputs, start, end, link_base=link_base, **scope)
    write_report(report, layout, start, end, out, Scope(inputs, end, **scope).covered())
