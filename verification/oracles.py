"""DuckDB SQL for every query, computed from flat rows.

The SQL never nests: events, experiment variables and snapshots are flat from
the start, totals and uniques are separate passes. So it shares neither the
explode path nor the one-pass counting with the Spark plans.
"""

from __future__ import annotations

WINDOW = "BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"
LAST_DAY = "DATE '2024-01-30'"

# What the reports have to show. They stand here a second time, so that a
# wrong one in the code under test is found.
LINK_BASE = "https://dashboard.example.com/dashboard"
DOMAINS = """'gmail.com', 'msn.com', 'hotmail.com', 'yahoo.com', 'aol.com', '163.com', 'etlgr.com',
    'hotmail.co.th', 'icloud.com', 'live.com', 'me.com', 'naver.com', 'outlook.com', 'qq.com',
    'rocketmail.com', 'yahoo.co.id', 'yahoo.co.uk', 'yahoo.com.my', 'yahoo.com.ph', 'yahoo.com.sg',
    'yahoo.com.vn', 'ymail.com'"""
TYPE_CASE = """WHEN 0 THEN 'Immediate' WHEN 1 THEN 'Future' WHEN 2 THEN 'Manual'
    WHEN 3 THEN 'Triggered Local' WHEN 4 THEN 'Triggered Server' WHEN 5 THEN 'Recurring'"""
EMAIL_COUNTERS = {
    "Sent": "Sent", "Delivered": "Delivered", "Open": "Open", "Click": "Click", "Bounce": "Bounce",
    "Dropped": "Dropped", "Block": "Block", "Unsubscribe": "Unsubscribe", "Marked as spam": "Spam",
}
PUSH_COUNTERS = {"Sent": "Sent", "Bounce": "Bounce", "Held Back": "Held_Back", "Open": "Open"}
EMAIL_RATES = {
    "Delivered_PCT": ("Delivered", "Sent"), "Open_PCT": ("Open", "Delivered"),
    "Unique_Open_PCT": ("Unique_Open", "Delivered"), "Unique_Click_PCT": ("Unique_Click", "Delivered"),
    "Bounce_PCT": ("Bounce", "Sent"), "Spam_PCT": ("Spam", "Delivered"),
}
PUSH_RATES = {"Open_PCT": ("Open", "Sent"), "Bounce_PCT": ("Bounce", "Sent")}

BASE = f"""
snap(s, dt) AS (
  VALUES (0, DATE '2024-01-01'), (1, DATE '2024-01-11'), (2, DATE '2024-01-30'), (3, DATE '2024-02-05')
),
study AS (
  SELECT 4500000000000000 + p_partkey AS message_id, p_partkey // 20 AS app_id,
    p_name || ' #' || p_partkey || CASE WHEN p_partkey % 6 = 0 THEN ' v' || s ELSE '' END AS name,
    CASE WHEN p_partkey % 50 IN (7, 13) AND s = 3 THEN '__In App'
         WHEN p_partkey % 5 = 3 THEN '__Push Notification'
         WHEN p_partkey % 5 = 4 THEN '__In App' ELSE '__Email' END AS action_type,
    p_size % 8 AS delivery_type,
    1701388800 + 86400 * (p_partkey % 30
      + CASE WHEN p_partkey % 6 = 0 AND p_partkey % 12 <> 0 THEN s ELSE 0 END) AS changed,
    CASE WHEN p_partkey % 10 <> 9
         THEN CAST(DATE '2023-11-01' + CAST(p_partkey % 60 AS INTEGER) AS VARCHAR) END AS since,
    CASE WHEN p_partkey % 3 <> 0
         THEN (p_partkey + CASE WHEN p_partkey % 7 = 0 AND s = 3 THEN 1 ELSE 0 END) % 4 END AS category_id,
    dt
  FROM part, snap WHERE s >= CASE WHEN p_size % 25 = 13 THEN 3 ELSE 0 END AND NOT (s = 3 AND p_size % 25 = 4)
),
live_study AS (SELECT * FROM study WHERE dt = (SELECT max(dt) FROM study)),
email_ids AS (SELECT app_id, message_id FROM live_study WHERE action_type = '__Email'),
push_ids AS (SELECT app_id, message_id FROM live_study WHERE action_type = '__Push Notification'),
arm AS (
  SELECT p_partkey AS k, 4500000000000000 + p_partkey AS message_id,
    9000000000 + 2 * p_partkey + b AS variant_id, b, s, dt
  FROM part, snap, (VALUES (0), (1)) AS arms(b)
  WHERE p_partkey % 5 < 3 AND (b = 0 OR p_partkey % 4 = 0)
    AND s >= CASE WHEN p_size % 25 = 13 THEN 3 ELSE 0 END AND NOT (s = 3 AND p_size % 25 = 4)
),
vars AS (
  SELECT variant_id, message_id, dt, 'Subject' AS var_name,
    'Subj ' || k || CASE WHEN k % 8 = 0 AND b = 1 THEN ' r' || s ELSE '' END AS text
  FROM arm
  UNION ALL
  SELECT variant_id, message_id, dt, 'Sender email',
    CASE WHEN k % 15 = 6 THEN 'no-at-sender' WHEN k % 25 = 11 THEN ''
         ELSE 'news' || k || '@mail' || (k % 3) || CASE WHEN k % 8 = 4 AND b = 1 THEN '.alt' ELSE '' END
              || '.example.com' END
  FROM arm WHERE k % 5 <> 2
  UNION ALL
  SELECT variant_id, message_id, dt, '__message__' || message_id, '' FROM arm WHERE k % 4 = 0
  UNION ALL
  SELECT variant_id, message_id, dt, '__message__' || message_id || '.Subject',
    'Subj ' || k || CASE WHEN b = 0 THEN ' /A' ELSE ' /B' END
      || CASE WHEN k % 16 = 0 THEN ' r' || s ELSE '' END
  FROM arm WHERE k % 4 = 0 AND k % 12 <> 8
),
window_vars AS (SELECT * FROM vars WHERE dt {WINDOW}),
subjects AS (
  SELECT message_id, text AS Subject, max(dt) AS last_dt,
    row_number() OVER (PARTITION BY message_id ORDER BY max(dt) DESC, text) AS place
  FROM window_vars WHERE var_name = 'Subject' GROUP BY message_id, text
),
variant_map AS (
  SELECT DISTINCT variant_id, CAST(substr(var_name, 12) AS BIGINT) AS message_id FROM window_vars
  WHERE regexp_full_match(substr(var_name, 12), '[1-9][0-9]{{15}}')
),
variant_subjects AS (
  SELECT variant_id, CAST(substr(var_name, 12, 16) AS BIGINT) AS message_id, text AS variant_subject
  FROM window_vars WHERE contains(var_name, '.Subject')
  QUALIFY row_number() OVER (PARTITION BY variant_id, substr(var_name, 12, 16) ORDER BY dt DESC, text) = 1
),
senders AS (
  SELECT message_id, text AS sender FROM window_vars WHERE var_name = 'Sender email'
  QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY dt DESC, variant_id DESC) = 1
),
app AS (
  SELECT s_suppkey AS app_id, CAST(s_nationkey AS BIGINT) AS company_id,
    CASE WHEN s_suppkey % 7 = 0 THEN replace(s_name, '#', '/') ELSE s_name END
      || CASE WHEN s_suppkey % 5 = 1 AND s = 3 THEN ' new' ELSE '' END AS name,
    'default' || CASE WHEN s_suppkey % 4 = 1 THEN CAST(s AS VARCHAR) ELSE '' END
      || '@app' || s_suppkey || '.example.net' AS email_from_address,
    CASE WHEN s_suppkey % 25 = 23 THEN 'mail' WHEN s_suppkey % 25 <> 24 THEN 'email' END AS attribute,
    [CASE WHEN s_suppkey % 3 = 0 THEN 'email' ELSE 'attr_0' END,
     CASE WHEN s_suppkey % 3 = 1 THEN 'email' ELSE 'attr_1' END,
     CASE WHEN s_suppkey % 3 = 2 THEN 'email' ELSE 'attr_2' END] AS attribute_columns,
    dt
  FROM supplier, snap WHERE s >= CASE WHEN s_suppkey % 25 = 22 THEN 3 ELSE 0 END
),
live_app AS (SELECT * FROM app WHERE dt = (SELECT max(dt) FROM app)),
categories AS (
  SELECT app_id, category_id, category FROM live_app,
    (VALUES (1, 'News'), (2, 'Promo')) AS names(category_id, category)
  WHERE app_id % 2 = 0
),
listing AS (
  SELECT app_id, company_id, replace(name, '/', '-') AS App, email_from_address AS default_sender
  FROM app WHERE dt = {LAST_DAY}
),
ev AS (
  SELECT event_id, user_id, event_type, epoch(ts) AS t, CAST(ts AS DATE) AS dt,
    CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) < 40
         THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) ELSE event_id // 5 END AS m,
    (event_id * 7 + user_id * 3) % 20 AS code
  FROM events
),
labelled AS (
  SELECT *, m // 20 AS app_id,
    CASE WHEN code < 7 THEN '' WHEN code < 12 THEN 'Delivered' WHEN code < 15 THEN 'Open'
         WHEN code = 15 THEN 'Click' WHEN code = 16 THEN 'Bounce'
         WHEN code = 17 AND m % 5 = 3 THEN 'Held Back' WHEN code = 17 THEN 'Dropped'
         WHEN code = 18 AND m % 2 = 1 THEN 'Block' WHEN code = 18 THEN 'Unsubscribe'
         ELSE 'Marked as spam' END AS own,
    'u' || user_id || CASE user_id % 10
      WHEN 0 THEN '@Gmail.com'
      WHEN 1 THEN CASE WHEN event_id % 2 = 1 THEN '@hotmail.com' ELSE '@yahoo.com' END
      WHEN 2 THEN '@hotmail.com' WHEN 3 THEN '@example.org' WHEN 5 THEN '' WHEN 6 THEN '@QQ.com'
      WHEN 7 THEN '@corp.example' WHEN 8 THEN '@icloud.com' WHEN 9 THEN '@yahoo.co.uk' END AS address
  FROM ev
),
session AS (
  SELECT l.*, lower([CASE WHEN l.app_id % 3 = 0 THEN address ELSE 'x' END,
      CASE WHEN l.app_id % 3 = 1 THEN address ELSE 'x' END,
      CASE WHEN l.app_id % 3 = 2 THEN address ELSE 'x' END
    ][CAST(nullif(list_position(a.attribute_columns, a.attribute), 0) AS BIGINT)]) AS email
  FROM labelled l LEFT JOIN live_app a ON a.app_id = l.app_id
),
occurrence AS (
  SELECT event_id, user_id, app_id, dt, m, email, t AS time,
    CASE WHEN event_type = 'error' THEN 'session end'
         ELSE '.m' || (4500000000000000 + m) || CASE WHEN own = '' THEN '' ELSE ' ' || own END END AS name
  FROM session, (VALUES (0), (1), (2)) AS copies(copy) WHERE copy <= event_id % 3
  UNION ALL
  SELECT event_id, user_id, app_id, dt, m, email, t + 3600.5,
    CASE WHEN own = '' THEN '.m' || (4500000000000000 + m) || ' Delivered'
         WHEN own = 'Delivered' AND user_id % 2 = 0 THEN '.m' || (4500000000000000 + m) || ' Open'
         WHEN own = 'Delivered' THEN '.m' || (4500000000000000 + m) ELSE 'session end' END
  FROM session
  UNION ALL
  SELECT event_id, user_id, app_id, dt, m, email, t,
    CASE WHEN event_id % 97 = 5 THEN '.m' || (4500000000000000 + m + 20) || ' Open'
         WHEN event_id % 499 = 3 THEN '.mbadidbadidbadid1 Open'
         ELSE '.m4599999999999999 Click' END
  FROM session WHERE event_id % 97 = 5 OR event_id % 499 = 3 OR event_id % 211 = 9
),
msg AS (
  SELECT *, try_cast(substr(name, 3, 16) AS BIGINT) AS message_id,
    CASE WHEN substr(name, 20) = '' THEN 'Sent' ELSE substr(name, 20) END AS label,
    CAST(DATE '1970-01-01' + CAST(floor(time / 86400) AS INTEGER) AS VARCHAR) AS day,
    CASE WHEN regexp_extract(email, '@(.+)', 1) IN ({DOMAINS})
         THEN regexp_extract(email, '@(.+)', 1) ELSE 'Other' END AS Domain
  FROM occurrence WHERE name LIKE '.m%'
),
email_msg AS (SELECT * FROM msg SEMI JOIN email_ids USING (app_id, message_id)),
push_msg AS (SELECT * FROM msg SEMI JOIN push_ids USING (app_id, message_id)),
taken AS (
  SELECT event_id, 9000000000 + 2 * m + user_id % 2 AS variant_id
  FROM ev, (VALUES (0), (1)) AS copies(copy)
  WHERE user_id % 3 <> 2 AND (copy = 0 OR user_id % 11 = 0)
  UNION ALL
  SELECT event_id, 1 FROM ev WHERE user_id % 3 <> 2 AND user_id % 7 = 0
),
variant_msg AS (
  SELECT e.*, t.variant_id FROM email_msg e
  JOIN taken t ON t.event_id = e.event_id
  JOIN variant_map v ON v.variant_id = t.variant_id AND v.message_id = e.message_id
),
definition AS (
  SELECT message_id, name, CASE delivery_type {TYPE_CASE} ELSE 'Unknown' END AS Type
  FROM study WHERE dt {WINDOW}
  QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY changed DESC, dt DESC) = 1
),
push_names AS (
  SELECT app_id, message_id, name FROM study
  WHERE dt {WINDOW} AND action_type = '__Push Notification'
  QUALIFY row_number() OVER (PARTITION BY app_id, message_id ORDER BY dt DESC) = 1
)"""


def query(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip(), *(c.strip() for c in ctes)]) + "\n" + body.strip()


def totals(source: str, keys: str, counters: dict[str, str]) -> str:
    sums = ", ".join(
        f"CAST(count(*) FILTER (label = '{label}') AS BIGINT) AS {name}" for label, name in counters.items()
    )
    return f"SELECT {keys}, {sums} FROM {source} GROUP BY {keys}"


def day_uniques(source: str, keys: str, by: str) -> str:
    return f"""SELECT {keys},
  CAST(count(*) FILTER (label = 'Open') AS BIGINT) AS Unique_Open,
  CAST(count(*) FILTER (label = 'Click') AS BIGINT) AS Unique_Click
  FROM (SELECT DISTINCT {keys}, label, {by} FROM {source}) GROUP BY {keys}"""


def counted(source: str, keys: str) -> str:
    return f"SELECT {keys}, label, count(*) AS occurrence FROM {source} GROUP BY {keys}, label"


def rates(rates: dict[str, tuple[str, str]]) -> str:
    return ", ".join(
        f"CASE WHEN {base} > 0 THEN CAST({part} AS DOUBLE) / CAST({base} AS DOUBLE) * 100.0 ELSE 0.0 END AS {name}"
        for name, (part, base) in rates.items()
    )


def display(column: str) -> str:
    plain = f"CASE WHEN {column} > 0 AND {column} < 1e-3 THEN '0.00' ELSE CAST({column} AS VARCHAR) END"
    return f"substr({plain}, 1, 4) || '%'"


def link(app: str = "app_id", message: str = "message_id") -> str:
    return f"'{LINK_BASE}?appId=' || {app} || '#/' || {app} || '/messaging/' || {message}"


LIVE = """live AS (
  SELECT l.message_id, l.app_id, l.name AS live_name, l.action_type, coalesce(l.since, 'Unknown') AS StartDate,
    coalesce(c.category, 'Default') AS Category
  FROM live_study l LEFT JOIN categories c ON c.app_id = l.app_id AND c.category_id = l.category_id
)"""

DOMAIN_TOTALS = f"domain_totals AS ({totals('email_msg', 'app_id, message_id, Domain', EMAIL_COUNTERS)})"
DOMAIN_UNIQUES = f"domain_uniques AS ({day_uniques('email_msg', 'app_id, message_id, Domain', 'user_id, email, day')})"
SUBJECT_TOTALS = f"subject_totals AS ({totals('email_msg', 'app_id, message_id', EMAIL_COUNTERS)})"
SUBJECT_UNIQUES = f"subject_uniques AS ({day_uniques('email_msg', 'app_id, message_id', 'user_id, day')})"
AB_TOTALS = f"ab_totals AS ({totals('variant_msg', 'app_id, message_id, variant_id', EMAIL_COUNTERS)})"
AB_UNIQUES = f"ab_uniques AS ({day_uniques('variant_msg', 'app_id, message_id, variant_id', 'user_id, day')})"
PUSH_TOTALS = f"push_totals AS ({totals('push_msg', 'app_id, message_id', PUSH_COUNTERS)})"

SUMMED = ["Sent", "Delivered", "Open", "Unique_Open", "Unique_Click", "Bounce", "Dropped", "Unsubscribe", "Spam"]
WITH_ALL = f"""sent_domains AS (
  SELECT * FROM domain_totals JOIN domain_uniques USING (app_id, message_id, Domain)
  JOIN listing USING (app_id) WHERE Sent > 0
),
with_all AS (
  SELECT app_id, message_id, Domain, {", ".join(SUMMED)} FROM sent_domains
  UNION ALL
  SELECT app_id, message_id, 'All', {", ".join(f"CAST(sum({c}) AS BIGINT)" for c in SUMMED)}
  FROM sent_domains GROUP BY app_id, message_id HAVING sum(Delivered) > 0
)"""
DOMAIN_ROWS = f"""domain_rows AS (
  SELECT App, r.app_id, r.message_id,
    d.name || ' (' || coalesce(nullif(s.sender, ''), default_sender, '') || ')' AS MessageName,
    coalesce(nullif(s.sender, ''), default_sender, '') AS sender,
    Domain, StartDate, {", ".join(f"r.{c}" for c in SUMMED)}, {rates(EMAIL_RATES)}, d.Type, Category,
    CASE WHEN Domain = 'All' THEN ' ' ELSE {link("r.app_id", "r.message_id")} END AS MessageLink
  FROM with_all r JOIN listing USING (app_id) JOIN definition d USING (message_id)
  LEFT JOIN live ON live.message_id = r.message_id LEFT JOIN senders s ON s.message_id = r.message_id
),
domain_report AS (
  SELECT * EXCLUDE (sender), CASE WHEN contains(sender, '@') THEN regexp_replace(sender, '.*@', '') END AS SenderDomain
  FROM domain_rows
)"""
DOMAIN_CTES = [DOMAIN_TOTALS, DOMAIN_UNIQUES, WITH_ALL, LIVE, DOMAIN_ROWS]

SUBJECT_COLUMNS = f"""Sent, Delivered, Open, Unique_Open, Unique_Click, Bounce, Dropped, Unsubscribe, Spam,
  {rates(EMAIL_RATES)}, Category"""
SUBJECT_REPORT = f"""subject_report AS (
  SELECT App, app_id, message_id, Subject, StartDate, {SUBJECT_COLUMNS}, {link()} AS MessageLink
  FROM subject_totals JOIN subject_uniques USING (app_id, message_id) JOIN listing USING (app_id)
  JOIN subjects USING (message_id) JOIN (SELECT message_id, StartDate, Category FROM live) USING (message_id)
  WHERE Sent > 0
)"""
AB_ROWS = f"""plain_rows AS (
  SELECT *, CAST(NULL AS BIGINT) AS variant_id FROM subject_report
  WHERE (app_id, message_id) NOT IN (SELECT (app_id, message_id) FROM ab_totals)
),
variant_rows AS (
  SELECT App, app_id, message_id,
    coalesce(variant_subject, Subject) || ' --Variant ' || variant_id AS Subject, StartDate,
    {SUBJECT_COLUMNS}, {link()} AS MessageLink, variant_id
  FROM ab_totals JOIN ab_uniques USING (app_id, message_id, variant_id)
  SEMI JOIN (SELECT app_id, message_id FROM subject_totals WHERE Sent > 0) own USING (app_id, message_id)
  JOIN listing USING (app_id)
  JOIN (SELECT message_id, Subject FROM subjects WHERE place = 1) USING (message_id)
  LEFT JOIN variant_subjects USING (message_id, variant_id)
  JOIN (SELECT message_id, StartDate, Category FROM live) USING (message_id)
)"""
PUSH_COLUMNS = f"""StartDate, Sent, Open, Held_Back, Bounce, {rates(PUSH_RATES)}"""


def push_report_sql(app_column: str, apps: str) -> str:
    return f"""SELECT {app_column} AS App, t.app_id, t.message_id, coalesce(nullif(live_name, ''), n.name) AS MessageName,
  {PUSH_COLUMNS}, {link("t.app_id", "t.message_id")} AS MessageLink
FROM push_totals t JOIN push_names n USING (app_id, message_id) JOIN {apps} a ON a.app_id = t.app_id
JOIN live ON live.message_id = t.message_id WHERE Sent > 0"""


PUSH_ALL = push_report_sql("a.App", "listing")
LIVE_APPS = "(SELECT app_id, replace(name, '/', '-') AS App FROM live_app)"


def rate_rows() -> str:
    return f"""rate_rows AS (
  SELECT app_id, message_id, {rates(EMAIL_RATES)}
  FROM subject_totals JOIN subject_uniques USING (app_id, message_id)
)"""


def csv_select() -> str:
    columns = [
        "MessageName", "SenderDomain", "Domain", "StartDate", "Type", "Category", "MessageLink",
    ]
    numbers = [f"CAST({c} AS VARCHAR) AS {c}" for c in SUMMED]
    shown = [f"{display(c)} AS {c}" for c in EMAIL_RATES]
    name = "'EmailData_' || App || '_20240101_20240130_domain' AS report"
    return ", ".join([*columns, *numbers, *shown, name, "CAST(app_id AS VARCHAR) AS app_id"])


def oracles() -> dict[str, str]:
    email, push = EMAIL_COUNTERS, PUSH_COUNTERS
    return {
        "src_sessions_range": query("""
SELECT CAST(l.dt AS VARCHAR) AS dt, l.app_id, count(DISTINCT l.event_id) AS sessions, count(*) AS events
FROM occurrence l WHERE l.dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-24' GROUP BY l.dt, l.app_id"""),
        "src_snapshots_range": query(f"""
SELECT message_id, app_id, name, action_type, CAST(delivery_type AS BIGINT) AS delivery_type, category_id,
  CAST(dt AS VARCHAR) AS dt FROM study WHERE dt {WINDOW}"""),
        "src_app_asof": query(f"""
SELECT app_id, company_id, name, email_from_address FROM app WHERE dt = {LAST_DAY}"""),
        "src_ingest_snapshots": query("""
SELECT 'Study' AS model, CAST(dt AS VARCHAR) AS dt, message_id AS id, name AS text FROM study
UNION ALL
SELECT 'Experiment', CAST(dt AS VARCHAR), variant_id, min(text) FILTER (var_name = 'Subject') FROM vars
GROUP BY dt, variant_id
UNION ALL
SELECT 'App', CAST(dt AS VARCHAR), app_id, email_from_address FROM app WHERE dt <> DATE '2024-01-11'"""),
        "dim_study_latest": query(
            "SELECT message_id, app_id, name, action_type, CAST(dt AS VARCHAR) AS dt FROM live_study"),
        "dim_message_ids": query("""
SELECT 'email' AS channel, * FROM email_ids UNION ALL SELECT 'push', * FROM push_ids"""),
        "src_unnest_ids": query("""
SELECT message_id, label, count(*) AS occurrence FROM msg
WHERE message_id IN (SELECT 4500000000000000 + unnest(range(40))) GROUP BY message_id, label"""),
        "sink_report_csv": query(f"SELECT {csv_select()} FROM domain_report", *DOMAIN_CTES),
        "sink_rerun": query(f"SELECT {csv_select()} FROM domain_report WHERE app_id % 2 = 0", *DOMAIN_CTES),
        "interval_latest": query(
            "SELECT message_id, app_id, name, action_type, CAST(dt AS VARCHAR) AS dt FROM live_study"),
        "interval_definition": query("SELECT message_id, name, Type FROM definition"),
        "interval_as_of": query("""
SELECT m.app_id, m.message_id, m.day, m.occurrence, s.name, s.action_type, s.category_id
FROM (SELECT app_id, message_id, day, count(*) AS occurrence FROM msg GROUP BY app_id, message_id, day) m
JOIN study s ON s.app_id = m.app_id AND s.message_id = m.message_id
  AND s.dt = (SELECT max(dt) FROM snap WHERE dt <= CAST(m.day AS DATE))"""),
        "sessions_clustered": query("""
SELECT dt, app_id, sessions, events FROM (SELECT CAST(dt AS VARCHAR) AS dt, app_id, count(*) AS events FROM occurrence GROUP BY dt, app_id)
JOIN (SELECT CAST(dt AS VARCHAR) AS dt, app_id, count(*) AS sessions FROM session GROUP BY dt, app_id) USING (dt, app_id)"""),
        "evt_causes": query(f"""
SELECT app_id, count(*) AS events, count(*) FILTER (name IS NULL) AS nameless,
  count(*) FILTER (NOT starts_with(name, '.m')) AS foreign,
  count(*) FILTER (starts_with(name, '.m') AND id IS NULL) AS bad_ids,
  count(*) FILTER (starts_with(name, '.m') AND id IS NOT NULL AND NOT known) AS unknown_labels,
  count(*) FILTER (starts_with(name, '.m') AND id IS NOT NULL AND known) AS counted,
  count(*) FILTER (starts_with(name, '.m') AND id IS NOT NULL AND time IS NULL) AS bad_times
FROM (SELECT app_id, name, time, try_cast(substr(name, 3, 16) AS BIGINT) AS id,
  substr(name, 20) IN ('', {", ".join(f"'{label}'" for label in sorted(EMAIL_COUNTERS.keys() | PUSH_COUNTERS.keys()))}) AS known FROM occurrence)
GROUP BY app_id"""),
        "domain_report_stored": query("SELECT * FROM domain_report", *DOMAIN_CTES),
        "nest_events": query("""
SELECT user_id, app_id, CAST(dt AS VARCHAR) AS dt, name, CAST(floor(time) AS BIGINT) AS second FROM occurrence"""),
        "nest_event_variants": query("""
SELECT app_id, user_id, message_id, label, variant_id FROM msg LEFT JOIN taken USING (event_id)"""),
        "nest_vars": query("""
SELECT variant_id, message_id, CAST(dt AS VARCHAR) AS dt, var_name, text FROM vars
WHERE var_name IN ('Subject', 'Sender email')"""),
        "nest_email_attr": query("SELECT user_id, app_id, email, CAST(dt AS VARCHAR) AS dt FROM session"),
        "dim_category": query("SELECT message_id, Category FROM live", LIVE),
        "flt_message_events": query("""
SELECT name, count(*) AS events FROM occurrence WHERE name LIKE '.m%' GROUP BY name"""),
        "flt_company_apps": query("SELECT company_id, app_id, App FROM listing"),
        "flt_scope": query(f"""
SELECT 'company' AS scope, * FROM ({push_report_sql("a.App", "(SELECT * FROM listing WHERE company_id = 15)")})
UNION ALL
SELECT 'app', * FROM ({push_report_sql("a.App", f"(SELECT * FROM {LIVE_APPS} WHERE app_id = 1)")})""",
                           PUSH_TOTALS, LIVE),
        "ab_variant_subjects": query("SELECT variant_id, message_id, variant_subject FROM variant_subjects"),
        "ab_variant_messages": query("SELECT variant_id, message_id FROM variant_map"),
        "str_domain": query(f"""
SELECT email, CASE WHEN regexp_extract(email, '@(.+)', 1) IN ({DOMAINS})
  THEN regexp_extract(email, '@(.+)', 1) ELSE 'Other' END AS Domain, count(*) AS sessions
FROM session GROUP BY ALL"""),
        "win_latest_study": query("SELECT message_id, name, Type FROM definition"),
        "str_parse_event": query("SELECT name, message_id, label, count(*) AS events FROM msg GROUP BY ALL"),
        "dt_event_day": query("SELECT day, label, count(*) AS events FROM msg GROUP BY day, label"),
        "str_delivery_type": query(f"""
SELECT DISTINCT message_id, CAST(delivery_type AS BIGINT) AS delivery_type,
  CASE delivery_type {TYPE_CASE} ELSE 'Unknown' END AS Type FROM study"""),
        "str_sender_domain": query("""
SELECT message_id, sender, CASE WHEN contains(sender, '@') THEN regexp_replace(sender, '.*@', '') END AS SenderDomain
FROM senders"""),
        "dt_start_date": query("SELECT message_id, StartDate FROM live", LIVE),
        "num_rates": query("SELECT * FROM rate_rows", SUBJECT_TOTALS, SUBJECT_UNIQUES, rate_rows()),
        "str_pct_display": query(
            "SELECT app_id, message_id, " + ", ".join(f"{display(c)} AS {c}_display" for c in EMAIL_RATES)
            + " FROM rate_rows", SUBJECT_TOTALS, SUBJECT_UNIQUES, rate_rows()),
        "str_message_link": query(f"SELECT app_id, message_id, {link()} AS MessageLink FROM live_study"),
        "ab_totals": query("SELECT * FROM ab_totals", AB_TOTALS),
        "join_email_events": query(counted("email_msg", "app_id, message_id")),
        "join_push_events": query(counted("push_msg", "app_id, message_id")),
        "join_domain_study": query(
            "SELECT * FROM domain_totals JOIN definition USING (message_id)", DOMAIN_TOTALS),
        "join_subject_lines": query(
            "SELECT t.*, Subject FROM subject_totals t JOIN subjects USING (message_id)", SUBJECT_TOTALS),
        "join_sender": query("""
SELECT message_id, app_id, coalesce(nullif(sender, ''), default_sender, '') AS sender
FROM email_ids LEFT JOIN senders USING (message_id) JOIN listing USING (app_id)"""),
        "dim_push_names": query("SELECT app_id, message_id, name FROM push_names"),
        "agg_events_by_email": query(counted("msg", "app_id, message_id, email")),
        "agg_push_events": query(counted("msg", "app_id, message_id")),
        "agg_events_by_day": query(counted("msg", "app_id, message_id, day")),
        "agg_domain_events": query(counted("email_msg", "app_id, message_id, Domain")),
        "pivot_domain": query("SELECT * FROM domain_totals", DOMAIN_TOTALS),
        "pivot_subject": query("SELECT * FROM subject_totals", SUBJECT_TOTALS),
        "pivot_push": query("SELECT * FROM push_totals", PUSH_TOTALS),
        "uniq_domain": query("SELECT * FROM domain_uniques", DOMAIN_UNIQUES),
        "uniq_subject": query("SELECT * FROM subject_uniques", SUBJECT_UNIQUES),
        "uniq_ab": query("SELECT * FROM ab_uniques", AB_UNIQUES),
        "domain_all_rows": query("SELECT * FROM with_all", DOMAIN_TOTALS, DOMAIN_UNIQUES, WITH_ALL),
        "domain_report": query("SELECT * FROM domain_report", *DOMAIN_CTES),
        "subject_report": query(
            "SELECT * FROM subject_report", SUBJECT_TOTALS, SUBJECT_UNIQUES, LIVE, SUBJECT_REPORT),
        "ab_report": query(
            "SELECT * FROM plain_rows UNION ALL BY NAME SELECT * FROM variant_rows",
            SUBJECT_TOTALS, SUBJECT_UNIQUES, AB_TOTALS, AB_UNIQUES, LIVE, SUBJECT_REPORT, AB_ROWS),
        "push_report": query(PUSH_ALL, PUSH_TOTALS, LIVE),
    }
