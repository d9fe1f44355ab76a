"""A small hand-written world, stored as the engine reads it."""

from __future__ import annotations

import datetime as dt

from sendstats.sources.schemas import SESSIONS, SNAPSHOTS

DELETED = 4500000000000777
DAY1, DAY2, AFTER = dt.date(2024, 3, 1), dt.date(2024, 3, 3), dt.date(2024, 3, 9)
START, END = "20240301", "20240303"
MAIL, MAIL_B, LATE, SILENT, UNDELIVERED, MOVED = (4500000000000000 + n for n in range(1, 7))
PUSH, PUSH_B, OTHER_APP = (4500000000000000 + n for n in range(11, 14))


def at(day: dt.date, seconds: float = 0.0) -> float:
    return dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp() + seconds


def moment(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day, 23, 30, tzinfo=dt.timezone.utc)


def event(message: int, label: str, time: float) -> tuple:
    return (f".m{message}" + (f" {label}" if label else ""), time)


def session(user, app, day, events, email=None, variants=()):
    return (user, app, [(events[:1],), (None,), (events[1:],)], ["x", email], [(v,) for v in variants], day)


def sessions():
    t1, t2 = at(DAY1, 60), at(DAY2, 60)
    sent = [event(MAIL, "", t1), event(MAIL, "Delivered", t1), event(MAIL, "Open", t1), event(MAIL, "Open", t1)]
    return [
        session(1, 1, DAY1, sent, "One@Gmail.com", [71]),
        # The same user under a second address on the same day.
        session(1, 1, DAY1, [event(MAIL, "Open", t1), event(MAIL, "Click", t1)], "one@corp.example", [72]),
        session(1, 1, DAY2, [event(MAIL, "Open", t2)], "one@gmail.com", [71, 71]),
        session(2, 1, DAY1, [event(MAIL, "", t1), event(MAIL, "Bounce", t1), ("session end", t1)], None, [72, 99]),
        # Opened in the last tenth of a second of the day, then on the next one.
        session(2, 1, DAY1, [event(MAIL_B, "", t1), event(MAIL_B, "Delivered", t1),
                             event(MAIL_B, "Open", at(DAY2) - 0.1), event(MAIL_B, "Open", at(DAY2))], "no-at-sign"),
        session(3, 1, DAY1, [event(SILENT, "Open", t1)], "c@qq.com"),
        session(3, 1, DAY1, [event(UNDELIVERED, "", t1)], "c@qq.com"),
        session(3, 1, DAY1, [event(MOVED, "", t1), event(MOVED, "Delivered", t1)], "c@qq.com"),
        session(3, 1, DAY1, [event(LATE, "", t1), event(DELETED, "", t1)], "c@qq.com"),
        session(3, 1, DAY1, [(".mxxxxxxxxxxxxxxxx Open", t1), event(4500000000000999, "", t1)], "c@qq.com"),
        # Another app's message in this app's sessions is not counted.
        session(3, 1, DAY1, [event(OTHER_APP, "", t1)], "c@qq.com"),
        session(4, 1, DAY1, [event(PUSH, "", t1), event(PUSH, "Open", t1), event(PUSH, "Held Back", t1)]),
        session(4, 1, DAY2, [event(PUSH, "", t2), event(PUSH, "", t2), event(PUSH, "Bounce", t2)]),
        session(4, 1, DAY2, [event(PUSH_B, "Open", t2)]),
        session(5, 2, DAY2, [event(OTHER_APP, "", t2), event(OTHER_APP, "Delivered", t2)], "d@qq.com"),
        # Outside of the window.
        session(6, 1, AFTER, [event(MAIL, "", at(AFTER)), event(PUSH, "", at(AFTER))], "e@qq.com"),
    ]


def carried(rows):
    """Adds what the last snapshot lacks: it lists all there is, changed or not."""
    newest = {r[0]: r for r in rows}
    return rows + [(*r[:-1], AFTER) for r in newest.values() if r[-1] != AFTER]


def studies():
    def row(message, name, kind, day, app=1, changed=DAY1, since=DAY1, category=None, delivery=0):
        return ((message,), (app,), name, kind, delivery, moment(changed), since and moment(since), category, day)

    mail, push = "__Email", "__Push Notification"
    kept = [
        row(MAIL, "Hello", mail, DAY1, category=2, delivery=3),
        row(MAIL, "Hello, \"again\"", mail, DAY2, changed=DAY2, category=2, delivery=4),
        row(MAIL, "Hello live", mail, AFTER, changed=AFTER, category=1),
        row(MAIL_B, "tie a", mail, DAY1, since=None), row(MAIL_B, "tie b", mail, DAY2, since=None, category=9),
        row(LATE, "made after the window", mail, AFTER),
        row(SILENT, "only opened", mail, DAY1), row(UNDELIVERED, "lost", mail, DAY1, delivery=7),
        row(MOVED, "was mail", mail, DAY1), row(MOVED, "is in-app", "__In App", AFTER),
        row(PUSH, "ping", push, DAY1), row(PUSH, "ping 2", push, DAY2), row(PUSH, "", push, AFTER),
        row(PUSH_B, "never sent", push, DAY1),
        row(OTHER_APP, "other", mail, DAY1, app=2),
    ]
    # One message was deleted, and is none of the reports' any more.
    return carried(kept) + [row(DELETED, "gone", mail, DAY1)]


def experiments():
    def row(variant, message, day, **names):
        found = [(name.replace("_", " "), (text,)) for name, text in names.items()]
        if "Arm" in names:
            found[-1] = (f"__message__{message}.Subject", (names["Arm"],))
        if variant in (71, 72):
            found.append((f"__message__{message}", ("",)))
        return ((variant,), (message,), found, day)

    return [
        row(71, MAIL, DAY1, Subject="Hi", Sender_email="old@first.example"),
        row(71, MAIL, DAY2, Subject="Hi 2", Sender_email="me@here@new.example", Arm="Arm A"),
        row(72, MAIL, DAY2, Subject="Hi 2"),
        row(81, MAIL_B, DAY1, Subject="B", Sender_email=""),
        row(82, LATE, DAY1, Subject="L"), row(83, SILENT, DAY1, Subject="S"),
        row(84, UNDELIVERED, DAY1, Subject="U"), row(85, MOVED, DAY1, Subject="M"),
        row(86, OTHER_APP, DAY1, Subject="O", Sender_email="plain-name"),
    ]


def apps():
    def row(app, company, name, day, default):
        return ((app,), (company,), name, default, "mail", ["first", "mail"], [(1, "News"), (2, "Promo")], day)

    return [
        row(1, 50, "Shop/EU", DAY2, "d1@shop.example"),
        row(1, 50, "Shop live", AFTER, "new@shop.example"),
        row(2, 51, "Games", DAY2, "d2@games.example"),
        row(2, 51, "Games", AFTER, "d2@games.example"),
        row(3, 50, "Gone before the last day", DAY1, "d3@x.example"),
    ]


def write(spark, root: str) -> str:
    tables = {
        "sessions": (sessions(), SESSIONS["all"]),
        "Study": (studies(), SNAPSHOTS["Study"]),
        "Experiment": (experiments(), SNAPSHOTS["Experiment"]),
        "App": (apps(), SNAPSHOTS["App"]),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.partitionBy("dt").parquet(f"{root}/{name}")
    return root
