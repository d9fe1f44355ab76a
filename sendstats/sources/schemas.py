"""Read schemas.

They are given to the reader instead of being inferred: Spark does not prune
struct fields below two explode levels, so a report that needs only event names
has to ask for only event names.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _nested_id(name: str) -> T.StructField:
    return T.StructField(name, T.StructType([T.StructField("id", T.LongType())]))


def _states(*fields: T.StructField) -> T.StructField:
    event = T.ArrayType(T.StructType(list(fields)))
    return T.StructField("states", T.ArrayType(T.StructType([T.StructField("events", event)])))


_DT = T.StructField("dt", T.DateType())
_APP = T.StructField("app_id", T.LongType())
_USER = T.StructField("user_id", T.LongType())
_NAME = T.StructField("name", T.StringType())
_TIME = T.StructField("time", T.DoubleType())
_ATTRS = T.StructField("attrs", T.ArrayType(T.StringType()))
_EXPERIMENTS = T.StructField(
    "experiments", T.ArrayType(T.StructType([T.StructField("variant", T.LongType())]))
)

# The session columns each report reads.
SESSIONS = {
    "push": T.StructType([_APP, _states(_NAME), _DT]),
    "subject": T.StructType([_USER, _APP, _states(_NAME, _TIME), _DT]),
    "ab": T.StructType([_USER, _APP, _states(_NAME, _TIME), _EXPERIMENTS, _DT]),
    "domain": T.StructType([_USER, _APP, _states(_NAME, _TIME), _ATTRS, _DT]),
    "all": T.StructType([_USER, _APP, _states(_NAME, _TIME), _ATTRS, _EXPERIMENTS, _DT]),
}

# Snapshot rows as they are stored, with nested keys.
SNAPSHOTS = {
    "Study": T.StructType([
        _nested_id("__key__"),
        _nested_id("app"),
        T.StructField("name", T.StringType()),
        T.StructField("action_type", T.StringType()),
        T.StructField("delivery_type", T.IntegerType()),
        T.StructField("last_change_time", T.TimestampType()),
        T.StructField("active_since", T.TimestampType()),
        T.StructField("category_id", T.LongType()),
        _DT,
    ]),
    "Experiment": T.StructType([
        _nested_id("__key__"),
        _nested_id("study"),
        T.StructField("vars", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("value", T.StructType([T.StructField("text", T.StringType())])),
        ]))),
        _DT,
    ]),
    "App": T.StructType([
        _nested_id("__key__"),
        _nested_id("company"),
        T.StructField("name", T.StringType()),
        T.StructField("email_from_address", T.StringType()),
        T.StructField("email_user_attribute", T.StringType()),
        T.StructField("attribute_columns", T.ArrayType(T.StringType())),
        T.StructField("unsubscribe_categories", T.ArrayType(T.StructType([
            T.StructField("id", T.LongType()),
            T.StructField("name", T.StringType()),
        ]))),
        _DT,
    ]),
}

# Flat name of every nested key, per model.
FLAT_KEYS = {
    "Study": {"message_id": "__key__.id", "app_id": "app.id"},
    "Experiment": {"variant_id": "__key__.id", "message_id": "study.id"},
    "App": {"app_id": "__key__.id", "company_id": "company.id"},
}
