"""Email addresses, recipient domains, delivery types and message texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recipient domains that get a row of their own.
LISTED_DOMAINS = (
    "gmail.com",
    "msn.com",
    "hotmail.com",
    "yahoo.com",
    "aol.com",
    "163.com",
    "etlgr.com",
    "hotmail.co.th",
    "icloud.com",
    "live.com",
    "me.com",
    "naver.com",
    "outlook.com",
    "qq.com",
    "rocketmail.com",
    "yahoo.co.id",
    "yahoo.co.uk",
    "yahoo.com.my",
    "yahoo.com.ph",
    "yahoo.com.sg",
    "yahoo.com.vn",
    "ymail.com",
)
OTHER_DOMAIN = "Other"

# Delivery type codes.
DELIVERY_TYPES = {
    0: "Immediate",
    1: "Future",
    2: "Manual",
    3: "Triggered Local",
    4: "Triggered Server",
    5: "Recurring",
}

# Action types of the two reported channels.
EMAIL = "__Email"
PUSH = "__Push Notification"


def recipient_domain(email: str) -> Column:
    """Domain after the first ``@`` when listed, else ``Other`` (also for NULL)."""
    domain = f"regexp_extract({email}, '@(.+)', 1)"
    listed = ", ".join(f"'{name}'" for name in LISTED_DOMAINS)
    return F.expr(f"CASE WHEN {domain} IN ({listed}) THEN {domain} ELSE '{OTHER_DOMAIN}' END")


def sender_domain(address: Column) -> Column:
    """Text after the last ``@``; NULL without one."""
    return F.when(address.contains("@"), F.substring_index(address, "@", -1))


def delivery_type(code: Column) -> Column:
    named = F.lit("Unknown")
    for value, name in DELIVERY_TYPES.items():
        named = F.when(code == value, name).otherwise(named)
    return named


def message_name(name: Column, sender: Column) -> Column:
    return F.concat(name, F.lit(" ("), sender, F.lit(")"))


def variant_subject(subject: Column, variant_id: Column) -> Column:
    return F.concat(subject, F.lit(" --Variant "), variant_id.cast("string"))


def message_link(base_url: str, app_id: Column, message_id: Column) -> Column:
    app = app_id.cast("string")
    return F.concat(
        F.lit(f"{base_url}?appId="), app, F.lit("#/"), app,
        F.lit("/messaging/"), message_id.cast("string"),
    )


def file_safe(name: Column) -> Column:
    return F.translate(name, "/", "-")


def category_name(categories: Column, category_id: Column) -> Column:
    """Name of the first category with this id, else ``Default``."""
    found = F.get(F.filter(categories, lambda c: c["id"] == category_id), F.lit(0))
    return F.coalesce(found["name"], F.lit("Default"))
