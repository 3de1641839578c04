"""Cleaning of the dumps on their way into the raw tables.

Sale orders, order items and attendants are loaded as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.dates import parse_date
from boxoffice.functions.text import replace_text, title_case
from boxoffice.operators.dedup import keep_first, keep_latest

# Spark pattern letters, first fit counts: a closed list for dumps whose forms are known.
BIRTHDAY_FORMATS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "M/d/yyyy",
    "d/M/yyyy",
    "M-d-yyyy",
    "d-M-yyyy",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m:s.SSS",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
)


def raw_customers(dump: DataFrame, this_year: int | None = None) -> DataFrame:
    """Birthdays read from text of any format, else null; ``vietnam`` in the nationality becomes ``VN``.

    Years of two digits are taken to be near ``this_year``, by default the current one.
    """
    this_year = this_year or dt.date.today().year
    return dump.withColumns(
        {
            "birthday": parse_date(F.col("birthday"), this_year),
            "nationality": replace_text(F.col("nationality"), "vietnam", "VN"),
        }
    )


def raw_organizers(dump: DataFrame) -> DataFrame:
    """One row per merchant, with its name in title case."""
    named = dump.select("merchant_id", title_case(F.col("merchant_name_en")).alias("merchant_name_en"))
    return keep_first(named, ["merchant_id"])


def raw_events(dump: DataFrame) -> DataFrame:
    """Real timestamps and title-cased texts; a bad timestamp is an error."""
    return dump.withColumns(
        {
            "start_date": F.col("start_date").cast("timestamp_ntz"),
            "end_date": F.col("end_date").cast("timestamp_ntz"),
            "event_name": title_case(F.col("event_name")),
            "event_type": title_case(F.col("event_type")),
        }
    )


def raw_order_events(dump: DataFrame) -> DataFrame:
    """One row per event and merchant."""
    return keep_first(dump, ["event_id", "merchant_id"])


def raw_login(dump: DataFrame) -> DataFrame:
    """The latest login of each known customer."""
    parsed = dump.withColumns(
        {
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "updated_at": F.col("updated_at").cast("timestamp_ntz"),
        }
    )
    return keep_latest(parsed, "customer_code", "updated_at")
