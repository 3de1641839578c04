"""The report's star schema, prepared from the extract files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.dates import clock_time, date_key, hour_label, whole_seconds
from boxoffice.operators.metrics import event_ticket_total

# Ticket phases, and age bands by lower bound with their order.
PHASE_LABELS = {1: "Super Early Bird", 2: "Early Bird", 3: "Standard", 4: "Late"}
AGE_BANDS = [
    (70, "70 and Above", 7),
    (60, "60 - 69", 6),
    (50, "50 - 59", 5),
    (40, "40 - 49", 4),
    (30, "30 - 39", 3),
    (25, "25 - 29", 2),
    (16, "16 - 24", 1),
]
OTHER_AGES = ("Others", 8)


def named_events(events: DataFrame, cutoff: dt.date) -> DataFrame:
    """Events with an open flag as of ``cutoff``."""
    is_open = F.coalesce((F.col("closeDate") > F.lit(cutoff)).cast("int"), F.lit(0))
    return (
        events.withColumnsRenamed({"ticket_open_date2": "openDate", "ticket_close_date": "closeDate"})
        .withColumn("isOpening", is_open)
        .withColumn("statusSlicer", F.when(F.col("isOpening") == 0, "Closed").otherwise("Opening"))
    )


def dim_events(events: DataFrame, fact: DataFrame, cutoff: dt.date) -> DataFrame:
    """Events with an open flag as of ``cutoff`` and their total of tickets sold."""
    return event_ticket_total(named_events(events, cutoff), fact)


def dim_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.select(
        F.col("ticket_id").alias("id"),
        F.col("event_id").alias("eventID"),
        "distance",
        F.col("phase_id").alias("phaseID"),
        "price",
    )


def phase_label(phase_id: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for key, label in PHASE_LABELS.items():
        out = out.when(phase_id == key, label)
    return out.otherwise("Others")


def dim_ticket_phase(tickets: DataFrame) -> DataFrame:
    phases = tickets.select(F.col("phase_id").alias("phaseID")).distinct()
    return phases.withColumn("phase", phase_label(F.col("phaseID")))


def age_on(dob: Column, day: Column) -> Column:
    """Years of 365 days, rounded up."""
    return F.ceil(F.date_diff(day, dob) / 365).cast("int")


def age_group(age: Column) -> tuple[Column, Column]:
    """The age band and its order. An unknown age belongs to the last band."""
    label, order = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(0))
    for lowest, name, place in AGE_BANDS:
        label, order = label.when(age >= lowest, name), order.when(age >= lowest, place)
    return label.otherwise(OTHER_AGES[0]), order.otherwise(OTHER_AGES[1])


def dim_customers(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Customers with date keys, times of day and their age as of a given date."""
    age = age_on(F.col("dob"), F.lit(as_of))
    label, order = age_group(F.col("age"))
    return (
        customers.select(
            F.col("customer_id").alias("id"),
            F.col("date_of_birth").alias("dob"),
            "city",
            "state",
            "gender",
            clock_time(F.col("created_at")).alias("creationTime"),
            clock_time(F.col("last_login_at")).alias("lastLoginTime"),
            date_key(F.col("created_at")).alias("creationDateID"),
            date_key(F.col("last_login_at")).alias("lastLoginDateID"),
        )
        .withColumn("age", age)
        .withColumn("ageGroup", label)
        .withColumn("ageGroupOrder", order)
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    """One row per order with 1/0 status, date keys and the hour of purchase.

    ``checkoutTime`` is the minutes part of the duration: 5 for an hour and five minutes.
    The two date columns next to their keys are there for date arithmetic.
    """
    created, completed = F.col("created_at"), F.col("completed_at")
    status = F.replace(
        F.replace("order_status", F.lit("succeeded"), F.lit("1")), F.lit("failed"), F.lit("0")
    )
    seconds = whole_seconds(created, completed)
    minutes = F.signum(seconds) * (F.floor(F.abs(seconds) / 60) % 60)
    return orders.select(
        date_key(created).alias("creationDateID"),
        clock_time(created).alias("creationTime"),
        date_key(completed).alias("purchaseDateID"),
        hour_label(completed).alias("purchaseTOD"),
        F.hour(completed).alias("todSort"),
        F.col("order_id").alias("id"),
        F.col("customer_id").alias("customerID"),
        F.col("ticket_id").alias("ticketID"),
        F.col("event_id").alias("eventID"),
        F.col("total_tickets").alias("totalTickets"),
        "discount",
        "price",
        status.cast("int").alias("orderStatus"),
        F.col("payment_method").alias("paymentMethod"),
        minutes.cast("int").alias("checkoutTime"),
        F.to_date(created).alias("creationDate"),
        F.to_date(completed).alias("purchaseDate"),
    )


def calendar_bounds(fact: DataFrame) -> DataFrame:
    """One row: the first day of the first year and the last day of the last year in use."""
    ends = fact.agg(
        F.least(F.min("creationDate"), F.min("purchaseDate")).alias("lo"),
        F.greatest(F.max("creationDate"), F.max("purchaseDate")).alias("hi"),
    )
    return ends.select(
        F.trunc("lo", "year").alias("lo"),
        F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("hi"),
    )


def dim_calendar(bounds: DataFrame, as_of: dt.date) -> DataFrame:
    """Every day from ``lo`` to ``hi`` with its names, keys and offsets from ``as_of``."""
    d, a = F.col("date"), F.lit(as_of)
    years = F.year(d) - F.year(a)
    year_text = F.year(d).cast("string")
    quarter_text = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date")).select(
        date_key(d).alias("dateID"),
        "date",
        F.date_format(d, "E").alias("dayOfWeekShort"),
        F.date_format(d, "EEEE").alias("dayOfWeekLong"),
        (F.weekday(d) + 1).alias("dayOfWeekInt"),
        F.date_format(d, "dd").alias("dayOfMonth"),
        F.date_diff(d, a).alias("currDayOffset"),
        F.month(d).alias("monthInt"),
        F.date_format(d, "MMM").alias("monthShort"),
        F.date_format(d, "MMMM").alias("monthLong"),
        (12 * years + F.month(d) - F.month(a)).alias("currMonthOffset"),
        F.date_format(d, "yyyyMM").alias("yearMonthInt"),
        F.date_format(d, "MMM yyyy").alias("yearMonthShort"),
        F.date_format(d, "MMMM yyyy").alias("yearMonthLong"),
        F.quarter(d).alias("quarterInt"),
        quarter_text.alias("quarterTxt"),
        (4 * years + F.quarter(d) - F.quarter(a)).alias("currQuarterOffset"),
        F.concat(year_text, F.quarter(d).cast("string")).alias("yearQuarterInt"),
        F.concat_ws(" ", year_text, quarter_text).alias("yearQuarterTxt"),
        F.year(d).alias("year"),
        years.alias("currYearOffset"),
    )
