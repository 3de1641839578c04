"""The warehouse models, staged tables first and marts after them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.dates import date_key, hour_label, whole_minutes, whole_seconds
from boxoffice.functions.text import code_label, contains_any_case, extract_or_null, lacks_words
from boxoffice.operators.joins import in_values, not_in, with_membership

# Status of a paid order, and the words that make an event a sports event.
SUCCESS = "dat_hang_thanh_cong"
SPORTS = "(run|marathon|trail|tri|duathlon|race)"

# Accepted forms of an event date, and their Spark patterns.
EVENT_DATES = [
    ("^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy"),
    ("^[0-9]{2} [a-zA-Z]{3} [0-9]{4}$", "dd MMM yyyy"),
    ("^[0-9]{2} [a-zA-Z]{3}, [0-9]{4}$", "dd MMM, yyyy"),
]

# Words removed from a phase name, and the first matching rule that names a phase.
PHASE_NOISE = "TICKETS|TICKET|COMERS|COMER|PRICE|PACKAGE"
PHASE_RULES = [
    ("ĐĂNG KÝ SIÊU SỚM|SUPER BIRD", "SUPER EARLY BIRD"),
    ("SỚM|EARLR|EARLY BIRD|EARLY|EARLY SHARK|VÉ ĐĂNG KÝ SỚM|ĐĂNG KÝ SỚM", "EARLY BIRD"),
    ("ĐĂNG KÝ SIÊU TRỄ|SUPPER LATE|LATEST REGISTRATION", "SUPER LATE"),
    ("ĐĂNG KÝ TRỄ|LATE GR|GR LATE", "LATE"),
    (
        "STANDARD|STANDAR|GENERAL|BASIC|VÉ TIÊU CHUẨN|VÉ CƠ BẢN|ĐĂNG KÝ TIÊU CHUẨN|REGULAR  1",
        "REGULAR",
    ),
    ("FLASH SALES|BLACK FRIDAY|FLASH SALE", "FLASH SALES"),
    ("PRESALES", "PRE-SALES"),
]
PHASES = [name for _, name in PHASE_RULES]


def stg_organizers(organizers: DataFrame) -> DataFrame:
    return organizers.select(
        F.col("merchant_id").alias("id"), F.col("merchant_name_en").alias("organizer_name")
    )


def event_date(text: Column) -> Column:
    """The start date written in a free text: the text itself, or what follows the first ' - '."""
    after_dash = F.regexp_replace(extract_or_null(text, " - (.*)"), "[, ]{2,}", " ")
    day = F.when(~text.like("%-%"), text).otherwise(after_dash)
    return F.coalesce(*[F.when(day.rlike(p), F.try_to_date(day, f)) for p, f in EVENT_DATES])


def stg_events(order_events: DataFrame, events: DataFrame) -> DataFrame:
    """Registered events with their organiser, plus events known from orders only.

    The rule that a registered event must not be an orders-only event needs no join: if
    there are orders-only events at all, none of them is registered and no registered
    event lacks its id; and if there are none, the rule excludes nothing.
    """
    name = F.col("event_name_en")
    sold = order_events.where(
        lacks_words(name, "test") & lacks_words(F.col("merchant_name_en"), "test")
    ).select(
        "event_id",
        name.alias("event_name"),
        F.when(F.lower(name).rlike(SPORTS), "Sports").otherwise("Others").alias("event_type"),
        F.col("merchant_id").alias("organizer_id"),
        event_date(F.col("time_en")).alias("start_date"),
    )
    sold = sold.withColumn("end_date", F.date_add("start_date", 2))

    orders_only = not_in(sold, "event_id", events, "event_id")
    listed = events.where(lacks_words(F.col("event_name"), "demo", "email", "test"))
    organiser = sold.select(F.col("event_id").alias("_event"), "organizer_id")
    registered = listed.join(organiser, F.col("event_id") == F.col("_event"), "left").select(
        F.col("event_id").alias("id"),
        "event_name",
        "event_type",
        "organizer_id",
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
    )
    return registered.unionByName(orders_only.withColumnRenamed("event_id", "id")).distinct()


def _if_paid(c: str) -> Column:
    return F.when(F.col("order_status") == SUCCESS, F.col(c)).otherwise(0)


def stg_orders(sale_orders: DataFrame, order_items: DataFrame, events: DataFrame) -> DataFrame:
    """Order items of known events with the money of paid orders.

    ``checkout_time`` counts from purchase back to creation, so an order that was paid
    after it was created has 0 minutes; without a purchase date it is absent. What depends
    on the order alone is computed once per order, before its items are joined.
    """
    minutes = whole_minutes(F.col("purchased_at"), F.col("created_at"))
    orders = in_values(
        sale_orders.where(F.col("merchant_id").isNotNull()), "event_id", events, "id"
    ).select(
        date_key(F.col("purchased_at")).alias("date_id"),
        F.col("code").alias("order_id"),
        "event_id",
        F.col("customer_code").alias("customer_id"),
        "order_status",
        code_label(F.col("payment_method")).alias("payment_method"),
        F.when((minutes < 0) | (minutes > 15), 0).otherwise(minutes).alias("checkout_time"),
        hour_label(F.col("purchased_at")).alias("order_tod"),
    )
    items = order_items.select(
        F.col("order_code").alias("order_id"),
        "quantity",
        "subtotal",
        "discount_amount",
        "grand_total",
    )
    return orders.join(items, "order_id").select(
        "date_id",
        "order_id",
        "event_id",
        "customer_id",
        "quantity",
        _if_paid("subtotal").alias("gross_revenue"),
        _if_paid("discount_amount").alias("discount"),
        _if_paid("grand_total").alias("net_revenue"),
        "order_status",
        "payment_method",
        "checkout_time",
        "order_tod",
    )


def stg_customers(customers: DataFrame, login: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers with their account type, a checked nationality and date keys."""
    account = login.select(F.col("customer_code").alias("code"), "type")
    known = with_membership(customers, "nationality", countries, "alpha2_code", "is_country")
    return known.join(account, "code", "left").select(
        F.col("code").alias("id"),
        "is_activated",
        F.coalesce("type", F.lit("Website")).alias("account_type"),
        F.when(F.col("is_country"), F.col("nationality")).alias("nationality"),
        F.col("birthday").cast("date").alias("birthday"),
        date_key(F.col("created_at")).alias("creation_date_id"),
        hour_label(F.col("created_at")).alias("created_at_tod"),
        date_key(F.col("last_login_at")).alias("last_login_date_id"),
        hour_label(F.col("last_login_at")).alias("last_login_tod"),
    )


def clean_phase(phase: Column) -> Column:
    """Drop noise words and unify two spellings. The order of the three steps matters."""
    bare = F.regexp_replace(phase, PHASE_NOISE, "")
    return F.replace(
        F.replace(bare, F.lit(" GR"), F.lit("GR")), F.lit("STANDARD"), F.lit("REGULAR")
    )


def canonical_phase(phase: Column) -> Column:
    """One of the seven phases, else OTHERS; an absent phase stays absent."""
    named = F.when(contains_any_case(phase, "("), extract_or_null(phase, r"\((.*?)\)"))
    for pattern, name in PHASE_RULES:
        named = named.when(phase.rlike(pattern), F.lit(name))
    named = named.otherwise(F.trim(phase))
    return F.when(named.isin(PHASES), named).when(named.isNotNull(), "OTHERS")


def named_products(order_items: DataFrame, sale_orders: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct named products per known event."""
    items = order_items.where(F.col("product_name_en") != "").select(
        "order_code", "product_id", F.trim(F.upper("product_name_en")).alias("product_name")
    )
    orders = in_values(sale_orders, "event_id", events, "id").select(
        F.col("code").alias("order_code"), "event_id"
    )
    named = items.join(orders, "order_code")
    return named.select("product_id", "event_id", "product_name").distinct()


def product_phases(products: DataFrame) -> DataFrame:
    """Distinct cleaned phases per product, from the part of the name after the last ' - '."""
    raw = F.trim(extract_or_null(F.col("product_name"), ".* - (.*)"))
    return products.select("product_id", clean_phase(raw).alias("phase")).distinct()


def filled_phases(products: DataFrame) -> DataFrame:
    """Distinct phases per product, an absent one filled from the phase before it.

    In the order of name and phase, absent last, every name of a product is followed by all
    its phases. So the phase before an absent one is the greatest of the product, and no
    window over the names is needed; it stays absent where the product has no phase.
    """
    phases = product_phases(products)
    greatest = phases.groupBy("product_id").agg(F.max("phase").alias("greatest"))
    filled = F.coalesce("phase", "greatest").alias("phase")
    return phases.join(greatest, "product_id").select("product_id", filled).distinct()


def stg_product(order_items: DataFrame, sale_orders: DataFrame, events: DataFrame) -> DataFrame:
    """Products with each of their sale phases.

    A row without phase takes the phase before it, in the order of name and phase with the
    absent one last. So whenever a product has any phase, its absent one repeats another
    and adds nothing: it is only kept for products that have no phase at all. This needs
    no window, and phases are brought to their eight names before the join, which bounds
    the join to nine rows per product name.
    """
    products = named_products(order_items, sale_orders, events)
    # One aggregation per product: the set of names has at most nine members.
    known = F.col("phase").isNotNull()
    name = F.when(known, F.coalesce(canonical_phase(F.col("phase")), F.lit("")))
    per_product = (
        product_phases(products)
        .groupBy("product_id")
        .agg(F.count("phase").alias("n_known"), F.collect_set(name).alias("names"))
    )
    names = F.when(F.col("n_known") > 0, F.col("names")).otherwise(F.array(F.lit("")))
    phases = per_product.select("product_id", F.explode(names).alias("name")).select(
        "product_id", F.nullif("name", F.lit("")).alias("phase")
    )
    return products.join(phases, "product_id").select(
        "product_id", "event_id", "product_name", "phase"
    )


def bi_orders(
    order_items: DataFrame, sale_orders: DataFrame, attendants: DataFrame, events: DataFrame
) -> DataFrame:
    """The order mart at item grain, distinct, newest first.

    ``checkout_time`` counts whole minutes for orders paid within 900 seconds, else 0.
    """
    created, purchased = F.col("created_at"), F.col("purchased_at")
    in_time = whole_seconds(created, purchased).between(0, 900)
    minutes = F.when(in_time, whole_minutes(created, purchased)).otherwise(0)
    orders = in_values(
        sale_orders.where(F.col("merchant_id").isNotNull()), "event_id", events, "id"
    ).select(
        F.col("code").alias("order_code"),
        date_key(purchased).alias("date_id"),
        "event_id",
        F.col("merchant_id").alias("organizer_id"),
        F.col("customer_code").alias("customer_id"),
        "order_status",
        code_label(F.col("order_type")).alias("order_type"),
        code_label(F.col("payment_method")).alias("payment_method"),
        minutes.alias("checkout_time"),
        hour_label(purchased).alias("order_tod"),
    )
    present = attendants.select(
        F.col("item_id").alias("id"),
        "product_id",
        F.col("order_code").alias("order_id"),
        F.col("product_id").alias("attended_product"),
        F.col("category_en").alias("category"),
    )
    rows = (
        order_items.join(orders, "order_code")
        .join(present, ["id", "product_id"], "left")
        .select(
            "date_id",
            "order_id",
            "event_id",
            "organizer_id",
            "customer_id",
            F.col("attended_product").alias("product_id"),
            "category",
            "quantity",
            _if_paid("subtotal").alias("gross_revenue"),
            _if_paid("discount_amount").alias("discount"),
            _if_paid("grand_total").alias("profit"),
            "order_status",
            "order_type",
            "payment_method",
            "checkout_time",
            "order_tod",
        )
    )
    return rows.distinct().orderBy(
        *[F.col(c).desc() for c in ("date_id", "event_id", "customer_id", "organizer_id")],
        # Rows without a date are many; two more keys let them be split.
        "order_id",
        "product_id",
    )


def customer_rollup(orders: DataFrame) -> DataFrame:
    """Paid item rows, tickets and spending per customer."""
    return orders.groupBy("customer_id").agg(
        F.sum(_if_paid_value(F.lit(1))).alias("orders_completed"),
        F.sum(_if_paid("quantity")).alias("tickets_purchased"),
        F.sum(_if_paid("net_revenue")).alias("total_spending"),
    )


def _if_paid_value(c: Column) -> Column:
    return F.when(F.col("order_status") == SUCCESS, c).otherwise(0)


def bi_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The customer mart: customers with what they bought, by date of the last login."""
    bought = customer_rollup(orders).withColumnRenamed("customer_id", "id")
    totals = ("orders_completed", "tickets_purchased", "total_spending")
    return (
        customers.join(bought, "id", "left")
        .select(
            *customers.columns, *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in totals]
        )
        .orderBy("last_login_date_id", "id")
    )
