"""Declared schemas of the raw tables and of the report's extract files."""

from __future__ import annotations

from pyspark.sql import types as T

from boxoffice.functions.numbers import MONEY

TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TIME, DATE = T.TimestampNTZType(), T.DateType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SALE_ORDERS = _table(
    code=TEXT,
    event_id=LONG,
    customer_code=TEXT,
    order_status=TEXT,
    order_type=TEXT,
    payment_method=TEXT,
    created_at=TIME,
    purchased_at=TIME,
    merchant_id=LONG,
)
ORDER_ITEMS = _table(
    id=LONG,
    order_code=TEXT,
    product_id=LONG,
    quantity=LONG,
    subtotal=MONEY,
    discount_amount=MONEY,
    grand_total=MONEY,
    product_name_en=TEXT,
    ticket_phase_name_en=TEXT,
)
ORDER_ATTENDANT = _table(
    item_id=LONG,
    order_code=TEXT,
    product_id=LONG,
    category_en=TEXT,
)
CUSTOMERS = _table(
    code=TEXT,
    is_activated=INT,
    nationality=TEXT,
    birthday=TEXT,
    created_at=TIME,
    last_login_at=TIME,
)
# One dump feeds organisers and order events.
SALE_ORDER_EVENTS = _table(
    event_id=LONG,
    event_name_en=TEXT,
    merchant_id=LONG,
    merchant_name_en=TEXT,
    time_en=TEXT,
)
EVENTS = _table(
    event_id=LONG,
    event_name=TEXT,
    event_type=TEXT,
    start_date=TEXT,
    end_date=TEXT,
)
LOGIN = _table(
    customer_code=TEXT,
    type=TEXT,
    created_at=TEXT,
    updated_at=TEXT,
)

# Extract files of the report, in file order.
CSV_EVENTS = _table(
    id=LONG,
    name=TEXT,
    location=TEXT,
    type=TEXT,
    date=TIME,
    ticket_open_date2=TIME,
    ticket_close_date=TIME,
    target=LONG,
)
CSV_TICKETS = _table(
    _=LONG,
    ticket_id=LONG,
    event_id=LONG,
    distance=TEXT,
    phase_id=LONG,
    price=LONG,
)
CSV_CUSTOMERS = _table(
    customer_id=LONG,
    first_name=TEXT,
    last_name=TEXT,
    email=TEXT,
    date_of_birth=DATE,
    street_address=TEXT,
    city=TEXT,
    state=TEXT,
    gender=TEXT,
    created_at=TIME,
    updated_at=TIME,
    last_login_at=TIME,
)
CSV_ORDERS = _table(
    order_id=LONG,
    customer_id=LONG,
    ticket_id=LONG,
    event_id=LONG,
    total_tickets=LONG,
    order_status=TEXT,
    payment_method=TEXT,
    created_at=TIME,
    completed_at=TIME,
    cancelled_at=TIME,
    price=LONG,
    discount=DOUBLE,
)
