"""The nightly run for dumps of which little has changed.

Each dump is compared with its stored raw table, and only keys with changes are written.
What a model needs to rebuild follows from these keys: the orders, customers and products
they touch, as they were and as they are. Models are the same functions as in the full
run, over the rows of the touched keys; so both runs give the same tables. Events and organisers are
small and decide what counts as a known event; they are computed anew and compared.

The mart of orders keeps distinct rows without an order of their own, so its rows are replaced by
customer and event, inside which equal rows meet.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from boxoffice.plans import models
from boxoffice.plans.nightly import LOADS, PARTITIONED
from boxoffice.session import stable
from boxoffice.sources.changes import all_keys, changed_keys, merge_load, replace_keys, touched
from boxoffice.sources.json_array import CountedDump
from boxoffice.sources.sinks import add_version, current_table, loads, range_placed

# Raw table and the key by which its rows are compared.
RAW_KEYS = {
    "raw_sale_orders": ["code"],
    "raw_order_items": ["order_code"],
    "raw_order_attendant": ["item_id"],
    "raw_customers": ["code"],
    "raw_organizers": ["merchant_id"],
    "raw_order_events": ["event_id", "merchant_id"],
    "raw_events": ["event_id"],
    "raw_login": ["customer_code"],
    "raw_countries": ["alpha2_code"],
}

# Model and the key by which its rows are replaced.
MODEL_KEYS = {
    "stg_organizers": ["id"],
    "stg_events": ["id"],
    "stg_orders": ["order_id"],
    "stg_customers": ["id"],
    "stg_product": ["product_id"],
    "bi_orders": ["customer_id", "event_id"],
    "bi_customers": ["id"],
}


@dataclass
class Changes:
    """Rows written per table; zero where nothing had to be."""

    written: dict[str, int] = field(default_factory=dict)


class _Warehouse:
    """Stored tables as they are now and as they were before this run."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        tables = [*RAW_KEYS, *MODEL_KEYS]
        self.before = {t: entries[-1]["load"] for t in tables if (entries := loads(spark, f"{out}/{t}"))}

    def now(self, table: str) -> DataFrame:
        return current_table(self.spark, f"{self.out}/{table}").drop("bucket")

    def was(self, table: str) -> DataFrame:
        return current_table(self.spark, f"{self.out}/{table}", self.before[table]).drop("bucket")

    def either(self, table: str, *columns: str) -> DataFrame:
        """Some columns of the rows before and after."""
        return self.was(table).select(*columns).unionByName(self.now(table).select(*columns))

    def _laid_out(self, table: str, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        if table not in PARTITIONED:
            return rows, []
        return range_placed(rows, PARTITIONED[table]), ["bucket"]

    def whole(self, table: str, rows: DataFrame) -> int:
        rows, by = self._laid_out(table, rows)
        return add_version(rows, f"{self.out}/{table}", by)

    def replace(self, table: str, rows: DataFrame, keys: DataFrame) -> int:
        rows, by = self._laid_out(table, rows)
        return replace_keys(rows, keys.toDF(*MODEL_KEYS[table]), f"{self.out}/{table}", by)


def load_changes(
    spark: SparkSession, frames: dict[str, DataFrame], out: str, verify: dict | None = None
) -> tuple[Changes, dict[str, DataFrame]]:
    """Bring every raw table to its frame; returns rows written and changed keys per table."""
    done, keys = Changes(), {}
    for table, key in RAW_KEYS.items():
        check = (verify or {}).get(table)
        done.written[table], keys[table] = merge_load(frames[table], f"{out}/{table}", key, verify=check)
    return done, keys


def _build_all(store: _Warehouse) -> dict[str, int]:
    now = store.now
    written = {
        "stg_organizers": store.whole("stg_organizers", models.stg_organizers(now("raw_organizers"))),
        "stg_events": store.whole("stg_events", models.stg_events(now("raw_order_events"), now("raw_events"))),
    }
    orders, items, events = now("raw_sale_orders"), now("raw_order_items"), now("stg_events")
    built = {
        "stg_orders": lambda: models.stg_orders(orders, items, events),
        "stg_customers": lambda: models.stg_customers(now("raw_customers"), now("raw_login"), now("raw_countries")),
        "stg_product": lambda: models.stg_product(items, orders, events),
        "bi_orders": lambda: models.bi_orders(items, orders, now("raw_order_attendant"), events),
        "bi_customers": lambda: models.bi_customers(now("stg_orders"), now("stg_customers")),
    }
    return written | {table: store.whole(table, build()) for table, build in built.items()}


def _changed_dimension(store: _Warehouse, table: str, rows: DataFrame) -> tuple[int, DataFrame]:
    rows = stable(rows)
    keys = stable(changed_keys(store.now(table), rows, MODEL_KEYS[table]))
    return store.replace(table, touched(rows, MODEL_KEYS[table], keys), keys), keys


def _build_changed(store: _Warehouse, keys: dict[str, DataFrame]) -> dict[str, int]:
    now, written = store.now, {}
    written["stg_organizers"], _ = _changed_dimension(store, "stg_organizers", models.stg_organizers(now("raw_organizers")))
    known = models.stg_events(now("raw_order_events"), now("raw_events"))
    written["stg_events"], event_keys = _changed_dimension(store, "stg_events", known)
    events = now("stg_events")

    orders, items, attendants = now("raw_sale_orders"), now("raw_order_items"), now("raw_order_attendant")
    # Orders whose own rows or whose event's standing changed decide on staged orders and products.
    codes = all_keys(
        keys["raw_sale_orders"],
        keys["raw_order_items"],
        touched(orders.select("event_id", "code"), "event_id", event_keys).select("code"),
        names=["code"],
    )
    touched_items = touched(items, "order_code", codes)
    staged = models.stg_orders(touched(orders, "code", codes), touched_items, events)
    written["stg_orders"] = store.replace("stg_orders", staged, codes)

    products = all_keys(
        touched(store.either("raw_order_items", "order_code", "product_id"), "order_code", codes).select("product_id"),
        names=["product_id"],
    )
    sold = touched(items, "product_id", products)
    ordered = touched(orders, "code", sold.select("order_code"))
    written["stg_product"] = store.replace("stg_product", models.stg_product(sold, ordered, events), products)

    # For the mart also those of an attendant that came, went or changed.
    seen = touched(store.either("raw_order_items", "id", "order_code"), "id", keys["raw_order_attendant"])
    mart_codes = all_keys(codes, seen.select("order_code"), names=["code"])
    pairs = all_keys(
        touched(store.either("raw_sale_orders", "code", "customer_code", "event_id"), "code", mart_codes).select(
            "customer_code", "event_id"
        ),
        names=["customer_code", "event_id"],
    )
    sales = stable(touched(orders, ["customer_code", "event_id"], pairs))
    bought = stable(touched(items, "order_code", sales.select("code")))
    attended = touched(attendants, "item_id", bought.select("id"))
    written["bi_orders"] = store.replace("bi_orders", models.bi_orders(bought, sales, attended, events), pairs)

    customers = all_keys(
        keys["raw_customers"],
        keys["raw_login"],
        touched(now("raw_customers").select("nationality", "code"), "nationality", keys["raw_countries"]).select("code"),
        names=["code"],
    )
    accounts = touched(now("raw_login"), "customer_code", customers)
    staged = models.stg_customers(touched(now("raw_customers"), "code", customers), accounts, now("raw_countries"))
    written["stg_customers"] = store.replace("stg_customers", staged, customers)

    buyers = all_keys(
        customers,
        touched(store.either("stg_orders", "order_id", "customer_id"), "order_id", codes).select("customer_id"),
        names=["id"],
    )
    rows = models.bi_customers(
        touched(now("stg_orders"), "customer_id", buyers), touched(now("stg_customers"), "id", buyers)
    )
    written["bi_customers"] = store.replace("bi_customers", rows, buyers)
    return written


def apply_changes(
    spark: SparkSession, frames: dict[str, DataFrame], out: str, verify: dict | None = None
) -> Changes:
    """Bring all raw tables to ``frames`` and every model to what follows from them.

    ``frames`` has a cleaned frame for each table of RAW_KEYS. The first run builds everything.
    """
    store = _Warehouse(spark, out)
    done, keys = load_changes(spark, frames, out, verify)
    first = not set(MODEL_KEYS) <= set(store.before)
    done.written |= _build_all(store) if first else _build_changed(store, keys)
    return done


def run_incremental(spark: SparkSession, dumps: str, out: str, countries: DataFrame) -> Changes:
    """One night over the dump folders of the full run."""
    frames, verify = {"raw_countries": countries.select("alpha2_code")}, {}
    for table, folder, schema, clean in LOADS:
        dump = CountedDump(spark, f"{dumps}/{folder}", schema)
        frames[table], verify[table] = clean(dump.rows) if clean else dump.rows, dump.verify
    return apply_changes(spark, frames, out, verify)
