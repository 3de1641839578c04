"""Loads and models that follow only what has changed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from boxoffice.plans import incremental, models, raw, schemas
from boxoffice.session import stable
from boxoffice.sources import changes, sinks
from boxoffice.sources.json_array import CountedDump, MissingColumn, write_json_arrays
from tests.conftest import values
from tests.test_plans import plan


def keys_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_changed_keys(rows):
    schema = "k long, g string, v double"
    old = rows([(1, "a", 1.0), (1, "a", 1.0), (1, "b", 2.0), (2, "a", None), (3, "a", 3.0), (None, "n", 1.0)], schema)
    new = rows([(1, "a", 1.0), (1, "a", 1.0), (1, "b", 2.5), (2, "a", None), (4, "a", 4.0), (None, "n", 2.0)], schema)
    key = ["k", "g"]
    found = changes.changed_keys(old, new, key)
    assert keys_of(found) == sorted([(1, "b"), (3, "a"), (4, "a"), (None, "n")], key=str)
    assert changes.changed_keys(old, old.repartition(3), key).count() == 0
    # One copy less of a repeated row is a change.
    fewer = rows([(1, "a", 1.0), (1, "b", 2.0), (2, "a", None), (3, "a", 3.0), (None, "n", 1.0)], schema)
    assert keys_of(changes.changed_keys(old, fewer, key)) == [(1, "a")]


def test_changed_keys_take_one_shuffle(spark, tables):
    old, new = tables.sale_orders(), tables.sale_orders().where("event_id < 100")
    text = changes.changed_keys(old, new, ["code"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text and "partial_sum" in text


def test_merged_loads_follow_each_state(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string"
    states = [
        [(i, "a") for i in range(100)] + [(None, "n")],
        [(i, "a") for i in range(3, 100)] + [(None, "m"), (200, "new")],
        [(i, "b" if i == 50 else "a") for i in range(3, 101)] + [(0, "back")],
        [(i, "c") for i in range(100)],
        [],
        [(7, "x"), (7, "x"), (7, "y")],
    ]
    written = []
    for state in states:
        count, _ = changes.merge_load(rows(state, schema), path, ["k"])
        written.append(count)
        assert sorted(map(str, sinks.current_table(spark, path).collect())) == sorted(map(str, rows(state, schema).collect()))
    assert written == [101, 2, 3, 100, 0, 3]
    # States of the past can still be read, and a change that holds much is followed by a full version.
    assert sinks.current_table(spark, path, load=1).count() == 101
    kinds = [r["kind"] for r in sinks.loads(spark, path)]
    assert kinds[:4] == ["full", "change", "change", "change"] and kinds[4] == "full"


def test_key_ranges_of_a_changed_table_are_pruned(spark, tables, tmp_path):
    path = str(tmp_path / "t")
    limits = {"start": 19950000, "end": 20020101, "width": 15}
    df = tables.fact().select("creationDateID", "id")
    sinks.write_range_partitioned(df, path, "creationDateID", **limits)
    day = spark.createDataFrame([(19970301,)], df.select("creationDateID").schema)
    more = sinks.with_range_bucket(spark.createDataFrame([(19970301, -1)], df.schema), "creationDateID", 19950000, 20020101, 15)
    changes.replace_keys(more, day, path, ["bucket"])
    got = sinks.read_key_range(spark, path, "creationDateID", 19970225, 19970305, **limits)
    expected = df.where("creationDateID between 19970225 and 19970305 and creationDateID <> 19970301").collect()
    assert values(got, "creationDateID", "id") == sorted([tuple(r) for r in expected] + [(19970301, -1)], key=lambda t: tuple(map(str, t)))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan(got))
    assert len([f for f in filters if "bucket" in f]) >= 2


def night(tables, day):
    """The frames of one night, cleaned. Every table changes on some day, in few rows."""
    orders, items, attendants = tables.sale_orders(), tables.order_items(), tables.attendants()
    customers, login, events = tables.dump_customers(), tables.dump_login(), tables.dump_events()
    sold, countries = tables.dump_order_events(), tables.countries()
    code = F.col("code").cast("long")
    if day < 2:
        # The last orders have not been made yet.
        orders = orders.where(code % 50 != 0)
        items = items.where(F.col("order_code").cast("long") % 50 != 0)
    if day >= 2:
        status = F.when(code % 40 == 1, models.SUCCESS).otherwise(F.col("order_status"))
        customer = F.when(code % 90 == 2, "2").otherwise(F.col("customer_code"))
        orders = orders.withColumns({"order_status": status, "customer_code": customer})
        attendants = attendants.where("item_id % 97 <> 3")
        login = login.where("customer_code <> '7' or customer_code is null")
    if day >= 3:
        # Orders and customers go, an item changes its product, events and countries change their standing.
        orders = orders.where(code % 60 != 4)
        items = items.withColumn("product_id", F.when(F.col("id") % 131 == 5, 3).otherwise(F.col("product_id")))
        customers = customers.where("code <> '11'").withColumn("birthday", F.when(F.col("code") == "12", "2000-02-29").otherwise(F.col("birthday")))
        sold = sold.withColumn("event_name_en", F.when(F.col("event_id") == 4, "a test run").otherwise(F.col("event_name_en")))
        sold = sold.withColumn("merchant_name_en", F.when(F.col("merchant_id") == 3, "New Name").otherwise(F.col("merchant_name_en")))
        events = events.where("event_id <> 21")
        countries = countries.where("alpha2_code <> 'CANADA'").union(tables.spark.createDataFrame([("VN",)], countries.schema))
    return {
        "raw_sale_orders": orders,
        "raw_order_items": items,
        "raw_order_attendant": attendants,
        "raw_customers": raw.raw_customers(customers),
        "raw_organizers": raw.raw_organizers(sold),
        "raw_order_events": raw.raw_order_events(sold),
        "raw_events": raw.raw_events(events),
        "raw_login": raw.raw_login(login),
        "raw_countries": countries,
    }


def rebuilt(frames):
    """Every model from the frames alone."""
    orders, items, attendants = (frames[f"raw_{n}"] for n in ("sale_orders", "order_items", "order_attendant"))
    events = models.stg_events(frames["raw_order_events"], frames["raw_events"])
    staged = models.stg_orders(orders, items, events)
    customers = models.stg_customers(frames["raw_customers"], frames["raw_login"], frames["raw_countries"])
    return {
        "stg_organizers": models.stg_organizers(frames["raw_organizers"]),
        "stg_events": events,
        "stg_orders": staged,
        "stg_customers": customers,
        "stg_product": models.stg_product(items, orders, events),
        "bi_orders": models.bi_orders(items, orders, attendants, events),
        "bi_customers": models.bi_customers(staged, customers),
    }


def test_three_nights_equal_full_rebuilds(spark, tables, tmp_path):
    out, written, held = str(tmp_path / "changes"), {}, {}
    for day in (1, 2, 3):
        frames = {name: stable(df) for name, df in night(tables, day).items()}
        written[day] = incremental.apply_changes(spark, frames, out).written
        held[day] = {}
        for table, theirs in (frames | rebuilt(frames)).items():
            ours = values(sinks.current_table(spark, f"{out}/{table}").drop("bucket").select(*theirs.columns))
            assert ours == values(theirs), (day, table)
            held[day][table] = len(ours)
    assert written[1] == held[1]
    for day in (2, 3):
        for table in ("raw_sale_orders", "raw_order_items", "stg_orders", "bi_orders"):
            assert written[day][table] < 0.2 * held[day][table], (day, table)
        assert written[day]["stg_orders"] > 0 and written[day]["bi_customers"] > 0
    assert written[2]["raw_events"] == written[2]["stg_events"] == 0


def test_dumps_with_an_absent_key_change_nothing(spark, tables, tmp_path):
    dumps, out = tmp_path / "dumps", str(tmp_path / "out")
    orders = tables.sale_orders().limit(50)
    write_json_arrays(orders, str(dumps / "a"))
    first = CountedDump(spark, str(dumps / "a"), schemas.SALE_ORDERS)
    assert changes.merge_load(first.rows, out, ["code"], verify=first.verify)[0] == 50
    write_json_arrays(orders.drop("order_type"), str(dumps / "b"))
    second = CountedDump(spark, str(dumps / "b"), schemas.SALE_ORDERS)
    with pytest.raises(MissingColumn, match="order_type"):
        changes.merge_load(second.rows, out, ["code"], verify=second.verify)
    assert values(sinks.current_table(spark, out)) == values(orders)
    # The dump as it was: nothing is written.
    third = CountedDump(spark, str(dumps / "a"), schemas.SALE_ORDERS)
    assert changes.merge_load(third.rows, out, ["code"], verify=third.verify)[0] == 0
