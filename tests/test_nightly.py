"""The nightly run over dumps written from the test tables."""

from __future__ import annotations

import pytest

from boxoffice.catalog.bindings import AS_OF, CUTOFF
from boxoffice.operators import metrics
from boxoffice.plans import bi_tables, nightly
from boxoffice.sources.csv_tables import MalformedLines, write_csv
from boxoffice.sources.json_array import write_json_arrays
from boxoffice.sources.sinks import current_table
from tests.conftest import values

MODELS = ["stg_organizers", "stg_events", "stg_orders", "stg_customers", "stg_product", "bi_orders", "bi_customers"]


@pytest.fixture(scope="module")
def dumps(tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dumps")
    frames = {
        "sale_orders": tables.sale_orders(),
        "order_items": tables.order_items(),
        "order_attendant": tables.attendants(),
        "customers": tables.dump_customers(),
        "sale_order_events": tables.dump_order_events(),
        "events": tables.dump_events(),
        "login": tables.dump_login(),
    }
    for name, df in frames.items():
        write_json_arrays(df, str(folder / name))
    return str(folder)


def test_run_twice(spark, tables, dumps, tmp_path):
    out = str(tmp_path / "warehouse")
    first = nightly.run_nightly(spark, dumps, out, tables.countries())
    before = {m: values(current_table(spark, f"{out}/{m}")) for m in MODELS}
    second = nightly.run_nightly(spark, dumps, out, tables.countries())
    assert first == second
    assert first.rows["raw_sale_orders"] == tables.read("orders").count()
    assert set(first.failures.values()) == {0}
    assert before == {m: values(current_table(spark, f"{out}/{m}")) for m in MODELS}
    assert values(current_table(spark, f"{out}/stg_events")) == values(tables.stg_events())
    stored = current_table(spark, f"{out}/stg_orders").drop("bucket")
    assert values(stored) == values(tables.stg_orders().select(*stored.columns))


def test_report_tables(spark, tables, tmp_path):
    """Extracts written as CSV give the same star schema as the frames they came from."""
    extracts, out = str(tmp_path / "extracts"), str(tmp_path / "report")
    frames = {
        "events": tables.csv_events(),
        "tickets": tables.csv_tickets(),
        "customers": tables.csv_customers(),
        "orders": tables.csv_orders(),
    }
    for name, df in frames.items():
        write_csv(df, f"{extracts}/{name}")
    nightly.build_report(spark, extracts, out, CUTOFF, AS_OF)

    def stored(name):
        return current_table(spark, f"{out}/{name}")

    fact = bi_tables.fact_orders(tables.csv_orders())
    assert values(stored("fact_orders")) == values(fact)
    assert values(stored("dim_tickets")) == values(tables.tickets())
    assert values(stored("dim_ticket_phase")) == values(tables.phases())
    assert values(stored("dim_customers")) == values(tables.customers())
    calendar = bi_tables.dim_calendar(bi_tables.calendar_bounds(fact), AS_OF)
    assert values(stored("dim_calendar")) == values(calendar)
    sold = metrics.kpi(stored("fact_orders"), ["tickets"], ["eventID"])
    assert values(stored("dim_events"), "id", "tickets") == values(sold)


def test_report_from_loaded_extracts(spark, tables, tmp_path):
    """A damaged line stops its load until it is allowed; the report then builds from the stored extracts."""
    extracts, kept, out = (str(tmp_path / n) for n in ("extracts", "kept", "report"))
    frames = {"events": tables.csv_events(), "tickets": tables.csv_tickets(), "customers": tables.csv_customers()}
    for name, df in {**frames, "orders": tables.csv_orders()}.items():
        write_csv(df, f"{extracts}/{name}")
    with open(f"{extracts}/events/extra.csv", "w") as file:
        file.write(",".join(tables.csv_events().columns) + "\n-5,half\n")
    with pytest.raises(MalformedLines, match="'short': 1"):
        nightly.load_extracts(spark, extracts, kept)
    found = nightly.load_extracts(spark, extracts, kept, {"events": {"short": 1}})
    assert found["events"] == {"lines": tables.csv_events().count() + 1, "long": 0, "short": 1, "unreadable": 0, "undecoded": 0}
    assert found["orders"]["lines"] == tables.csv_orders().count()
    nightly.build_report(spark, kept, out, CUTOFF, AS_OF, loaded=True)
    assert values(current_table(spark, f"{out}/fact_orders")) == values(bi_tables.fact_orders(tables.csv_orders()))
    assert -5 in {r["id"] for r in current_table(spark, f"{out}/dim_events").collect()}
