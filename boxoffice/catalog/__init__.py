"""Every operator as a query over the test tables, with an equivalent DuckDB query."""

from boxoffice.catalog import (
    cleaning,
    cohorts,
    expressions_and_joins,
    kpis,
    models_and_tables,
    rankings,
    sources_sinks,
    time_series,
)
from boxoffice.catalog.register import ENTRIES

FAMILIES = (
    sources_sinks,
    cleaning,
    models_and_tables,
    expressions_and_joins,
    kpis,
    cohorts,
    time_series,
    rankings,
)

__all__ = ["ENTRIES", "FAMILIES"]
