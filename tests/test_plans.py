"""Physical plans, planned as for tables too large to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from boxoffice.operators import dedup, joins, metrics, ranking
from boxoffice.plans import raw
from boxoffice.sources.sinks import read_key_range, write_range_partitioned
from tests.conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", [n for n in sorted(queries()) if n[:2] not in ("A0", "B0", "B1")])
def test_no_pairwise_joins_and_no_python(large, name):
    text = plan(queries()[name](large, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEvalPython"):
        assert bad not in text, name


def test_bundle_is_one_scan_per_table(large, tables):
    text = plan(metrics.kpi(tables.fact(), list(metrics.MEASURES), ["paymentMethod"]))
    assert text.count("FileScan") == 2


def test_only_needed_columns_are_read(large, tables):
    text = plan(metrics.kpi(tables.fact(), ["tickets"], ["eventID"]))
    assert "struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in text
    assert "struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_filters_reach_the_scan(large, tables):
    text = plan(tables.read("orders").where("o_custkey = 5 AND o_orderstatus = 'F'"))
    assert "EqualTo(o_custkey,5)" in text and "EqualTo(o_orderstatus,F)" in text


@pytest.mark.parametrize("clean, dump", [(raw.raw_order_events, "dump_order_events"), (raw.raw_login, "dump_login")])
def test_dedup_limits_groups_before_the_shuffle(large, tables, clean, dump):
    text = plan(clean(getattr(tables, dump)()))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("Exchange hashpartitioning") < partial  # the exchange is above it


def test_anti_join_does_not_broadcast(large, tables):
    text = plan(joins.not_in(tables.sale_orders(), "event_id", tables.dump_events(), "event_id"))
    assert "LeftAnti" in text and "Broadcast" not in text


def test_top_n_has_no_global_window(large, tables):
    text = plan(ranking.top_n(metrics.kpi(tables.fact(), ["tickets"], ["eventID"]), "tickets", 5))
    assert "TakeOrderedAndProject" in text and "Window" not in text


def test_numbering_never_sorts_all_rows_in_one_task(large, tables):
    names = tables.events().select("name", "target")
    text = plan(ranking.rank_by(names, "target", "name"))
    # The only window without keys runs over one row per range.
    single = re.findall(r"Window \[.*?\], \[\], ", text) + re.findall(r"Exchange SinglePartition", text)
    assert "partial_count(1)" in text and len(single) <= 2


def test_dimensions_are_not_broadcast_by_hint(large, tables):
    joined = joins.star_join(tables.fact(), tables.events(), tables.customers(), tables.tickets(), tables.phases())
    assert "BroadcastHashJoin" not in plan(joined)


def test_range_read_prunes_folders(spark, tmp_path, tables):
    path = str(tmp_path / "t")
    df = tables.fact().select("creationDateID", "id")
    limits = {"start": 19950000, "end": 20020101, "width": 15}
    write_range_partitioned(df, path, "creationDateID", **limits)
    got = read_key_range(spark, path, "creationDateID", 19970301, 19970331, **limits)
    text = plan(got)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", text)
    expected = df.where("creationDateID between 19970301 and 19970331")
    assert sorted(map(tuple, got.select("creationDateID", "id").collect())) == sorted(map(tuple, expected.collect()))
    read = {r[0].split("bucket=")[1].split("/")[0] for r in got.select(F.col("_metadata.file_path")).distinct().collect()}
    assert len(read) <= 4


def test_keep_first_of_a_hot_key(large):
    """A third of the rows share one key; each task passes on one row of it."""
    df = large.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    got = dedup.keep_first(df, ["k"])
    assert got.count() == 2001 and got.where("k = -1").first()["id"] == 0
