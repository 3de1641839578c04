"""Reading and writing."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.operators import quality
from boxoffice.plans import schemas
from boxoffice.session import scratch_path, shared_dir
from boxoffice.sources import csv_tables, json_array, parameters, sinks
from tests.conftest import values



def schema(**columns):
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


def test_array_file_keeps_declared_columns(spark, tmp_path):
    (tmp_path / "d.json").write_text('[\n {"a": 1, "b": "x", "c": {"deep": 1}},\n {"b": null, "a": 2, "c": []}\n]')
    df = json_array.read_json_array(spark, str(tmp_path), schema(a=T.LongType(), b=T.StringType()))
    assert values(df) == [(1, "x"), (2, None)]


def test_a_record_without_a_declared_column_fails(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"a": 1, "b": "x"}, {"a": 2}]')
    wanted = schema(a=T.LongType(), b=T.StringType())
    with pytest.raises(Exception, match="a record lacks b"):
        json_array.read_json_array(spark, str(tmp_path), wanted).collect()
    with pytest.raises(Exception, match="a record lacks b"):
        json_array.read_json_array(spark, str(tmp_path), wanted).select("a").collect()
    assert values(json_array.read_json_array(spark, str(tmp_path), wanted, strict=False)) == [(1, "x"), (2, None)]
    assert values(json_array.missing_columns(spark, str(tmp_path), wanted)) == [("b", 1)]


def test_a_json_null_is_no_absent_key(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"a": null, "b": null}]')
    wanted = schema(a=T.LongType(), b=T.StringType())
    assert values(json_array.read_json_array(spark, str(tmp_path), wanted)) == [(None, None)]
    assert json_array.missing_columns(spark, str(tmp_path), wanted).count() == 0


def test_several_files_are_one_scan(spark, tmp_path):
    """Files with and without records, keys in any order; values in their declared types."""
    (tmp_path / "a.json").write_text('[{"a": 1, "m": 12.3400, "t": "2024-05-06 07:08:09", "s": {"x": [1, null]}}]')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text('[\n{"s": 1.5, "t": "2024-05-06T00:00:00", "m": 7, "a": 2},\n\n{"s": "z", "t": null, "m": null, "a": 3}]')
    wanted = schema(a=T.LongType(), m=T.DecimalType(18, 4), t=T.TimestampNTZType(), s=T.StringType())
    df = json_array.read_json_array(spark, str(tmp_path), wanted)
    text = [(r.a, str(r.m), str(r.t), r.s) for r in df.orderBy("a").collect()]
    assert text == [
        (1, "12.3400", "2024-05-06 07:08:09", '{"x":[1,null]}'),
        (2, "7.0000", "2024-05-06 00:00:00", "1.5"),
        (3, "None", "None", "z"),
    ]
    assert df.schema == wanted
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "wholetext" not in plan


def test_absent_keys_are_counted_by_the_load_itself(spark, tmp_path):
    dump, path = tmp_path / "dump", str(tmp_path / "table")
    dump.mkdir()
    wanted = schema(a=T.LongType(), b=T.StringType(), c=T.LongType())
    (dump / "1.json").write_text('[{"a": 1, "b": "x", "c": null}]')
    whole = json_array.CountedDump(spark, str(dump), wanted)
    assert sinks.overwrite_load(whole.rows, path, verify=whole.verify) == 1
    (dump / "2.json").write_text('[{"a": 2, "c": 5}, {"a": 3}]')
    lacking = json_array.CountedDump(spark, str(dump), wanted)
    with pytest.raises(json_array.MissingColumn, match="'b': 2, 'c': 1"):
        sinks.overwrite_load(lacking.rows, path, verify=lacking.verify)
    assert values(sinks.current_table(spark, path)) == [(1, "x", None)]


def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    """The second load dies in some of its tasks after others have written their files."""
    path = str(tmp_path / "t")
    sinks.overwrite_load(spark.range(0, 100, 1, 4), path)
    poor = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("bad row"))).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        sinks.overwrite_load(poor, path)
    assert sinks.current_table(spark, path).count() == 100 and len(sinks.loads(spark, path)) == 1
    # A table can be replaced by what is computed from itself.
    sinks.overwrite_load(sinks.current_table(spark, path).where("id < 10"), path)
    assert sinks.current_table(spark, path).count() == 10


def test_old_versions_can_be_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 6, 7):
        sinks.overwrite_load(spark.range(n), path)
    old = sinks.current_table(spark, path, load=2)
    assert len(sinks.drop_old_versions(spark, path, keep=2)) == 1
    assert sinks.current_table(spark, path).count() == 7 and old.count() == 6
    assert sinks.drop_old_versions(spark, path, keep=2) == []
    with pytest.raises(sinks.NoTable):
        sinks.current_table(spark, str(tmp_path / "nothing"))


def test_array_files_have_a_bounded_size(spark, tmp_path):
    path = str(tmp_path / "dump")
    json_array.write_json_arrays(spark.range(0, 95, 1, 3).withColumn("s", F.lit(None).cast("string")), path, 10)
    sizes = spark.read.option("wholetext", True).text(path).select(
        F.size(F.from_json("value", "array<map<string,string>>")).alias("n")
    )
    assert sizes.agg(F.max("n"), F.sum("n")).first()[:] == (10, 95)
    back = json_array.read_json_array(spark, path, schema(id=T.LongType(), s=T.StringType()))
    assert back.count() == 95


def test_array_files_are_compressed(spark, tmp_path):
    """Keys come with every record, so a dump as plain text is several times its table."""
    path = str(tmp_path / "dump")
    df = spark.range(0, 20_000, 1, 3).withColumn("a_long_name_of_a_column", F.lit("the same text"))
    json_array.write_json_arrays(df, path, 5_000)
    size = sum(f.stat().st_size for f in (tmp_path / "dump").iterdir())
    assert size < 0.25 * df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    back = json_array.read_json_array(spark, path, schema(id=T.LongType(), a_long_name_of_a_column=T.StringType()))
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000


def test_bad_json_value_fails(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"a": "not a number"}]')
    with pytest.raises(Exception):
        json_array.read_json_array(spark, str(tmp_path), schema(a=T.LongType())).collect()


def test_csv_code_page(spark, tmp_path):
    header = ",ticket_id,event_id,distance,phase_id,price\n"
    (tmp_path / "t.csv").write_bytes((header + '0,1,2,5€ – "café",3,900\n1,2,2,x,,5\n').encode("cp1252"))
    df = csv_tables.read_csv(spark, str(tmp_path), schemas.CSV_TICKETS, "1252")
    assert values(df) == [(0, 1, 2, '5€ – "café"', 3, 900), (1, 2, 2, "x", None, 5)]


def test_csv_short_and_long_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x,extra\n2\n")
    df = csv_tables.read_csv(spark, str(tmp_path), schema(a=T.LongType(), b=T.StringType()))
    assert values(df) == [(1, "x"), (2, None)]


def test_odd_lines_are_counted_and_kept(spark, tmp_path):
    body = "a,b,c\n1,x,5\n2,x,5,more\n3,x,5,\n4\n\n5,x,five\n6,,\nno,x,7,more\n7,\ufffd,1\n8,x\n"
    # A second file with a header of its own, whose last line holds bytes that are no UTF-8.
    (tmp_path / "a.csv").write_text(body)
    (tmp_path / "b.csv").write_bytes(b"a,b,c\n9,\xff\xfe,1\n")
    wanted = schema(a=T.LongType(), b=T.StringType(), c=T.IntegerType())
    lines = csv_tables.AuditedCsv(spark, str(tmp_path), wanted)
    got = {tuple(r) for r in lines.rows.collect()}
    assert got == {
        (1, "x", 5), (2, "x", 5), (3, "x", 5), (4, None, None), (5, "x", None), (6, None, None), (None, "x", 7),
        (7, "\ufffd", 1), (8, "x", None), (9, "\ufffd\ufffd", 1),
    }
    assert lines.counts() == {"lines": 10, "long": 3, "short": 2, "unreadable": 2, "undecoded": 2}
    odd = {tuple(r["fields"]): r["kinds"] for r in lines.odd_lines().collect()}
    assert odd[("no", "x", "7", "more")] == ["long", "unreadable"] and odd[("4",)] == ["short"]
    assert odd[("3", "x", "5", "")] == ["long"] and len(odd) == 8
    lines.verify(long=3, short=2, unreadable=2, undecoded=2)
    with pytest.raises(csv_tables.MalformedLines, match="'long': 3"):
        lines.verify(short=2, unreadable=2, undecoded=2)


def test_counts_do_not_depend_on_the_columns_in_use(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x,more\n2\nno,x\n")
    lines = csv_tables.AuditedCsv(spark, str(tmp_path), schema(a=T.LongType(), b=T.StringType()))
    lines.rows.select("b").write.format("noop").mode("overwrite").save()
    assert lines.counts() == {"lines": 3, "long": 1, "short": 1, "unreadable": 1, "undecoded": 0}


def test_audit_of_a_code_page(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("a,b\n1,5€\n2,é\n".encode("cp1252") + b"3,\x81\n")
    lines = csv_tables.AuditedCsv(spark, str(tmp_path), schema(a=T.LongType(), b=T.StringType()), "1252")
    assert values(lines.rows) == [(1, "5€"), (2, "é"), (3, "\x81")]
    assert lines.counts() == {"lines": 3, "long": 0, "short": 0, "unreadable": 0, "undecoded": 1}


def test_audit_of_an_empty_extract(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    lines = csv_tables.AuditedCsv(spark, str(tmp_path), schema(a=T.LongType(), b=T.StringType()))
    assert lines.rows.collect() == [] and set(lines.counts().values()) == {0}


def test_a_damaged_extract_leaves_the_table_as_it_was(spark, tmp_path):
    wanted = schema(a=T.LongType(), b=T.StringType())
    table, texts = str(tmp_path / "table"), {"good": "a,b\n1,x\n", "bad": "a,b\n2\n3,y\n"}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "t.csv").write_text(text)
    good, bad = [csv_tables.AuditedCsv(spark, str(tmp_path / n), wanted) for n in texts]
    assert sinks.overwrite_load(good.rows, table, verify=good.verify) == 1
    with pytest.raises(csv_tables.MalformedLines):
        sinks.overwrite_load(bad.rows, table, verify=bad.verify)
    assert values(sinks.current_table(spark, table)) == [(1, "x")]
    again = csv_tables.AuditedCsv(spark, str(tmp_path / "bad"), wanted)
    assert sinks.overwrite_load(again.rows, table, verify=lambda: again.verify(short=1)) == 2
    assert values(sinks.current_table(spark, table)) == [(2, None), (3, "y")]


def test_csv_bad_number_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv_tables.read_csv(spark, str(tmp_path), schema(a=T.LongType())).collect()


def test_load_replaces_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    wanted = schema(b=T.StringType(), a=T.LongType())
    assert sinks.overwrite_load(spark.range(5).select(F.col("id").alias("a"), F.lit("x").alias("b")), path, wanted) == 5
    assert sinks.overwrite_load(spark.range(3).select(F.col("id").alias("a"), F.lit("y").alias("b")), path, wanted) == 3
    assert values(sinks.current_table(spark, path)) == [("y", 0), ("y", 1), ("y", 2)]
    assert [r["rows"] for r in sinks.loads(spark, path)] == [5, 3]


def test_load_refuses_a_missing_column(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_load(spark.range(2), path)
    with pytest.raises(Exception):
        sinks.overwrite_load(spark.range(9), path, T.StructType([T.StructField("gone", T.LongType(), False)]))
    assert sinks.current_table(spark, path).count() == 2


def test_row_counts_against_the_run_before(rows):
    loads = rows([("a", 1, 10), ("a", 2, 15), ("b", 2, 7)], "table string, run_date int, rows long")
    assert values(sinks.load_metrics(loads), "table", "run_date", "change") == [("a", 1, None), ("a", 2, 5), ("b", 2, None)]


@pytest.mark.parametrize(
    "key, bucket", [(20200000, 0), (20200014, 0), (20200015, 1), (20250100, 3340), (20250101, -1), (20199999, -1), (None, -1)]
)
def test_buckets(spark, key, bucket):
    c = sinks.range_bucket(F.lit(key).cast("int"))
    assert spark.range(1).select(c.alias("v")).first()["v"] == bucket


def test_outside_keys_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(20190101,), (20200001,), (20200031,), (20260101,), (None,)], "k int")
    sinks.write_range_partitioned(df, path, "k")
    for lo, hi, n in ((20190000, 20200005, 2), (20200000, 20200030, 1), (20200031, 20270000, 2)):
        assert sinks.read_key_range(spark, path, "k", lo, hi).count() == n


def test_parameter_tables(spark):
    assert parameters.summary_metrics(spark).count() == 12
    assert parameters.sales_metrics(spark).where("visible = 1").count() == 5
    assert parameters.summary_slicer(spark).count() == 4 and parameters.sales_slicer(spark).count() == 5
    assert parameters.scatter_axes(spark).count() == 4 and parameters.scatter_colours(spark).count() == 3
    assert parameters.scatter_legends(spark).count() == 6


def test_checks_find_failures(rows):
    df = rows([(1, "a"), (1, None), (None, "b"), (None, "c")], "id long, v string")
    assert quality.failures("n", quality.null_rows(df, "id")).first()["failures"] == 2
    assert values(quality.duplicates(df, "id")) == [(1, 2)]
    report = quality.schema_report(df, schema(id=T.LongType(), gone=T.LongType()))
    assert values(report) == [("gone", 0, 4), ("id", 1, 2)]
    assert quality.conforms(df, schema(id=T.LongType())) and not quality.conforms(df, schema(gone=T.LongType()))


def test_shared_folder_comes_from_the_session(spark):
    named = shared_dir(spark)
    assert scratch_path(spark, "x").startswith(f"{named}/boxoffice/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
