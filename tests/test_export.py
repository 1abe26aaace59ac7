"""CSV export and staged copies."""

import datetime
import glob
from unittest.mock import MagicMock

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import Row

from facetable import (
    LOSSLESS_CSV,
    export_csv,
    export_table,
    from_events,
    read_staged,
    to_events,
)
from facetable.functions.names import document_field, flat_name, quote, staged_name
from tests.compare import spark_bag


def files_of(path):
    return sorted(glob.glob(f"{path}/part-*"))


def text_of(path):
    return "".join(open(name, encoding="utf-8", newline="").read() for name in files_of(path))


def test_default_csv_text(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a,b", None, "", 'q"x', 1.5, datetime.datetime(2024, 1, 2, 3, 4, 5, 120000), True)],
        "a string, b string, c string, d string, f double, g timestamp, h boolean",
    )
    path = export_csv(rows, str(tmp_path), "db.t")
    assert path == f"{tmp_path}/db.t"
    assert text_of(path) == '"a,b",,"","q\\"x",1.5,2024-01-02T03:04:05.120Z,true\n'


def test_export_replaces(spark, tmp_path):
    export_csv(spark.range(50), str(tmp_path) + "/", "t")
    path = export_csv(spark.range(3), str(tmp_path), "t")
    assert sorted(text_of(path).split()) == ["0", "1", "2"]


def test_empty_table_leaves_one_empty_file(spark, tmp_path):
    path = export_csv(spark.range(0).coalesce(1), str(tmp_path), "t")
    assert len(files_of(path)) == 1 and text_of(path) == ""


def test_one_file_per_task_and_bounded_files(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4)
    assert len(files_of(export_csv(rows, str(tmp_path), "tasks"))) == 4
    bounded = export_csv(rows, str(tmp_path), "bounded", {"maxRecordsPerFile": "10"})
    assert len(files_of(bounded)) == 12


def test_nested_values_raise_or_become_json(spark, tmp_path):
    rows = spark.sql(
        "SELECT 1 AS id, array(1, 2) AS a, named_struct('x', CAST(NULL AS INT)) AS s, "
        "map('k', 1) AS m, NULL AS v"
    )
    with pytest.raises(AnalysisException):
        export_csv(rows, str(tmp_path), "t")
    path = export_csv(rows, str(tmp_path), "t", {"escape": '"'}, nested="json")
    assert text_of(path) == '1,"[1,2]","{""x"":null}","{""k"":1}",\n'
    with pytest.raises(ValueError):
        export_csv(rows, str(tmp_path), "t", nested="drop")


TEXTS = st.one_of(
    st.none(),
    st.text(
        st.one_of(
            st.sampled_from(list(' ",\\\n\r\t\'N#')),
            st.characters(codec="utf-8", exclude_characters="\0"),
        ),
        max_size=12,
    ).filter(lambda text: text != "\\N"),
)


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=8))
def test_lossless_csv_brings_any_text_back(spark, tmp_path_factory, pairs):
    rows = spark.createDataFrame(
        [(i, *pair) for i, pair in enumerate(pairs)], "i int, a string, b string"
    )
    path = export_csv(rows, str(tmp_path_factory.mktemp("csv")), "t", LOSSLESS_CSV)
    back = read_staged(spark, path, "csv", LOSSLESS_CSV, schema=rows.schema)
    assert spark_bag(back) == spark_bag(rows)


def test_lossless_csv_keeps_line_ends_and_blanks(spark, tmp_path):
    texts = ["\r", "a\r\nb", "\n", " x ", "", None, "\\", '\\"', '"', ",", "\t"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    path = export_csv(rows, str(tmp_path), "t", LOSSLESS_CSV)
    back = read_staged(spark, path, "csv", LOSSLESS_CSV, schema=rows.schema)
    assert [row.t for row in back.orderBy("i").collect()] == texts


def test_lossless_csv_keeps_times_and_numbers(spark, tmp_path):
    rows = spark.sql(
        "SELECT TIMESTAMP '2024-01-02 03:04:05.123456' AS t, "
        "TIMESTAMP_NTZ '1969-12-31 23:59:59.000001' AS n, DATE '2024-02-29' AS d, "
        "CAST(1.10 AS DECIMAL(5, 2)) AS m, CAST('-Infinity' AS DOUBLE) AS x, 1e-300D AS y"
    )
    path = export_csv(rows, str(tmp_path), "t", LOSSLESS_CSV)
    back = read_staged(spark, path, "csv", LOSSLESS_CSV, schema=rows.schema)
    assert spark_bag(back) == spark_bag(rows)


def test_times_come_back_in_any_zone(spark, tmp_path):
    """Old offsets with seconds, and the hour that a clock change repeats."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = spark.sql(
            "SELECT * FROM VALUES (TIMESTAMP '1800-06-01 12:00:00.123456 UTC'), "
            "(TIMESTAMP '2024-10-27 00:30:00 UTC'), (TIMESTAMP '2024-10-27 01:30:00 UTC'), "
            "(TIMESTAMP '9999-12-31 23:00:00 UTC') AS t(t)"
        )
        path = export_csv(rows, str(tmp_path), "t", LOSSLESS_CSV)
        by_csv = read_staged(spark, path, "csv", LOSSLESS_CSV, schema=rows.schema)
        by_json = from_events(to_events(rows, "json"), rows.schema, "json")
        for back in (by_csv, by_json):
            assert back.exceptAll(rows).count() == 0 and back.count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_names():
    assert flat_name("default.people") == "default_people"
    assert staged_name("ds", "default.people") == "ds.default_people"
    assert document_field("ds", "default.people") == "ds_default_people"
    assert quote("a`b") == "`a``b`"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_staged_files(spark, tmp_path, fmt):
    rows = spark.createDataFrame([Row(a=1, b="x", c=[1, 2]), Row(a=2, b=None, c=[])])
    target = export_table(rows, str(tmp_path), "db.t", fmt)
    assert target == f"{tmp_path}/db_t"
    assert spark_bag(read_staged(spark, target, fmt, schema=rows.schema)) == spark_bag(rows)
    export_table(rows.where("a = 1"), str(tmp_path), "db.t", fmt)
    assert read_staged(spark, target, fmt, schema=rows.schema).count() == 1


def test_a_connector_gets_the_name_as_an_option():
    frame = MagicMock()
    writer = frame.write.format.return_value.mode.return_value.options.return_value
    options = {"temporaryGcsBucket": "bucket"}
    assert export_table(frame, "ds", "db.t", "warehouse", options) == "ds.db_t"
    frame.write.format.assert_called_once_with("warehouse")
    frame.write.format.return_value.mode.assert_called_once_with("overwrite")
    frame.write.format.return_value.mode.return_value.options.assert_called_once_with(**options)
    writer.option.assert_called_once_with("table", "ds.db_t")
    writer.option.return_value.save.assert_called_once_with()

    spark = MagicMock()
    read_staged(spark, "ds.db_t", "warehouse", options, "dbtable")
    reader = spark.read.format.return_value.options.return_value
    reader.option.assert_called_once_with("dbtable", "ds.db_t")


def test_noop_connector(spark):
    assert export_table(spark.range(5), "ds", "db.t", "noop") == "ds.db_t"
