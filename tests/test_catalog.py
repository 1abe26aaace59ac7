"""Tables by name."""

import pathlib
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from facetable import (
    TableNotFound,
    create_table,
    create_table_from_parquet,
    get_table,
    list_tables,
    parquet_view,
    read_parquet,
    scan_table,
)
from facetable.session import scratch_database, scratch_path
from facetable.sources.catalog import _overlap
from tests.compare import spark_bag


@pytest.fixture
def database(spark):
    name = scratch_database(spark, "test")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_parquet_file_and_folder(spark, data, tmp_path):
    one = read_parquet(spark, f"{data}/nation.parquet")
    one.repartition(3).write.parquet(str(tmp_path / "many"))
    assert spark_bag(read_parquet(spark, str(tmp_path / "many"))) == spark_bag(one)


def test_view(spark, data):
    parquet_view(spark, f"{data}/region.parquet", "some_regions")
    assert spark.sql("SELECT count(*) AS n FROM some_regions").first().n == 5
    spark.catalog.dropTempView("some_regions")


def test_create_keeps_rows_and_schema(spark, data, database):
    path = f"{data}/events.parquet"
    made = create_table_from_parquet(spark, path, f"{database}.events")
    source = read_parquet(spark, path)
    assert made.dtypes == source.dtypes
    assert spark_bag(scan_table(spark, f"{database}.events")) == spark_bag(source)


def test_create_replaces_rows_and_schema(spark, data, database):
    name = f"{database}.thing"
    create_table_from_parquet(spark, f"{data}/region.parquet", name)
    create_table_from_parquet(spark, f"{data}/nation.parquet", name)
    assert scan_table(spark, name).columns == ["n_nationkey", "n_name", "n_regionkey"]
    assert scan_table(spark, name).count() == 25


def test_a_job_that_fails_leaves_the_old_table(spark, data, database):
    name = f"{database}.kept"
    create_table_from_parquet(spark, f"{data}/region.parquet", name)
    before = spark_bag(scan_table(spark, name))
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise("x").alias("a"))
    with pytest.raises(Exception, match="no"):
        create_table(bad, name)
    assert spark_bag(scan_table(spark, name)) == before
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["kept"]


def test_a_table_may_be_replaced_by_a_query_on_itself(spark, data, database):
    for name in (f"{database}.own_rows", f"`{database}`.`quoted`"):
        create_table_from_parquet(spark, f"{data}/nation.parquet", name)
        create_table(scan_table(spark, name).where("n_nationkey < 5"), name)
        assert scan_table(spark, name).count() == 5
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    assert sorted(names) == ["own_rows", "quoted"]


def test_a_table_is_not_made_from_its_own_files(spark, data, database):
    name = f"{database}.own"
    create_table_from_parquet(spark, f"{data}/region.parquet", name)
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    location = details.where("col_name = 'Location'").first().data_type
    for path in (location, location.removeprefix("file:"), location + "/"):
        with pytest.raises(ValueError):
            create_table_from_parquet(spark, path, name)
    assert scan_table(spark, name).count() == 5


@pytest.mark.parametrize(
    ("location", "path", "same"),
    [
        ("file:/wh/t", "/wh/t", True),
        ("file:/wh/t", "/wh/", True),
        ("file:/wh/t", "/wh/t/part-0.parquet", True),
        ("file:/wh/t", "/wh/t2", False),
        ("hdfs://nn:8020/wh/t", "/wh/t", True),
        ("s3a://one/wh/t", "s3a://two/wh/t", False),
        ("s3a://one/wh/t", "s3a://one/wh/t/", True),
    ],
)
def test_own_location(location, path, same):
    assert _overlap(location, path) is same


def test_a_plugin_catalog_replaces_in_one_step(spark):
    spark.conf.set("spark.sql.catalog.lake", "some.plugin")
    frame = MagicMock()
    frame.sparkSession.conf.get.side_effect = spark.conf.get
    try:
        create_table(frame, "lake.db.t", "iceberg")
    finally:
        spark.conf.unset("spark.sql.catalog.lake")
    frame.writeTo.assert_called_once_with("lake.db.t")
    frame.writeTo.return_value.using.assert_called_once_with("iceberg")
    frame.writeTo.return_value.using.return_value.createOrReplace.assert_called_once_with()


def test_listing_is_fresh_and_without_session_views(spark, data, database):
    create_table_from_parquet(spark, f"{data}/region.parquet", f"{database}.region")
    parquet_view(spark, f"{data}/region.parquet", "session_view")

    def listed():
        rows = list_tables(spark).where(f"database = '{database}'").collect()
        return sorted(tuple(row) for row in rows)

    assert listed() == [(database, "region", f"{database}.region")]
    assert listed() == listed()
    create_table_from_parquet(spark, f"{data}/nation.parquet", f"{database}.nation")
    assert [row[1] for row in listed()] == ["nation", "region"]
    assert list_tables(spark).where("`table` = 'session_view'").count() == 0
    spark.catalog.dropTempView("session_view")


def test_get_table(spark, data, database):
    create_table_from_parquet(spark, f"{data}/region.parquet", f"{database}.region")
    assert get_table(spark, f"{database}.region").count() == 5
    for name in (f"{database}.nothing", "no_such_database.region", "nothing"):
        with pytest.raises(TableNotFound):
            get_table(spark, name)


def test_get_table_does_not_see_session_views(spark, data):
    parquet_view(spark, f"{data}/region.parquet", "only_a_view")
    with pytest.raises(TableNotFound):
        get_table(spark, "only_a_view")
    spark.catalog.dropTempView("only_a_view")


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_a_cluster_must_name_its_shared_folder():
    cluster = MagicMock()
    cluster.conf.get.side_effect = lambda key, default=None: (
        "yarn" if key == "spark.master" else default
    )
    with pytest.raises(ValueError):
        scratch_path(cluster, "x")


def test_scratch_is_dropped(spark, data):
    """Queries leave nothing behind, and those that only name a table copy nothing."""
    from facetable import drop_scratch
    from facetable.plans.registry import QUERIES
    from facetable.session import shared_folder

    drop_scratch(spark)
    before = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    for name in ("describe", "expose_sql"):
        QUERIES[name](spark, data).collect()
    folder = pathlib.Path(shared_folder(spark)) / "facetable"
    assert not list(folder.rglob("*.parquet"))
    QUERIES["table_create_scan"](spark, data).collect()
    assert list(folder.rglob("*.parquet"))
    drop_scratch(spark)
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == before
    assert not list(folder.rglob("*.parquet"))
    assert spark.read.parquet(f"{data}/customer.parquet").count() == 150
