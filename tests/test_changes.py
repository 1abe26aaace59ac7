"""Upsert, update and delete on partitioned tables."""

import pytest
from pyspark.sql import functions as F

from facetable.session import scratch_database, scratch_path
from facetable.sources import changes
from facetable.sources.changes import delete_rows, finish_changes, update_rows, upsert

ROWS = [(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, None, 40), (5, "c", None)]
SCHEMA = "id int, part string, value int"


@pytest.fixture
def table(spark):
    database = scratch_database(spark, "changes")
    name = f"{database}.things"
    spark.createDataFrame(ROWS, SCHEMA).select("id", "value", "part").write.partitionBy("part").saveAsTable(name)
    yield name, scratch_path(spark, "journal")
    spark.sql(f"DROP DATABASE {database} CASCADE")


def held(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("id", "part", "value").collect()), key=str)


def files(spark, name):
    found = spark.table(name).select(F.col("_metadata.file_path").alias("f"), "part").distinct().collect()
    return {r.part: r.f for r in found}


def test_upsert_writes_touched_partitions_alone(spark, table):
    name, journal = table
    before = files(spark, name)
    new = spark.createDataFrame([(2, "a", 21), (6, "d", 60), (3, "a", 31)], SCHEMA)
    upsert(new, name, ["id"], journal)
    want = [(1, "a", 10), (2, "a", 21), (3, "a", 31), (4, None, 40), (5, "c", None), (6, "d", 60)]
    assert held(spark, name) == sorted(want, key=str)
    after = files(spark, name)
    assert {p for p in before if after.get(p) == before[p]} == {None, "c"}  # b is empty now
    assert "part=b" not in [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def test_update_and_delete(spark, table):
    name, journal = table
    update_rows(spark, name, {"value": "value + id"}, "value >= 20 OR id = 5", journal)
    assert held(spark, name) == sorted(
        [(1, "a", 10), (2, "a", 22), (3, "b", 33), (4, None, 44), (5, "c", None)], key=str
    )
    delete_rows(spark, name, "value > 30", journal)  # NULL stays
    assert held(spark, name) == sorted([(1, "a", 10), (2, "a", 22), (5, "c", None)], key=str)
    delete_rows(spark, name, "id > 100", journal)
    delete_rows(spark, name, "TRUE", journal)
    assert held(spark, name) == []
    upsert(spark.createDataFrame([(1, None, 1)], SCHEMA), name, ["id"], journal)
    assert held(spark, name) == [(1, None, 1)]


@pytest.mark.parametrize("ends", ["before", "within", "after"])
def test_a_job_that_ends_half_way(spark, table, monkeypatch, ends):
    name, journal = table
    plain = changes._publish

    def broken(session, table_name, path):
        if ends == "after":
            plain(session, table_name, path)
            raise RuntimeError("lost")
        if ends == "within":  # one of two partitions is overwritten
            rows = session.read.schema(session.table(table_name).schema).parquet(f"{path}/rows").where("part = 'a'")
            changes._overwrite_partitions(rows, table_name)
        raise RuntimeError("lost")

    monkeypatch.setattr(changes, "_publish", broken)
    with pytest.raises(RuntimeError):
        update_rows(spark, name, {"value": "value * 2"}, "id <= 3", journal)
    monkeypatch.setattr(changes, "_publish", plain)
    assert finish_changes(spark, name, journal) == (0 if ends == "after" else 1)
    assert finish_changes(spark, name, journal) == 0
    assert held(spark, name) == sorted(
        [(1, "a", 20), (2, "a", 40), (3, "b", 60), (4, None, 40), (5, "c", None)], key=str
    )


def test_a_job_that_ends_before_its_list_changes_nothing(spark, table):
    name, journal = table
    path = f"{changes._journal(spark, name, journal)}/x"
    spark.table(name).limit(1).write.parquet(f"{path}/rows")
    assert finish_changes(spark, name, journal) == 0 and len(held(spark, name)) == 5


def test_what_is_refused(spark, table):
    name, journal = table
    for bad in ([(1, "a", 1), (1, "b", 1)], [(None, "a", 1)]):
        with pytest.raises(ValueError):
            upsert(spark.createDataFrame(bad, SCHEMA), name, ["id"], journal)
    for values in ({"part": "'z'"}, {"nothing": "1"}):
        with pytest.raises(ValueError):
            update_rows(spark, name, values, "TRUE", journal)
    plain = f"{name}_plain"
    spark.range(3).write.saveAsTable(plain)
    with pytest.raises(ValueError):
        delete_rows(spark, plain, "id = 1", journal)
    assert len(held(spark, name)) == 5
