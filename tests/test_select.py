"""Describe, project, filter, preview."""

import pytest
from pyspark.errors import AnalysisException, ParseException

from facetable import describe, describe_frame, preview, preview_text, project_filter
from facetable.operators import query_table


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            (1, "Ann", 60000.0, "Peru"),
            (2, "Bo, Jr", 50000.0, "Chad"),
            (3, "Cy", None, "Peru"),
            (4, "Di", 90000.0, "Chad"),
        ],
        "id long, first_name string, salary double, country string",
    )


def test_projection_keeps_the_order_and_null_is_no_match(people):
    result = project_filter(people, ["salary", "id"], ["salary>50000"])
    assert result.columns == ["salary", "id"]
    assert sorted(tuple(row) for row in result.collect()) == [(60000.0, 1), (90000.0, 4)]


def test_no_predicate_keeps_all_rows(people):
    assert project_filter(people, ["id"]).count() == 4


def test_predicates_are_joined_by_and(people):
    result = project_filter(people, ["id"], ["salary>50000", "country='Chad'"])
    assert [row.id for row in result.collect()] == [4]


def test_or_inside_a_predicate_stays_inside(spark):
    rows = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    result = project_filter(rows, ["a"], ["a = 1 OR a = 3", "b > 2"])
    assert [row.a for row in result.collect()] == [3]


def test_filter_may_use_a_column_that_is_not_selected(people):
    assert project_filter(people, ["id"], ["first_name LIKE 'A%'"]).first().id == 1


def test_star_alias_and_aggregate(people):
    assert project_filter(people, ["*"]).columns == people.columns
    assert project_filter(people, ["count(*) AS n"], ["salary > 0"]).first().n == 3


def test_empty_projection_raises(people):
    with pytest.raises(ValueError):
        project_filter(people, [])


def test_one_string_is_not_a_list(people):
    with pytest.raises(TypeError):
        project_filter(people, "id")
    with pytest.raises(TypeError):
        project_filter(people, ["id"], "id > 1")


def test_more_than_a_condition_is_rejected(people):
    with pytest.raises((AnalysisException, ParseException)):
        project_filter(people, ["DISTINCT country"])
    with pytest.raises((AnalysisException, ParseException)):
        project_filter(people, ["country"], ["id > 0 GROUP BY country"])


def test_query_table(spark, people):
    people.write.mode("overwrite").saveAsTable("people_select")
    result = query_table(spark, "default.people_select", ["id"], ["salary > 50000"])
    assert sorted(row.id for row in result.collect()) == [1, 4]


def test_describe(spark, people):
    people.write.mode("overwrite").saveAsTable("people_describe")
    expected = [
        ("id", "bigint", None),
        ("first_name", "string", None),
        ("salary", "double", None),
        ("country", "string", None),
    ]
    assert [tuple(row) for row in describe(spark, "people_describe").collect()] == expected
    assert [tuple(row) for row in describe_frame(people).collect()] == expected


def test_describe_shows_comments_and_nested_types(spark):
    spark.sql(
        "CREATE OR REPLACE TEMP VIEW nested AS "
        "SELECT array(1) AS a, named_struct('x', 1, 'y', 'z') AS s"
    )
    rows = describe_frame(spark.table("nested")).collect()
    assert [row.data_type for row in rows] == ["array<int>", "struct<x:int,y:string>"]


def test_preview_bounds_rows(spark):
    assert preview(spark.range(1000)).count() == 100
    assert preview(spark.range(7)).count() == 7


def test_preview_text_cuts_cells(spark):
    frame = spark.sql("SELECT 'abcdefghijklmnopqrstuvwxyz' AS word FROM range(150)")
    text = preview_text(frame)
    assert text.count("|abcdefghijklmnopq...|") == 100
    assert "only showing top 100 rows" in text
