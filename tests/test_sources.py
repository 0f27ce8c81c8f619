from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from qlens.config import SchemaConfig, resolve_query_column
from qlens.period import Period
from qlens.sources import sinks, tables


def test_logical_names_over_a_renamed_table(spark, tmp_path):
    cfg = SchemaConfig(columns={"input_text": "body", "chatting_pk": "id", "created_at": "at"})
    path = str(tmp_path / "chats")
    spark.createDataFrame([(1, "q", datetime(2025, 6, 19), "unused")], "id bigint, body string, at timestamp_ntz, extra string").write.parquet(path)
    chats = tables.read_chats(spark, path, cfg)
    assert rows(chats) == [(1, "q", datetime(2025, 6, 19))]
    plan = chats._sc._jvm.PythonSQLUtils.explainString(chats._jdf.queryExecution(), "formatted")
    assert "extra" not in plan


@pytest.mark.parametrize(
    "columns, name",
    [
        (["id", "content", "query_text"], "query_text"),
        (["id", "question", "text"], "question"),
        (["id", "body"], "body"),
        (["body"], "body"),
    ],
)
def test_question_column_priority(columns, name):
    assert resolve_query_column(columns) == name


def test_fact_table_with_another_question_column(spark, make_keywords):
    kw = make_keywords(("a", "k", 1, 1, "2025-06-19"))
    assert tables.read_keywords(spark, kw.withColumnRenamed("query_text", "content")).first().query_text == "a"


def test_collation_makes_names_compare_case_insensitively(spark, make_keywords):
    kw = make_keywords(("Ab", "k", 1, 1, "2025-06-19"), ("aB ", "k", 1, 1, "2025-06-19"))
    cfg = SchemaConfig(collation="UNICODE_CI_RTRIM")
    assert tables.read_keywords(spark, kw, cfg).select("query_text").distinct().count() == 1
    assert tables.read_keywords(spark, kw).select("query_text").distinct().count() == 2


def test_append_and_prune_by_day(spark, make_keywords, tmp_path):
    path = str(tmp_path / "facts")
    sinks.append_keywords(make_keywords(("a", "k", 1, 1, "2025-06-19")), path)
    sinks.append_keywords(make_keywords(("b", "k", 1, 1, "2025-06-20")), path)
    day = Period("2025-06-20", "2025-06-20")
    got = tables.read_keywords(spark, path, period=day)
    assert rows(got.select("query_text")) == [("b",)]
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(created_date" in plan
    assert tables.read_keywords(spark, path).count() == 2


def test_append_under_physical_names(spark, make_keywords, tmp_path):
    cfg = SchemaConfig(columns={"query_text": "content", "created_at": "day"})
    path = str(tmp_path / "facts")
    sinks.append_keywords(make_keywords(("a", "k", 1, 1, "2025-06-19")), path, cfg)
    assert set(spark.read.parquet(path).columns) == {"content", "keyword", "category_id", "query_count", "day", "batch_created_at", "created_date", "load"}
    assert tables.read_keywords(spark, path, cfg).first().query_text == "a"


def test_table_columns_in_order(spark):
    df = spark.createDataFrame([(1, "a", date(2025, 6, 19))], "b int, a string, c date")
    assert [tuple(r) for r in tables.table_columns(df).collect()] == [(1, "b", "int"), (2, "a", "string"), (3, "c", "date")]


def test_categories_are_read_and_bounded(spark, categories, tmp_path):
    path = str(tmp_path / "cats")
    categories.write.parquet(path)
    assert tables.read_categories(spark, path).count() == 11


def test_database_urls_and_options():
    assert tables.jdbc_url("mysql+pymysql://u:p@host:3306/db") == "jdbc:mysql://host:3306/db"
    assert tables.jdbc_url("postgresql://host/db") == "jdbc:postgresql://host/db"
    assert tables.jdbc_url("sqlite:////abs/f.db") == "jdbc:sqlite:/abs/f.db"
    assert tables.jdbc_url("sqlite:///f.db") == "jdbc:sqlite:f.db"
    assert tables.jdbc_url("jdbc:mysql://h/d") == "jdbc:mysql://h/d"
    with pytest.raises(ValueError):
        tables.jdbc_url("oracle://h/d")
    source = tables.JdbcSource("mysql+pymysql://u:p@host/db", "chattings", partitions=31)
    week = source.for_period(Period("2025-06-11", "2025-06-17")).reader_options()
    assert week["numPartitions"] == "31" and week["lowerBound"] == "2025-06-11 00:00:00"
    assert (week["user"], week["password"]) == ("u", "p") and "p@" not in week["url"]
    assert "partitionColumn" not in source.reader_options()


def test_a_path_a_table_and_a_frame_are_sources(spark, make_chats, tmp_path):
    chats = make_chats(("a", "2025-06-19T00:00:00"))
    chats.createOrReplaceTempView("source_chats")
    path = str(tmp_path / "chats")
    chats.write.parquet(path)
    for source in (chats, "source_chats", path):
        assert tables.read_chats(spark, source).select(F.count("*")).first()[0] == 1
