from datetime import date

from helpers import rows
from pyspark.sql import functions as F

from qlens.operators import questions as q
from qlens.period import Period

JUNE = Period("2025-06-11", "2025-06-19")


def sample(make_chats):
    return make_chats(
        ("테스트 질문", "2025-06-18T09:00:00"),
        ("테스트 질문", "2025-06-19T09:00:00"),
        ("테스트 질문", "2025-06-19T10:00:00"),
        ("수강신청 질문", "2025-06-19T08:00:00"),
        (None, "2025-06-19T08:00:00"),
        (None, "2025-06-18T08:00:00"),
        ("밖", "2025-06-20T00:00:00"),
    )


def test_unique_questions_of_a_range(make_chats):
    got = [tuple(r) for r in q.unique_questions(sample(make_chats), JUNE).collect()]
    assert got == [
        ("테스트 질문", 3, date(2025, 6, 19)),
        (None, 2, date(2025, 6, 19)),
        ("수강신청 질문", 1, date(2025, 6, 19)),
    ]


def test_unique_questions_of_each_day(make_chats):
    got = rows(q.unique_questions_per_day(sample(make_chats), JUNE))
    assert ("테스트 질문", 2, date(2025, 6, 19)) in got and ("테스트 질문", 1, date(2025, 6, 18)) in got
    assert len(got) == 5


def test_repeat_count_keeps_every_row_and_null_questions(make_chats):
    got = rows(q.with_repeat_count(sample(make_chats)).select("chatting_pk", "total_count"))
    assert got == [(1, 3), (2, 3), (3, 3), (4, 1), (5, 2), (6, 2), (7, 1)]


def test_repeat_count_agrees_with_a_window_on_a_hot_question(spark):
    chats = spark.range(3000).select(
        F.col("id").alias("chatting_pk"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), (F.col("id") % 700).cast("string"))).alias("input_text"),
        F.lit("2025-06-19 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    chats.createOrReplaceTempView("hot_chats")
    window = spark.sql("SELECT *, count(*) OVER (PARTITION BY input_text) AS total_count FROM hot_chats")
    ours = q.with_repeat_count(chats)
    assert ours.exceptAll(window).isEmpty() and ours.count() == 3000


def test_latest_row_breaks_ties_by_key(make_chats):
    chats = make_chats(("a", "2025-06-19T08:00:00"), ("a", "2025-06-19T08:00:00"), ("a", "2025-06-18T08:00:00"))
    assert [r.chatting_pk for r in q.latest_per_question(chats).collect()] == [2]


def test_distinct_questions_are_sorted_by_day_then_text(make_chats):
    got = [tuple(r) for r in q.distinct_questions(sample(make_chats), JUNE).collect()]
    assert got == [
        (None, date(2025, 6, 18)),
        ("테스트 질문", date(2025, 6, 18)),
        (None, date(2025, 6, 19)),
        ("수강신청 질문", date(2025, 6, 19)),
        ("테스트 질문", date(2025, 6, 19)),
    ]


def test_existing_keys_and_skip(make_chats, make_keywords):
    kw = make_keywords(
        ("테스트 질문", "k", 1, 1, "2025-06-18"), ("테스트 질문", "k2", 2, 1, "2025-06-18"), (None, "k", 1, 1, "2025-06-18")
    )
    assert rows(q.existing_keys(kw, JUNE)) == [("테스트 질문|2025-06-18",), (None,)]
    left = q.skip_existing(q.unique_questions_per_day(sample(make_chats), JUNE), kw, JUNE)
    assert rows(left.select("input_text", "created_at")) == [
        ("수강신청 질문", date(2025, 6, 19)),
        ("테스트 질문", date(2025, 6, 19)),
        (None, date(2025, 6, 18)),
        (None, date(2025, 6, 19)),
    ]


def test_resume_offset_numbers_rows_across_partitions(spark):
    work = spark.range(500).select(
        F.concat(F.lit("q"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("input_text"),
        (F.col("id") % 7).alias("total_count"),
        F.lit(date(2025, 6, 19)).alias("created_at"),
    )
    expected = [tuple(r) for r in work.orderBy(*q.work_order()).collect()]
    for start in (0, 1, 137, 499, 500):
        assert sorted(map(tuple, q.resume_offset(work, start).collect())) == sorted(expected[start:])


def test_a_large_limit_is_not_gathered_in_one_task(spark):
    from qlens.operators.questions import first_in_order

    df = spark.range(0, 500, 1, 7).selectExpr("id % 13 AS a", "CAST(id AS STRING) AS b")
    order = [df["a"], df["b"]]
    for limit in (0, 1, 77, 500, 900):
        assert first_in_order(df, limit, order, at_once=0).collect() == first_in_order(df, limit, order).collect()
    plan = first_in_order(df, 77, order, at_once=0)
    assert "TakeOrdered" not in plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
