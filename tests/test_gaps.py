from datetime import date

import pytest
from helpers import rows

from qlens.operators import gaps
from qlens.period import Period

JUNE = Period("2025-06-11", "2025-06-13")
D1, D2, D3 = date(2025, 6, 11), date(2025, 6, 12), date(2025, 6, 13)


@pytest.fixture(scope="module")
def tables(make_chats, make_keywords):
    chats = make_chats(
        ("day one only", "2025-06-11T09:00:00"),
        ("day one only", "2025-06-12T09:00:00"),
        ("day one only", "2025-06-12T08:00:00"),
        ("both days", "2025-06-11T09:00:00"),
        ("both days", "2025-06-12T09:00:00"),
        ("never", "2025-06-12T10:00:00"),
        (None, "2025-06-12T10:00:00"),
        ("outside", "2025-06-14T10:00:00"),
    )
    kw = make_keywords(
        ("day one only", "k", 1, 1, "2025-06-11", "2025-06-20T01:00:00"),
        ("both days", "k", 1, 1, "2025-06-11", "2025-06-20T01:00:00"),
        ("both days", "k", 11, 1, "2025-06-12", "2025-06-21T01:00:00"),
        (None, "k", 1, 1, "2025-06-12", "2025-06-20T01:00:00"),
        ("never", "k", 1, 1, "2025-06-10", "2025-06-20T01:00:00"),
    )
    return chats, kw


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("first_day", [(None, D2), ("both days", D2), ("day one only", D2), ("never", D2)]),
        ("per_day", [(None, D2), ("day one only", D2), ("never", D2)]),
        ("ever", [(None, D2), ("never", D2)]),
    ],
)
def test_three_meanings_of_missing(tables, mode, expected):
    assert rows(gaps.missing_pairs(*tables, JUNE, mode)) == sorted(expected, key=repr)


def test_unknown_mode_is_refused(tables):
    with pytest.raises(ValueError):
        gaps.missing_pairs(*tables, JUNE, "sometimes")


def test_work_list_status_and_limit(tables):
    work = gaps.missing_work(*tables, JUNE, "per_day")
    assert rows(work) == sorted([(D2, None, 1), (D2, "day one only", 2), (D2, "never", 1)], key=repr)
    assert [tuple(r) for r in gaps.missing_work(*tables, JUNE, "per_day", limit=2).collect()] == [
        (D2, None, 1),
        (D2, "day one only", 2),
    ]
    assert rows(gaps.missing_status(*tables, JUNE, "first_day")) == [(D2, 5)]
    assert rows(gaps.missing_pairs_per_day(*tables, JUNE)) == [(D2, 3)]
    detail = {r.input_text: r.first_seen.hour for r in gaps.missing_detail(*tables, JUNE, "per_day").collect()}
    assert detail == {None: 10, "day one only": 8, "never": 10}


def test_verification_ignores_null_questions(tables, make_chats):
    chats, kw = tables
    remaining = gaps.verify_remaining(chats, kw, JUNE)
    assert rows(remaining) == [(D2, 2)]
    assert rows(gaps.verify_verdict(remaining)) == [(2, False)]
    only_null = make_chats((None, "2025-06-12T10:00:00"))
    assert rows(gaps.verify_verdict(gaps.verify_remaining(only_null, kw, JUNE))) == [(0, True)]
    assert rows(gaps.verify_verdict(gaps.verify_remaining(only_null.limit(0), kw, JUNE))) == [(0, True)]


def test_final_missing_believes_recent_rows_only(tables, categories):
    chats, kw = tables
    assert rows(gaps.final_missing(chats, kw, JUNE, "2025-06-20")) == [(2,)]
    assert rows(gaps.final_missing(chats, kw, JUNE, "2025-06-21")) == [(3,)]
    # Together with the summary, first days count as classified as well.
    assert rows(gaps.final_missing_union(chats, kw, categories, JUNE, "2025-06-21")) == [(2,)]


def test_coverage_spans_every_day(tables):
    by_day = gaps.coverage_by_day(*tables, JUNE)
    assert [tuple(r) for r in by_day.collect()] == [(D1, 2, 2, 2, 0), (D2, 3, 5, 0, 2), (D3, 0, 0, 0, 0)]
    assert rows(gaps.coverage_totals(by_day)) == [(5, 2, 2, 40.0)]


def test_coverage_of_nothing(tables):
    chats, kw = tables
    totals = gaps.coverage_totals(gaps.coverage_by_day(chats.limit(0), kw.limit(0), JUNE))
    assert rows(totals) == [(0, 0, 0, 0.0)]


def test_rate_rounds_half_to_even(spark):
    df = spark.createDataFrame([(49, 400), (1, 3), (0, 0)], "p bigint, t bigint")
    got = [r[0] for r in df.select(gaps.percent(df.p, df.t)).collect()]
    assert got == [12.2, 33.3, 0.0]


def test_load_verdict(tables):
    chats, kw = tables
    assert rows(gaps.load_verdict(chats, kw, JUNE, "2025-06-21")) == [(5, 3, 1, 2, 60.0, "missing")]
    done = chats.filter("input_text = 'both days'")
    assert gaps.load_verdict(done, kw, JUNE, "2025-06-21").first().verdict == "loaded"
    assert gaps.load_verdict(done, kw, JUNE, "2025-06-25").first().verdict == "nothing_loaded"


def test_join_sides_are_partitioned_alike(spark, tables):
    """One exchange per side: the de-duplication's partitioning serves the join."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = gaps.missing_work(*tables, JUNE, "per_day")
        plan = work._sc._jvm.PythonSQLUtils.explainString(work._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2 and "LeftAnti" in plan


def test_hot_question_is_one_row_per_day_before_the_join(spark, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = gaps.missing_work(*tables, JUNE, "ever")
        plan = work._sc._jvm.PythonSQLUtils.explainString(work._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.index("LeftAnti") < plan.index("partial_count")
