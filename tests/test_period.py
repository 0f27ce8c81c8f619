from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from qlens.period import SHORTCUTS, Period, data_day_spine, day_spine, in_period, loaded_on, loaded_since, shortcut_table


def test_closed_period_ends_a_second_before_midnight(make_chats):
    chats = make_chats(
        ("a", "2025-06-18T23:59:59"),
        ("b", "2025-06-19T00:00:00"),
        ("c", "2025-06-19T23:59:59"),
        ("d", "2025-06-19T23:59:59.500000"),
        ("e", "2025-06-20T00:00:00"),
    )
    closed = in_period(chats, Period("2025-06-19", "2025-06-19"))
    assert [r.input_text for r in closed.orderBy("chatting_pk").collect()] == ["b", "c"]
    half_open = in_period(chats, Period("2025-06-19", "2025-06-19", exclusive_end=True))
    assert [r.input_text for r in half_open.orderBy("chatting_pk").collect()] == ["b", "c", "d"]


def test_period_must_not_end_before_it_starts():
    with pytest.raises(ValueError):
        Period("2025-06-20", "2025-06-19")


@pytest.mark.parametrize(
    "name, start, end",
    [
        ("today", "2024-03-01", "2024-03-01"),
        ("yesterday", "2024-02-29", "2024-02-29"),
        ("this-week", "2024-02-26", "2024-03-03"),
        ("last-week", "2024-02-19", "2024-02-25"),
        ("this-month", "2024-03-01", "2024-03-31"),
        ("last-month", "2024-02-01", "2024-02-29"),
        ("2023-12-31", "2023-12-31", "2023-12-31"),
    ],
)
def test_shortcuts(name, start, end):
    assert Period.parse(name, "2024-03-01") == Period(start, end)


def test_month_shortcuts_cross_the_year():
    assert Period.parse("this-month", "2024-12-31") == Period("2024-12-01", "2024-12-31")
    assert Period.parse("last-month", "2024-01-15") == Period("2023-12-01", "2023-12-31")
    assert Period.yesterday("2024-01-01") == Period("2023-12-31", "2023-12-31")


def test_column_shortcuts_agree_with_the_driver_side(spark):
    days = spark.sql("SELECT explode(sequence(date'2023-12-20', date'2024-03-05')) AS ref_date")
    got = {(r.ref_date, r.shortcut): (r.start_date, r.end_date) for r in shortcut_table(days).collect()}
    assert len(got) == 77 * len(SHORTCUTS)
    for (ref, name), bounds in got.items():
        p = Period.parse(name, ref)
        assert bounds == (p.start, p.end)


def test_day_spines(spark, make_chats):
    assert [r.date for r in day_spine(spark, Period("2024-02-28", "2024-03-01")).collect()] == [
        date(2024, 2, 28),
        date(2024, 2, 29),
        date(2024, 3, 1),
    ]
    chats = make_chats(("a", "2024-02-28T10:00:00"), ("b", "2024-03-01T10:00:00"))
    assert data_day_spine(chats).count() == 3
    assert data_day_spine(chats.limit(0)).count() == 0


def test_loaded_filters(make_keywords):
    kw = make_keywords(
        ("a", "k", 1, 1, "2025-06-01", "2025-06-10T23:59:59.900000"),
        ("b", "k", 1, 1, "2025-06-01", "2025-06-11T00:00:00"),
        ("c", "k", 1, 1, "2025-06-01", "2025-06-12T00:00:00"),
    )
    assert [r[0] for r in rows(loaded_since(kw, "2025-06-11").select("query_text"))] == ["b", "c"]
    assert [r[0] for r in rows(loaded_on(kw, "2025-06-11").select("query_text"))] == ["b"]


def test_period_filter_reaches_the_scan(spark, make_chats, tmp_path):
    path = str(tmp_path / "chats")
    make_chats(("a", "2025-06-19T00:00:00")).write.parquet(path)
    plan = in_period(spark.read.parquet(path), Period("2025-06-19", "2025-06-19")).select(F.count("*"))
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(created_at" in text and "LessThanOrEqual(created_at" in text


def test_no_time_zone_moves_the_bounds(spark, make_chats):
    chats = make_chats(("a", "2025-06-18T23:59:59"), ("b", "2025-06-19T00:00:00"), ("c", "2025-06-19T23:59:59"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("Asia/Seoul", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = in_period(chats, Period("2025-06-19", "2025-06-19")).select("input_text").collect()
            assert [r[0] for r in got] == ["b", "c"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
