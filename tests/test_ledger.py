from datetime import date, datetime

from helpers import rows

from qlens.operators import ledger
from qlens.period import Period
from qlens.sources.logs import parse_log_lines, read_run_log

P = Period("2025-06-11", "2025-06-13")
D1, D2, D3 = (date(2025, 6, d) for d in (11, 12, 13))


def test_daily_volumes(make_chats, make_keywords):
    chats = make_chats(("a", "2025-06-11T01:00:00"), ("a", "2025-06-11T02:00:00"), (None, "2025-06-11T02:00:00"), ("b", "2025-06-12T02:00:00"))
    assert [tuple(r) for r in ledger.daily_totals(chats, P).collect()] == [(D1, 1, 3), (D2, 1, 1)]
    kw = make_keywords(
        ("a", "k", 1, 4, "2025-06-11", "2025-06-20T00:00:00"), ("a", "l", 2, 5, "2025-06-11", "2025-06-21T00:00:00"), ("b", "k", 1, 1, "2025-06-13", "2025-06-21T23:00:00")
    )
    assert [tuple(r) for r in ledger.keyword_daily(kw, P).collect()] == [(D1, 1, 2), (D3, 1, 1)]
    assert [tuple(r) for r in ledger.keyword_daily(kw, P, "2025-06-21").collect()] == [(D1, 1, 1), (D3, 1, 1)]
    assert [tuple(r) for r in ledger.keyword_volume(kw, P).collect()] == [(D1, 1, 9), (D3, 1, 1)]


def test_reconciliation_covers_days_of_either_side(make_chats, make_keywords, categories):
    chats = make_chats(("a", "2025-06-11T01:00:00"), ("b", "2025-06-11T02:00:00"), ("a", "2025-06-12T02:00:00"))
    kw = make_keywords(("a", "k", 1, 4, "2025-06-11"), ("a", "k", 1, 4, "2025-06-12"), ("z", "k", 1, 2, "2025-06-13"))
    assert [tuple(r) for r in ledger.daily_reconciliation(chats, kw, categories, P).collect()] == [
        (D1, 2, 1, 1, 4, 1),
        (D2, 1, 0, 0, 0, 1),
        (D3, 0, 1, 1, 2, -1),
    ]


def asked(spark):
    return spark.createDataFrame([("a", 1, D1), ("b", 2, D1), ("a", 1, D2), (None, 1, D2)], "input_text string, total_count bigint, created_at date")


def test_ledger_and_totals(spark, make_keywords):
    good = make_keywords(("a", "k", 1, 1, "2025-06-11"), ("a", "l", 2, 1, "2025-06-11"))
    bad = make_keywords(("a", "k", None, 1, "2025-06-12"))
    days = ledger.run_ledger(asked(spark), good, P, bad)
    assert [tuple(r) for r in days.collect()] == [
        (D1, 2, 2, 1, 0, "SUCCESS", None),
        (D2, 2, 0, 2, 1, "FAILED", "no row could be stored"),
        (D3, 0, 0, 0, 0, "SUCCESS", None),
    ]
    assert tuple(ledger.run_totals(days).first()) == (3, 4, 2, 3, "2025-06-12", "PARTIAL_SUCCESS")
    assert ledger.run_totals(days.filter("status = 'SUCCESS'")).first().status == "SUCCESS"
    # Several days that all fail are still partial; a single one fails.
    failed = days.filter("status = 'FAILED'")
    assert ledger.run_totals(failed.unionAll(failed)).first().status == "PARTIAL_SUCCESS"
    assert ledger.run_totals(failed).first().status == "FAILED"
    assert ledger.run_ledger(asked(spark), good, P).filter("status <> 'SUCCESS'").isEmpty()


def test_result_diff_counts_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert rows(ledger.result_diff(a, b)) == [(1, "left"), (2, "left"), (3, "right")]
    assert rows(ledger.result_diff(a, b, distinct=True)) == [(2, "left"), (3, "right")]
    assert ledger.same_result(a, a) and not ledger.same_result(a, b)


def test_result_diff_reads_each_side_once(spark, tmp_path, monkeypatch):
    a = [(k % 7, float(k % 3), "x" if k % 2 else None) for k in range(60)]
    b = [(k % 5, float(k % 3), "x") for k in range(50)] + [(1, float("nan"), "y")]
    frames = []
    for name, data in (("a", a), ("b", b)):
        spark.createDataFrame(data, "n int, v double, t string").write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    left, right = frames
    found = ledger.result_diff(left, right)
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple").split("== Initial Plan")[0]
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1
    only = [(left.exceptAll(right), "left"), (right.exceptAll(left), "right")]
    for pieces in (ledger.PIECE, 2):
        monkeypatch.setattr(ledger, "PIECE", pieces)
        expected = sorted(repr((*r, side)) for df, side in only for r in df.collect())
        assert sorted(repr(tuple(r)) for r in ledger.result_diff(left, right).collect()) == expected
    distinct = sorted(repr((*r, s)) for x, y, s in ((left, right, "left"), (right, left, "right")) for r in x.subtract(y).collect())
    assert sorted(repr(tuple(r)) for r in ledger.result_diff(left, right, distinct=True).collect()) == distinct


LOG = [
    "2025-06-19 01:00:00 - nightly_run - INFO - 🎉 기간별 배치 처리 완료! - 끝",
    "2025-06-19 01:00:01 - classifier - INFO - API 호출 성공",
    "2025-06-19 01:00:02 - classifier - ERROR - API 호출 실패: 429",
    "2025-06-20 01:00:00 - nightly_run - ERROR - ❌ 청크 3 처리 실패: x",
    "  Traceback line",
]


def test_log_lines_and_counts(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text("\n".join(LOG) + "\n", encoding="utf-8")
    lines = read_run_log(spark, str(path))
    got = lines.orderBy("logged_at").collect()
    assert tuple(got[0]) == (None, None, None, "  Traceback line")
    assert tuple(got[1]) == (datetime(2025, 6, 19, 1), "nightly_run", "INFO", "🎉 기간별 배치 처리 완료! - 끝")
    counts = {(r.date, r.level): tuple(r)[2:] for r in ledger.log_counts(lines).collect()}
    assert counts == {
        (None, None): (1, 0, 0, 0, 0),
        (date(2025, 6, 19), "INFO"): (2, 1, 0, 1, 0),
        (date(2025, 6, 19), "ERROR"): (1, 0, 0, 0, 1),
        (date(2025, 6, 20), "ERROR"): (1, 0, 1, 0, 0),
    }
    odd = spark.createDataFrame([("2025-13-45 01:00:00 - a - INFO - m",)], "value string")
    assert tuple(parse_log_lines(odd).first()) == (None, "a", "INFO", "m")
