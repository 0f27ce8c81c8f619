from datetime import datetime

import pytest
from helpers import rows

from qlens import Period, SchemaConfig, Workspace, complete_run

P = Period("2025-06-11", "2025-06-12")
LOADED = datetime(2025, 6, 20, 1)


@pytest.fixture
def chats(make_chats):
    return make_chats(
        ("전학 절차", "2025-06-11T09:00:00"),
        ("전학 절차", "2025-06-11T10:00:00"),
        ("전학 절차", "2025-06-12T10:00:00"),
        ("성적 확인", "2025-06-12T10:00:00"),
        (None, "2025-06-12T10:00:00"),
    )


def test_classify_check_repair_report(spark, chats, categories, tmp_path):
    ws = Workspace(spark, chats, categories, str(tmp_path / "facts"), str(tmp_path / "rejects"))
    assert ws.facts().count() == 0
    first = ws.run_batch(Period("2025-06-11", "2025-06-11"), LOADED)
    assert tuple(first.totals.first())[:4] == (1, 1, 1, 0)
    assert rows(ws.facts().select("query_text", "keyword", "category_id", "query_count")) == [("전학 절차", "전학", 5, 2)]

    by_day, totals = ws.check_missing(P)
    assert [tuple(r)[1:] for r in by_day.collect()] == [(1, 2, 1, 0), (2, 3, 0, 2)]
    assert tuple(totals.first()) == (3, 1, 2, 33.3)

    repaired = ws.process_missing(P, mode="per_day", loaded=LOADED)
    assert rows(repaired.verdict) == [(0, True)]
    assert repaired.totals.first().processed_count == 2 and repaired.totals.first().skipped_count == 1
    assert ws.facts(P).count() == 3

    # Everything is done: a repeated run adds nothing, the NULL question stays skipped.
    again = ws.run_batch(P, LOADED)
    assert again.totals.first().processed_count == 0 and ws.facts().count() == 3

    folders = ws.report(P, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(folders["채팅키워드분류"]).count() == 3
    assert len(folders) == 6


def test_a_period_without_messages(spark, chats, categories, tmp_path):
    ws = Workspace(spark, chats, categories, str(tmp_path / "facts"), str(tmp_path / "rejects"))
    later = Period("2026-01-01", "2026-01-02")
    assert tuple(ws.run_batch(later, LOADED).totals.first()) == (2, 0, 0, 0, "", "SUCCESS")
    assert ws.facts().count() == 0
    assert tuple(ws.check_missing(later)[1].first()) == (0, 0, 0, 0.0)
    assert ws.repair(later) is None
    folders = ws.report(later, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(folders["채팅키워드분류"]).first()[0] == "데이터 없음"


def test_physical_names_reach_the_fact_table(spark, chats, categories, tmp_path):
    cfg = SchemaConfig(columns={"query_text": "content", "created_at": "day"})
    ws = Workspace(spark, chats, categories, str(tmp_path / "facts"), cfg=cfg)
    ws.run_batch(P, LOADED)
    assert "content" in spark.read.parquet(str(tmp_path / "facts")).columns
    assert ws.facts(P).count() == 3 and ws.check_missing(P)[1].first().total_missing_questions == 1


def test_run_without_skipping_repeats_rows_like_a_plain_append(spark, chats, categories, tmp_path):
    ws = Workspace(spark, chats, categories, str(tmp_path / "facts"))
    for _ in range(2):
        ws.run_batch(P, LOADED, skip_done=False)
    assert ws.facts().count() == 6


def test_repair_runs_only_when_something_was_never_classified(spark, chats, categories, tmp_path):
    ws = Workspace(spark, chats.filter("input_text IS NOT NULL"), categories, str(tmp_path / "facts"))
    assert ws.repair(P, mode="per_day").verdict.first().verification_success
    assert ws.repair(P) is None


def test_first_day_repair_repeats_later_days(spark, chats, categories, tmp_path):
    ws = Workspace(spark, chats, categories, str(tmp_path / "facts"))
    ws.run_batch(P, LOADED)
    done = ws.process_missing(P, loaded=LOADED)
    # The later day of the repeated question and the NULL question were "missing".
    assert done.totals.first().total_rows == 2 and done.totals.first().processed_count == 1


def test_work_limit_is_applied(spark, chats, categories, tmp_path):
    ws = Workspace(spark, chats.filter("input_text IS NOT NULL"), categories, str(tmp_path / "facts"))
    assert ws.process_missing(P, mode="per_day", limit=1).totals.first().total_rows == 1
    assert ws.facts().count() == 1


def test_complete_run(chats, make_keywords, categories):
    none = make_keywords(("x", "k", 1, 1, "2025-06-11")).limit(0)
    r = complete_run(chats, none, categories, P, LOADED).first().asDict()
    assert r == {
        "basic_questions": 4,
        "basic_rows": 3,
        "basic_skipped": 1,
        "missing_found": 1,
        "missing_questions": 2,
        "missing_rows": 1,
        "missing_skipped": 1,
        "remaining_missing": 0,
        "total_rows_written": 4,
        "verification_success": True,
    }
    clean = complete_run(chats.filter("input_text IS NOT NULL"), none, categories, P, LOADED).first()
    assert (clean.missing_found, clean.missing_questions, clean.total_rows_written) == (0, 0, 3)


def test_checkpoint_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from qlens import storage

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return {}

    with pytest.raises(RuntimeError):
        storage.checkpoint_dir(Cluster())
    assert storage.checkpoint_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
