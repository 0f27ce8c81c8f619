import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from qlens.operators import classify as c

LOADED = datetime(2025, 6, 20, 1)
DAY = date(2025, 6, 19)


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame(
        [("전학 절차를 알고 싶습니다", 5, DAY), ("날씨가 좋네요", 3, DAY), ("전학 절차를 알고 싶습니다", 1, date(2025, 6, 18)), (None, 2, DAY), ("  ", 1, DAY)],
        "input_text string, total_count bigint, created_at date",
    )


def test_word_rules_give_one_row_per_question_and_day(questions, categories):
    facts = c.classify_questions(questions, categories, LOADED)
    assert facts.columns == c.FACT_COLUMNS + ["category_name"]
    assert rows(facts.select("query_text", "keyword", "category_id", "query_count", "created_at")) == [
        ("날씨가 좋네요", "날씨가", 11, 3, datetime(2025, 6, 19)),
        ("전학 절차를 알고 싶습니다", "전학", 5, 1, datetime(2025, 6, 18)),
        ("전학 절차를 알고 싶습니다", "전학", 5, 5, datetime(2025, 6, 19)),
    ]
    assert {r[0] for r in facts.select("batch_created_at").collect()} == {LOADED}
    skipped = c.skipped_questions(questions, facts)
    assert rows(skipped.select("input_text")) == [("  ",), (None,)]


def test_own_classifier_sees_each_question_once_and_may_fail(spark, questions, categories):
    calls = spark.sparkContext.accumulator(0)

    def classifier(text):
        calls.add(1)
        if text.startswith("날씨"):
            raise RuntimeError("down")
        return [{"keyword": "절차", "categories": ["전학, 편입", "없는 분류", " 기타 "]}, {"keyword": "a" * 150, "categories": "기타"}]

    facts = c.classify_questions(questions, categories, LOADED, classifier, parallelism=2)
    got = rows(facts.select("query_text", "keyword", "category_id", F.to_date("created_at")))
    assert calls.value == 3  # two questions with words and the blank one
    assert ("날씨가 좋네요", "날씨가", 11, DAY) in got
    assert ("전학 절차를 알고 싶습니다", "절차", 5, DAY) in got and ("전학 절차를 알고 싶습니다", "절차", 11, date(2025, 6, 18)) in got
    # The over-long keyword gave way to the first telling word.
    assert ("전학 절차를 알고 싶습니다", "전학", 11, DAY) in got


def test_executors_need_no_package_to_call_a_classifier(tmp_path):
    """A session started elsewhere, where this package is not on the Python path of the workers."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(c.__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {os.path.dirname(root)!r})
from pyspark.sql import SparkSession
from qlens.operators.classify import ask_classifier
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("a",)], "input_text string")
print("GOT", ask_classifier(df, lambda t: [{{"keyword": t, "categories": "b"}}]).first().response)
""",
        encoding="utf-8",
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "GOT" in done.stdout and '"keyword": "a"' in done.stdout


def test_classifier_may_return_a_raw_response(spark, questions, categories):
    raw = '{"result":{"message":{"toolCalls":[{"function":{"arguments":{"keywords_with_categories":[{"keyword":"서류","categories":["정보공개"]}]}}}]}}}'
    facts = c.classify_questions(questions.limit(1), categories, LOADED, lambda text: raw)
    assert rows(facts.select("keyword", "category_id")) == [("서류", 10)]


def test_explode_drops_blank_keywords_and_fills_default_ones(spark):
    df = spark.createDataFrame(
        [("졸업 문의", [("  ", ["기타"]), ("기타", ["a", "b"]), ("k" * 101, ["c"]), (" ok ", [])])],
        "input_text string, classification array<struct<keyword:string,categories:array<string>>>",
    )
    assert rows(c.explode_classification(df)) == [
        ("졸업 문의", "졸업 문의", "c"),
        ("졸업 문의", "졸업", "a"),
        ("졸업 문의", "졸업", "b"),
    ]


def test_classification_is_not_moved_below_the_deduplication(make_chats, categories):
    from qlens.operators.questions import unique_questions_per_day

    chats = make_chats(("전학", "2025-06-19T08:00:00"))
    facts = c.classify_questions(unique_questions_per_day(chats), categories, LOADED)
    plan = facts._sc._jvm.PythonSQLUtils.explainString(facts._jdf.queryExecution(), "simple")
    below = plan[plan.index("partial_count"):].split("BroadcastExchange")[0]
    assert "임용고시" not in below


def test_rejects_are_split_before_writing(make_keywords):
    facts = make_keywords(
        ("a", "k", 1, 1, "2025-06-19"),
        (None, "k", 1, 1, "2025-06-19"),
        ("b", None, 1, 1, "2025-06-19"),
        ("c", "k" * 101, 1, 1, "2025-06-19"),
        ("d", "k", None, 1, "2025-06-19"),
        ("e", "k", 1, None, "2025-06-19"),
    )
    good, bad = c.split_rejects(facts)
    assert rows(good.select("query_text")) == [("a",)]
    assert rows(bad.select("reject_reason")) == [
        ("category_id is null",), ("keyword is null",), ("keyword too long",), ("query_count is null",), ("query_text is null",)
    ]
    assert dict(rows(c.reject_counts(facts)))["stored"] == 1


def test_category_distribution_is_sorted(spark):
    df = spark.createDataFrame([("학습지원",)] * 5 + [("기타",)] * 2 + [("학사정보",)] * 2, "category_name string")
    assert [tuple(r) for r in c.category_distribution(df).collect()] == [("학습지원", 5), ("기타", 2), ("학사정보", 2)]
