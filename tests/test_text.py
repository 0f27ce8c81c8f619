"""Pinned cases, worked out by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from qlens.functions import dates, text, validation

LONG = "안녕하세요 " + "가" * 403  # 409 characters


def value(spark, expr, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(expr.alias("x")).first().x


QUESTIONS = [
    # question, category (first rule), keyword (longest word)
    ("전학을 신청하려면 어떤 서류가 필요한가요?", "전학, 편입", "전학"),
    ("성적표는 어떻게 발급받나요?", "평가(성적) 관련", "성적"),
    ("학교폭력 신고는 어디에 하나요?", "학교폭력", "학교폭력"),
    ("검정고시 접수 기간이 언제인가요?", "검정고시", "검정고시"),
    ("교사 임용고시 일정을 알려주세요", "교권보호 (교육활동 보호)", "임용고시"),
    ("수강신청은 언제 하나요?", "학생 생활", "수강신청"),
    ("휴학 신청 절차는 어떻게 되나요?", "학생 생활", "휴학"),
    ("장학금 신청 기간은 언제인가요?", "학생 생활", "장학금"),
    ("날씨가 좋네요 정말", "기타", "날씨가"),
    ("이 가 abc", "기타", "abc"),
    ("가 나 다", "기타", "가 나 다"),
]


@pytest.mark.parametrize("question, category, keyword", QUESTIONS)
def test_rules(spark, question, category, keyword):
    assert value(spark, text.rule_category("c0"), question) == category
    assert value(spark, text.rule_keyword("c0"), question) == keyword
    item = value(spark, text.fallback_classify("c0"), question)[0]
    assert (item.keyword, item["categories"]) == (keyword, [category])


def test_category_is_the_first_rule_and_keyword_the_longest(spark):
    q = "시험 임용고시"
    assert value(spark, text.rule_category("c0"), q) == "평가(성적) 관련"
    assert value(spark, text.rule_keyword("c0"), q) == "임용고시"


def test_own_rules_match_lower_cased_text_for_category_and_raw_text_for_keyword(spark):
    rules = {"gpa": "평가(성적) 관련", "GPA score": "입학 관련"}
    q = "My GPA score"
    assert value(spark, text.rule_category("c0", rules), q) == "평가(성적) 관련"
    assert value(spark, text.rule_keyword("c0", rules), q) == "GPA score"
    item = value(spark, text.fallback_classify("c0", rules), q)[0]
    assert (item.keyword, item["categories"]) == ("GPA score", ["평가(성적) 관련"])


def test_null_text_has_no_answer(spark):
    for fn in (text.rule_category, text.rule_keyword, text.simple_keyword, text.first_meaningful_word, text.fallback_classify):
        assert value(spark, fn("c0"), None) is None


@pytest.mark.parametrize(
    "t, word",
    [
        ("에서 습니다 도서관", "도서관"),
        ("가　나다 라", "나다"),  # ideographic space
        ("a\x1cbcd", "bcd"),  # separator control characters split words too
        ("  \x85xy", "xy"),
        ("ab\xa0cd", "ab"),
        ("한" * 30, "한" * 20),
        ("𝐀 𝐁𝐂", "𝐁𝐂"),
        ("𝐀" * 25, "𝐀" * 20),
        ("", ""),
        ("   ", ""),
        ("a b c d e f g", "a b c d e"),
        ("에서의 길", "에서의"),
        ("x 에서", "x 에서"),
    ],
)
def test_first_meaningful_word(spark, t, word):
    assert value(spark, text.first_meaningful_word("c0"), t) == word


@pytest.mark.parametrize(
    "t, keyword",
    [
        ("수강신청은 언제 하나요?", "수강신청"),
        ("시험과 성적", "성적"),
        ("어떻게 하는 건가요", "건가요"),
        ("라서 있다", "라서"),  # not a stop word in this list
        ("가 나", "가 나"),
        ("가 나 다 라 마 바 사", "가 나 다 라 마"),
    ],
)
def test_simple_keyword(spark, t, keyword):
    assert value(spark, text.simple_keyword("c0"), t) == keyword


@pytest.mark.parametrize(
    "keyword, question, cleaned",
    [
        (LONG, LONG, "안녕하세요"),
        ("a" * 150, "수강신청 문의", "수강신청"),
        ("b" * 101, " ", "기타"),
        ("가" * 60, "가" * 60, "가" * 20),
        ("가" * 60, "다른 질문", "가" * 60),
        ("수강신청", "질문", "수강신청"),
        ("x", "질문", "기타"),
        ("", "질문", "기타"),
        ("12345", "질문", "기타"),
        ("١٢٣", "질문", "기타"),
        ("²³", "질문", "기타"),
        ("12a", "질문", "12a"),
        ('"(서류)!"', "질문", "서류"),
        ("(a)", "질문", "기타"),
        ("!?", "질문", "기타"),
        ("12\n", "질문", "12"),
    ],
)
def test_clean_keyword(spark, keyword, question, cleaned):
    assert value(spark, text.clean_keyword("c0", "c1"), keyword, question) == cleaned


def test_caps(spark):
    assert value(spark, text.cap_by_question("c0", "c1"), "a" * 101, LONG) == LONG[:95] + "..."
    assert value(spark, text.cap_by_question("c0", "c1"), "a" * 101, "짧은 질문") == "짧은 질문"
    assert value(spark, text.cap_by_question("c0", "c1"), "a" * 100, LONG) == "a" * 100
    for n, kept, legacy in ((100, 100, 100), (101, 100, 101), (410, 100, 101)):
        assert len(value(spark, text.truncate_keyword("c0"), "k" * n)) == kept
        assert len(value(spark, text.truncate_keyword("c0", legacy=True), "k" * n)) == legacy
    assert value(spark, text.truncate_keyword("c0"), "k" * 410) == "k" * 97 + "..."


def test_backfill(spark):
    q = "졸업 증명서 발급"
    assert value(spark, text.backfill_keyword("c0", "c1"), " 기타 ", q) == "졸업"
    assert value(spark, text.backfill_keyword("c0", "c1"), "  ", q) == "졸업"
    assert value(spark, text.backfill_keyword("c0", "c1"), "서류", q) == "서류"
    assert value(spark, text.backfill_keyword("c0", "c1"), "기타", " ") == "기타"


def test_normalize_categories(spark):
    df = spark.createDataFrame([(1, [" 입학 관련 ", "", None, " "]), (2, []), (3, None), (4, ["　"])], "id int, c array<string>")
    got = {r.id: r.x for r in df.select("id", text.normalize_categories("c").alias("x")).collect()}
    assert got == {1: ["입학 관련"], 2: ["기타"], 3: ["기타"], 4: ["기타"]}


def test_ellipsis_and_key(spark):
    assert value(spark, text.ellipsis("c0"), "가" * 101) == "가" * 100 + "..."
    assert value(spark, text.ellipsis("c0"), "가" * 100) == "가" * 100
    ts = F.lit("2025-06-19 10:00:00").cast("timestamp_ntz")
    assert value(spark, text.question_key("c0", ts), "질문") == "질문|2025-06-19"
    assert value(spark, text.question_key("c0", ts), None) is None


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2025-06-19 10:00:00", "2025-06-19"),
        ("2025-06-19", "2025-06-19"),
        ("2025-6-9", "2025-06-09"),
        ("2025-2-30", "2025-2-30"),
        ("2025-6-9 1:00", "2025-6-9 1"),
        ("2025/06/19 10:00", "2025/06/19"),
        ("20250619", "20250619"),
        (None, None),
    ],
)
def test_normalize_day(spark, raw, day):
    assert value(spark, dates.normalize_day("c0"), raw) == day


@pytest.mark.parametrize(
    "seconds, ms, hms",
    [
        (65, "1분 5초", "1분 5초"),
        (30, "0분 30초", "30초"),
        (3661, "61분 1초", "1시간 1분 1초"),
        (3600, "60분 0초", "1시간 0분 0초"),
        (0.9, "0분 0초", "0초"),
        (59.99, "0분 59초", "59초"),
    ],
)
def test_durations(spark, seconds, ms, hms):
    df = spark.createDataFrame([(float(seconds),)], "s double")
    assert tuple(df.select(dates.duration_ms("s"), dates.duration_hms("s")).first()) == (ms, hms)


def test_validation(spark):
    cases = {
        validation.valid_email: [("a.b+c@d-e.fr", True), ("a@b", False), ("a b@c.de", False), ("a@b.c", False), (None, False), ("a@b.co\n", True)],
        validation.non_empty: [(" x ", True), ("　", False), ("", False), (None, False)],
        validation.positive_integer: [("5", True), (" 07 ", True), ("0", False), ("-3", False), ("1.5", False), ("x", False), ("1_000", True), (None, False), ("５", True), ("０", False), ("٣", True), ("5\n", True), ("5_", False), ("1\n2", False)],
        validation.valid_day: [("2024-02-29", True), ("2024-2-9", True), ("2023-02-29", False), ("2024/01/01", False), ("20240101", False), (None, False), ("2024-1-1\n", False), ("２０２４-01-01", True), ("٢٠٢٤-٢-٣٠", False), ("2024-᠑-१", True)],
        validation.keyword_structure: [
            ('[{"keyword":"a","categories":["b"]}]', True),
            ("[]", True),
            ('[{"keyword":"a","categories":[]}]', True),
            ('[{"keyword":1,"categories":["b"]}]', False),
            ('[{"keyword":"a","categories":"b"}]', False),
            ('[{"keyword":"a","categories":["b",2]}]', False),
            ('[{"keyword":"a"}]', False),
            ('["a"]', False),
            ('{"keyword":"a"}', False),
            ("broken", False),
            (None, False),
        ],
    }
    for rule, examples in cases.items():
        for given, expected in examples:
            assert value(spark, rule("c0"), given) is expected, (rule.__name__, given)


def test_violations_count_in_one_row_per_rule(spark):
    df = spark.createDataFrame([("a@b.cd", 1), ("x", 0), (None, None)], "mail string, n int")
    rules = {"mail": validation.valid_email("mail"), "n": validation.positive_number("n")}
    assert sorted(tuple(r) for r in validation.violations(df, rules).collect()) == [("mail", 3, 2), ("n", 3, 2)]
    assert validation.validate_rows(df, rules).filter("ok_mail AND ok_n").count() == 1


def test_keyword_length_is_a_setting(spark, categories):
    from datetime import datetime

    from qlens.config import Settings
    from qlens.operators.classify import classify_questions, reject_counts, split_rejects

    ask = lambda q: [{"keyword": "k" * 60, "categories": ["입학 관련"]}]
    asked = spark.createDataFrame([("전학 절차가 궁금합니다", 1, datetime(2025, 6, 11))], "input_text string, total_count bigint, created_at timestamp_ntz")
    short = Settings(max_keyword_length=30)
    facts = classify_questions(asked, categories, datetime(2025, 6, 20), ask, settings=short)
    assert [len(r.keyword) for r in facts.collect()] == [30]
    long = classify_questions(asked, categories, datetime(2025, 6, 20), ask)
    assert [len(r.keyword) for r in long.collect()] == [60]
    assert [r.reject_reason for r in split_rejects(long, short)[1].collect()] == ["keyword too long"]
    assert split_rejects(long)[0].count() == 1 and reject_counts(long, short).first().outcome == "keyword too long"


def test_words_are_found_whatever_else_the_text_holds(spark):
    rules = {"갉": "low", "힢x": "high", "Zed": "latin", "é": "accent"}
    texts = ["plain latin text", "갉", "a힢x", "힢 x", "zed", "ZedZed", "café", "中文 only", "", None, "\U0001f600 힢x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.w for r in df.select(text.rule_word("t", rules).alias("w")).collect()]
    want = [None if t is None else max((w for w in rules if w in t), key=len, default=None) for t in texts]
    assert got == want
