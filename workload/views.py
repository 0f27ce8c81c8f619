"""The three chat tables, derived by Spark from the given parquet tables.

``chattings``            one message per event: a phrase by event type plus the number in ``props``
``admin_chat_keywords``  classified rows: events grouped by question, keyword, category and day,
                         with known holes (an outage, questions never classified, small values)
``admin_categories``     the fixed category names, ids in list order
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qlens.config import KEYWORDS
from qlens.functions.fixed_values import CATEGORY_NAMES
from qlens.functions.text import strip
from qlens.operators.lookup import bounded_dimension
from qlens.period import Period
from qlens.sources.sinks import append_keywords
from qlens.sources.tables import read_keywords
from qlens.storage import checkpoint_dir, join_path

# Every event lies in January 2024, so this period covers the whole table.
PERIOD = Period(date(2024, 1, 1), date(2024, 1, 31))
# Half of the data, for the filters whose point is to leave rows out.
WEEK = Period(date(2024, 1, 5), date(2024, 1, 11))
SECOND_LOAD = date(2024, 2, 2)

PHRASES = {
    "click": "전학 신청 서류",
    "view": "성적 확인 방법",
    "purchase": "졸업 증명서 발급",
    "error": "오류 화면 문의",
    "signup": "기숙사 생활 규정",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their number ``k`` and the question text; some questions are NULL."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_replace("props", "[^0-9]", "").cast("int")
    phrase = None
    for kind, words in PHRASES.items():
        phrase = F.when(F.col("event_type") == kind, words) if phrase is None else phrase.when(F.col("event_type") == kind, words)
    return e.withColumn("k", k).withColumn(
        "question",
        F.when((F.col("event_type") == "signup") & (F.col("k") == 3), None).otherwise(
            F.concat(phrase, F.lit(" "), F.col("k").cast("string"))
        ),
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("chatting_pk"), F.col("question").alias("input_text"), F.col("ts").alias("created_at")
    )


def categories(spark: SparkSession) -> DataFrame:
    rows = [(i, name) for i, name in enumerate(CATEGORY_NAMES, start=1)]
    return bounded_dimension(spark.createDataFrame(rows, "category_id int, category_name string"))


def keywords(spark: SparkSession, sf_dir: str, period: Period | None = None) -> DataFrame:
    """The classified fact as the library stores it: parquet by day, read back through its reader.

    Derived from the events once per application and kept in the checkpoint
    folder, because a fact table is an input of the queries, not part of them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fact_folders:
        folder = join_path(checkpoint_dir(spark), f"workload-{key[0]}-{len(_fact_folders)}", "admin_chat_keywords")
        append_keywords(derived_keywords(spark, sf_dir), folder, mode="overwrite")
        _fact_folders[key] = folder
    return read_keywords(spark, _fact_folders[key], period=period)


_fact_folders: dict[tuple[str, str], str] = {}


def derived_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified rows made from events, with NULL and unknown categories and NULL questions among them."""
    ntz = "timestamp_ntz"
    e = events(spark, sf_dir).filter(
        (F.col("value") >= 2.0)
        & (F.col("k") >= 5)
        & ~((F.col("event_type") == "error") & (F.col("ts") >= F.lit("2024-01-20 00:00:00").cast(ntz)))
        | F.col("question").isNull()
    )
    first, rest = F.split_part("question", F.lit(" "), F.lit(1)), F.split_part("question", F.lit(" "), F.lit(2))
    category = (
        F.when(F.col("k") == 98, None)
        .when(F.col("k") == 97, 12)
        .when(F.col("k") == 96, F.when(F.col("user_id") < 50, 11))
        .when(F.col("k").between(70, 79) | (F.col("value") < 15.0), 11)
        .otherwise(1 + F.pmod("user_id", F.lit(10)))
    )
    return (
        e.groupBy(
            F.col("question").alias("query_text"),
            F.when(F.col("value") < 40.0, first).otherwise(F.concat(first, F.lit(" "), rest)).alias("keyword"),
            category.cast("int").alias("category_id"),
            F.to_date("ts").cast(ntz).alias("created_at"),
        )
        .agg(F.count(F.lit(1)).alias("query_count"))
        .withColumn(
            "batch_created_at",
            F.when(F.col("created_at") < F.lit("2024-01-15 00:00:00").cast(ntz), F.lit("2024-02-01 01:00:00"))
            .otherwise(F.lit("2024-02-02 01:00:00"))
            .cast(ntz),
        )
        .select(*KEYWORDS)
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of every kind: conversations, documents and chat questions."""
    return (
        table(spark, sf_dir, "conversations")
        .select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text")
        .unionByName(table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text"))
        .unionByName(
            events(spark, sf_dir).select(F.concat(F.lit("e"), "event_id").alias("id"), F.col("question").alias("text"))
        )
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a keyword of every awkward shape."""
    kind, t = F.col("kind"), F.col("text")
    made = (
        F.when(kind == 0, t)
        .when(kind == 1, F.concat(F.lit(" ("), strip("text"), F.lit(")! ")))
        .when(kind == 2, F.length("text").cast("string"))
        .when(kind == 3, F.lit("기타"))
        .when(kind == 4, F.lit("  "))
        .when(kind == 5, F.lit("."))
        .when(kind == 6, F.concat(t, t, t, t))
        .otherwise(F.repeat(F.lit("a"), 150))
    )
    kinds = F.explode(F.sequence(F.lit(0), F.lit(7)))
    return texts(spark, sf_dir).withColumn("kind", kinds).withColumn("keyword", made)


# Answers in every shape a classifier has been seen to give; <q> stands for the question.
RESPONSE_SHAPES = [
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":{"keywords_with_categories":[{"keyword":" <q> ","categories":["학생 생활"," 입학 관련 "]}]}}}]}}}',
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":"{\\"keywords_with_categories\\":[{\\"keyword\\":\\"(서류)\\",\\"categories\\":\\"정보공개\\"}]}"}}]}}}',
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":"{broken"}}]}}}',
    '{"result":{"message":{"content":"<q>"}}}',
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":{"keywords_with_categories":[{"keyword":"123","categories":[]},{"keyword":"","categories":["기타"]},"x",{"keyword":"<q>!","categories":["","검정고시",null]}]}}}]}}}',
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":{"keywords_with_categories":[{"keyword":null,"categories":["기타"]},{"keyword":"성적","categories":["기타"]}]}}}]}}}',
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":{"keywords_with_categories":[{"keyword":"성적","categories":["평가(성적) 관련",5]}]}}}]}}}',
    '{"result":{"message":{"toolCalls":[{"function":{"arguments":{"keywords_with_categories":[{"keyword":"졸업","categories":7},{"keyword":"기타","categories":["없는 이름"]}]}}}]}}}',
    "not json",
]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chat message with a classifier answer; the shape follows the user."""
    shapes = F.array(*[F.lit(s) for s in RESPONSE_SHAPES])
    return events(spark, sf_dir).select(
        F.col("event_id").alias("chatting_pk"),
        F.col("question").alias("input_text"),
        F.to_date("ts").alias("created_at"),
        F.lit(1).cast("bigint").alias("total_count"),
        F.replace(
            F.element_at(shapes, F.pmod("user_id", F.lit(len(RESPONSE_SHAPES))).cast("int") + 1),
            F.lit("<q>"),
            F.coalesce("question", F.lit("")),
        ).alias("response"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run-log line per event."""
    level = (
        F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARNING").otherwise("INFO")
    )
    message = (
        F.when(F.col("k") < 20, "API 호출 성공")
        .when(F.col("k") < 30, "API 호출 실패: timeout")
        .when((F.col("event_type") == "error") & (F.col("k") < 60), F.concat(F.lit("❌ 청크 "), F.col("k").cast("string"), F.lit(" 처리 실패")))
        .when(F.col("k") < 60, F.concat(F.lit("🎉 배치 "), F.col("k").cast("string"), F.lit(" 처리 완료 - 끝")))
        .otherwise(F.concat(F.lit("처리 중 - "), F.coalesce("question", F.lit(""))))
    )
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.when(F.col("k").between(20, 25), " - classifier - ").otherwise(" - nightly_run - "),
        level,
        F.lit(" - "),
        message,
    )
    return events(spark, sf_dir).select(
        F.when(F.col("k") == 99, F.concat(F.lit("  File "), F.col("k").cast("string"))).otherwise(line).alias("value")
    )
