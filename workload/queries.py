"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qlens.config import KEYWORDS
from qlens.functions import dates, text, validation
from qlens.functions.responses import parse_distinct_responses
from qlens.operators import classify, gaps, ledger, lookup, questions, report, summary
from qlens.period import Period, data_day_spine, in_period, loaded_on, shortcut_table
from qlens.plans.runs import complete_run
from qlens.sources.logs import parse_log_lines
from qlens.storage import kept
from workload import views as v
from workload.views import PERIOD, SECOND_LOAD, WEEK

Query = Callable[[SparkSession, str], DataFrame]
LOADED = datetime(2024, 2, 3, 1, 0, 0)
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a query under its function's name, without a trailing underscore."""
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


# --- scans and filters -------------------------------------------------------


@query
def scan_chats(spark, d):
    return v.chats(spark, d)


@query
def scan_keywords(spark, d):
    return v.keywords(spark, d).select(*KEYWORDS)


@query
def period_filter(spark, d):
    return in_period(v.chats(spark, d), WEEK)


@query
def period_shortcuts(spark, d):
    return shortcut_table(v.chats(spark, d), "created_at")


@query
def day_spine(spark, d):
    return data_day_spine(v.chats(spark, d))


@query
def loaded_on_(spark, d):
    return loaded_on(v.keywords(spark, d), SECOND_LOAD).select(*KEYWORDS)


@query
def classified_rows(spark, d):
    return summary.classified_rows(v.keywords(spark, d), v.categories(spark), PERIOD)


@query
def log_lines(spark, d):
    return parse_log_lines(v.log_lines(spark, d))


@query
def log_counts(spark, d):
    return ledger.log_counts(parse_log_lines(v.log_lines(spark, d)))


# --- questions ---------------------------------------------------------------


@query
def unique_questions(spark, d):
    return questions.unique_questions(v.chats(spark, d), PERIOD)


@query
def unique_questions_per_day(spark, d):
    return questions.unique_questions_per_day(v.chats(spark, d), PERIOD)


@query
def repeat_count_window(spark, d):
    return questions.with_repeat_count(v.chats(spark, d))


@query
def latest_per_question(spark, d):
    return questions.latest_per_question(v.chats(spark, d))


@query
def distinct_questions(spark, d):
    return questions.distinct_questions(v.chats(spark, d), PERIOD)


@query
def existing_keys(spark, d):
    return questions.existing_keys(v.keywords(spark, d), PERIOD)


@query
def skip_existing(spark, d):
    asked = questions.unique_questions_per_day(v.chats(spark, d), PERIOD)
    return questions.skip_existing(asked, v.keywords(spark, d), PERIOD)


@query
def resume_offset(spark, d):
    return questions.resume_offset(questions.unique_questions(v.chats(spark, d), PERIOD, ordered=False), 100)


# --- classification summary --------------------------------------------------


@query
def first_occurrence(spark, d):
    return summary.first_occurrence(v.keywords(spark, d), PERIOD)


@query
def earliest_keyword(spark, d):
    return summary.earliest_keyword(v.keywords(spark, d), PERIOD)


@query
def earliest_category(spark, d):
    return summary.earliest_category(v.keywords(spark, d), PERIOD)


@query
def all_default_flag(spark, d):
    return summary.all_default_flag(v.keywords(spark, d), PERIOD)


@query
def classify_summary(spark, d):
    return summary.classify_summary(v.keywords(spark, d), v.categories(spark), PERIOD)


@query
def classify_summary_week(spark, d):
    return summary.classify_summary(v.keywords(spark, d, WEEK), v.categories(spark), WEEK)


@query
def category_lookup(spark, d):
    return lookup.with_category_name(v.keywords(spark, d).select(*KEYWORDS), v.categories(spark))


# --- gaps and coverage -------------------------------------------------------


@query
def missing_first_day(spark, d):
    return gaps.missing_pairs(v.chats(spark, d), v.keywords(spark, d), PERIOD, "first_day")


@query
def missing_per_day(spark, d):
    return gaps.missing_pairs(v.chats(spark, d), v.keywords(spark, d), PERIOD, "per_day")


@query
def missing_ever(spark, d):
    return gaps.missing_pairs(v.chats(spark, d), v.keywords(spark, d), PERIOD, "ever")


@query
def missing_loaded_since(spark, d):
    return gaps.missing_pairs(v.chats(spark, d), v.keywords(spark, d), PERIOD, "per_day", SECOND_LOAD)


@query
def missing_work(spark, d):
    return gaps.missing_work(v.chats(spark, d), v.keywords(spark, d), PERIOD, "first_day")


@query
def missing_work_limit(spark, d):
    return gaps.missing_work(v.chats(spark, d), v.keywords(spark, d), PERIOD, "per_day", limit=106)


@query
def missing_detail(spark, d):
    out = gaps.missing_detail(v.chats(spark, d), v.keywords(spark, d), PERIOD, "first_day")
    return out.orderBy("missing_date", F.col("missing_count").desc(), "input_text")


@query
def missing_status(spark, d):
    return gaps.missing_status(v.chats(spark, d), v.keywords(spark, d), PERIOD, "first_day")


@query
def missing_pairs_per_day(spark, d):
    return gaps.missing_pairs_per_day(v.chats(spark, d), v.keywords(spark, d), PERIOD)


@query
def verify_remaining(spark, d):
    return gaps.verify_remaining(v.chats(spark, d), v.keywords(spark, d), PERIOD)


@query
def verify_verdict(spark, d):
    return gaps.verify_verdict(gaps.verify_remaining(v.chats(spark, d), v.keywords(spark, d), PERIOD))


@query
def final_missing(spark, d):
    return gaps.final_missing(v.chats(spark, d), v.keywords(spark, d), PERIOD, SECOND_LOAD)


@query
def union_classified(spark, d):
    return gaps.union_classified(v.keywords(spark, d), v.categories(spark), PERIOD, SECOND_LOAD)


@query
def final_missing_union(spark, d):
    return gaps.final_missing_union(
        v.chats(spark, d), v.keywords(spark, d), v.categories(spark), PERIOD, SECOND_LOAD
    )


@query
def coverage_by_day(spark, d):
    return gaps.coverage_by_day(v.chats(spark, d), v.keywords(spark, d), PERIOD)


@query
def coverage_totals(spark, d):
    return gaps.coverage_totals(gaps.coverage_by_day(v.chats(spark, d), v.keywords(spark, d), PERIOD))


@query
def load_verdict(spark, d):
    return gaps.load_verdict(v.chats(spark, d), v.keywords(spark, d), PERIOD, SECOND_LOAD)


# --- report ------------------------------------------------------------------


def _rows(spark, d, period=PERIOD):
    return report.report_rows(v.keywords(spark, d), v.categories(spark), period)


@query
def report_rows(spark, d):
    return _rows(spark, d)


@query
def report_overview(spark, d):
    return report.report_overview(_rows(spark, d), PERIOD)


@query
def report_overview_sheet(spark, d):
    return report.overview_sheet(report.report_overview(_rows(spark, d), PERIOD)).toDF("item", "value")


@query
def report_by_category(spark, d):
    return report.report_by_category(_rows(spark, d))


@query
def report_by_day(spark, d):
    return report.report_by_day(_rows(spark, d))


@query
def report_top_keywords(spark, d):
    return report.report_top_keywords(_rows(spark, d))


@query
def report_top_questions(spark, d):
    return report.report_top_questions(kept(_rows(spark, d)))


@query
def report_placeholder(spark, d):
    """Main sheets of a period with data and of one without, under plain column names."""
    empty = Period("2025-06-11", "2025-06-19")
    names = ("query_text", "keyword", "category_name", "query_count", "created_at")
    full, none = (report.main_sheet_or_placeholder(kept(_rows(spark, d, p)), p).toDF(*names) for p in (PERIOD, empty))
    return full.withColumn("sheet", F.lit("full")).unionByName(none.withColumn("sheet", F.lit("empty")))


@query
def report_titled_sheets(spark, d):
    """The six sheets under their printed names and titles, a line for each row."""

    def lines(name, sheet):
        cells = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in sheet.columns]
        return sheet.select(F.lit(name).alias("sheet"), F.concat_ws(" | ", *cells).alias("line"))

    sheets = report.report_sheets(kept(_rows(spark, d)), PERIOD)
    return reduce(DataFrame.unionByName, (lines(name, sheet) for name, sheet in sheets.items()))


@query
def report_ellipsis(spark, d):
    return v.texts(spark, d).select("id", text.ellipsis("text", 100).alias("shown"))


# --- bookkeeping -------------------------------------------------------------


@query
def daily_totals(spark, d):
    return ledger.daily_totals(v.chats(spark, d), PERIOD)


@query
def keyword_daily(spark, d):
    return ledger.keyword_daily(v.keywords(spark, d), PERIOD)


@query
def keyword_daily_loaded(spark, d):
    return ledger.keyword_daily(v.keywords(spark, d), PERIOD, SECOND_LOAD)


@query
def keyword_volume(spark, d):
    return ledger.keyword_volume(v.keywords(spark, d), PERIOD)


@query
def daily_reconciliation(spark, d):
    return ledger.daily_reconciliation(v.chats(spark, d), v.keywords(spark, d), v.categories(spark), PERIOD)


@query
def result_diff(spark, d):
    """Work lists under two meanings of missing, row by row."""
    a = gaps.missing_work(v.chats(spark, d), v.keywords(spark, d), PERIOD, "per_day")
    b = gaps.missing_work(v.chats(spark, d), v.keywords(spark, d), PERIOD, "ever")
    return ledger.result_diff(a, b)


@query
def run_ledger(spark, d):
    """Messages asked against fact rows written, storable rows only."""
    asked = questions.unique_questions_per_day(v.chats(spark, d), PERIOD)
    good, bad = classify.split_rejects(v.keywords(spark, d))
    return ledger.run_ledger(asked, good, PERIOD, bad)


@query
def run_totals(spark, d):
    return ledger.run_totals(run_ledger(spark, d))


@query
def complete_run_(spark, d):
    return complete_run(v.chats(spark, d), v.keywords(spark, d), v.categories(spark), PERIOD, LOADED)


@query
def reject_split(spark, d):
    good, bad = classify.split_rejects(v.keywords(spark, d).select(*KEYWORDS))
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)


@query
def reject_counts(spark, d):
    return classify.reject_counts(v.keywords(spark, d))


# --- text functions over whole texts -----------------------------------------


@query
def rule_category(spark, d):
    return v.texts(spark, d).select("id", text.rule_category("text").alias("category_name"))


@query
def rule_keyword(spark, d):
    return v.texts(spark, d).select("id", text.rule_keyword("text").alias("keyword"))


@query
def first_meaningful_word(spark, d):
    return v.texts(spark, d).select("id", text.first_meaningful_word("text").alias("word"))


@query
def simple_keyword(spark, d):
    return v.texts(spark, d).select("id", text.simple_keyword("text").alias("keyword"))


@query
def fallback_classify(spark, d):
    item = F.explode_outer(text.fallback_classify("text")).alias("item")
    return v.texts(spark, d).select("id", item).filter("item IS NOT NULL").select(
        "id", "item.keyword", F.explode("item.categories").alias("category_name")
    )


@query
def clean_keyword(spark, d):
    return v.candidates(spark, d).select("id", "kind", text.clean_keyword("keyword", "text").alias("keyword"))


@query
def cap_keyword(spark, d):
    return v.candidates(spark, d).select("id", "kind", text.cap_by_question("keyword", "text").alias("keyword"))


@query
def truncate_keyword(spark, d):
    return v.candidates(spark, d).select(
        "id",
        "kind",
        text.truncate_keyword("keyword").alias("keyword"),
        text.truncate_keyword("keyword", legacy=True).alias("legacy_keyword"),
    )


@query
def backfill_keyword(spark, d):
    return v.candidates(spark, d).select("id", "kind", text.backfill_keyword("keyword", "text").alias("keyword"))


@query
def normalize_categories(spark, d):
    """The comma and line separated parts of every text taken as a raw category list."""
    raw = F.split("text", "[,\n]")
    names = text.normalize_categories(F.when(F.col("text").isNotNull(), raw))
    return v.texts(spark, d).select("id", F.posexplode(names).alias("pos", "category_name"))


@query
def normalize_day(spark, d):
    """Event times written in mixed layouts."""
    ts = F.col("ts")
    mixed = (
        F.when(F.col("k") < 20, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("k") < 40, F.date_format(ts, "yyyy-MM-dd"))
        .when(F.col("k") < 60, F.date_format(ts, "yyyy-M-d"))
        .when(F.col("k") < 70, F.date_format(ts, "yyyy/MM/dd HH:mm"))
        .when(F.col("k") < 80, F.lit("2024-2-30"))
        .when(F.col("k") < 90, F.date_format(ts, "yyyyMMddHHmmss"))
    )
    return v.events(spark, d).select(
        "event_id", dates.normalize_day(mixed).alias("day"), dates.normalize_day(ts, is_text=False).alias("ts_day")
    )


@query
def duration_format(spark, d):
    """Time between a user's first and last message of a day."""
    spans = (
        v.events(spark, d)
        .groupBy("user_id", F.to_date("ts").alias("date"))
        .agg((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).alias("us"))
    )
    seconds = F.col("us") / 1000000
    return spans.select(
        "user_id",
        "date",
        dates.duration_ms(seconds).alias("minutes_seconds"),
        dates.duration_hms(seconds).alias("hours_minutes_seconds"),
    )


@query
def validation_counts(spark, d):
    """Rules over documents and events; one row per rule and table."""
    docs = v.table(spark, d, "documents").withColumn("email", F.regexp_extract("text", r"[^ \n]+@[^ \n]+", 0))
    on_docs = validation.violations(
        docs,
        {
            "email": validation.valid_email("email"),
            "text": validation.non_empty("text"),
            "size": validation.positive_number("n_chars"),
        },
    ).withColumn("source", F.lit("documents"))
    ev = v.events(spark, d)
    label = F.concat(F.lit("2024-"), F.col("k").cast("string"), F.lit("-"), F.pmod("user_id", F.lit(40)).cast("string"))
    args = F.when(F.col("k") < 50, F.concat(F.lit('[{"keyword":"'), F.col("event_type"), F.lit('","categories":["기타"]}]'))).when(
        F.col("k") < 60, F.lit('[{"keyword":5,"categories":["기타"]}]')
    ).when(F.col("k") < 70, F.lit('[{"keyword":"a","categories":"기타"}]')).when(
        F.col("k") < 80, F.lit('[{"keyword":"a","categories":["기타",null]}]')
    ).when(F.col("k") < 90, F.lit('{"keyword":"a"}'))
    on_events = validation.violations(
        ev,
        {
            "day": validation.valid_day(label),
            "question": validation.non_empty("question"),
            "count": validation.positive_integer(F.col("k").cast("string")),
            "names": validation.string_list(F.array("event_type", "question")),
            "structure": validation.keyword_structure(args),
        },
    ).withColumn("source", F.lit("events"))
    return on_docs.unionByName(on_events)


# --- classification ----------------------------------------------------------


def _flat(classified: DataFrame, *cols: str) -> DataFrame:
    items = classified.select(*cols, F.posexplode_outer("classification").alias("item_pos", "item"))
    return items.filter("item IS NOT NULL").select(
        *cols, "item_pos", "item.keyword", F.posexplode("item.categories").alias("category_pos", "category_name")
    )


def _parsed(spark, d):
    return parse_distinct_responses(v.responses(spark, d), spread=["chatting_pk"])


@query
def parse_responses(spark, d):
    return _flat(_parsed(spark, d), "chatting_pk")


@query
def explode_classification(spark, d):
    parsed = _parsed(spark, d).drop("response")
    return classify.explode_classification(parsed)


@query
def category_resolve(spark, d):
    parsed = _parsed(spark, d).drop("response")
    return lookup.resolve_category_ids(classify.explode_classification(parsed), v.categories(spark))


@query
def category_distribution(spark, d):
    return classify.category_distribution(category_resolve(spark, d))


@query
def classify_questions(spark, d):
    asked = questions.unique_questions_per_day(v.chats(spark, d), PERIOD)
    return classify.classify_questions(asked, v.categories(spark), LOADED)


@query
def skipped_questions(spark, d):
    asked = questions.unique_questions_per_day(v.chats(spark, d), PERIOD)
    good, _ = classify.split_rejects(v.keywords(spark, d))
    return classify.skipped_questions(asked, good)


@query
def classify_with_caller(spark, d):
    def sample_classifier(question: str):
        """A caller's classifier: last word but one as keyword, no answer for one kind of question."""
        if question.startswith("오류"):
            raise RuntimeError("no answer")
        return [{"keyword": question.split()[-2], "categories": ["학생 생활", "기타"]}]

    asked = questions.unique_questions_per_day(v.chats(spark, d), PERIOD)
    return classify.classify_questions(asked, v.categories(spark), LOADED, sample_classifier)
