"""Whole runs: classify a period, check and repair gaps, report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qlens.config import DEFAULTS, KEYWORDS, SchemaConfig, Settings, binary
from qlens.functions.fixed_values import CATEGORY_RULES
from qlens.operators.classify import Classifier, classify_questions, split_rejects
from qlens.operators.gaps import (
    asked_pairs,
    coverage_by_day,
    coverage_totals,
    missing_work,
    verify_remaining,
    verify_verdict,
)
from qlens.operators.ledger import run_ledger, run_totals
from qlens.operators.questions import skip_existing, unique_questions_per_day
from qlens.operators.report import report_rows, report_sheets
from qlens.period import Period
from qlens.sources.sinks import BATCH_LOAD, store_keywords, write_rejects, write_report
from qlens.sources.tables import facts_of_other_loads, read_keywords, stored_facts
from qlens.storage import in_memory, scratch


def as_questions(work: DataFrame) -> DataFrame:
    """A missing work list in the shape of unique questions."""
    return work.select(
        "input_text",
        F.col("missing_count").alias("total_count"),
        F.col("missing_date").alias("created_at"),
    )


def complete_run(
    chats: DataFrame,
    keywords: DataFrame,
    categories: DataFrame,
    period: Period,
    batch_created_at: datetime,
    classifier: Classifier | None = None,
    rules: Mapping[str, str] = CATEGORY_RULES,
    limit: int | None = None,
    parallelism: int | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Classify every question of the period, then find and repair gaps, then verify; one summary row.

    Nothing is written to the fact table. The messages are read once, reduced
    to one row per (day, question); those and the classified rows are kept in
    the checkpoint folder while the run lasts, so the classifier runs once per
    step.
    """
    with scratch(chats.sparkSession) as keep:
        summary = _complete_run(
            keep, chats, keywords, categories, period, batch_created_at, classifier, rules, limit, parallelism, settings
        )
        return in_memory(summary)


def _complete_run(
    keep, chats, keywords, categories, period, batch_created_at, classifier, rules, limit, parallelism, settings
) -> DataFrame:
    def classified(questions: DataFrame) -> DataFrame:
        found = classify_questions(questions, categories, batch_created_at, classifier, rules, parallelism, settings)
        return found.select(*KEYWORDS)

    def together(facts: DataFrame, new: DataFrame) -> DataFrame:
        """The fact table and new rows, in the fact table's collation and with its partition column."""
        kinds = {f.name: f.dataType for f in facts.schema.fields}
        new = new.withColumn("created_date", F.to_date("created_at")) if "created_date" in kinds else new
        return facts.unionByName(new.select(*[F.col(c).cast(kind) for c, kind in kinds.items()]))

    facts = keywords.select(*KEYWORDS, *(["created_date"] if "created_date" in keywords.columns else []))
    pairs = keep(asked_pairs(chats, period))
    questions = as_questions(pairs)
    basic = keep(classified(questions))
    facts = together(facts, basic)

    found = coverage_totals(coverage_by_day(pairs, facts, period)).first()["total_missing_questions"]
    work = missing_work(pairs, facts, period, "first_day", limit)
    if found == 0:
        work = work.limit(0)
    todo = keep(as_questions(work))
    repaired = keep(classified(todo))
    facts = together(facts, repaired)

    def step(name: str, asked: DataFrame, rows: DataFrame) -> DataFrame:
        counts = run_totals(run_ledger(asked.withColumn("input_text", binary("input_text")), rows, period))
        return counts.select(
            F.lit(name).alias("step"),
            "total_rows",
            F.col("processed_count").alias("rows_written"),
            F.col("skipped_count").alias("questions_skipped"),
        )

    steps = step("basic", questions, basic).unionByName(step("missing", todo, repaired))
    remaining = verify_verdict(verify_remaining(pairs, facts, period)).select(
        F.lit("verify").alias("step"),
        F.col("remaining_missing_count").alias("total_rows"),
        F.lit(0).cast("bigint").alias("rows_written"),
        F.lit(0).cast("bigint").alias("questions_skipped"),
    )

    def pick(step_name: str, col: str, alias: str):
        return F.coalesce(F.sum(F.when(F.col("step") == step_name, F.col(col))), F.lit(0)).alias(alias)

    return (
        steps.unionByName(remaining)
        .agg(
            pick("basic", "total_rows", "basic_questions"),
            pick("basic", "rows_written", "basic_rows"),
            pick("basic", "questions_skipped", "basic_skipped"),
            F.lit(found).cast("bigint").alias("missing_found"),
            pick("missing", "total_rows", "missing_questions"),
            pick("missing", "rows_written", "missing_rows"),
            pick("missing", "questions_skipped", "missing_skipped"),
            pick("verify", "total_rows", "remaining_missing"),
        )
        .withColumn("total_rows_written", F.col("basic_rows") + F.col("missing_rows"))
        .withColumn("verification_success", F.col("remaining_missing") == 0)
    )


@dataclass(frozen=True)
class RunResult:
    """Outcome of a writing run: one frame per level."""

    ledger: DataFrame
    totals: DataFrame
    verdict: DataFrame | None = None


class Workspace:
    """The three tables of one installation and the runs over them.

    ``facts`` is a parquet folder or the name of a catalog table, owned by this
    library; streams may append to the same folder. Other sources may be
    anything the readers accept, already loaded as DataFrames.
    """

    def __init__(
        self,
        spark: SparkSession,
        chats: DataFrame,
        categories: DataFrame,
        facts: str,
        reject_path: str | None = None,
        cfg: SchemaConfig = SchemaConfig(),
        classifier: Classifier | None = None,
        rules: Mapping[str, str] = CATEGORY_RULES,
        parallelism: int | None = None,
        settings: Settings = DEFAULTS,
    ) -> None:
        self.spark, self.chats, self.categories = spark, chats, categories
        self.fact_source, self.reject_path, self.cfg = facts, reject_path, cfg
        self.classifier, self.rules, self.parallelism = classifier, rules, parallelism
        self.settings = settings

    def facts(self, period: Period | None = None) -> DataFrame:
        """The fact table; empty before the first run."""
        return read_keywords(self.spark, stored_facts(self.spark, self.fact_source, self.cfg), self.cfg, period)

    def _classify_and_append(
        self, questions: DataFrame, period: Period, loaded: datetime, load: str | None = None
    ) -> RunResult:
        with scratch(self.spark) as keep:
            questions = keep(questions.withColumn("input_text", binary("input_text")))
            facts = keep(
                classify_questions(
                    questions, self.categories, loaded, self.classifier, self.rules, self.parallelism, self.settings
                ).select(*KEYWORDS)
            )
            good, bad = split_rejects(facts, self.settings)
            mode = "append" if load is None else "replace"
            store_keywords(good, self.fact_source, self.cfg, mode=mode, load=load or BATCH_LOAD)
            if self.reject_path:
                write_rejects(bad, self.reject_path, load)
            ledger = in_memory(run_ledger(questions, good, period, bad))
        return RunResult(ledger, run_totals(ledger))

    def run_batch(
        self, period: Period, loaded: datetime | None = None, skip_done: bool = True, load: str | None = None
    ) -> RunResult:
        """Classify and append every question of every day of the period.

        ``skip_done`` leaves out (question, day) pairs already in the fact table,
        which also makes a repeated run harmless. A run with a name of its own,
        ``load``, replaces what it wrote when it is repeated, rejected rows
        too, and leaves out only pairs of other loads.
        """
        questions = unique_questions_per_day(self.chats, period)
        if skip_done:
            stored = self.facts(period) if load is None else facts_of_other_loads(self.spark, self.fact_source, self.cfg, load)
            questions = skip_existing(questions, stored, period)
        return self._classify_and_append(questions, period, loaded or datetime.now().replace(microsecond=0), load)

    def check_missing(self, period: Period) -> tuple[DataFrame, DataFrame]:
        """(per day, totals) of the coverage of a period."""
        by_day = coverage_by_day(self.chats, self.facts(period), period)
        return by_day, coverage_totals(by_day)

    def process_missing(
        self,
        period: Period,
        mode: str = "first_day",
        limit: int | None = None,
        loaded: datetime | None = None,
    ) -> RunResult:
        """Classify and append the missing pairs, then verify.

        ``first_day`` also repeats pairs classified on a later day than their
        first; ``per_day`` repairs exactly what verification looks for.
        """
        work = missing_work(self.chats, self.facts(period), period, mode, limit)
        done = self._classify_and_append(
            as_questions(work), period, loaded or datetime.now().replace(microsecond=0)
        )
        verdict = in_memory(verify_verdict(verify_remaining(self.chats, self.facts(period), period)))
        return RunResult(done.ledger, done.totals, verdict)

    def repair(self, period: Period, mode: str = "first_day", limit: int | None = None) -> RunResult | None:
        """Check, and process only when some question was never classified."""
        _, totals = self.check_missing(period)
        if totals.first()["total_missing_questions"] == 0:
            return None
        return self.process_missing(period, mode, limit)

    def report(self, period: Period, path: str, fmt: str = "csv") -> dict[str, str]:
        """The six report sheets of a period, one folder each."""
        with scratch(self.spark) as keep:
            rows = keep(report_rows(self.facts(period), self.categories, period, self.settings))
            return write_report(report_sheets(rows, period), path, fmt)
