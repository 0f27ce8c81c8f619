import random
from datetime import datetime

import duckdb
import pandas as pd
import pytest
from helpers import rows, schema

from qlens.config import KEYWORDS
from qlens.operators import lookup, summary
from qlens.period import Period
from workload.oracle import summary_ctes

JUNE = Period("2025-06-11", "2025-06-19")


def test_summary_picks_first_row_and_first_real_category(make_keywords, categories):
    kw = make_keywords(
        ("a", "late", 3, 5, "2025-06-12"),
        ("a", "early", 11, 2, "2025-06-11"),
        ("a", "later", 1, 1, "2025-06-13"),
        ("only default", "k", 11, 1, "2025-06-11"),
        ("default and null", "k", 11, 1, "2025-06-11"),
        ("default and null", "l", None, 1, "2025-06-12"),
        ("unknown id", "k", 99, 1, "2025-06-11"),
        (None, "k", 1, 1, "2025-06-11"),
        ("outside", "k", 1, 1, "2025-06-20"),
    )
    got = {r.query_text: (r.category_name, r.keyword, r.created_at.day, r.query_count) for r in summary.classify_summary(kw, categories, JUNE).collect()}
    assert got == {
        "a": ("학생 생활", "early", 11, 2),
        "only default": ("기타", "k", 11, 1),
        "default and null": (None, "k", 11, 1),
        "unknown id": (None, "k", 11, 1),
    }


def test_ties_on_the_same_day_have_a_total_order(make_keywords, categories):
    kw = make_keywords(
        ("a", "z", 5, 1, "2025-06-11"), ("a", "b", 2, 7, "2025-06-11"), ("a", "a", 2, 9, "2025-06-11"), ("a", None, 2, 3, "2025-06-11")
    )
    r = summary.classify_summary(kw, categories, JUNE).first()
    assert (r.category_name, r.keyword, r.query_count) == ("교권보호 (교육활동 보호)", None, 3)
    assert rows(summary.earliest_category(kw, JUNE)) == [("a", 2)]


def test_all_default_flag_treats_null_as_another_category(make_keywords):
    kw = make_keywords(("a", "k", 11, 1, "2025-06-11"), ("b", "k", 11, 1, "2025-06-11"), ("b", "k", None, 1, "2025-06-11"))
    assert rows(summary.all_default_flag(kw, JUNE)) == [("a", True), ("b", False)]


@pytest.mark.parametrize("seed", range(4))
def test_one_aggregate_equals_the_window_and_join_chain(spark, categories, seed):
    rng = random.Random(seed)
    facts = [
        (
            rng.choice(["a", "b", "c", "d", "e", "f", "g", None]),
            rng.choice(["k1", "k2", "k3", None]),
            rng.choice([1, 2, 3, 11, 11, 12, None]),
            rng.randint(1, 4),
            datetime(2025, 6, rng.randint(9, 21)),
            datetime(2025, 6, 22),
        )
        for _ in range(rng.choice([5, 40, 150]))
    ]
    kw = spark.createDataFrame(facts, schema(KEYWORDS))
    ours = rows(summary.classify_summary(kw, categories, JUNE))

    con = duckdb.connect()
    frame = pd.DataFrame(facts, columns=list(KEYWORDS)).astype({"category_id": "Int64"})
    con.register("admin_chat_keywords", frame)
    con.register("admin_categories", categories.toPandas())
    period = "created_at BETWEEN '2025-06-11 00:00:00' AND '2025-06-19 23:59:59'"
    con.execute(f"WITH {summary_ctes(period)} SELECT category_name, query_text, keyword, created_at, query_count FROM summary")
    assert ours == sorted(con.fetchall(), key=repr)


def test_lookup_by_name_takes_the_highest_usable_id(spark):
    cats = spark.createDataFrame([(1, "a"), (4, "a"), (0, "zero"), (None, "none"), (3, "b ")], "category_id int, category_name string")
    df = spark.createDataFrame([(" a　",), ("zero",), ("none",), ("b ",), ("missing",), (None,)], "category_name string")
    assert rows(lookup.resolve_category_ids(df, cats)) == [(" a　", 4)]


def test_dimension_is_only_broadcast_within_its_bounds(spark, categories):
    def hinted(df):
        return "broadcast" in df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended").lower()

    assert hinted(lookup.bounded_dimension(categories))
    assert not hinted(lookup.bounded_dimension(categories, max_rows=10))
    assert not hinted(lookup.bounded_dimension(categories, max_bytes=20))
    df = spark.createDataFrame([(1,), (77,), (None,)], "category_id int")
    for dim in (lookup.bounded_dimension(categories), lookup.bounded_dimension(categories, max_rows=1)):
        assert rows(lookup.with_category_name(df, dim)) == [(1, "학교폭력"), (77, None), (None, None)]
