"""Classifier responses (JSON text) to keyword and category lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qlens.functions.fixed_values import CATEGORY_RULES
from qlens.functions.text import (
    OTHER,
    clean_keyword,
    fallback_classify,
    normalize_categories,
    strip,
)
from qlens.storage import shuffle_partitions

ARGUMENTS_PATH = "$.result.message.toolCalls[0].function.arguments"
FALSY_JSON = r"^(null|false|\[\]|\{\}|-?0+(\.0+)?([eE][-+]?[0-9]+)?)$"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _part(v: Column, path: str, dtype: str = "variant") -> Column:
    return F.try_variant_get(v, path, dtype)


def _read(item: Column) -> Column:
    """The two parts of an object, each path followed once."""
    return F.struct(
        _part(item, "$.keyword").alias("keyword"),
        _part(item, "$.categories").alias("categories"),
        _part(item, "$.categories", "array<variant>").alias("listed"),
    )


def _category_names(item: Column) -> Column:
    """String entries of ``categories``; NULL when it is neither a list nor a string."""
    listed = item["listed"]
    one = F.when(_kind(item["categories"]) == "STRING", F.array(_part(item["categories"], "$", "string")))
    return F.coalesce(
        F.transform(
            F.filter(listed, lambda n: _kind(n) == "STRING"), lambda n: _part(n, "$", "string")
        ),
        one,
    )


def _has_odd_category(item: Column) -> Column:
    """A list entry that is neither text nor empty makes the response unusable."""
    return F.coalesce(
        F.exists(
            item["listed"],
            lambda n: (_kind(n) != "STRING") & ~F.to_json(n).rlike(FALSY_JSON),
        ),
        F.lit(False),
    )


def _item(item: Column) -> Column:
    """One object of the response; ``broken`` sends the whole question to the word rules."""
    keyword_kind = _kind(item["keyword"])
    keyword = F.coalesce(strip(_part(item["keyword"], "$", "string")), F.lit(""))
    wrong_keyword = F.coalesce(keyword_kind != "STRING", F.lit(False))
    return F.struct(
        keyword.alias("keyword"),
        _category_names(item).alias("categories"),
        (wrong_keyword | ((keyword != "") & _has_odd_category(item))).alias("broken"),
    )


def parse_distinct_responses(
    df: DataFrame,
    spread: Sequence[str],
    response: str = "response",
    text: str = "input_text",
    out: str = "classification",
    rules: Mapping[str, str] = CATEGORY_RULES,
    other: str = OTHER,
) -> DataFrame:
    """Like ``parse_responses``, for rows of which many have the same text and response: each pair is parsed once.

    The answers are joined back on the pair and a slice, a hash of the columns
    ``spread`` that tell rows apart, so that a pair which a third of all rows
    have is dealt out over as many tasks as a shuffle has.
    """
    slices = F.lit(shuffle_partitions(df.sparkSession))
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), slices).cast("int"))
    keys = sliced.select(F.col(text).alias("_text"), F.col(response).alias("_response"), "_slice").distinct()
    parsed = parse_responses(
        keys.select("_text", "_response").distinct(), "_response", "_text", "_out", rules, other
    ).select(F.col("_text").alias("_t"), F.col("_response").alias("_r"), "_out")
    answers = keys.join(parsed, F.col("_text").eqNullSafe(F.col("_t")) & F.col("_response").eqNullSafe(F.col("_r"))).select(
        "_text", "_response", F.col("_slice").alias("_s"), "_out"
    )
    same = F.col(text).eqNullSafe(F.col("_text")) & F.col(response).eqNullSafe(F.col("_response"))
    joined = sliced.join(answers, same & (F.col("_slice") == F.col("_s")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_out").alias(out))


def parse_responses(
    df: DataFrame,
    response: str = "response",
    text: str = "input_text",
    out: str = "classification",
    rules: Mapping[str, str] = CATEGORY_RULES,
    other: str = OTHER,
) -> DataFrame:
    """Adds ``out``: ``array<struct<keyword, categories>>`` read from the response column.

    The first tool call's arguments may be an object or JSON text. A missing,
    malformed or empty answer, or one with a wrongly typed entry, is replaced
    by the word rules for that question. NULL text gives NULL.
    """
    arguments = _part(F.try_parse_json(F.col(response)), ARGUMENTS_PATH)
    staged = (
        df.withColumn("_args", arguments)
        .withColumn(
            "_args",
            F.when(
                _kind(F.col("_args")) == "STRING", F.try_parse_json(_part(F.col("_args"), "$", "string"))
            ).otherwise(F.col("_args")),
        )
        .withColumn("_items", _part(F.col("_args"), "$.keywords_with_categories", "array<variant>"))
        .withColumn(
            "_items",
            F.transform(F.transform(F.filter("_items", lambda i: _kind(i).startswith("OBJECT")), _read), _item),
        )
    )
    usable = F.transform(
        F.filter("_items", lambda i: i["keyword"] != ""),
        lambda i: F.struct(
            clean_keyword(i["keyword"], F.col(text), other).alias("keyword"),
            normalize_categories(i["categories"], other).alias("categories"),
        ),
    )
    broken = F.coalesce(F.exists("_items", lambda i: i["broken"]), F.lit(True))
    return (
        staged.withColumn("_usable", F.when(~broken, usable))
        .withColumn(
            out,
            F.when(F.col(text).isNull(), None)
            .when(F.coalesce(F.size("_usable"), F.lit(0)) > 0, F.col("_usable"))
            .otherwise(fallback_classify(text, rules, other)),
        )
        .drop("_args", "_items", "_usable")
    )
