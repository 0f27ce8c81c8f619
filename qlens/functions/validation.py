"""Row validation: boolean rule columns and their violation counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qlens.functions.fixed_values import EMAIL_PATTERN
from qlens.functions.text import is_blank, strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _holds(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def valid_email(col: Column | str) -> Column:
    return _holds(_col(col).rlike("(?d)" + EMAIL_PATTERN))


def non_empty(col: Column | str) -> Column:
    return _holds(~is_blank(col))


def decimal_digits() -> str:
    """Every script's decimal digits: runs of ten that begin with a zero."""
    return "".join(chr(c) for c in range(0x110000) if chr(c).isdecimal())


def ascii_digits(text: Column) -> Column:
    """The text with the decimal digits of every script as 0 to 9."""
    digits = decimal_digits()
    return F.translate(text, digits, "".join(str(int(d)) for d in digits))


def positive_integer(col: Column | str) -> Column:
    """Text that reads as a whole number above zero; any decimal digit counts."""
    t = strip(col)
    zero = "".join(d for d in decimal_digits() if int(d) == 0)
    return _holds(t.rlike(r"^\+?\p{Nd}+(_\p{Nd}+)*\z") & t.rlike(rf"[\p{{Nd}}&&[^{zero}]]"))


def positive_number(col: Column | str) -> Column:
    """A numeric column whose whole part is above zero."""
    return _holds(F.floor(_col(col)) > 0)


def valid_day(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text naming a real day; single-digit months and days are fine, and any decimal digits."""
    c = ascii_digits(_col(col))
    parsed = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), c.try_cast("date"))
    return _holds(parsed >= F.lit("0001-01-01").cast("date"))


def string_list(col: Column | str) -> Column:
    """An array without NULL entries."""
    return _holds(F.forall(_col(col), lambda x: x.isNotNull()))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def keyword_structure(json: Column | str) -> Column:
    """JSON text holding a list of ``{keyword: string, categories: [string, ...]}``."""
    items = F.try_variant_get(F.try_parse_json(_col(json)), "$", "array<variant>")

    def good(item: Column) -> Column:
        names = F.try_variant_get(item, "$.categories", "array<variant>")
        return _holds(_kind(F.try_variant_get(item, "$.keyword", "variant")) == "STRING") & _holds(
            F.forall(names, lambda n: _holds(_kind(n) == "STRING"))
        )

    return _holds(F.forall(items, good))


def validate_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with one ``ok_<rule>`` flag per rule."""
    return df.withColumns({f"ok_{name}": rule for name, rule in rules.items()})


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: rows checked and rows breaking it, in a single pass over ``df``."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(~rule).alias(f"bad_{name}") for name, rule in rules.items()],
    )
    per_rule = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(f"bad_{name}").alias("violations")) for name in rules]
    )
    return counted.select("rows_checked", F.explode(per_rule).alias("r")).select(
        "r.rule", "rows_checked", "r.violations"
    )
