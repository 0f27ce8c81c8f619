"""Question and keyword text: every function is a JVM-side column expression.

Blank handling follows the full Unicode set, lengths and cuts count code points.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from qlens.config import DEFAULTS
from qlens.functions.fixed_values import (
    BLANKS,
    CATEGORY_RULES,
    KEYWORD_PUNCTUATION,
    KEYWORD_STOP_WORDS,
    OTHER_DIGITS,
    SIMPLE_STOP_WORDS,
    TOPIC_WORDS,
)

OTHER = DEFAULTS.default_category_name


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(BLANKS))


def is_blank(text: Column | str) -> Column:
    return strip(text) == ""


def _hits(haystack: Column, words: Mapping[str, str]) -> Column:
    """``array<struct<rank, word, value>>`` of the words contained in the text, in mapping order.

    ``rank`` orders by length, longest first, then by mapping order. The words
    are one constant array searched by a lambda: a chain of ``when`` branches
    this long would outgrow what the JVM compiles. Wrapping the text in an
    array binds it once for all words. A text without a character in the
    range of the words' first ones, found out in one pass, is not searched for the words.
    """
    longest_first = {w: i for i, w in enumerate(sorted(words, key=len, reverse=True))}
    table = F.array(
        *[
            F.struct(F.lit(longest_first[w]).alias("rank"), F.lit(w).alias("word"), F.lit(v).alias("value"))
            for w, v in words.items()
        ]
    )

    firsts = [ord(w[0]) for w in words if w] or [0]
    between = f"[\\x{{{min(firsts):x}}}-\\x{{{max(firsts):x}}}]"

    def search(text: Column) -> Column:
        found = F.filter(table, lambda entry: text.contains(entry["word"]))
        return found if "" in words or not words else F.when(text.rlike(between), found).otherwise(F.slice(table, 1, 0))

    return F.get(F.transform(F.array(haystack), search), F.lit(0))


def _first_value(hits: Column) -> Column:
    return F.get(hits, F.lit(0))["value"]


def _longest_word(hits: Column) -> Column:
    return F.array_min(F.transform(hits, lambda h: F.struct(h["rank"], h["word"])))["word"]


def _lowered(text: Column, words: Mapping[str, str]) -> Column:
    """Lower-cased text; words without upper and lower case need no lowering."""
    return text if all(w.lower() == w.upper() for w in words) else F.lower(text)


def rule_category(text: Column | str, rules: Mapping[str, str] = CATEGORY_RULES, other: str = OTHER) -> Column:
    """Category of the first rule word found in the lower-cased text, else the default."""
    t = _col(text)
    return F.when(t.isNotNull(), F.coalesce(_first_value(_hits(_lowered(t, rules), rules)), F.lit(other)))


def rule_word(text: Column | str, rules: Mapping[str, str] = CATEGORY_RULES) -> Column:
    """Longest rule word found in the raw text (ties: rule order), else NULL."""
    return _longest_word(_hits(_col(text), rules))


def _if_any(text: Column) -> Column:
    """The text, or NULL if it is empty; evaluated once, where ``nullif`` would repeat it."""
    return F.get(F.filter(F.array(text), lambda t: t != ""), F.lit(0))


def _first_long_word(text: Column, stop_words: Sequence[str]) -> Column:
    """First word of two or more characters that is not a stop word, else ''.

    One anchored search that ends at the first hit, so a long text is not split up.
    """
    blank, word = f"[{BLANKS}]", f"[^{BLANKS}]"
    skip = "|".join(stop_words)
    return F.regexp_extract(text, f"(?<!{word})(?!(?:{skip})(?!{word}))({word}{{2,}})", 1)


def first_meaningful_word(text: Column | str, stop_words: Sequence[str] = KEYWORD_STOP_WORDS) -> Column:
    """First telling word cut to 20 characters, else the first 10 characters trimmed."""
    t = _col(text)
    found = _if_any(F.substring(_first_long_word(t, stop_words), 1, 20))
    return F.when(t.isNotNull(), F.coalesce(found, strip(F.substring(t, 1, 10))))


def rule_keyword(text: Column | str, rules: Mapping[str, str] = CATEGORY_RULES) -> Column:
    """Longest rule word in the text, else its first telling word."""
    return F.coalesce(rule_word(text, rules), first_meaningful_word(text))


def simple_keyword(text: Column | str) -> Column:
    """First topic word in the text, else the first telling word, else the text's start."""
    t = _col(text)
    topics = {w: w for w in TOPIC_WORDS}
    return F.coalesce(_first_value(_hits(_lowered(t, topics), topics)), first_meaningful_word(t, SIMPLE_STOP_WORDS))


def clean_keyword(keyword: Column | str, text: Column | str, other: str = OTHER) -> Column:
    """Keyword as accepted from a classifier; only an over-long one is searched for in the text."""
    k, t = _col(keyword), _col(text)
    word = _if_any(F.substring(first_meaningful_word(t), 1, 50))
    replacement = F.when(t.isNotNull(), F.coalesce(word, F.lit(other)))
    bare = F.btrim(strip(k), F.lit(KEYWORD_PUNCTUATION))
    return (
        F.when(F.length(k) > 100, replacement)
        .when((F.length(k) > 50) & (strip(k) == strip(t)), replacement)
        .when(F.length(k) < 2, other)
        .when(k.rlike(f"^[\\p{{Nd}}{OTHER_DIGITS}]+\\z"), other)
        .when(F.length(bare) < 2, other)
        .otherwise(bare)
    )


def cap_by_question(keyword: Column | str, text: Column | str) -> Column:
    """A keyword over 100 characters gives way to the (shortened) question."""
    k, t = _col(keyword), _col(text)
    short = F.when(F.length(t) > 95, F.concat(F.substring(t, 1, 95), F.lit("..."))).otherwise(t)
    return F.when(F.length(k) > 100, short).otherwise(k)


def truncate_keyword(keyword: Column | str, n: int = DEFAULTS.max_keyword_length, legacy: bool = False) -> Column:
    """Storage cap of ``n`` characters; ``legacy`` keeps the old cut, one character too long."""
    k = _col(keyword)
    keep = n - 2 if legacy else n - 3
    return F.when(F.length(k) > n, F.concat(F.substring(k, 1, keep), F.lit("..."))).otherwise(k)


def backfill_keyword(keyword: Column | str, text: Column | str, other: str = OTHER) -> Column:
    """A blank or default keyword is replaced by the simple keyword of the question."""
    k, t = _col(keyword), _col(text)
    simple = F.when(t.isNotNull(), F.coalesce(_if_any(simple_keyword(t)), F.lit(other)))
    return F.when(strip(k).isin("", other), simple).otherwise(k)


def normalize_categories(categories: Column | str, other: str = OTHER) -> Column:
    """Trimmed, non-blank names; never empty. NULL input counts as the wrong type."""
    c = _col(categories)
    names = F.transform(F.filter(c, lambda x: x.isNotNull() & ~is_blank(x)), strip)
    return F.when(c.isNull() | (F.size(names) == 0), F.array(F.lit(other))).otherwise(names)


def fallback_classify(text: Column | str, rules: Mapping[str, str] = CATEGORY_RULES, other: str = OTHER) -> Column:
    """``array<struct<keyword, categories>>`` from the word rules alone."""
    t = _col(text)
    lowered = _lowered(t, rules)

    def item(hits: Column) -> Column:
        # The category looks at the lowered text; where lowering is idle one search serves both.
        category = _first_value(hits) if lowered is t else _first_value(_hits(lowered, rules))
        return F.struct(
            F.coalesce(_longest_word(hits), first_meaningful_word(t)).alias("keyword"),
            F.array(F.coalesce(category, F.lit(other))).alias("categories"),
        )

    return F.when(t.isNotNull(), F.transform(F.array(_hits(t, rules)), item))


def ellipsis(text: Column | str, n: int = 100) -> Column:
    t = _col(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def question_key(text: Column | str, ts: Column | str) -> Column:
    """``text|yyyy-MM-dd``; NULL when either part is."""
    return F.concat(_col(text), F.lit("|"), F.date_format(_col(ts), "yyyy-MM-dd"))
