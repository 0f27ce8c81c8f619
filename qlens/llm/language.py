"""Language identification by compression.

Every language has a zstandard raw-content dictionary of known text. A text is
compressed with each, in blocks so that a long text leans on the dictionary
all the way; the language that needs the fewest bytes wins. A margin between
the best two that is too narrow is a rejection.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qlens.llm.common import give_back, id_remainder, per_worker, travels, whole_row

# What is fitted is bounded: distinct texts, in hash order, until a dictionary is full.
DICTIONARY_BYTES = 256 << 10
ALL_DICTIONARIES_BYTES = 64 << 20
OVERSAMPLE = 4  # so many times the dictionary's bytes are looked at, for letters are fewer
BLOCK = 4_096
LEVEL = 6
MIN_MARGIN = 0.01
UNKNOWN = "und"

NOT_LETTERS = re.compile(r"[\W\d_]+")

RESULT = "lang string, score double, margin double"


def letters(text: str) -> str:
    """What is compressed: lower case, and one blank for whatever lies between letters."""
    return NOT_LETTERS.sub(" ", text.lower())


def fit(docs: DataFrame, learn: Column | None = None, dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary) pairs, the most frequent language first, from rows with text and lang for which ``learn`` holds.

    Each language's distinct texts are taken in hash order until their letters
    fill the dictionary or none is left; only so many of the smallest hashes
    are ordered as hold ``OVERSAMPLE`` times its bytes, and of a longer text
    only the beginning. Many languages share ``ALL_DICTIONARIES_BYTES``.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text"), (F.lit(True) if learn is None else learn).alias("use"))
    rows = rows.filter(F.col("use") & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    # half of all hashes have 64 bits, a quarter 63, and so on
    rows = rows.withColumn("width", F.when(F.col("h") == 0, 0).otherwise(F.length(F.bin("h"))))
    distinct = rows.groupBy("lang", "width", "h").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("bytes"))
    widths = distinct.groupBy("lang", "width").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    found: dict[str, list] = {}
    for r in widths.orderBy("lang", "width").collect():  # at most 65 rows per language
        found.setdefault(r["lang"], []).append(r)
    known = sorted(found, key=lambda lang: (-sum(r["n"] for r in found[lang]), lang))
    if not known:
        return []
    share = max(1, min(dictionary_bytes, ALL_DICTIONARIES_BYTES // len(known)))
    upto = []
    for lang in known:
        held = 0
        for r in found[lang]:
            held += r["bytes"]
            if held >= share * OVERSAMPLE:
                break
        upto.append((lang, r["width"]))

    @F.pandas_udf("binary")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: letters(t).encode()[:share])

    limits = F.broadcast(docs.sparkSession.createDataFrame(upto, "lang string, upto int"))
    wanted = rows.join(limits, "lang").filter("width <= upto")
    # copies are one before the shuffle
    sample = wanted.groupBy("lang", "h").agg(F.min(F.substring("text", 1, share * OVERSAMPLE)).alias("text"))
    pieces = sample.select("lang", "h", cleaned("text").alias("piece"))
    before = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    taken = pieces.withColumn("before", F.coalesce(F.sum(F.octet_length("piece")).over(before), F.lit(0))).filter(F.col("before") < share)
    texts: dict[str, list[bytes]] = {lang: [] for lang in known}
    for r in taken.select("lang", "piece").orderBy("lang", F.col("h").desc()).collect():  # under twice ``share`` per language
        texts[r["lang"]].append(bytes(r["piece"]))
    return [(lang, b" ".join(own)[-share:]) for lang, own in texts.items()]


class Sizes:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        import zstandard

        self.languages = [lang for lang, _ in dictionaries]
        self.coders = []
        for _, data in dictionaries:
            known = zstandard.ZstdCompressionDict(data.ljust(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.coders.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, its share of the evidence (2 to the minus bits), and the margin between the best two."""
        if text is None or not any(map(str.isalpha, text)) or not self.coders:
            return UNKNOWN, 0.0, 0.0
        data = letters(text).encode()
        blocks = [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.coders]
        best = min(sizes)
        score = 1 / sum(2.0 ** (8 * max(best - s, -100)) for s in sizes)
        ordered = sorted(sizes)
        margin = 1.0 if len(sizes) == 1 else (ordered[1] - best) / ordered[1]
        return self.languages[sizes.index(best)], score, margin


def predictor(spark, dictionaries: list[tuple[str, bytes]]):
    """A column function: text to struct<lang, score, margin>."""
    shared = spark.sparkContext.broadcast(dictionaries)
    key = uuid.uuid4().hex

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizes = per_worker(key, lambda: Sizes(shared.value))
        for texts in batches:
            yield pd.DataFrame([sizes(t) for t in texts], columns=["lang", "score", "margin"], index=texts.index)
            give_back()

    return predict


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, without the rows whose language can't be told.

    Null, empty and letterless texts go; repeated rows stay or go together.
    Learned from all of ``docs`` that have text and lang; if none has, or
    ``docs`` is empty, nothing stays.
    """
    predict = predictor(docs.sparkSession, fit(docs))
    rows = docs.select(whole_row(docs), predict(F.col("text")).alias("p"))
    return rows.filter((F.col("p.lang") != UNKNOWN) & (F.col("p.margin") >= MIN_MARGIN)).select("row.*")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin, rejected of every row.

    Learned from ids whose crc32 modulo 3 is not 1; the others are held out.
    Null or letterless text is ``und`` with score 0, rejected; so is every
    row if there is nothing to learn from. Ties go to the language most rows
    have; repeated rows give repeated results.
    """
    predict = predictor(docs.sparkSession, fit(docs, id_remainder(3) != 1))
    return docs.select("doc_id", (id_remainder(3) == 1).alias("held_out"), predict(F.col("text")).alias("p")).select(
        "doc_id",
        "held_out",
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        F.col("p.margin").alias("margin"),
        ((F.col("p.lang") == UNKNOWN) | (F.col("p.margin") < MIN_MARGIN)).alias("rejected"),
    )


travels(__name__)
