import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qlens.llm import token_counts as t

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "  two  blanks ", "<s> </s> <unk>", "línea\n\tÑ 漢字 \U0001f600", "word " * 30000, "x" * 5000, "same", "same"]


def exact(path):
    if path == MODEL:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_counts(make_docs, documents, tmp_path, path):
    count = exact(path)
    pairs = [*enumerate(TEXTS), (8, "same"), (None, "no id")]
    for docs, source in (
        (make_docs(*pairs, extra="content n_tokens raw tokenizer"), pairs),
        (documents, [(r.doc_id, r.text) for r in documents.collect()]),
    ):
        got = rows(t.token_counts(docs, path, str(tmp_path / "cache")))
        wanted = [(k, len((x or "").encode()), count(x or ""), count(x or "") > 4096) for k, x in source]
        assert got == sorted(wanted, key=repr)


def stored(spark, path):
    return spark.read.schema(t.CACHE).parquet(path)


def test_only_distinct_misses_are_encoded(spark, make_docs, tmp_path):
    cache = str(tmp_path / "cache")
    t.token_counts(make_docs((1, "a"), (2, "a"), (3, "b")), MODEL, cache).collect()
    assert stored(spark, cache).count() == 2
    out = t.token_counts(make_docs((1, "a"), (4, "c"), (5, "c")), MODEL, cache).collect()
    assert stored(spark, cache).count() == 3 and len(out) == 3
    t.token_counts(make_docs((1, "a")), MODEL, cache).collect()
    assert stored(spark, cache).count() == 3
    t.token_counts(make_docs((1, "a")), JSON, cache).collect()  # another tokenizer has counts of its own
    assert stored(spark, cache).groupBy("tokenizer").count().count() == 2


def test_counts_come_from_the_cache(spark, make_docs, tmp_path):
    cache = str(tmp_path / "cache")
    known = spark.createDataFrame([("known",)], "text string").select(
        t.content_digest(F.col("text")).alias("content"), F.lit(77).cast("bigint").alias("n_tokens"), F.lit(t.tokenizer_digest(MODEL)).alias("tokenizer")
    )
    for _ in range(2):  # two runs may have appended the same content
        known.write.mode("append").partitionBy("tokenizer").parquet(cache)
    out = t.token_counts(make_docs((1, "known"), (2, "new")), MODEL, cache)
    assert rows(out, "doc_id", "n_tokens") == [(1, 77), (2, exact(MODEL)("new"))]


@pytest.mark.parametrize("bits", [1, 25])
def test_known_texts_that_pass_the_filter_are_not_counted_again(spark, make_docs, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(t, "FILTER_BITS", bits)  # with one bit nearly all do
    cache = str(tmp_path / "cache")
    t.token_counts(make_docs(*[(k, f"text {k}") for k in range(20)]), MODEL, cache).collect()
    out = t.token_counts(make_docs((1, "a b"), (2, "c"), (3, "a b"), *[(k, f"text {k}") for k in range(5, 30)]), MODEL, cache)
    assert rows(out.filter("doc_id < 4"), "doc_id", "n_tokens") == [(1, exact(MODEL)("a b")), (2, 1), (3, exact(MODEL)("a b"))]
    assert out.count() == 28 and stored(spark, cache).count() == stored(spark, cache).distinct().count() == 32


def test_filter_keeps_all_that_is_wanted_and_little_else(spark):
    every = spark.range(5000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("content"), "id")
    wanted = every.filter("id % 50 = 0").select("content")
    found = {r.id for r in t.among(every, wanted).collect()}
    assert set(range(0, 5000, 50)) <= found and len(found) < 110
    assert t.among(every, wanted.limit(0)).count() == 0


def test_a_hot_content_is_spread(make_docs, tmp_path, monkeypatch):
    """A third of all rows have one text; no task joins more than its share of them."""
    monkeypatch.setattr(t, "shuffle_partitions", lambda spark: 16)
    docs = make_docs(*[(k, "the same text" if k % 3 == 0 else f"text {k % 40}") for k in range(1200)])
    out = t.token_counts(docs, MODEL, str(tmp_path / "cache"))
    assert rows(out.groupBy("n_tokens").count())
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "[content#" in plan and "slice#" in plan
    assert out.count() == 1200


def test_normalised_content(spark, make_docs, tmp_path):
    cache = str(tmp_path / "cache")
    out = t.token_counts(make_docs((1, " A "), (2, "a")), MODEL, cache, normalise=lambda c: F.lower(F.trim(c)))
    assert rows(out, "doc_id", "n_bytes", "n_tokens") == [(1, 3, 1), (2, 1, 1)]
    assert stored(spark, cache).count() == 1


def test_version_digest(tmp_path):
    copy = tmp_path / "copy.model"
    copy.write_bytes(open(MODEL, "rb").read())
    assert t.tokenizer_digest(str(copy)) == t.tokenizer_digest(MODEL)
    copy.write_bytes(copy.read_bytes() + b"x")
    assert t.tokenizer_digest(str(copy)) != t.tokenizer_digest(MODEL)


def test_empty_table(spark, make_docs, tmp_path):
    assert t.token_counts(make_docs(), MODEL, str(tmp_path / "cache")).collect() == []
