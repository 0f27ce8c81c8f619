import random

import duckdb
import public_tokenizers
import pytest
from llm_helpers import rows
from tokenizers import Tokenizer

import corpus_pipeline
from qlens.llm import decontaminate, simhash, workload

SF = "/root/testdata/sf0.001"

# Columns and types of each query's contract; further columns may follow.
CONTRACTS = {
    "op1_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op2_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op3_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op5_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op6_benchmark_decontamination": "doc_id bigint, item_id bigint, edits int, end bigint",
    "op7_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8_sharding": "doc_id bigint, slot int, shard string",
    "op9_document_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op10_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op11_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op12_entropy_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op13_embedding_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
}


def test_every_operator_is_registered():
    import __spark_entry__

    assert set(CONTRACTS) == set(workload.QUERIES)
    assert {*CONTRACTS, "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_columns(spark, name):
    out = workload.QUERIES[name](spark, SF)
    wanted = [tuple(c.split()) for c in CONTRACTS[name].split(", ")]
    assert out.dtypes[: len(wanted)] == wanted
    if name == "op5_html_extraction":
        assert out.count() == 50
    elif name == "op13_embedding_whitening":
        assert out.count() == 8 * 500
    elif name not in ("op1_best_fit_packing", "op6_benchmark_decontamination", "op11_hard_negatives"):
        assert out.count() == 200


@pytest.mark.parametrize("name", sorted(workload.ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = con.execute(workload.ORACLE[name]).fetchall()
    assert rows(workload.QUERIES[name](spark, SF)) == sorted(expected, key=repr)


@pytest.fixture
def small(spark, make_docs, tmp_path):
    """A folder of tables with one case for every stage."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    good = base.join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1"), "doc_id").filter("lang = 'en' AND n_chars > 1500").orderBy("doc_id")
    text = good.first().text
    worst = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0")
    bad = base.join(worst, "doc_id").filter("text LIKE '%!! %!! %'").orderBy("doc_id").first().text
    item = benchmark.orderBy("item_id").first().text
    rng = random.Random(1)
    words = text.split(" ")
    rng.shuffle(words)
    other = " ".join(words)
    rng.shuffle(words)
    third = " ".join(words)
    planted = make_docs(
        (5000, text), (5001, text), (5002, text + "\n"), (5003, None), (5004, "12 34 ..."), (5005, other),
        (5006, third[:700] + " " + item.upper() + " " + third[700:]), (5007, bad), (None, text),
    )
    base.unionByName(planted).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    held = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        after = docs.collect()
        held[name] = (before, after)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert {repr(r) for r in after} <= {repr(r) for r in before}
        before = after

    def ids(name, k):
        return {r.doc_id for r in held[name][k]}

    gone = ids("language_id", 0) - ids("language_id", 1)
    assert {5003, 5004} <= gone and len(gone) <= 8 and not {5000, 5005} & gone
    gone = ids("quality_classifier", 0) - ids("quality_classifier", 1)
    assert 5007 in gone and not {5000, 5005, 5006} & gone

    entered, stayed = held["simhash_near_dedup"]
    prints = {r.doc_id: simhash.simhash(r.text) for r in entered if r.doc_id is not None}
    assert {5001, 5002} <= ids("simhash_near_dedup", 0) - ids("simhash_near_dedup", 1)
    left = [prints[r.doc_id] for r in stayed]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(left) for b in left[:i])
    for doc_id in prints.keys() - {r.doc_id for r in stayed}:  # what went has a near relative
        assert any(other != doc_id and (p ^ prints[doc_id]).bit_count() <= 2 for other, p in prints.items())

    entered, stayed = held["benchmark_decontamination"]
    match = decontaminate.Matcher([(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()], decontaminate.ERROR_RATE)
    assert {r.doc_id for r in stayed} == {r.doc_id for r in entered if not match(r.text)}
    assert 5006 in ids("benchmark_decontamination", 0) and 5006 not in ids("benchmark_decontamination", 1)

    entered, pieces = held["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in entered}
    found = {}
    for r in pieces:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == lengths


def test_run_equals_its_stages(spark, small):
    out = corpus_pipeline.run(spark, small)
    again = corpus_pipeline.run(spark, small)
    places = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert rows(out, *places) == rows(again, *places)


def test_empty_documents(spark, make_docs, tmp_path):
    make_docs().write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_workers_keep_the_last_two_objects(monkeypatch):
    import sys

    from qlens.llm.common import per_worker

    monkeypatch.setitem(sys.__dict__, "_qlens_held", {})
    made = []

    def get(key):
        return per_worker(key, lambda: made.append(key) or key)

    for key in "aabaccab":
        assert get(key) == key
    assert made == ["a", "b", "c", "b"]


def test_empty_labels_and_benchmark_and_nothing_left_behind(spark, tmp_path):
    import os

    from qlens.storage import checkpoint_dir

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = set(os.listdir(checkpoint_dir(spark)))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.select("doc_id").distinct().count() > 10
    left = set(os.listdir(checkpoint_dir(spark))) - before
    assert len(left) == 1 and next(iter(left)).startswith("corpus-")
