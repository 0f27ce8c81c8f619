import itertools
import zlib

import numpy as np
from llm_helpers import rows

from qlens.llm import quality


def test_linear_time_identity():
    rng = np.random.default_rng(1)
    model = {"w0": 0.3, "w": rng.normal(size=quality.N_FEATURES), "v": rng.normal(size=(quality.N_FEATURES, 4))}
    docs = [(rng.choice(500, size=n, replace=False), rng.normal(size=n)) for n in (1, 5, 12)]
    starts = np.cumsum([0, 1, 5])
    odds, _, _ = quality.margins(model, np.concatenate([d[0] for d in docs]), np.concatenate([d[1] for d in docs]), starts)
    for (ids, values), got in zip(docs, odds):
        pairs = sum(
            model["v"][ids[i]] @ model["v"][ids[j]] * values[i] * values[j] for i, j in itertools.combinations(range(len(ids)), 2)
        )
        assert np.isclose(got, 0.3 + model["w"][ids] @ values + pairs)


def test_gradient_lowers_the_loss():
    docs = [(np.array([k % 7, 7 + k % 3], dtype=np.int32), np.ones(2, dtype=np.float32)) for k in range(600)]
    labels = np.array([(k % 7 < 3) ^ (k % 3 == 0) for k in range(600)], dtype=np.float32)  # needs the pairs
    model = quality.fit_model(docs * 5, np.tile(labels, 5))
    odds, _, _ = quality.margins(model, np.concatenate([d[0] for d in docs]), np.concatenate([d[1] for d in docs]), np.arange(0, 1200, 2))
    assert ((odds > 0) == labels).mean() > 0.95
    assert quality.fit_model([], np.empty(0))["rows"] == 0 and model["rows"] == 3000


def test_features_of_odd_texts():
    for text in (None, "", " \n", "x", "É" * 50, "a b\n" * 20000, "\x00 |||"):
        ids, values = quality.features(text, None, {})
        assert len(ids) == len(values) == len(set((text or "").split())) + len(quality.STATISTICS)
        assert ids.min() >= 0 and ids.max() < quality.N_FEATURES and np.isfinite(values).all()


def test_scores(spark, make_docs):
    good = [(k, f"a calm sentence with number words {k} in it. Another one follows here.") for k in range(60)]
    bad = [(100 + k, f"BUY!! NOW!! {k}!! $$$ ### CLICK!! " * 4) for k in range(60)]
    odd = [(300, None), (301, ""), (302, "calm words " * 30000), (3, good[3][1]), (None, good[4][1])]
    docs = make_docs(*good, *bad, *odd, extra="score quality predicted row s")
    labels = spark.createDataFrame(
        [(k, 1, 0, "x") for k, _ in good] + [(k, 0, 1, "x") for k, _ in bad] + [(None, 1, 0, "x"), (5, None, 0, "x")],
        "doc_id bigint, quality int, toxic int, text string",
    )
    out = quality.score_documents(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.doc_id is not None and r.doc_id < 200:
            assert r.predicted == int(r.doc_id < 100)
    twice = [r.score for r in out if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == twice[1]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {k for k, _ in good}
    assert not {r.doc_id for r in kept.collect()} & {k for k, _ in bad}


def test_held_out_labels_are_not_learned(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(pmod(crc32(cast(string(doc_id) AS binary)), 4) = 2, 1 - quality, quality) AS quality", "toxic"
    )
    assert rows(quality.score_documents(documents, labels)) == rows(quality.score_documents(documents, turned))


def test_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in out if r.quality == q] for q in (1, 0))
    assert np.mean(np.array(good)[:, None] > np.array(bad)[None, :]) > 0.95


def test_sample_is_bounded(spark, documents, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "fit_model", lambda found, y: seen.append(len(found)))
    quality.fit(documents, labels, sample_rows=10)
    assert seen == [10]


def test_one_row_of_a_repeated_id_is_learned_from(spark, make_docs, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_model", lambda found, y: seen.append((len(found), sorted(y))))
    docs = make_docs(*[(1, f"text {k} of one id") for k in range(50)], (2, "another text"), (2, None), (3, "no label"), (None, "no id"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, 1)], "doc_id bigint, quality int")
    quality.fit(docs, labels)
    assert seen == [(2, [0, 1])]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.score_documents(make_docs(), none).collect() == []
    even = [r.score for r in quality.score_documents(make_docs((1, "a"), (2, "a")), none).collect()]
    assert len(even) == 2 and even[0] == even[1] and abs(even[0] - 0.5) < 0.05
    other = spark.createDataFrame([(77, 1), (78, 0)], "doc_id bigint, quality int")
    for labels in (none, other):  # nothing known against any of them
        assert rows(quality.keep_good(make_docs((1, "a"), (2, None)), labels), "doc_id") == [(1,), (2,)]
    one = quality.score_documents(make_docs((1, "a")).drop("n_chars"), none).collect()
    assert len(one) == 1 and 0 <= one[0].score <= 1


def test_labels_of_other_ids_take_no_place(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    others = spark.range(10**6, 10**6 + 100_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    many = labels.unionByName(others.withColumn("quality", others["quality"].cast(labels.schema["quality"].dataType)))
    assert rows(quality.keep_good(documents, many)) == rows(quality.keep_good(documents, labels))


def test_sample_is_bounded_in_bytes(spark, make_docs, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_model", lambda found, y: seen.append(len(found)))
    docs = make_docs(*[(k, "some words here " * 10) for k in range(100)], (100, "long " * 10_000))
    labels = spark.createDataFrame([(k, k % 2) for k in range(101)], "doc_id bigint, quality int")
    quality.fit(docs, labels, sample_bytes=3200)
    quality.fit(docs, labels, sample_bytes=16 * 160 * 5)
    quality.fit(docs, labels)
    assert seen == [20, 80, 101]


def test_score_against_every_pair_outright(spark, documents):
    """From text to score, with all pairs of features written out instead of the linear form."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.fit(documents, labels, quality.id_remainder(4) != 2)
    scores = {r.doc_id: r.score for r in quality.score_documents(documents, labels).collect()}
    short = sorted(documents.collect(), key=lambda r: len(r.text or ""))[:25]
    for r in short:
        ids, values = quality.features(r.text, r.n_chars, {})
        odds = float(model["w0"]) + sum(float(model["w"][i]) * float(x) for i, x in zip(ids, values))
        for (i, x), (j, y) in itertools.combinations(list(zip(ids, values)), 2):
            odds += float(model["v"][i].astype(float) @ model["v"][j].astype(float)) * float(x) * float(y)
        assert abs(scores[r.doc_id] - 1 / (1 + np.exp(-odds))) < 1e-4
