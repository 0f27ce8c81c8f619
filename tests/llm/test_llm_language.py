import random
import re
import zlib

from llm_helpers import rows

from qlens.llm import language

EN = "the quick brown fox jumps over the lazy dog and then the dog runs after the fox through the old forest "
DE = "der schnelle braune fuchs springt über den faulen hund und dann läuft der hund dem fuchs durch den wald nach "


def corpus(make_docs, **options):
    learn = [(k, (EN if k % 2 else DE) * 3, "en" if k % 2 else "de") for k in range(40)]
    odd = [
        (100, None, "en"),
        (101, "", "en"),
        (102, "12345 ... !!!", "en"),
        (103, "The lazy dog jumps over the fox and runs", None),
        (104, "DER FAULE HUND LÄUFT DURCH DEN WALD", None),
        (105, EN * 5000, None),
        (None, "den hund über den fuchs", "de"),
        (7, EN * 3, "en"),
    ]
    return make_docs(*learn, *odd, **options)


def test_predictions(make_docs):
    docs = corpus(make_docs, extra="p row lang_pred margin score rejected")
    out = language.identify(docs).collect()
    assert len(out) == docs.count()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        assert r.rejected == (r.lang_pred == "und" or r.margin < language.MIN_MARGIN)
    for k in (100, 101, 102):
        assert (by_id[k][0].lang_pred, by_id[k][0].score, by_id[k][0].rejected) == ("und", 0.0, True)
    assert [by_id[k][0].lang_pred for k in (103, 104, 105, None)] == ["en", "de", "en", "de"]
    assert len(by_id[7]) == 2 and by_id[7][0] == by_id[7][1]


def test_held_out_labels_are_not_learned(make_docs):
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 == 1]
    docs = make_docs(*[(k, EN, "held" if k in held else "known") for k in range(60)])
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"known"}


def test_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert out.filter("lang_pred = lang").count() / out.count() > 0.97


def test_dictionary_is_bounded_and_holds_whole_texts(documents):
    found = dict(language.fit(documents, dictionary_bytes=2000))
    assert set(found) == {"en", "fr", "de", "es"}
    assert all(len(d) <= 2000 for d in found.values())


def test_long_texts_and_copies_fill_their_dictionaries(spark, make_docs):
    def words(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))

    copies = spark.range(3000).selectExpr("id AS doc_id", f"'{words(0, 300)}' AS text", "'copies' AS lang")
    few = [(5000 + k, words(k, 10) + " 12. " * 20, "copies") for k in range(1, 9)]
    docs = make_docs(*few, (6000, words(9, 60_000), "long"), (6001, "ab cd", "tiny")).select("doc_id", "text", "lang").unionByName(copies)
    for size in (500, 2000):
        found = dict(language.fit(docs, dictionary_bytes=size))
        assert {lang: len(d) for lang, d in found.items()} == {"copies": size, "long": size, "tiny": 5}
    whole = dict(language.fit(docs))["copies"].decode()
    assert all(language.letters(t).strip() in whole for t in (words(0, 300), *[words(k, 10) for k in range(1, 9)]))


def test_stage_keeps_columns_and_drops_rejected(make_docs):
    docs = corpus(make_docs, extra="p row lang_pred")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    wanted = docs.filter("doc_id IS NULL OR doc_id NOT IN (100, 101, 102)")
    assert rows(kept) == rows(wanted)


def test_nothing_to_learn_from(make_docs):
    assert {tuple(r)[2:] for r in language.identify(make_docs((1, "text", None))).collect()} == {("und", 0.0, 0.0, True)}
    assert language.identify(make_docs()).collect() == []
    assert language.keep_identified(make_docs()).collect() == []


def test_predictions_against_one_call_for_each_block_and_dictionary(spark):
    """From texts and labels of a whole table to predictions, with a compressor made anew for every call."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = language.fit(docs, language.id_remainder(3) != 1)
    rows_ = sorted(docs.collect(), key=lambda r: r.doc_id)[:60]

    def size(block, data):
        known = zstandard.ZstdCompressionDict(data.ljust(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(coder.compress(block))

    expected = {}
    for r in rows_:
        text = r.text or ""
        if not any(c.isalpha() for c in text):
            expected[r.doc_id] = ("und", 0.0)
            continue
        data = " ".join(re.split(r"[\W\d_]+", text.lower())).encode()
        sizes = {}
        for lang, known in learned:
            sizes[lang] = sum(size(data[k : k + language.BLOCK], known) for k in range(0, len(data), language.BLOCK))
        best = min(sizes.values())
        expected[r.doc_id] = (next(lang for lang, s in sizes.items() if s == best), 1 / sum(2.0 ** (8 * max(best - s, -100)) for s in sizes.values()))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect() if r.doc_id in expected}
    assert found.keys() == expected.keys()
    same = [k for k in expected if found[k][0] == expected[k][0] and abs(found[k][1] - expected[k][1]) < 0.01]
    assert len(same) == len(expected)
