import random
import re

import pytest
from llm_helpers import rows

from qlens.llm import licenses

WORD = re.compile(licenses.WORD)
NOTICE = list(licenses.NOTICES)


def brute(text):
    own = WORD.findall((text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for k in range(len(own) - len(p) + 1):
            if own[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def random_texts():
    rng = random.Random(1)
    pool = "GNU gnu general public license Apache LICENSE, license mit MIT cc-by CC by BY; the é".split()
    return [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(120)]


@pytest.fixture(scope="module")
def texts():
    return [
        None,
        "",
        "...",
        "MIT License",
        "mit\x00license mit_license mit1license mitlicense",
        "MİT license ſ K",
        "cc by cc by cc by",
        "gnu general public gnu general public license license",
        "x " * 60000 + "Apache License, Version 2.0",
        *random_texts(),
    ]


def test_base_places(make_docs, texts):
    docs = make_docs(*enumerate(texts), (3, texts[3]), (None, texts[6]), extra="body w label labels score k")
    got = rows(licenses.scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    pairs = [*enumerate(texts), (3, texts[3]), (None, texts[6])]
    assert got == sorted(((k, *brute(t)) for k, t in pairs), key=repr)


def test_same_id_with_different_texts(make_docs):
    out = licenses.scan(make_docs((1, "mit license"), (1, "apache license"), (1, "none")))
    assert rows(out, "base_labels") == [("",), ("apache",), ("mit",)]


def test_changed_notices(make_docs):
    mit, apache = NOTICE[0], NOTICE[1]
    words = mit.split()
    cases = {
        0: (mit.upper(), "mit", 1.0),
        1: ("before " + " ".join([*words[:9], "extra", "words", *words[9:]]) + " after", "mit", None),
        2: (" ".join(w for k, w in enumerate(words) if k != 12), "mit", None),
        3: (" ".join(words[:6]), "", 0.0),
        4: (" filler ".join(words), "", 0.0),
        5: (apache + " text between them " + mit, "apache,mit", 1.0),
        6: (" ".join(random.Random(1).sample(words, len(words))), "", 0.0),
    }
    out = {r.doc_id: r for r in licenses.scan(make_docs(*[(k, t) for k, (t, _, _) in cases.items()])).collect()}
    for k, (_, labels, score) in cases.items():
        assert out[k].labels == labels, k
        assert out[k].score == score if score is not None else 0.6 <= out[k].score < 1


def test_base_labels_stay(make_docs, texts):
    for r in licenses.scan(make_docs(*enumerate(texts))).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 0) == (r.labels == "")


def test_native(documents):
    plan = licenses.scan(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(make_docs):
    assert licenses.scan(make_docs()).collect() == []


def test_own_templates(make_docs):
    docs = make_docs((1, "All rights reserved, by ACME. Ask first!"), (2, "mit license"), (3, "ask before you copy or sell any of this text"))
    own = {"ACME: all rights": "x", "Rights reserved by Acme": "acme", "word": "short"}
    out = licenses.scan(docs, own, {"Ask before you copy, print or sell any of this text": "ask", "too few": "y"})
    assert rows(out, "doc_id", "base_labels", "labels") == [(1, "acme", "acme"), (2, "", ""), (3, "", "")]
    out = licenses.scan(docs, {}, {"ask before you copy or sell any of this": "ask"})
    assert rows(out, "doc_id", "n_base", "labels") == [(1, 0, ""), (2, 0, ""), (3, 0, "ask")]
    assert sorted(r.n_words for r in licenses.scan(docs, {}, {}).filter("labels = ''").collect()) == [2, 7, 10]


def test_more_templates_than_are_broadcast(make_docs, texts, monkeypatch):
    docs = make_docs(*enumerate(texts[:40]))
    sent = rows(licenses.scan(docs))
    monkeypatch.setattr(licenses, "SENT_GRAMS", 1)
    assert rows(licenses.scan(docs)) == sent


def test_whole_license_texts(make_docs):
    full = [t for t in licenses.NOTICES if len(t.split()) > 50]
    assert len(full) == 4
    out = licenses.scan(make_docs(*enumerate(full))).collect()
    assert {r.doc_id: licenses.NOTICES[full[r.doc_id]] in r.labels.split(",") for r in out} == dict.fromkeys(range(4), True)


def test_texts_are_taken_apart_once(documents):
    plan = licenses.scan(documents)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("regexp_extract_all") == 1 and "regexp_count" not in plan
