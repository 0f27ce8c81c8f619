import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from llm_helpers import rows

from qlens.llm import mixing, workload

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string"


def targets(words, weights=(5, 2, 1), most=3):
    """Water-filling one source at a time."""
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    held, total = {}, sum(words.values())
    while True:
        free = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * words[s]]
        if not over:
            return held | share
        held |= {s: most * words[s] for s in over}


def check(found, docs, slack):
    """Sizes, targets and sums of a result (pandas) against the documents (id, text, source)."""
    size = [len(WORD.findall(t or "")) for _, t, _ in docs]
    words = defaultdict(int)
    for s, (_, _, source) in zip(size, docs):
        words[source] += s
    aim = targets(words)
    expected = Counter((i, s, words[source], round(aim[source], 6)) for s, (i, _, source) in zip(size, docs))
    own = found.astype(object).where(found.notna(), None)
    assert Counter((r.doc_id, r.size_, r.source_size, round(r.target, 6)) for r in own.rename(columns={"size": "size_"}).itertuples()) == expected
    assert ((found.taken >= 0) & (found.taken <= 3 * found["size"])).all()
    assert (found.taken % found["size"].where(found["size"] > 0, 1) == 0).all()
    taken = found.groupby(["source_size", "target"]).taken.sum()
    copies_of = Counter((words[s], aim[s]) for s in words)
    for (source_size, target), got in taken.items():
        n = max(c for (w, t), c in copies_of.items() if w == source_size and math.isclose(t, target))
        assert abs(got - n * target) <= slack * n, (source_size, target, got)


def test_given_documents(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    query = workload.QUERIES["op12_entropy_mixing"]
    check(query(spark, SF).toPandas(), docs, 100)  # half of the shortest document of a source of ten
    shuffled = spark.createDataFrame(docs, SCHEMA).repartition(5)
    assert rows(mixing.mix(shuffled)) == rows(query(spark, SF))  # whatever the layout


def test_nulls_ties_repeats_and_clashing_names(spark):
    docs = [(i, "w " * (i % 9), f"s{i % 4}") for i in range(200)]
    docs += [(None, None, None), (None, "a b c", None), (7, "x", "é"), (8, "", "zero"), (9, "one word\x0bnext", "S")]
    docs += [(500, "hot words here", "hot")] * 300 + [(None, "no id", "hot")] * 50
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA + ", size string, key string").repartition(6)
    found = mixing.mix(df)
    check(found.toPandas(), docs, 9)
    assert rows(found) == rows(mixing.mix(df))


def test_pieces_of_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 7)
    docs = [(1, "hot words here", "a")] * 100 + [(k, "w " * k, "b") for k in range(40)]
    found = mixing.mix(spark.createDataFrame(docs, SCHEMA)).toPandas()
    check(found, docs, 4)
    assert len(found) == len(docs)


@pytest.mark.parametrize("docs", [[], [(1, None, "a"), (2, "", None)], [(1, "one", "a")], [(1, "a b", "x"), (2, "c", "y")]])
def test_small_tables(spark, docs):
    found = mixing.mix(spark.createDataFrame(docs, SCHEMA)).toPandas()
    assert len(found) == len(docs)
    assert (found.taken <= 3 * found["size"]).all()
    if not sum(found["size"]):
        assert (found.target == 0).all() and (found.taken == 0).all()


def test_tilt_is_the_root_of_the_dual(spark):
    """Against bisection in plain Python, one source each way and one at its most."""
    rng = np.random.default_rng(4)
    cases = {"down": 0.3, "up": 1.9, "most": 3.0, "even": 1.0}
    classes, sources = [], []
    for key, ratio in cases.items():
        table = Counter(rng.geometric(0.02, 300).tolist())
        words = sum(s * n for s, n in table.items())
        classes += [(key, s, n) for s, n in table.items()]
        sources.append((key, words, ratio * words, min(table), sum(table.values())))
    from qlens.storage import scratch

    c = spark.createDataFrame(classes, "key string, size bigint, n bigint")
    s = spark.createDataFrame(sources, "key string, words bigint, target double, shortest bigint, docs bigint")
    with scratch(spark) as keep:
        found = {r.key: r.tilt for r in mixing.tilts(c, s, 3, keep).collect()}
    for key, words, target, _, _ in sources:
        own = [(size, n) for k, size, n in classes if k == key]
        got = sum(n * size * min(3.0, math.exp(min(found[key] * size, 50))) for size, n in own)
        assert math.isclose(got, target, rel_tol=1e-6), key
    assert found["down"] < 0 < found["up"] and abs(found["even"]) < 1e-9


def test_rounding_follows_the_rates():
    rng = np.random.default_rng(5)
    for _ in range(50):
        sizes = np.sort(rng.choice(np.arange(1, 400), 60, replace=False))[::-1]
        sizes[-1] = 1
        frame = pd.DataFrame({"size": sizes, "n": rng.integers(1, 5, 60), "rate": rng.uniform(0.2, 2.8, 60)})
        got = mixing.copies(frame, 3)
        assert (got >= 0).all() and (got <= 3 * frame.n).all()
        wanted = (frame["size"] * frame.n * frame.rate).sum()
        assert abs((got * frame["size"]).sum() - wanted) <= sizes[-6:].sum()
