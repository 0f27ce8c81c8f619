import random

import duckdb
import numpy as np
import pytest
from llm_helpers import rows
from pyspark.sql import functions as F

from qlens.llm import hard_negatives, workload

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, label bigint, vector array<bigint>"


def brute(data, is_anchor, positives=5, negatives=3, low=50, high=95):
    """Every pair outright; rows are distinct (id, label, vector)."""
    data = [(i, c, v) for i, c, v in data if i is not None and c is not None and v is not None and None not in v]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = set()
    for i, label, vector in data:
        if not is_anchor(i):
            continue
        others = [(-score(vector, v), k, c == label) for k, c, v in data if k != i]
        best = sorted({(s, k) for s, k, same in others if same})[:positives]
        for s, k in best:
            fit = sorted({(t, m) for t, m, same in others if not same and low * -s <= 100 * -t <= high * -s})[:negatives]
            out.update((i, k, rank, m, -s, -t) for rank, (t, m) in enumerate(fit, 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 5), (70, 64, 33), (130, 200, 257), (40, 0, 40), (5, 7, 0)])
def test_product_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(1 << 27), 1 << 27, (m, k)), rng.integers(-(1 << 27), 1 << 27, (n, k))
    expected = a.astype(object) @ b.T.astype(object)
    for leaf in (1, 4, 32):
        assert (hard_negatives.product(a, b, leaf) == expected).all()


def test_heaps_against_sorting():
    rng = np.random.default_rng(3)
    heaps = hard_negatives.Heaps(np.full(4, -5), 3)
    seen = [set() for _ in range(4)]
    for _ in range(30):
        groups, scores, ids = rng.integers(0, 4, 20), rng.integers(-8, 8, 20), rng.integers(0, 10, 20)
        heaps.offer(groups, scores, ids)
        for g, s, i in zip(groups.tolist(), scores.tolist(), ids.tolist()):
            if s >= -5:
                seen[g].add((-s, i))
    found = list(zip(*[x.tolist() for x in heaps.entries()]))
    assert found == [(g, -s, i) for g in range(4) for s, i in sorted(seen[g])[:3]]


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(5)
    data = [(i, rng.randrange(3), [rng.randrange(-4, 5) for _ in range(5)]) for i in range(60)]
    data += [(100 + i, rng.randrange(3), [1, 1, 1, 1, 1]) for i in range(12)]  # ties
    data += [(200, 1, [2, 2]), (201, 2, []), (202, 1, [9, 0, 0, 0, 0, 3])]  # shorter and longer
    data += [(None, 1, [1, 2, 3, 4, 5]), (300, None, [1, 2, 3, 4, 5]), (310, 1, None), (320, 1, [1, None, 3, 4, 5])]
    data += [(20, 0, [3, 3, 3, 3, 3]), (20, 2, [4, 3, 3, 3, 3])]  # an anchor's id again, with other contents
    copies = data + data[:25] + [data[10]] * 5
    df = spark.createDataFrame([(*r, "x") for r in copies], SCHEMA + ", score string").repartition(7)
    found = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, block_bytes=block_bytes)
    assert rows(found) == brute(data, lambda i: i % 10 == 0)


def test_nothing_to_mine(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(hard_negatives.mine(empty, F.col("vec_id") % 10 == 0)) == []
    alone = spark.createDataFrame([(10, 1, [1, 2]), (11, 2, [1, 2])], SCHEMA)
    assert rows(hard_negatives.mine(alone, F.col("vec_id") % 10 == 0)) == []
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(10, 1, [1 << 40])], SCHEMA), F.lit(True))


def test_quantised_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(7, 9, [0.5, -0.001]), (8, 9, [1.0]), (9, None, [1.0]), (10, 1, None), (11, 1, [None]), (12, 1, [nan]), (13, 1, [-inf]), (14, 3, [])]
    df = spark.createDataFrame(data, "vec_id bigint, label int, embedding array<float>")
    assert rows(hard_negatives.quantised(df)) == [(14, 4, []), (7, 0, [128, -1]), (8, 9, [256])]


def test_given_embeddings_against_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = workload.QUERIES["op11_hard_negatives"](spark, SF)
    expected = duckdb.sql(workload.ORACLE["op11_hard_negatives"]).df()
    assert rows(found, *expected.columns) == sorted(map(tuple, expected.itertuples(index=False)), key=repr)
    assert found.count() > 100
