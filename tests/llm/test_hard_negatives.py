import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from quotemill.llm import hard_negatives
from quotemill.llm.queries import QUERIES

SCHEMA = "vec_id long, label int, vector array<float>, row string, query string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def drawn(n, d, labels=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    return [(i, int(rng.integers(labels)), [float(c) for c in v]) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])]


def brute(rows, asked, positives=5, negatives=10, least=30, most=90):
    """Every anchor against every row."""
    width = max((len(v) for _, _, v in rows), default=0)
    filled = [(i, y, [math.floor(256 * float(np.float32(c))) for c in v] + [0] * (width - len(v))) for i, y, v in rows]
    out = []
    for a, (i, y, v) in enumerate(filled):
        if i is None or not asked(i):
            continue
        scored = [(-sum(p * q for p, q in zip(v, w, strict=True)), j is None, j or 0, j, z) for b, (j, z, w) in enumerate(filled) if b != a]
        for p in sorted(s for s in scored if s[4] == y)[:positives]:
            inside = [s for s in scored if s[4] != y and -least * p[0] <= -100 * s[0] <= -most * p[0]]
            out += [(i, p[3], r, s[3], -p[0], -s[0]) for r, s in enumerate(sorted(inside)[:negatives], 1)]
    return sorted(out, key=str)


def mined(df, asked, **how):
    return sorted((tuple(r) for r in hard_negatives.mine(df, asked, **how).collect()), key=str)


@pytest.mark.parametrize("d", [3, 24, 70])
def test_same_as_every_pair(spark, d, monkeypatch):
    for name, size in (("ROWS", 97), ("ANCHORS", 11), ("SAMPLE", 60), ("TOGETHER", 5)):
        monkeypatch.setattr(hard_negatives, name, size)  # many blocks, and windows that need a second threshold
    rows = drawn(500, d)
    want = brute(rows, lambda i: i % 20 == 0)
    assert want and mined(frame(spark, rows), F.col("vec_id") % 20 == 0) == want


def test_ties_repeats_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 16)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 8)
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(2)), [float(c) for c in rng.choice([-0.5, 0.5], 4)]) for i in range(80)]
    rows += rows[::10] + [(i, 1, [0.5] * 4) for i in range(200, 240)]
    assert mined(frame(spark, rows), F.col("vec_id") % 10 == 0, most=100) == brute(rows, lambda i: i % 10 == 0, most=100)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    bad = [(0, 1, None), (0, None, [1.0]), (0, 1, [1.0, None]), (0, 1, [nan]), (0, 1, [inf])]
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [1.0]), (None, 2, [0.5, 0.5]), (None, 1, [1.0, 0.5]), (3, 2, []), (4, 1, [-1.0, 0.0])]
    want = brute(rows, lambda i: i == 0)
    assert mined(frame(spark, rows + bad), F.col("vec_id") == 0) == want
    assert {(p, n) for _, p, _, n, _, _ in want} == {(1, 2), (1, None), (None, 2), (None, None)}
    assert mined(frame(spark, []), F.lit(True)) == [] == mined(frame(spark, rows), F.lit(False))


def test_positives_at_and_below_zero(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 1, [-1.0, 0.0]), (3, 2, [0.0, 1.0]), (4, 2, [-0.5, 0.0])]
    assert mined(frame(spark, rows), F.col("vec_id") == 0) == [(0, 1, 1, 3, 0, 0)]


def test_large_components_stay_exact(spark):
    rows = [(i, i % 2, [float(200_000 + 7 * i), float(3 * i), 1.0] * 40) for i in range(60)]
    assert mined(frame(spark, rows), F.col("vec_id") % 9 == 0, most=100) == brute(rows, lambda i: i % 9 == 0, most=100)


@pytest.mark.parametrize("share", [-2.0, 0.0, 0.2, 0.6, 0.95, 1.5])
def test_index_finds_all_pairs_at_a_threshold(share):
    rng = np.random.default_rng(5)
    q, x = rng.integers(-100, 100, (30, 40)) * (rng.random((30, 40)) < 0.5), rng.integers(-100, 100, (200, 40))
    x[::7] = 0
    q[3] = 0
    least = (share * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()).astype(np.int64)
    i, j, score = hard_negatives.reaching(q, least, x)
    full = q @ x.T
    a, b = np.nonzero(full >= least[:, None])
    assert sorted(zip(i, j, score, strict=True)) == sorted(zip(a, b, full[a, b], strict=True))


def test_query_on_no_rows(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op12_hard_negatives"](spark, str(tmp_path)).collect() == []
