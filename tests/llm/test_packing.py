from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD
from quotemill.llm import packing
from quotemill.llm.queries import QUERIES


def cheapest(lengths, counts, buckets):
    best = None
    for k in range(1, min(buckets, len(lengths)) + 1):
        for cuts in combinations(range(len(lengths) - 1), k - 1):
            bounds = [lengths[c] for c in cuts] + [lengths[-1]]
            cost = sum(n * min(b for b in bounds if b >= x) for x, n in zip(lengths, counts, strict=True))
            best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 5))
def test_boundaries_are_the_best(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[x] for x in lengths]
    bounds = packing.best_boundaries(np.array(lengths), np.array(counts), buckets)
    assert bounds == sorted(set(bounds)) and len(bounds) <= buckets and bounds[-1] == lengths[-1]
    cost = sum(n * min(b for b in bounds if b >= x) for x, n in zip(lengths, counts, strict=True))
    assert cost == cheapest(lengths, counts, buckets)


def test_histogram_is_bounded(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(x,) for x in [1, 2047, 2048, 2049, 2050, 4096, 4097, 10**9]], "n long")
    up = [r[0] for r in df.select(packing.rounded_length(F.col("n"))).collect()]
    assert up[:3] == [1, 2047, 2048] and up[3:5] == [2050, 2050] and up[5] == 4096 and up[6] == 4100
    assert 10**9 <= up[7] <= 10**9 * (1 + 2 / 2048)


def test_long_histograms(spark):
    """As good as trying every place for every length; lengths up to 65,536 are told apart."""
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.choice(20_000, 700, replace=False) + 1)
    counts = rng.integers(1, 10**6, 700)
    before = np.concatenate([[0], np.cumsum(counts)])
    least = lengths * before[1:]
    for _ in range(5):
        least = np.array([min([least[j], *(least[:j] + lengths[j] * (before[j + 1] - before[1 : j + 1]))]) for j in range(700)])
    bounds = np.array(packing.best_boundaries(lengths, counts, 6))
    assert (bounds[np.searchsorted(bounds, lengths)] * counts).sum() == least[-1]

    rows = [(i, n) for i, n in enumerate([9999, 10_001, 65_535, 65_536, 65_537, 65_538, 200_001])]
    packed = packing.pack(spark.createDataFrame(rows, "id long, n long"), "n", ["id"], buckets=9).collect()
    assert {r.n: r.padded_length for r in packed} == {n: n for _, n in rows} | {65_537: 65_538, 200_001: 200_004}


def check(rows, budget):
    batches = defaultdict(list)
    for r in rows:
        if r.batch is None:
            assert not r.length and r.bucket is r.padded_length is r.slot is r.padding is None
            continue
        assert r.padding == r.padded_length - r.length >= 0
        batches[r.batch].append(r)
    assert sorted(batches) == list(range(len(batches)))
    partial = Counter()
    for held in batches.values():
        assert len({r.bucket for r in held}) == 1
        room = max(1, budget // held[0].padded_length)
        assert sorted(r.slot for r in held) == list(range(len(held))) and len(held) <= room
        partial[held[0].bucket] += len(held) < room
    assert all(n <= 1 for n in partial.values())


@pytest.mark.parametrize("budget", [1, 100, 5000])
def test_batches(spark, budget):
    rows = [(i, None if i == 5 else i * i % 97, "clash") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, length long, slot string")
    got = packing.pack(df, "length", ["id"], buckets=4, budget=budget).collect()
    assert sorted(r.id for r in got) == list(range(500))
    check(got, budget)
    assert len({r.bucket for r in got if r.length}) == 4


def test_query_on_odd_rows(spark, documents):
    got = QUERIES["op8_packing"](spark, documents(ODD)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in ODD)
    check(got, 65_536)


def test_empty_table(spark, documents):
    assert QUERIES["op8_packing"](spark, documents([], files=1)).collect() == []
    assert len(QUERIES["op8_packing"](spark, documents([(1, None)], files=1, name="blank")).collect()) == 1


def test_any_other_column_names(spark):
    names = ["doc_id", "length", "_h", "_value", "_real", "_slice", "_position", "_room", "row", "record"]
    rows = [(i, i % 30, *"abcdefgh") for i in range(100)]
    packed = packing.pack(spark.createDataFrame(rows, names), "length", ["doc_id"])
    assert packed.columns[:10] == names
    assert sorted(tuple(r)[:10] for r in packed.collect()) == rows
