"""Operator 12, hard-negative mining by threshold joins in the manner of L2AP.

Both searches, for an anchor's positives and for the negatives in a window of scores, are one
threshold join: all pairs whose inner product reaches a threshold. Anchors and rows meet in blocks. Of a
block of rows an inverted index holds, dimension by dimension, only what the threshold needs:
a row's leading dimensions are omitted as long as their norm is too small to reach it with any anchor of
the block. Partial scores are accumulated from the index, pairs go as soon as the norms of what
remains can't lift them to the threshold, and the omitted part is added for those that are left.

Thresholds start at the best score of a bounded sample of rows, and are lowered for the
windows that did not fill: to the last score that the sample filled them with, or to the window's end.
As every block returns the best of each window above the threshold, a window that is full holds exactly
its first rows, and one that was searched to its end holds all there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import sound, whole

#: Rows, and anchors, of a block.
ROWS = 2048
ANCHORS = 1024
#: Anchors scored together, and dimensions added before pairs are looked at again.
TOGETHER = 256
GROUP = 16
#: Rows that the first thresholds are taken from.
SAMPLE = 2048
#: Beyond every score.
ANY = 1 << 62


def _norms(x: np.ndarray) -> np.ndarray:
    """[:, m]: the length of the first m components."""
    squares = np.zeros((len(x), x.shape[1] + 1))
    np.cumsum(x.astype(float) ** 2, axis=1, out=squares[:, 1:])
    return np.sqrt(squares)


def reaching(q: np.ndarray, least: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of all pairs with ``q[i] @ x[j] >= least[i]``, exact for whole numbers."""
    none = np.empty(0, np.int64)
    if not len(q) or not len(x):
        return none, none, none
    d = q.shape[1]
    order = np.argsort((x.astype(float) ** 2).sum(0), kind="stable")  # what adds little is omitted first
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * d
    kind = float if largest < 2**53 else np.int64  # sums of floats are exact up to there
    q, x = q[:, order].astype(kind), x[:, order].astype(kind)
    of_q, of_x = _norms(q), _norms(x)
    floor = least - (1 + np.abs(least) * 1e-9)  # bounds are rounded
    length = of_q[:, -1]
    ratio = np.where(length > 0, floor / np.where(length > 0, length, 1), np.where(floor > 0, np.inf, -np.inf)).min()

    omitted = np.maximum((of_x < ratio).sum(1) - 1, 0)
    by = np.argsort(omitted, kind="stable")
    x, of_x, omitted = x[by], of_x[by], omitted[by]
    indexed = np.where(np.arange(d) >= omitted[:, None], x, 0)
    live = np.flatnonzero((omitted < d) | (ratio <= 0))
    score = np.zeros((len(q), len(live)), kind)
    for end in range(d, 0, -GROUP):
        begin = max(end - GROUP, 0)
        n = int(np.searchsorted(omitted[live], end))  # the lists of these dimensions hold the rows that omit fewer
        score[:, :n] += q[:, begin:end] @ indexed[live[:n], begin:end].T
        rest = np.maximum(omitted[live], begin)
        alive = (score + of_q[:, rest] * of_x[live, rest] >= floor[:, None]).any(0)
        if not alive.all():
            live, score = live[alive], score[:, alive]
    rest = omitted[live]
    i, c = np.nonzero(score + of_q[:, rest] * of_x[live, rest] >= floor[:, None])
    found, total = live[c], score[i, c]
    for first in range(0, len(i), 1 << 16):
        part = slice(first, first + (1 << 16))
        total[part] += np.einsum("pd,pd->p", q[i[part]], x[found[part]] - indexed[found[part]])
    total = total.astype(np.int64)
    enough = total >= least[i]
    return i[enough], by[found[enough]], total[enough]


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = lists.combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    x = np.zeros((len(sizes), width), np.int64)
    x[np.arange(width) < sizes[:, None]] = np.asarray(lists.flatten())
    return x


def _of_block(k: int, same: bool):
    """The best ``k`` rows of a block for each window of a block of anchors, above its threshold."""

    def best(windows: pa.Table, rows: pa.Table) -> pa.Table:
        width = max((int(np.diff(np.asarray(t["vector"].combine_chunks().offsets)).max(initial=0)) for t in (windows, rows) if len(t)), default=0)
        window, low, high = (np.asarray(windows[c]) for c in ("window", "low", "high"))
        anchors, first, of = np.unique(np.asarray(windows["query"]), return_index=True, return_inverse=True)
        q, x = (_matrix(t["vector"], width) for t in (windows.take(first), rows))
        q_label, x_label = np.asarray(windows["label"])[first], np.asarray(rows["label"])
        row, ids = np.asarray(rows["row"]), rows["vec_id"].combine_chunks()
        by_id = np.asarray(ids.fill_null((1 << 63) - 1))
        least = np.full(len(anchors), ANY, np.int64)
        np.minimum.at(least, of, low)
        nth = np.zeros(len(of), np.int64)  # of the windows of an anchor
        by = np.argsort(of, kind="stable")
        nth[by] = np.arange(len(of)) - np.searchsorted(of[by], of[by])
        found: list[tuple[np.ndarray, ...]] = []
        for start in range(0, len(anchors), TOGETHER):
            i, j, score = reaching(q[start : start + TOGETHER], least[start : start + TOGETHER], x)
            i += start
            right = ((q_label[i] == x_label[j]) == same) & (anchors[i] != row[j])
            i, j, score = i[right], j[right], score[right]
            for n in range(int(nth.max(initial=-1)) + 1):
                name, lo, hi = np.zeros(len(anchors), np.int32), np.full(len(anchors), ANY), np.full(len(anchors), -ANY)
                chosen = nth == n
                name[of[chosen]], lo[of[chosen]], hi[of[chosen]] = window[chosen], low[chosen], high[chosen]
                inside = np.flatnonzero((score >= lo[i]) & (score <= hi[i]))
                inside = inside[np.lexsort((row[j[inside]], by_id[j[inside]], -score[inside], i[inside]))]
                a = i[inside]
                inside = inside[np.arange(len(a)) - np.searchsorted(a, a) < k]
                found.append((anchors[i[inside]], name[i[inside]], j[inside], score[inside]))
        query, name, j, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        j = pa.array(j, pa.int64())
        return pa.table(
            {
                "query": pa.array(query, pa.int64()),
                "window": pa.array(name, pa.int32()),
                "row": rows["row"].take(j),
                "vec_id": ids.take(j),
                "score": pa.array(score, pa.int64()),
            }
        )

    return best


def _search(windows: DataFrame, anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """(query, window, row, vec_id, score, place from 1): the first ``k`` rows with scores from ``low`` to ``high``
    of each of the ``windows`` (query, window, low, high), with the anchor's label or without."""
    across = max(1, -(-rows.count() // ROWS))
    down = max(1, -(-anchors.count() // ANCHORS))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = windows.join(anchors, "query").withColumn("i", block("query", down)).withColumn("j", every(across))
    right = rows.withColumn("j", block("row", across)).withColumn("i", every(down))
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
        _of_block(k, same), "query long, window int, row long, vec_id long, score long"
    )
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _filled(windows: DataFrame, anchors: DataFrame, rows: DataFrame, sample: DataFrame, k: int, same: bool) -> DataFrame:
    """``_search`` with thresholds that start high and are lowered where a window does not fill."""
    key = ["query", "window"]
    seen = _search(windows, anchors, sample, k, same).groupBy(*key).agg(
        F.max("score").alias("best"), F.min("score").alias("last"), F.count(F.lit(1)).alias("n")
    )
    levels = staged(
        windows.join(seen, key, "left").select(
            *key,
            F.coalesce("best", "low").alias("first"),
            F.when(F.col("n") >= k, F.col("last")).otherwise(F.col("low")).alias("second"),
            "high",
        ),
        "windows",
    )
    high = staged(_search(levels.select(*key, F.col("first").alias("low"), "high"), anchors, rows, k, same), "found")
    full = high.where(F.col("place") == k).select(*key)
    short = staged(levels.where("second < first").join(full, key, "left_anti"), "short-windows")
    lowered = _search(short.select(*key, F.col("second").alias("low"), "high"), anchors.join(short.select("query").distinct(), "query"), rows, k, same)
    return staged(high.join(short, key, "left_anti").unionByName(lowered), "found")


def mine(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256
) -> DataFrame:
    """Hard negatives of the anchors among the rows of ``df`` (vec_id, label, vector).

    An anchor's positives are the first ``positives`` other rows of its label, by inner product, then smaller
    vec_id; all, if there are fewer. For each of them, the first ``negatives`` rows of other labels whose score is from
    ``least`` to ``most`` hundredths of the positive's, both included; a positive below zero has none. Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are those of the components floor(``scale`` * x), within 2 ** 27 either way. Rows whose label or vector
    is null, or whose vector holds a null or non-finite component, take no part. Shorter vectors count
    as filled up with zeros. A row without vec_id is no anchor, and comes last among ties. Repeated
    rows are rows of their own, as anchors too. Other columns are not read.
    """
    rows = df.where(F.col("label").isNotNull() & sound(F.col("vector"))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        whole(F.col("vector"), scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    )
    rows = staged(rows, "rows")
    asked = staged(rows.where("asked").select(F.col("row").alias("query"), F.col("vec_id").alias("anchor_id"), "label", "vector"), "anchors")
    anchors, rows = asked.drop("anchor_id"), rows.drop("asked")
    sample = staged(rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE), "sample")
    of = lambda low, high: [F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")]
    everything = anchors.select("query", F.lit(0).alias("window"), *of(-ANY, ANY))
    near = _filled(everything, anchors, rows, sample, positives, True).select(
        "query", F.col("place").cast("int").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    hundredths = lambda n: F.col("positive_score").cast("decimal(20,0)") * n / 100
    windows = near.select(
        "query", "window", F.ceil(hundredths(least)).cast("long").alias("low"), F.floor(hundredths(most)).cast("long").alias("high")
    )
    hard = _filled(windows.where("low <= high"), anchors, rows, sample, negatives, False)
    return (
        hard.join(near, ["query", "window"])
        .join(asked.select("query", "anchor_id"), "query")
        .select(
            "anchor_id",
            "positive_id",
            F.col("place").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
