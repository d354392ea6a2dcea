"""Operator 8, packing: length buckets with the least padding, and batches within a token budget.

A histogram of all lengths goes to the driver, where dynamic programming chooses the
bucket boundaries. Each sequence is padded to the boundary of its bucket, and a batch takes
as many sequences of one bucket as the budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_sum, unused

#: The least number of lengths that a histogram tells apart.
EXACT = 2048
#: Lengths up to here are told apart exactly by ``pack``; above, only to one part in LENGTHS / 2.
#: That bounds the histogram: LENGTHS entries, and LENGTHS / 2 more each time the longest length doubles.
LENGTHS = 65_536


def rounded_length(length: Column, exact: int = EXACT) -> Column:
    """The smallest length of the histogram that is not below ``length``; itself up to ``exact``."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.ceil(F.log2(length / F.lit(exact))))).cast("long")
    up = F.ceil(length / step) * step
    return F.when(length <= exact, length).otherwise(up).cast("long")


def _one_more_bucket(cost: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(costs, first lengths of the last bucket) of lengths[0..j] for each j, given their ``cost`` with a bucket less.

    The later j, the later its last bucket starts: for the middle j of a range all places are tried
    that its ends allow, and the two halves share these between them.
    """
    best, start = cost.copy(), np.zeros(len(lengths), dtype=np.int64)
    ranges = [(1, len(lengths), 0, len(lengths))]
    while ranges:
        lo, hi, least, most = ranges.pop()
        if lo >= hi:
            continue
        j = (lo + hi) // 2
        end = min(j, most)
        tried = cost[least:end] + lengths[j] * (before[j + 1] - before[least + 1 : end + 1])
        i = least + int(tried.argmin())
        best[j], start[j] = tried[i - least], i + 1
        ranges += [(lo, j, least, i + 1), (j + 1, hi, i, most)]
    return best, start


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets that minimise the sum of padded lengths.

    ``lengths`` ascend; a bucket's boundary is the largest length in it. Of equally good
    choices the one with the fewest buckets, then the smallest boundaries, wins.
    """
    n = len(lengths)
    if n == 0:
        return []
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    cost = lengths * before[1:]  # one bucket for lengths[0..j]
    starts = []  # starts[b][j]: first length of the last bucket, for lengths[0..j] in b + 2 buckets
    costs = [cost]
    for _ in range(1, min(buckets, n)):
        cost, start = _one_more_bucket(cost, lengths, before)
        starts.append(start)
        costs.append(cost)
    used = int(np.argmin([c[-1] for c in costs]))
    bounds, j = [], n - 1
    for level in reversed(range(used)):
        bounds.append(int(lengths[j]))
        j = int(starts[level][j]) - 1
    return [int(lengths[j]), *reversed(bounds)]


def pack(df: DataFrame, length: str, order: list[str], buckets: int = 8, budget: int = 65_536, ties: list[str] = ()) -> DataFrame:
    """Add bucket int, padded_length long, batch long, slot long and padding long to all rows of ``df``.

    ``padded_length`` is the boundary of the bucket. A batch holds max(1, budget div
    padded_length) sequences of one bucket, the last batch of a bucket perhaps fewer; a sequence
    above the budget is a batch of its own. Batches are numbered from 0 over all buckets, slots
    from 0 within a batch. Within a bucket, rows come in the order of a hash of ``order``.

    A row whose length is null or 0 is in no batch: its five columns are null. Columns of
    ``df`` with these names are replaced. ``df`` is read several times, so it should be a table.
    """
    added = ("bucket", "padded_length", "batch", "slot", "padding")
    df = df.drop(*added)
    sizes = (
        df.where(F.col(length) > 0)
        .groupBy(rounded_length(F.col(length), LENGTHS).alias("up"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("up")
        .collect()
    )
    lengths, counts = (np.array([r[k] for r in sizes], dtype=np.int64) for k in ("up", "n"))
    bounds = best_boundaries(lengths, counts, buckets)
    table, first, lo = [], 0, 0
    for b, bound in enumerate(bounds):
        rows = int(counts[(lengths > lo) & (lengths <= bound)].sum())
        room = max(1, budget // bound)
        table.append((b, bound, room, first))
        first, lo = first + -(-rows // room), bound
    bucket = F.lit(None).cast("int")
    for b, bound, _, _ in reversed(table):
        bucket = F.when(F.col(length) <= bound, b).otherwise(bucket)
    bucket = F.when(F.col(length) > 0, bucket)
    of = lambda k: F.get(F.array(*[F.lit(t[k]).cast("long") for t in table]), F.col("bucket")) if table else F.lit(None).cast("long")
    position, room = unused(df, "_position", "_room")
    placed = running_sum(df.withColumn("bucket", bucket), ["bucket"], order, F.lit(1), position, ties=ties)
    return (
        placed.withColumn("padded_length", of(1))
        .withColumn(room, of(2))
        .withColumn("batch", of(3) + F.expr(f"{position} div {room}"))
        .withColumn("slot", F.when(F.col("batch").isNotNull(), F.col(position) % F.col(room)))
        .withColumn("padding", (F.col("padded_length") - F.col(length)).cast("long"))
        .select(*[f"`{c}`" for c in df.columns], *added)
    )
