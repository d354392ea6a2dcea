"""Operator 7, MinHash near-dedup: bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct word shingles; its sketch is the K
smallest of them. Documents with equal sets are one class. Inverted lists of retained values
bring classes together; the sketch of the union estimates their similarity and drops most
pairs; exact Jaccard similarity on the full sets decides. Links join classes to components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import unused
from .components import components

#: Values of a sketch, for the estimate.
K = 64
#: The smallest values of it, which go to inverted lists.
Q = 24
#: Chance that sampling hides a pair exactly at the threshold from the lists, or from the estimate.
MISS = 1e-6
#: Lists up to this length yield pairs; longer ones are compared in tiles of TILE x TILE documents.
PAIRS = 256
TILE = 1024
#: Up to so many rows of a few bytes are broadcast to find the texts to read again; more are shuffled.
BROADCAST_ROWS = 500_000

_LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))
_FACTORS = np.random.default_rng(5).integers(1 << 32, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


#: Words whose hashes a task remembers.
KNOWN_WORDS = 150_000


class _WordHash(dict):
    """64-bit hashes of words, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, words: int, known: _WordHash) -> np.ndarray:
    """Sorted hashes of the distinct ``words``-word shingles; of the whole sequence if it is shorter."""
    tokens = text.translate(_LOWER).split() if text else []  # splits at space and tab to carriage return
    if not tokens:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed += hashes[i : i + n] * _FACTORS[i]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique((mixed ^ (mixed >> np.uint64(31))).view(np.int64))


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    for value in batch.column(name).cast(pa.large_binary()):
        yield value.as_py()


def least_shared(size: int, similarity: float) -> int:
    """So many of the ``size`` smallest values of a union are in both sets, but for a chance of ``MISS``."""
    tail, shared = 0.0, 0
    while shared <= size:
        tail += math.comb(size, shared) * similarity**shared * (1 - similarity) ** (size - shared)
        if tail > MISS:
            return shared
        shared += 1
    return size


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (16 bytes that identify the set; null if it is empty), sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for batch in batches:
            counts, nodes, sketches = [], [], []
            for text in _texts(batch, "text"):
                values = shingle_set(text, words, known)
                counts.append(len(values))
                nodes.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                sketches.append(values[:K])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "sketch"],
            )

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(sketch, f"doc_id {kind}, text_hash long, n_shingles long, node binary, sketch array<long>")


def _lists(classes: DataFrame, similarity: float) -> DataFrame:
    """(value, node, n): entries of the inverted lists.

    Two similar sets share at least t of their Q smallest values. With all values in one
    order, rarest first, they then share one of their first Q - t + 1: only those are
    entered, so a passage that thousands of documents contain makes no list unless a
    document consists of little else. Smaller sets are their own sketches, and similar ones
    share ``similarity`` of the larger.
    """
    t = least_shared(Q, similarity)
    values = classes.select("node", "n", F.explode(F.slice("sketch", 1, Q)).alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    kept = F.least(F.col("n"), F.lit(Q))
    needed = F.least(F.ceil(F.round(kept * similarity, 6)), F.lit(t))
    first = (
        values.join(shared, "value")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("common"))
        # values that no other document retains come first, and can't be in a list
        .withColumn("take", kept - needed + 1 - (kept - F.size("common")))
        .where("take > 0")
    )
    return first.select("node", "n", F.explode(F.expr("slice(common, 1, int(take))")).alias("entry")).select(
        F.col("entry.value").alias("value"), "node", "n"
    )


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def _likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) that the sketch of the union allows to be similar."""
    of = lambda x: classes.select(F.col("node").alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col("n").alias(f"n_{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    union = F.array_sort(F.array_union("sketch_a", "sketch_b"))
    common = F.array_intersect("sketch_a", "sketch_b")
    small = (F.col("n_a") <= K) & (F.col("n_b") <= K)  # both sketches are whole sets
    exact = F.size(common) >= F.lit(similarity - 1e-9) * F.size(union)
    sampled = F.size(F.array_intersect(F.slice(union, 1, K), common)) >= least_shared(K, similarity)
    return both.where(F.when(small, exact).otherwise(sampled)).select("a", "b")


def _tile_links(percent: int):
    """Links of the left documents of a tile to its right ones (or among themselves), as a spanning forest."""

    def compare(rows: pa.Table) -> pa.Table:
        left = np.flatnonzero(np.asarray(rows["left"]))
        right = np.flatnonzero(np.asarray(rows["right"]))
        sets = rows["set"].combine_chunks()
        flat, offsets = np.asarray(sets.values), np.asarray(sets.offsets)
        flat = flat[offsets[0] : offsets[-1]]
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        _, value, seen = np.unique(flat, return_inverse=True, return_counts=True)
        useful = seen[value] > 1
        owner, value = owner[useful], np.unique(value[useful], return_inverse=True)[1]
        overlap = np.zeros((len(left), len(right)))  # sums of whole numbers, exact
        row_of = np.full(len(sizes), -1)
        for start in range(0, int(value.max(initial=-1)) + 1, 4096):
            here = (value >= start) & (value < start + 4096)
            x, y = (np.zeros((len(side), 4096), np.float32) for side in (left, right))
            for side, matrix in ((left, x), (right, y)):
                row_of[:] = -1
                row_of[side] = np.arange(len(side))
                at = row_of[owner[here]]
                matrix[at[at >= 0], value[here][at >= 0] - start] = 1
            overlap += x @ y.T
        union = sizes[left][:, None] + sizes[right][None, :] - overlap
        at, to = np.nonzero(overlap * 100 >= union * percent)
        parent = np.arange(len(sizes))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found: list[tuple[int, int]] = []
        for i, j in zip(left[at], right[to], strict=True):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                found.append((i, j))
        nodes = rows["node"].to_pylist()
        return pa.table(
            {"a": pa.array([nodes[i] for i, _ in found], pa.binary()), "b": pa.array([nodes[j] for _, j in found], pa.binary())}
        )

    return compare


def links(docs: DataFrame, sketched: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) between sets, enough to connect all sets with similarity of ``percent`` or more."""
    spark, similarity = docs.sparkSession, percent / 100
    classes = (
        sketched.where("node is not null")
        .groupBy("node")
        .agg(F.min("n_shingles").alias("n"), F.min(F.struct("doc_id", "text_hash")).alias("doc"), F.first("sketch").alias("sketch"))
    )
    classes = staged(classes, "classes")
    lists = staged(_lists(classes.select("node", "n", "sketch"), similarity), "lists")
    lengths = lists.groupBy("value").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    short = staged(lists.join(lengths.where(F.col("length") <= PAIRS).select("value"), "value"), "short-lists")
    long = staged(
        lists.join(lengths.where(F.col("length") > PAIRS), "value").select(
            "value", "node", "n", F.ceil(F.col("length") / TILE).cast("int").alias("tiles")
        ),
        "long-lists",
    )

    other = short.select("value", F.col("node").alias("b"), F.col("n").alias("n_b"))
    pairs = (
        short.join(other, "value")
        .where((F.col("node") < F.col("b")) & _sizes_fit(F.col("n"), F.col("n_b"), percent))
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )
    likely = staged(_likely(pairs, classes, similarity), "pairs")

    # the full sets of the documents still in question, from their texts
    asked = likely.select(F.col("a").alias("node")).union(likely.select("b")).union(long.select("node")).distinct()
    asked = staged(asked.join(classes, "node").select("node", "doc.doc_id", "doc.text_hash"), "asked")
    if asked.count() <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    same = docs["doc_id"].eqNullSafe(asked["doc_id"]) & (F.xxhash64(docs["text"]) == asked["text_hash"])
    texts = docs.join(asked, same).select("node", "text")

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                sets = [shingle_set(t, words, known) for t in _texts(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "set"])

    sets = staged(texts.mapInArrow(whole_sets, "node binary, set array<long>").dropDuplicates(["node"]), "sets")

    of = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    checked = likely.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    verified = checked.where(common * 100 >= union * percent).select("a", "b")

    # a long list is cut into parts, and each two parts meet in a tile
    part = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    tiles = (
        long.withColumn("part", part)
        .withColumn("to", F.explode(F.expr("sequence(0, tiles - 1)")))
        .select(
            "value",
            "node",
            F.least("part", "to").alias("i"),
            F.greatest("part", "to").alias("j"),
            (F.col("part") <= F.col("to")).alias("left"),
            (F.col("part") >= F.col("to")).alias("right"),
        )
        .join(sets, "node")
    )
    tiled = tiles.groupBy("value", "i", "j").applyInArrow(_tile_links(percent), "a binary, b binary")
    return verified.unionByName(tiled)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Group the documents whose shingle sets are alike, of ``docs`` (doc_id, text, and others).

    Two documents are linked if 100 * |A and B| >= ``percent`` * |A or B|; links chain. Returns

    * documents: doc_id, text_hash, n_shingles, node, group (null if nothing is in the set)
    * groups: group, first (the smallest doc_id, then text hash, of the group)

    Null, empty and blank texts have no shingles and are linked with nothing. A null doc_id
    comes after all others. Repeated rows are equal documents. Extra columns are not read.
    """
    docs = docs.select("doc_id", "text")
    sketched = staged(_sketched(docs, words), "sketched")
    labels = components(links(docs, sketched, words, percent))
    documents = sketched.select("doc_id", "text_hash", "n_shingles", "node").join(labels, "node", "left")
    documents = staged(documents.withColumn("group", F.coalesce("label", "node")).drop("label"), "documents")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    # grouped as a struct: a join by group then shuffles both sides, and AQE can split a hot group or the null one
    groups = documents.where("group is not null").groupBy(F.struct("group").alias("key")).agg(F.min(order).alias("first"))
    return documents, groups.select("key.group", F.struct("first.doc_id", "first.text_hash").alias("first"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that near-dedup keeps, with all columns: one document of each group.

    The smallest doc_id stays; of repeated rows that are all the smallest, one stays. A
    document without shingles stays. All columns are as they were.
    """
    documents, groups = near_duplicates(docs, words, percent)
    own, text, is_first, rows = unused(docs, "_id", "_hash", "_first", "_rows")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    marked = (
        documents.join(groups, "group")
        .select(F.col("doc_id").alias(own), F.col("text_hash").alias(text), first.alias(is_first))
        .groupBy(own, text)
        .agg(F.first(is_first).alias(is_first), F.count(F.lit(1)).alias(rows))
        .where(~F.col(is_first) | (F.col(rows) > 1))
    )
    marked = staged(marked, "marked")
    if marked.count() <= BROADCAST_ROWS:
        marked = F.broadcast(marked)
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(text))
    found, columns = docs.join(marked, same, "left"), [f"`{c}`" for c in docs.columns]
    once = found.where(F.col(is_first).isNull()).select(*columns)
    repeated = found.where(F.col(is_first) & (F.col(rows) > 1)).dropDuplicates(["doc_id", text]).select(*columns)
    return once.unionByName(repeated)
