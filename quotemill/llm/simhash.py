"""Operator 13, SimHash near-dedup: a byte-position inverted index with count filtering.

A fingerprint is eight bytes, each at its position. Two fingerprints that differ in few bits agree in most of
them: with 2 bits, in at least 6 of 8. The index has a list for each set of ``SHARED`` positional
bytes. Bytes stand in order of how rare they are among all fingerprints, and a fingerprint
is entered by its rarest 8 - 6 + SHARED = 6 only: of these, two that agree in 6 share at least SHARED. So every
such pair meets in some list, and lists stay short (with single bytes, each would hold 1/256 of all
fingerprints). Within a list the shared positional bytes of each pair are tallied; pairs with
fewer than 6 go, and the others are verified by their bits.

Different fingerprints are indexed once, however many documents have them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .components import components

WIDTH = 3
SEED = 42
#: Differing bits up to which fingerprints are linked; as each may spoil a byte, so many bytes may differ.
BITS = 2
BYTES = 8
#: Bytes that a list stands for.
SHARED = 4
#: Members of a list that are compared in one go; longer lists are cut into tiles.
TILE = 2048
#: Entries that a task gets together.
TOGETHER = 100_000
#: Shingles hashed at a time.
CHUNK = 1 << 16

_LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """The 64 bits that are set in over half the hashes of the shingles of ``text``; 0 without words."""
    chars = np.frombuffer(text.translate(_LOWER) if text else b"", np.uint8)
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    before = np.concatenate([[True], space[:-1]]) if len(chars) else space
    kept = ~(space & before)  # one character for each run of white space, none at the start
    chars, space = np.where(space, np.uint8(32), chars)[kept], space[kept]
    ends = np.flatnonzero(space)
    if len(space) and not space[-1]:
        ends = np.append(ends, len(space))
    if not len(ends):
        return 0
    starts = np.concatenate([[0], ends[:-1] + 1])
    wide = min(width, len(ends))
    n = len(ends) - wide + 1
    joined, set_in = chars.tobytes(), np.zeros(64, np.int64)
    for first in range(0, n, CHUNK):
        last = min(first + CHUNK, n)
        spans = zip(starts[first:last].tolist(), ends[first + wide - 1 : last + wide - 1].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        set_in += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of ``docs`` (doc_id, text)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(hashed, f"doc_id {kind}, fingerprint long")


def _bytes(prints: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(prints).view(np.uint8).reshape(-1, BYTES)


def _entries(prints: DataFrame, bits: int, shared: int) -> DataFrame:
    """(key, fingerprint): the lists that each of the different ``prints`` is entered in."""
    byte = lambda p: F.shiftrightunsigned("fingerprint", 8 * p).bitwiseAND(F.lit(255)).cast("int")
    positional = F.explode(F.array(*[byte(p) + 256 * p for p in range(BYTES)])).alias("byte")
    counts = np.zeros(BYTES * 256, np.int64)
    for r in prints.select(positional).groupBy("byte").agg(F.count(F.lit(1)).alias("n")).collect():  # 2,048 at most
        counts[r["byte"]] = r["n"]
    rank = np.empty(BYTES * 256, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(BYTES * 256)
    rarest = min(BYTES, bits + shared)
    sets = [list(c) for c in combinations(range(rarest), shared)]

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.asarray(batch.column("fingerprint"))
            tokens = _bytes(prints).astype(np.int64) + 256 * np.arange(BYTES)
            order = np.argsort(rank[tokens], axis=1)[:, :rarest]
            tokens = np.take_along_axis(tokens, order, 1)
            for chosen in sets:
                key = np.zeros(len(prints), np.int64)
                for t in np.sort(tokens[:, chosen], axis=1).T:
                    key = key * (BYTES * 256) + t
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(prints)], ["key", "fingerprint"])

    return prints.mapInArrow(entered, "key long, fingerprint long")


class _Trees(dict):
    """Joins fingerprints into trees, the smallest of each at its root."""

    def root(self, x: int) -> int:
        while (up := self.setdefault(x, x)) != x:
            self[x] = x = self[up]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


def alike(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that share enough positional bytes, and differ in ``bits`` at most."""
    a, b = _bytes(left), _bytes(right)
    tally = np.zeros((len(left), len(right)), np.uint8)
    for p in range(BYTES):
        tally += a[:, p, None] == b[None, :, p]
    i, j = np.nonzero(tally >= BYTES - bits)
    near = np.bitwise_count((left[i] ^ right[j]).view(np.uint64)) <= bits
    return i[near], j[near]


def _links_in(bits: int):
    """Links of the lists of a group, or of the two sides of a tile: of what they connect, each to the smallest."""

    def found(rows: pa.Table) -> pa.Table:
        key, prints = np.asarray(rows["key"]), np.asarray(rows["fingerprint"])
        is_left, is_right = (np.asarray(rows[c]) for c in ("left", "right"))
        order = np.argsort(key, kind="stable")
        trees = _Trees()
        for members in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            left, right = prints[members[is_left[members]]], prints[members[is_right[members]]]
            for first in range(0, len(left), 256):
                part = left[first : first + 256]
                i, j = alike(part, right, bits)
                for a, b in zip(part[i].tolist(), right[j].tolist(), strict=True):
                    if a != b:
                        trees.link(a, b)
        members = [x for x in trees if trees.root(x) != x]
        return pa.table({"a": pa.array(map(trees.root, members), pa.int64()), "b": pa.array(members, pa.int64())})

    return found


def links(prints: DataFrame, bits: int = BITS, shared: int = SHARED) -> DataFrame:
    """Edges (a, b) between the different ``prints``: they connect all that differ in ``bits`` at most, and what
    is reached through such pairs, but nothing else. An edge itself may skip steps.

    Up to 7 bits; ``shared`` and ``bits`` together are 8 at most.
    """
    if not 0 <= bits < BYTES or not 1 <= shared <= BYTES - bits:
        raise ValueError("shared bytes and differing bits have to be 8 at most")
    entries = staged(_entries(prints, bits, shared), "entries")
    lengths = entries.groupBy(F.struct("key").alias("of")).agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    common = staged(entries.join(lengths.select("of.key", "length"), "key"), "lists")
    groups = common.count() // TOGETHER + 1
    short = common.where(F.col("length") <= TILE).select(
        "key", "fingerprint", F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("left"), F.lit(True).alias("right")
    )
    # a long list is cut into parts, and each two parts meet in a tile
    tiles = F.ceil(F.col("length") / TILE).cast("int")
    long = (
        common.where(F.col("length") > TILE)
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), tiles).cast("int"))
        .withColumn("to", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select(
            "key",
            "fingerprint",
            (-1 - F.col("key")).alias("group"),
            F.least("part", "to").alias("i"),
            F.greatest("part", "to").alias("j"),
            (F.col("part") <= F.col("to")).alias("left"),
            (F.col("part") >= F.col("to")).alias("right"),
        )
    )
    return short.unionByName(long).groupBy("group", "i", "j").applyInArrow(_links_in(bits), "a long, b long").distinct()


def near_groups(docs: DataFrame, width: int = WIDTH, bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component): documents whose fingerprints differ in ``bits`` at most, and what is reached through them.

    ``component`` is the smallest doc_id of them, null if none of them has one. A shorter text than ``width`` words is
    one shingle; null, empty and blank texts have the fingerprint zero, and are linked like any other.
    Repeated rows are documents of their own. Only doc_id and text of ``docs`` are read.
    """
    rows = staged(fingerprints(docs, width), "fingerprints")
    prints = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "different")
    labels = components(links(prints.select("fingerprint"), bits))
    named = staged(prints.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"), "labelled")
    grouped = named.where("label is not null").groupBy(F.struct("label").alias("of")).agg(F.min("first").alias("least"))
    reached = named.join(grouped.select("of.label", "least"), "label", "left").select(
        "fingerprint", F.when(F.col("label").isNull(), F.col("first")).otherwise(F.col("least")).alias("component")
    )
    return rows.join(staged(reached, "reached"), "fingerprint").select("doc_id", "fingerprint", "component")
