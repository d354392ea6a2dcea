"""Operator 10, token files: frequency-ranked ids in byte-aligned variable-length coding.

A file is a sequence of blocks, each with a table of its own. In a block, an id is replaced by
its rank by frequency, the most frequent one being 0, and a rank takes 1 to 4 bytes. The
lengths, 2 bits each, stand apart from the bytes, in control bytes of four lengths: reading
looks them up in a table, and numpy puts all ranks together at once.

Layout of a block, little-endian:

=============  =====================================================================
4 bytes        ``FRB1``
4 x uint64     documents, ids, entries of the table, bytes of data
documents x    int64 doc_id (0 where null); then uint8, 1 where null; then uint64 ids
table x        uint32 id, by rank
ids / 4        control bytes, rounded up; the first length in the lowest bits
data           the ranks, each with its lower bytes first
uint32         crc32 of all before
1 byte         line feed
=============  =====================================================================

Files are written by Spark's text sink, whose line separator is that line feed. A task that is
lost leaves nothing behind, and any file system that Spark knows will do.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_path

MAGIC = b"FRB1"
#: A block is closed when it has so many ids.
BLOCK_IDS = 1 << 20
#: Blocks in a file, at most: a file is read as a whole.
FILE_BLOCKS = 16
#: Texts whose ids are put together at a time.
TEXTS = 256
#: Bytes of the texts that are encoded together, about: in more of them, fewer words are new.
CHUNK = 8 << 20

#: The lengths in a control byte.
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def _counted_up(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each pair, as many as its size says."""
    ends = np.cumsum(sizes, dtype=np.int32)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)


class Encoder:
    """Encodes texts with a byte-level tokenizer, each different word of them once.

    A token of such a tokenizer has a space only in front. So a text may be cut before each
    space that stands between others than white space, and the words encoded on their own.
    """

    #: Words encoded as one text: short texts cost a call each, long ones slow the library down.
    WORDS = 200
    #: Such texts in one call.
    TEXTS = 32
    #: Words whose ids are kept for the texts to come.
    KNOWN = 100_000
    _SPACES = r" [\t-\r\x{85}\p{Z}]| $"

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks keep the cores busy
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special  # their names in a text are text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if special or not token.special]
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)
        self.starts[[i for token, i in vocabulary.items() if token[0] == "Ġ"]] = True
        nothing = np.empty(0, np.int32)
        self.known = (pa.array([], pa.large_string()), nothing.astype(np.uint32), nothing, nothing)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = []
        for first in range(0, len(texts), self.TEXTS):  # what the library returns takes far more room than ids
            some = self.tokenizer.encode_batch_fast(texts[first : first + self.TEXTS], add_special_tokens=False)
            found += [np.array(e.ids, np.uint32) for e in some]
        return found

    def _new(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, each after a space, and where those of each word begin (and the last ends)."""
        cuts = pa.array([*range(0, len(words), self.WORDS), len(words)], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(cuts, words.cast(pa.string())), " ") if len(words) else []
        ids = np.concatenate([np.empty(0, np.uint32), *self._ids([f" {text}" for text in joined])])
        begins = np.flatnonzero(self.starts[ids])
        if len(begins) != len(words):
            raise ValueError("not a byte-level tokenizer that keeps spaces in front")
        return ids, np.append(begins, len(ids))

    def _words(self, words: pa.LargeStringArray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin of each word's, number of each word's); words that come more than once are remembered."""
        known, known_ids, known_begins, known_sizes = self.known
        place = pc.index_in(words, value_set=known).fill_null(-1).to_numpy()
        old, new = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        fresh, ends = self._new(words.take(pa.array(new)))
        ids = np.concatenate([known_ids, fresh])
        begins, sizes = np.empty(len(words), np.int32), np.empty(len(words), np.int32)
        begins[old], sizes[old] = known_begins[place[old]], known_sizes[place[old]]
        begins[new], sizes[new] = len(known_ids) + ends[:-1], np.diff(ends)
        # the words known for the longest time go
        kept = new[counts[new] > 1][: self.KNOWN]
        first = max(0, len(known) + len(kept) - self.KNOWN)
        start = np.concatenate([known_begins[first:], begins[kept]])
        size = np.concatenate([known_sizes[first:], sizes[kept]])
        self.known = (
            pa.concat_arrays([known[first:], words.take(pa.array(kept))]),
            ids[_counted_up(start, size)],
            np.cumsum(size, dtype=np.int32) - size,
            size,
        )
        return ids, begins, sizes

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; none for null."""
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = pc.match_substring_regex(texts, self._SPACES)
        for token in self.added:  # also within words, or over several
            whole = pc.or_(whole, pc.match_substring(texts, token))
        whole = whole.to_numpy(zero_copy_only=False)
        found: list[np.ndarray] = [None] * len(texts)
        at = np.flatnonzero(whole)
        for i, ids in zip(at, self._ids(texts.take(pa.array(at)).to_pylist()), strict=True):
            found[i] = ids
        cut = np.flatnonzero(~whole)
        words = pc.split_pattern(texts.take(pa.array(cut)) if len(at) else texts, " ")
        firsts = np.asarray(words.offsets)
        flat, heads = words.flatten(), firsts[:-1]
        coded = flat.dictionary_encode()
        place = np.array(coded.indices)
        ids, begins, sizes = self._words(coded.dictionary, np.bincount(place))
        # the first words have no space in front; their ids follow those of the others
        own = self._ids(flat.take(pa.array(heads)).to_pylist())
        place[heads] = len(begins) + np.arange(len(heads))
        own_sizes = np.array([len(x) for x in own], np.int32)
        begins = np.concatenate([begins, len(ids) + np.cumsum(own_sizes, dtype=np.int32) - own_sizes])
        sizes = np.concatenate([sizes, own_sizes])
        ids = np.concatenate([ids, *own])
        for first in range(0, len(cut), TEXTS):
            some = firsts[first : first + TEXTS + 1]
            own = place[some[0] : some[-1]]
            bounds = np.concatenate([[0], np.cumsum(sizes[own])])[some - some[0]]
            joined = ids[_counted_up(begins[own], sizes[own])]
            for i, part in zip(cut[first : first + TEXTS], np.split(joined, bounds[1:-1]), strict=True):
                found[i] = part
        return found


@functools.cache
def _encoder(path: str, special: bool = False) -> Encoder:
    """One for each worker process."""
    return Encoder(path, special)


def _ranked(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids by frequency, the smaller one first among equals; the rank of each of ``flat``)."""
    if len(flat) and flat.max() < 1 << 22:  # as of any tokenizer
        counts = np.bincount(flat)
        values = np.flatnonzero(counts)
        order = values[np.argsort(-counts[values], kind="stable")]
        rank_of = np.zeros(len(counts), np.uint32)
        rank_of[order] = np.arange(len(order), dtype=np.uint32)
        return order, rank_of[flat]
    values, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank_of = np.zeros(len(values), np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    return values[order], rank_of[place]


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    table, ranks = _ranked(flat)
    ranks = ranks.astype("<u4")
    lengths = np.ones(len(ranks), np.uint8)
    for limit in (1 << 8, 1 << 16, 1 << 24):
        if len(table) > limit:
            lengths += ranks >= limit
    width = int(lengths.max(initial=1))
    data = ranks.view(np.uint8).reshape(-1, 4)[:, :width][np.arange(width) < lengths[:, None]]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    body = b"".join(
        [
            MAGIC,
            struct.pack("<4Q", len(doc_ids), len(ranks), len(table), len(data)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array([len(x) for x in ids], "<u8").tobytes(),
            table.astype("<u4").tobytes(),
            control.astype(np.uint8).tobytes(),
            data.tobytes(),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_blocks(content: bytes) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """(doc_ids, ids of each) of every block of a file; raises ValueError where it is damaged."""
    view, at = memoryview(content), 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(view, kind, n, at)
        at += found.nbytes
        return found

    while at < len(content):
        start = at
        if view[at : at + 4] != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += 4
        documents, n, entries, size = (int(x) for x in take("<u8", 4))
        doc_ids, null, counts = take("<i8", documents), take("u1", documents), take("<u8", documents)
        table, control, data = take("<u4", entries), take("u1", -(-n // 4)), take("u1", size)
        lengths = _LENGTHS[control].reshape(-1)[:n]
        ranks = np.zeros((n, 4), np.uint8)
        width = int(lengths.max(initial=1))
        used = np.zeros((n, width), np.uint8)
        used[np.arange(width) < lengths[:, None]] = data
        ranks[:, :width] = used
        if zlib.crc32(view[start:at]) != int(take("<u4", 1)[0]) or view[at : at + 1] != b"\n":
            raise ValueError(f"damaged block at byte {start}")
        at += 1
        ids = table[ranks.view("<u4").reshape(-1)]
        ends = np.cumsum(counts).astype(np.int64)
        yield (
            [None if z else int(d) for d, z in zip(doc_ids, null, strict=True)],
            np.split(ids, ends[:-1]) if documents else [],
        )


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
    """(doc_ids, texts) of about CHUNK bytes, over the ends of batches."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        for first in range(0, len(batch), 256):
            part = batch.slice(first, 256)
            doc_ids += part.column("doc_id").to_pylist()
            texts.append(part.column("text"))
            size += texts[-1].nbytes
            if size >= CHUNK:
                yield doc_ids, pa.chunked_array(texts).combine_chunks()
                doc_ids, texts, size = [], [], 0
    if doc_ids:
        yield doc_ids, pa.chunked_array(texts).combine_chunks()


def write(docs: DataFrame, tokenizer: str, end: int = 0, path: str | None = None, special: bool = False) -> str:
    """Encode doc_id long and text of ``docs`` and write all ids in ascending doc_id order; returns the path.

    ``end`` is appended to each document; a null text has only that. Null doc_ids come first;
    equal ones come in the order of their texts. Other columns are not read. ``tokenizer`` is a
    tokenizers file that all executors can open. A document is never split over blocks. With
    ``special``, the name of a special token in a text is that token, as the library has it by
    default; otherwise it is text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, special)
        doc_ids, ids, held = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_block(doc_ids, ids)], pa.binary())], ["block"])

        for names, texts in _chunks(batches):
            for doc_id, found in zip(names, encoder.encode(texts), strict=True):
                doc_ids.append(doc_id)
                ids.append(np.append(found, np.uint32(end)))
                held += len(ids[-1])
                if held >= BLOCK_IDS:
                    yield block()
                    doc_ids, ids, held = [], [], 0
        if doc_ids:
            yield block()

    path = path or stage_path(docs.sparkSession, "tokens")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = ordered.mapInArrow(blocks, "block binary")
    encoded.select(F.col("block").cast("string")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", FILE_BLOCKS
    ).text(path)
    return path


def read(spark: SparkSession, path: str, columns: str = "ids array<int>", of=lambda ids: ids.astype(np.int32)) -> DataFrame:
    """doc_id, start, n_tokens and ``columns`` of every document in the files of :func:`write`.

    ``start`` is the number of ids of all documents before it. ``of`` makes the last column's value
    from a document's ids; by default it is the ids themselves.
    """
    name, kind = columns.split(" ", 1)

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                for number, (doc_ids, ids) in enumerate(unpack_blocks(content.as_py())):
                    counts = np.array([len(x) for x in ids], np.int64)
                    columns = {
                        "file": pa.array([file.as_py()] * len(ids)),
                        "block": pa.array([number] * len(ids), pa.int64()),
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "before": pa.array(np.cumsum(counts) - counts),
                        "n_tokens": pa.array(counts),
                        name: pa.array([of(x) for x in ids]),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    # blocks in order: those of a file by number, files by their first document
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                for number, size, first in block_heads(content.as_py()):
                    row = {"file": [file.as_py()], "block": [number], "size": [size], "first": pa.array([first], pa.int64())}
                    yield pa.RecordBatch.from_pydict(row)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    heads = files.mapInArrow(blocks, "file string, block long, size long, first long")
    whole = heads.groupBy("file").agg(F.sum("size").alias("size"), F.min_by("first", "block").alias("first"))
    earlier = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("file", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = heads.select("file", "block", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("block_start")).join(whole, "file")
    found = files.mapInArrow(documents, f"file string, block long, doc_id long, before long, n_tokens long, {columns}")
    return found.join(starts, ["file", "block"]).select(
        "doc_id", (F.col("file_start") + F.col("block_start") + F.col("before")).alias("start"), "n_tokens", name
    )


def block_heads(content: bytes) -> Iterator[tuple[int, int, int | None]]:
    """(number, ids, first doc_id) of every block, without decoding it."""
    at = number = 0
    while at < len(content):
        documents, n, entries, size = struct.unpack_from("<4Q", content, at + 4)
        first = at + 36
        null = content[first + 8 * documents]
        yield number, n, None if null else struct.unpack_from("<q", content, first)[0]
        at = first + 17 * documents + 4 * entries + -(-n // 4) + size + 5
        number += 1
