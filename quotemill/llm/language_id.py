"""Operator 6, language ID: language-bitmask n-gram filters.

One Bloom filter holds the letter 4-grams of all languages. It is bit-sliced: a position
has a bit for each language, so one lookup per hash, and one AND over the hashes, returns all
languages that contain an n-gram. A text's language is the one that contains most of its
n-grams, after the expected number of false positives is taken off.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from ..session import staged

UNKNOWN = "und"
#: Labelled documents that the filters are built from: about so many of each language, or all there are.
SAMPLE = 2_000
#: Positions of the filter, a power of 2; it bounds the size of the model, also on the driver.
POSITIONS = 1 << 20
HASHES = 3
#: An n-gram belongs to a language if so many sampled documents have it (one, in a language of fewer than FEW_DOCUMENTS), ...
LEAST_DOCUMENTS = 2
FEW_DOCUMENTS = 20
#: ... and so large a part of them, against the language where that part is largest.
LEAST_RATE = 0.2
#: Languages in one slice of the filter.
SLICE = 32
#: Texts are worked through in pieces of about so many characters.
PIECE = 500_000


class Filters(NamedTuple):
    """``bits``: a row of positions for each slice of SLICE languages."""

    languages: list[str]
    bits: np.ndarray

    @property
    def false_positives(self) -> np.ndarray:
        """The chance, for each language, that an n-gram that is not in it seems to be."""
        fill = [np.mean(self.bits[i // SLICE] >> np.uint32(i % SLICE) & np.uint32(1)) for i in range(len(self.languages))]
        return np.array(fill) ** HASHES


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(indices, texts) of bounded size; a longer text is cut after a space, so that no word is cut."""
    at, held, size = [], [], 0
    for i, text in enumerate(texts):
        start = 0
        while text and start < len(text):
            end = len(text)
            if end - start > PIECE:
                cut = text.find(" ", start + PIECE, start + 2 * PIECE)
                end = cut + 1 if cut >= 0 else min(end, start + 2 * PIECE)
            at.append(i)
            held.append(text[start:end])
            size += end - start
            start = end
            if size >= PIECE:
                yield at, held
                at, held, size = [], [], 0
    if held:
        yield at, held


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its text) of each 4-gram: four letters, or letters and the edge of a word."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lower)), [len(t) + 1 for t in lower])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one character after each word stands for all between words
    keep[0] = True
    owner = np.concatenate([[0], owner])[keep]
    c = np.where(letter, points, 32)[keep].astype(np.uint64)
    if len(c) < 4:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = (c[1:-2] != 32) & (c[2:-1] != 32)
    h = (c[:-3] | c[1:-2] << np.uint64(21) | c[2:-1] << np.uint64(42))[inside] * np.uint64(0x9E3779B97F4A7C15)
    h += c[3:][inside] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29)), owner[3:][inside]


def positions(hashes: np.ndarray) -> list[np.ndarray]:
    return [(hashes >> np.uint64(21 * i)).astype(np.int64) & (POSITIONS - 1) for i in range(HASHES)]


def draw(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows (text, lang) of ``labelled`` that teach, written once; rows without a text or a language don't.

    Equal texts of a language count once. Of each language, those with the smallest text hashes
    are taken, about SAMPLE of them (all, if fewer).
    """
    labelled = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null")
    hashed = labelled.withColumn("h", F.xxhash64("text"))
    counts = {r["lang"]: r["count"] for r in hashed.select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not counts:
        return labelled
    rate = F.create_map(*[F.lit(x) for k in sorted(counts) for x in (k, min(1.0, SAMPLE / counts[k]))])
    share = F.shiftrightunsigned("h", 33) / float(1 << 31)
    return staged(hashed.where(share < rate[F.col("lang")]).select("text", "lang").distinct(), "labelled")


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from the rows of ``labelled`` that :func:`draw` takes."""
    return fit(draw(labelled, text, lang))[0]


def fit(sample: DataFrame) -> tuple[Filters, Filters]:
    """Filters from the rows of :func:`draw`, and what a sampled document finds of them if it did not teach itself.

    The second ones have only n-grams that one more document has than it takes. Counting runs on
    Spark; the driver gets one row per language, then at most one per position and slice.
    Without labelled rows there are no languages.
    """
    drawn = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    languages = sorted(drawn)
    slices = -(-len(languages) // SLICE) or 1
    bits, others = np.zeros((slices, POSITIONS), np.uint32), np.zeros((slices, POSITIONS), np.uint32)
    if not languages:
        return Filters(languages, bits), Filters(languages, others)
    index = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for at, texts in pieces(batch.column("text").to_pylist()):
                hashes, owner = ngrams(texts)
                # once for each document, then one row per n-gram and language
                document = np.array(at)[owner]
                order = np.lexsort((document, hashes))
                hashes, document = hashes[order], document[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
                hashes, spoken = hashes[new], np.array([index[n] for n in names])[document[new]]
                pairs, n = np.unique(np.stack([hashes, spoken.astype(np.uint64)]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].astype(np.int32)), pa.array(n)],
                    ["hash", "language", "documents"],
                )

    found = sample.mapInArrow(count, "hash long, language int, documents long").groupBy("hash", "language").agg(
        F.sum("documents").alias("documents")
    )
    size = F.create_map(*[F.lit(x) for k in languages for x in (index[k], float(drawn[k]))])
    least = F.create_map(*[F.lit(x) for k in languages for x in (index[k], 1 if drawn[k] < FEW_DOCUMENTS else LEAST_DOCUMENTS)])
    rated = found.groupBy("hash").agg(
        F.collect_list(
            F.struct(
                "language",
                (F.col("documents") - least[F.col("language")]).alias("spare"),
                (F.col("documents") / size[F.col("language")]).alias("rate"),
            )
        ).alias("in")
    )
    most = F.array_max(F.transform("in", lambda x: x["rate"]))
    own = F.filter("in", lambda x: (x["spare"] >= 0) & (x["rate"] >= F.col("most") * LEAST_RATE))
    kept = rated.withColumn("most", most).select("hash", F.explode(own).alias("x"))
    language = F.col("x.language")
    entries = kept.select(
        F.explode(
            F.array(*[(F.shiftrightunsigned("hash", 21 * i).bitwiseAND(POSITIONS - 1)).cast("int") for i in range(HASHES)])
        ).alias("position"),
        F.expr(f"x.language div {SLICE}").cast("int").alias("slice"),
        F.pow(F.lit(2), language % SLICE).cast("long").alias("bit"),
        (F.col("x.spare") > 0).alias("spare"),
    )
    spare = F.bit_or(F.when(F.col("spare"), F.col("bit")).otherwise(0))
    for r in entries.groupBy("slice", "position").agg(F.bit_or("bit").alias("mask"), spare.alias("spare")).collect():
        bits[r["slice"], r["position"]] = r["mask"]
        others[r["slice"], r["position"]] = r["spare"]
    return Filters(languages, bits), Filters(languages, others)


def _scores(texts: list[str | None], filters: Filters, false: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the part of each text's n-grams that each language contains, how many it has)."""
    languages, bits = filters
    hits = np.zeros((len(texts), max(1, len(languages))))
    total = np.zeros(len(texts))
    for at, held in pieces(texts):
        hashes, owner = ngrams(held)
        document = np.array(at)[owner]
        total += np.bincount(document, minlength=len(texts))
        for s, plane in enumerate(bits):
            a, *others = positions(hashes)
            mask = plane[a]
            for p in others:
                mask &= plane[p]
            for i in range(s * SLICE, min(len(languages), (s + 1) * SLICE)):
                inside = (mask >> np.uint32(i % SLICE) & np.uint32(1)).astype(bool)
                hits[:, i] += np.bincount(document[inside], minlength=len(texts))
    expected = total[:, None] * false if languages else 0
    true = np.clip((hits - expected) / (1 - false if languages else 1), 0, None)
    return (true / np.maximum(total, 1)[:, None]).clip(0, 1), total


def reached(sample: DataFrame, others: Filters, ngrams: int) -> dict[str, float]:
    """The score that 99 in 100 of each language's sampled documents reach if they did not teach themselves.

    ``others`` are the second filters of :func:`fit`. Documents of fewer than ``ngrams`` n-grams don't
    count; a language that has no others gets 0. The driver gets a histogram of scores.
    """
    false = others.false_positives

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {name: i for i, name in enumerate(others.languages)}
        for batch in batches:
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                scores, total = _scores(part.column("text").to_pylist(), others, false)
                long = np.flatnonzero(total >= max(1, ngrams))
                mine = np.array([index[name] for name in part.column("lang").to_pylist()])[long]
                score = (scores[long, mine] * 1000).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(mine.astype(np.int32)), pa.array(score)], ["language", "score"])

    found: dict[str, list] = {name: [] for name in others.languages}
    for r in sample.mapInArrow(own, "language int, score int").groupBy("language", "score").count().collect():
        found[others.languages[r["language"]]].append((r["score"], r["count"]))
    lowest = {}
    for name, scores in found.items():
        below = sum(n for _, n in scores) // 100
        lowest[name] = 0.0
        for score, n in sorted(scores):
            lowest[name] = score / 1000
            below -= n
            if below < 0:
                break
    return lowest


def predict(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """All rows of ``docs`` as (record, lang_pred, score, ngrams); record is a struct of all columns.

    ``ngrams`` is how many n-grams the text has, and ``score`` the part of them that the language contains, from 0 to 1. A null
    text, and one without letters, gets ``und`` and 0; so does every text if no language was
    learned. Where languages are level, or the letters make no n-gram, the first in order of name wins.
    """
    languages = filters.languages
    false = filters.false_positives
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.col(text).alias("text"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                texts = part.column("text").to_pylist()
                scores, total = _scores(texts, filters, false)
                lettered = total > 0
                for i in np.flatnonzero(~lettered):  # too short for an n-gram, perhaps
                    lettered[i] = texts[i] is not None and any(map(str.isalpha, texts[i]))
                best = scores.argmax(axis=1)
                score = scores[np.arange(len(texts)), best]
                named = [languages[b] if languages and l else UNKNOWN for b, l in zip(best, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("record"), pa.array(named, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(total.astype(np.int64))],
                    ["record", "lang_pred", "score", "ngrams"],
                )

    result = StructType([rows.schema["record"]]).add("lang_pred", StringType()).add("score", DoubleType()).add("ngrams", LongType())
    return rows.mapInArrow(decide, result)


def held_out(doc_id: Column) -> Column:
    """True for the documents that nothing is learned from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
