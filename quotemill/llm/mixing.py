"""Operator 4, mixing sources to target weights, in DataFrame operations only.

The words of a source, document after document, are packed into blocks of fixed length.
The mix is a number of shards with equally many slots of one block each; every shard draws
its multinomial counts per source. A slot has an ordinal within its source, and a
pseudorandom permutation of the source's block indices maps it to a block: each block comes
once before any comes twice. Slots and blocks then join by index.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import keyed, running_sum, word_count

WEIGHTS = (5, 2, 1)
#: The range of the uniform draws is cut into so many cells, to find a draw's source by an equi-join.
CELLS = 1024
#: Rounds of the permutation of block indices.
ROUNDS = 12
#: Slots that a task makes.
TASK_SLOTS = 50_000
#: What stands between words.
_SPACE = " \t\n\x0b\x0c\r"


class Mix(NamedTuple):
    """``sources``: source_no, source, weight, source_size, blocks, target, slots.
    ``rows``: row, doc_id, source_no, size.
    ``spans``: shard, place (orders the slots of a shard), source_no, epoch, block, row, first_word, words:
    the words of each slot, one row per document they come from."""

    sources: DataFrame
    rows: DataFrame
    spans: DataFrame


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: int = 2, block_words: int = 64) -> DataFrame:
    """Targets in words of each source of ``sizes`` (source, size).

    Sources by code point, null last, get the weights in turn. They share ``share`` of all
    sizes by weight; a target stops at ``cap`` times its source's size, and the excess is
    shared again by weight until no target is above. That end is found without a loop: with a
    level L, each source gets min(cap * size, weight * L); for the sources that stop
    first in order of cap * size / weight, L is the largest (total - their caps) / (weights
    of the others).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    stopped = Window.orderBy("_ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    others = Window.orderBy("_ratio", "source_no").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * cap
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(stopped), F.lit(0))) / F.sum(
        "weight"
    ).over(others)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights)))
        .withColumn("blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}"))
        .withColumn("_ratio", limit / F.col("weight"))
        .withColumn("_level", level)
        .withColumn("target", F.least(limit.cast("double"), F.max("_level").over(everything) * F.col("weight")))
        .withColumn(
            "slots",
            F.when(F.col("blocks") == 0, 0)
            .otherwise(F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.col("blocks") * cap))
            .cast("long"),
        )
        .select("source_no", "source", "weight", "source_size", "blocks", "target", "slots")
    )


def permuted(index: str, size: str, key: str) -> Column:
    """The image of column ``index`` under a permutation of 0 .. ``size`` - 1 chosen by the columns ``key``.

    A swap-or-not shuffle: each round pairs the indices by reflection at a keyed point, and
    a keyed bit for each pair says whether its two members change places. Works for any size.
    """
    pair = f"pmod(xxhash64(2 * r, {key}) % {size} - x, {size})"
    swap = f"xxhash64(2 * r + 1, {key}, greatest(x, {pair})) & 1 = 1"
    return F.expr(f"aggregate(sequence(1, {ROUNDS}), {index}, (x, r) -> if({swap}, {pair}, x))")


def _drawn_slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(shard, source_no, ordinal) of every slot: the ordinals of a source run from 0 to its ``slots`` - 1.

    Each shard draws the source of each of its slots, with probabilities in proportion to
    the sources' slots: its counts are multinomial. Over all shards a source then has a few
    slots more or less than it should. The surplus ones go to sources that lack some.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        sources.where("slots > 0")
        .withColumn("lo", F.coalesce(F.sum("slots").over(before), F.lit(0)))
        .withColumn("hi", F.col("lo") + F.col("slots"))
        .withColumn("cell", F.explode(F.expr(f"sequence(lo * {CELLS} div {max(total, 1)}, (hi - 1) * {CELLS} div {max(total, 1)})")))
        .select("source_no", "lo", "hi", "cell")
    )
    draws = (
        spark.range(total)
        .select(F.expr(f"id div {shard_slots}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))).alias("u"))
        .withColumn("cell", F.expr(f"u * {CELLS} div {max(total, 1)}"))
    )
    counts = staged(
        draws.join(ranges, "cell").where("u >= lo and u < hi").groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("n")),
        "mix-counts",
    )
    # where a shard's slots of a source begin among all of them, summed in slices; then every task makes its share
    first = running_sum(counts, ["source_no"], ["shard"], F.col("n"), "first")
    drawn = (
        first.repartition(max(1, -(-total // TASK_SLOTS)), "shard", "source_no")
        .join(sources.select("source_no", "slots"), "source_no")
        .select("shard", "source_no", "slots", F.explode(F.expr("sequence(first, first + n - 1)")).alias("ordinal"))
    )
    # number all surplus ordinals, and likewise the missing ones, source after source
    balance = (
        sources.join(counts.groupBy("source_no").agg(F.sum("n").alias("n")), "source_no", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("surplus", F.greatest(F.col("n") - F.col("slots"), F.lit(0)))
        .withColumn("missing", F.greatest(F.col("slots") - F.col("n"), F.lit(0)))
        .withColumn("_surplus_lo", F.coalesce(F.sum("surplus").over(before), F.lit(0)))
        .withColumn("_missing_lo", F.coalesce(F.sum("missing").over(before), F.lit(0)))
    )
    spare = (
        drawn.where("ordinal >= slots")
        .join(balance.select("source_no", "_surplus_lo"), "source_no")
        .select("shard", (F.col("_surplus_lo") + F.col("ordinal") - F.col("slots")).alias("_place"))
    )
    wanted = (
        balance.where("missing > 0")
        .select("source_no", "n", "_missing_lo", F.explode(F.expr("sequence(0, missing - 1)")).alias("k"))
        .select("source_no", (F.col("n") + F.col("k")).alias("ordinal"), (F.col("_missing_lo") + F.col("k")).alias("_place"))
    )
    kept = drawn.where("ordinal < slots").select("shard", "source_no", "ordinal")
    return kept.unionByName(spare.join(wanted, "_place").select("shard", "source_no", "ordinal"))


def mix(
    rows: DataFrame,
    weights=WEIGHTS,
    share: float = 1.5,
    cap: int = 2,
    block_words: int = 64,
    shard_slots: int = 4096,
    seed: int = 0,
    ties: list[str] = ("row",),
) -> Mix:
    """Plan the mix of ``rows`` (row, doc_id, source, size in words; ``row`` tells all rows apart).

    Documents of a source come in the order of a hash of doc_id, equal ones by the columns ``ties``.

    A source's slots come to its target but for less than a block, and no document is taken
    more than ``cap`` times. Null sources are one source; a document without words is never
    taken. The same input gives the same mix.
    """
    sources = staged(source_targets(rows, weights, share, cap, block_words), "mix-sources")
    numbers = sources.select(F.col("source").alias("_source"), "source_no")
    rows = rows.join(numbers, F.col("source").eqNullSafe(F.col("_source"))).select(*dict.fromkeys(["row", "doc_id", "source_no", "size", *ties]))
    placed = running_sum(rows.where("size > 0"), ["source_no"], ["doc_id"], F.col("size"), "start", ties=list(ties))
    b = block_words
    pieces = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})"))).select(
        "source_no",
        "block",
        "row",
        F.expr(f"greatest(start, block * {b}) - start").alias("first_word"),
        F.expr(f"least(start + size, (block + 1) * {b}) - greatest(start, block * {b})").alias("words"),
    )
    slots = (
        _drawn_slots(sources, shard_slots, seed)
        .join(sources.select("source_no", "blocks"), "source_no")
        .withColumn("epoch", F.expr("ordinal div blocks"))
        .withColumn("block", permuted("ordinal % blocks", "blocks", f"{seed}, source_no, epoch"))
        .withColumn("place", F.xxhash64(F.lit(seed), "source_no", "ordinal"))
    )
    spans = slots.join(pieces, ["source_no", "block"]).select(
        "shard", "place", "source_no", "epoch", "block", "row", "first_word", "words"
    )
    return Mix(sources, rows, spans)


def runs(parts: Column) -> Column:
    """Stretches of words that follow each other as one, of ``parts`` (first_word, words) in ascending order."""
    none = F.array().cast("array<struct<first_word:bigint,words:bigint>>")

    def joined(found, part):
        last = F.element_at(found, -1)
        follows = F.coalesce(F.try_element_at(found, F.lit(-1))["first_word"] + F.try_element_at(found, F.lit(-1))["words"] == part["first_word"], F.lit(False))
        longer = F.struct(last["first_word"].alias("first_word"), (last["words"] + part["words"]).alias("words"))
        return F.when(follows, F.concat(F.slice(found, 1, F.size(found) - 1), F.array(longer))).otherwise(
            F.concat(found, F.array(F.struct(part["first_word"].alias("first_word"), part["words"].alias("words"))))
        )

    return F.aggregate(parts, none, joined)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The texts of the mix, with the columns of ``docs`` (doc_id, text and source among them).

    A row for each stretch of a document that the mix takes in one go, at most ``cap`` times the whole. Where
    that is all its words, the text is as it was. Else it is cut out of the text from the stretch's first
    word to its last, with the white space between as it was; n_chars (if there is such a column) is its
    length. Null, empty and blank texts are never taken. Columns may have any names.
    """
    rows = keyed(docs)
    words = word_count(F.col("record.text"))
    sizes = staged(
        rows.select("row", "record.doc_id", "record.source", words.alias("size"), F.xxhash64("record.text").alias("content")), "sizes"
    )
    taken = (
        mix(sizes, ties=["content", "row"], **how)
        .spans.groupBy("row", "epoch")
        .agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(F.struct("first_word", "words"))).alias("parts"))
        .join(sizes.select("row", "size"), "row")
        .select("row", F.when(F.col("taken") < F.col("size"), runs(F.col("parts"))).alias("runs"))
    )
    joined = rows.join(taken, "row")
    # every word with the white space after it, so that what is cut out is as it stands in the text
    words = F.regexp_extract_all("record.text", F.lit(r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"), F.lit(0))
    joined = joined.withColumn("words", F.when(F.col("runs").isNotNull(), words))
    cut = F.expr("transform(runs, r -> array_join(slice(words, int(r.first_word + 1), int(r.words)), ''))")
    cut = F.transform(cut, lambda text: F.rtrim(text, F.lit(_SPACE)))
    # the size asked for outside of the lambda keeps the optimizer from splitting the text once for each run
    texts = F.when(F.col("runs").isNull(), F.array("record.text")).when(F.size("words") > 0, cut)
    joined = joined.select("record", F.col("runs").isNull().alias("all"), F.explode(texts).alias("text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("all"), F.col("record.n_chars")).otherwise(F.length("text"))
    return joined.select(*[changed.get(c, F.col(f"record.`{c}`")).alias(c) for c in docs.columns])
