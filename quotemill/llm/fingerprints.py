"""Operator 5, document fingerprints, in DataFrame operations only: a Merkle tree for each text.

Leaves are pieces of paragraphs: a paragraph ends at a line feed, a piece at the end of a
sentence or after PIECE characters. Runs of leaves make sections, whose ends depend on the
leaves alone, so that an edit changes the sections around it and no others. The root is the
hash of the sections. Equal roots mean equal texts; else the sections, and in them the
leaves, that only one of the two trees has, locate the edits.

A fingerprint is a string: the root, then for each section its hash and its leaves,

    root|section:leaf leaf leaf|section:leaf leaf
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a piece without an end of sentence or line, at most.
PIECE = 48
#: Hexadecimal digits kept of a leaf's hash and of a section's; the root, which tells texts apart, has all 64.
LEAF, SECTION = 8, 12
#: A section ends at a leaf whose last digit is 0, so after 16 leaves on average, or after so many.
LONGEST_SECTION = 64
#: Ranges of doc_ids whose bounds the driver holds, at most, and characters of a text in a bound.
QUANTILES, HEAD = 1024, 64

_PIECES = rf"[^.!?\n]{{1,{PIECE}}}[.!?\n]?|[.!?\n]"
_DIGITS = "[0-9a-f]"
_SECTIONS = (
    rf"(?:{_DIGITS}{{{LEAF - 1}}}[1-9a-f] ){{0,{LONGEST_SECTION - 1}}}{_DIGITS}{{{LEAF}}} "
)


def pieces(text: Column) -> Column:
    """The text cut into leaves, whose texts one after the other are the text; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_PIECES), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The tree of ``text`` as a string; a null text has that of an empty one."""
    leaves = F.array_join(F.transform(pieces(text), lambda x: F.substring(F.sha2(x, 256), 1, LEAF)), " ")
    sections = F.regexp_extract_all(F.concat(leaves, F.lit(" ")), F.lit(_SECTIONS), F.lit(0))
    named = F.transform(sections, lambda s: F.concat(F.substring(F.sha2(s, 256), 1, SECTION), F.lit(":"), F.rtrim(s)))
    # the root is a hash of the text's own bytes along with the tree: cut hashes alone may collide
    root = F.sha2(F.concat(F.sha2(F.coalesce(text, F.lit("")), 256), F.array_join(named, "|")), 256)
    return F.concat_ws("|", root, F.array_join(named, "|"))


def sections_of(tree: Column) -> Column:
    """array of section texts ``hash:leaf leaf`` of a fingerprint."""
    return F.filter(F.slice(F.split(tree, r"\|"), 2, 1 << 30), lambda s: s != "")


def leaves_of(tree: Column) -> Column:
    """The leaves of a fingerprint, in order."""
    return F.regexp_extract_all(tree, F.lit(rf"(?<=[: ]){_DIGITS}{{{LEAF}}}(?= |\||$)"), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: twice the different leaves that two fingerprints share, by the different leaves of both.

    1 for equal roots, null if one of them is null.
    """
    one, other = F.array_distinct(leaves_of(a)), F.array_distinct(leaves_of(b))
    shared = F.size(F.array_intersect(one, other))
    return F.when(a == b, F.lit(1.0)).otherwise(2.0 * shared / F.greatest(F.size(one) + F.size(other), F.lit(1)))


def differing(a: Column, b: Column) -> Column:
    """array<struct<section int, leaf int>>: the branches of ``a`` that ``b`` lacks, from 0; empty for equal roots.

    ``leaf`` is its place in the section. Sections that both trees have are not looked into.
    """
    hashes = F.transform(sections_of(b), lambda s: F.substring_index(s, ":", 1))
    known = leaves_of(b)
    changed = F.transform(
        sections_of(a),
        lambda s, i: F.when(
            ~F.array_contains(hashes, F.substring_index(s, ":", 1)),
            F.filter(
                F.transform(
                    F.split(F.substring_index(s, ":", -1), " "),
                    lambda leaf, j: F.when(~F.array_contains(known, leaf), F.struct(i.alias("section"), j.alias("leaf"))),
                ),
                lambda x: x.isNotNull(),
            ),
        ),
    )
    none = F.array().cast("array<struct<section:int,leaf:int>>")
    return F.when(a == b, none).otherwise(F.flatten(F.filter(changed, lambda x: x.isNotNull())))


def _parted(docs: DataFrame, part_rows: int) -> DataFrame:
    """(doc_id, text, range, part): ``docs`` in about ``part_rows`` rows to a part, in the order of ``with_next``.

    QUANTILES ranges at most, of about as many rows each, come from a range partitioning of the ids and HEAD first
    characters; a range of more rows is cut by the width of its ids. No id, also null, is too frequent for that
    unless its texts begin alike.
    """
    text = F.coalesce("text", F.lit(""))
    order = {"last": F.col("doc_id").isNull(), "down": F.bitwise_not(F.col("doc_id").cast("long")), "head": F.left(text, F.lit(HEAD))}
    key = F.struct(*[value.alias(name) for name, value in order.items()])
    n = docs.count()
    ranges = max(1, min(QUANTILES, -(-n // part_rows)))
    cuts = -(-n // (ranges * part_rows)) or 1
    firsts = (
        docs.select(key.alias("key")).select("key.*").repartitionByRange(ranges, *order)
        .groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("first"))
    )
    bounds = [r.first.asDict() for r in firsts.select("first").collect()]  # QUANTILES at most, or what Spark makes of it
    bounds.sort(key=lambda b: (b["last"], b["down"] or 0, b["head"].encode()))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    # a literal: the JSON is read once, by the optimizer
    bounds = F.from_json(F.lit(json.dumps(bounds)), "array<struct<last:boolean,down:bigint,head:string>>")
    # binary search for the last range that starts at the key or before
    place = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step) <= F.col("key"), at + step).otherwise(at)
    )
    placed = docs.select("doc_id", text.alias("text"), key.alias("key")).withColumn("range", place)
    down = F.col("key.down").cast("double")
    start, end = (F.get(bounds, F.col("range") + i)["down"].cast("double") for i in (0, 1))
    # null where the range ends in null ids, which are not cut, or is the last one, of which only its first cut is certain
    share = F.least(F.greatest((down - start) / (end - start + 1.0), F.lit(0.0)), F.lit(1.0))
    cut = F.when(F.col("key.last"), cuts - 1).otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * cuts), F.lit(cuts - 1)))
    return placed.select("doc_id", "text", "range", (F.col("range") * F.lit(cuts).cast("long") + cut).alias("part"))


def with_next(docs: DataFrame, part_rows: int = 1024) -> DataFrame:
    """(doc_id, text, next_text) of each row of ``docs``: also the text of the next smaller doc_id.

    After the smallest doc_id comes the largest. Null doc_ids come after all others; rows with
    equal ones stand in the order of the first HEAD characters of their texts, then of the rest as far
    as one part holds them, and a null text is an empty one. The rows are cut into parts of about
    ``part_rows``, each part is sorted by itself, and the last row of a part gets the first text of the part
    that follows.
    """
    rows = _parted(docs, part_rows)
    down = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), "text")
    ordered = rows.select("*", F.lead("text").over(down).alias("following"), F.row_number().over(down).alias("place"))
    tops = ordered.where("place = 1").select(F.col("part").alias("after"), F.col("text").alias("top"))
    parts = rows.select("range", "part").distinct()
    ranges = parts.groupBy("range").agg(F.min("part").alias("part"))
    every = Window.orderBy("range")  # of QUANTILES rows at most
    first_of_all = F.first("part").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranges = ranges.select(F.col("range").alias("of"), F.coalesce(F.lead("part").over(every), first_of_all).alias("later"))
    within = F.lead("part").over(Window.partitionBy("range").orderBy("part"))
    parts = parts.select("range", F.col("part").alias("at"), within.alias("after"))
    parts = parts.join(ranges, F.col("range") == F.col("of")).select("at", F.coalesce("after", "later").alias("after"))
    edges = parts.join(tops, "after").select("at", "top")
    return ordered.join(edges, F.col("part") == F.col("at")).select(
        "doc_id", "text", F.coalesce("following", "top").alias("next_text")
    )
