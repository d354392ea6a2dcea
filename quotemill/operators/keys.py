"""Operators by key: last row wins, existence, lookup, concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def last_wins(df: DataFrame, key: str | list[str], order: str | Column) -> DataFrame:
    """One whole row per key: the one greatest in ``order``.

    An aggregate, not a window: each task reduces its rows to one per key before
    the shuffle, so a key with a third of all rows costs no more than others.
    """
    keys = _names(key)
    rest = [c for c in df.columns if c not in keys]
    order = F.col(order) if isinstance(order, str) else order
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("row"))
        .select(*[F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns])
    )


def key_count(df: DataFrame, key: str | list[str]) -> DataFrame:
    """The number of different keys."""
    return df.select(*_names(key)).distinct().agg(F.count(F.lit(1)).alias("n"))


def distinct_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """The different keys, grouped as a struct.

    Grouped by the bare columns, they would be partitioned as a following join
    wants them, and the join would read the aggregate without a shuffle of its
    own. AQE splits hot keys of the other side only where both sides are shuffled.
    """
    keys = _names(key)
    return df.select(F.struct(*keys).alias("key")).distinct().select("key.*")


def _by_existence(
    wanted: DataFrame, existing: DataFrame, key: str | list[str], how: str
) -> DataFrame:
    keys = _names(key)
    existing = distinct_keys(
        existing.select(*[F.col(k).alias(f"existing_{k}") for k in keys]),
        [f"existing_{k}" for k in keys],
    )
    same = [F.col(k) == F.col(f"existing_{k}") for k in keys]
    return wanted.join(existing, reduce(Column.__and__, same), how)


def missing(wanted: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``wanted`` whose key does not occur in ``existing``; a NULL key never occurs.

    ``existing`` is reduced to its keys before it is shuffled. AQE broadcasts them
    if they turn out small, and splits hot keys of ``wanted`` if not.
    """
    return _by_existence(wanted, existing, key, "left_anti")


def present(wanted: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``wanted`` whose key occurs in ``existing``."""
    return _by_existence(wanted, existing, key, "left_semi")


def title_has(col: Column, marker: str) -> Column:
    """Literal substring test; ``_`` in a marker is no wildcard."""
    return F.contains(col, F.lit(marker))


def containing(catalog: DataFrame, needles: list[str], col: str = "title") -> DataFrame:
    """Rows of ``catalog`` whose ``col`` contains any of the given ``needles``: a pushed-down filter."""
    return catalog.where(reduce(Column.__or__, [title_has(F.col(col), n) for n in needles], F.lit(False)))


def matching(catalog: DataFrame, needles: DataFrame, col: str = "title", piece: int = 8) -> DataFrame:
    """Rows of ``catalog`` whose ``col`` contains any value of the one-column ``needles``.

    An index of pieces: each needle is entered by one piece of ``piece`` characters, the rarest of its
    own in the titles; a shorter needle is its own piece. The different titles are cut into their pieces of
    that length (and of those of shorter needles, if there are any), of which only those of needles are
    kept. Titles and needles that meet by an equi-join on the piece are then tested as a whole.
    A title of n characters makes n pieces, however many lengths the needles have. For a few
    needles that are known, see ``containing``.

    NULLs match nothing, an empty needle every title.
    """
    if piece < 1:
        raise ValueError(f"pieces of {piece} characters")
    name = needles.columns[0]
    needles = needles.select(F.col(name).alias("needle")).where("needle is not null").distinct()
    size = F.least(F.char_length("needle"), F.lit(piece))
    sizes = sorted(r.n for r in needles.select(size.alias("n")).distinct().collect())  # ``piece`` + 1 at most
    if not sizes:
        return catalog.where(F.lit(False))
    if sizes[0] == 0:
        return catalog.where(F.col(col).isNotNull())

    entries = needles.select("needle", _pieces(F.col("needle"), size, sizes))
    known = distinct_keys(entries.select(F.col("piece").alias("known")), "known")
    # A hash stands for a title until it is tested; titles of one hash are tested for each other's needles too.
    titles = catalog.select(F.col(col).alias("title")).where("title is not null").distinct()
    titles = titles.select("title", F.xxhash64("title").alias("id"))
    found = titles.select("id", _pieces(F.col("title"), None, sizes))
    found = found.join(known, found["piece"] == known["known"], "left_semi")

    counts = found.groupBy(F.col("piece").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    # an inner join: a needle that is in a title has all its pieces counted
    rarest = entries.join(counts, entries["piece"] == counts["of"]).groupBy("needle")
    rarest = rarest.agg(F.min_by("piece", F.struct("n", "piece")).alias("rarest"))

    meet = found.join(rarest, found["piece"] == rarest["rarest"]).select("id", "needle")
    hits = meet.join(titles, "id").where(F.contains("title", "needle"))
    hits = distinct_keys(hits.select(F.col("title").alias("hit")), "hit")
    return catalog.join(hits, catalog[col] == hits["hit"], "left_semi")


def _pieces(text: Column, size: Column | None, sizes: list[int]) -> Column:
    """A row ``piece`` for each different piece of ``text``, of ``size`` or else of all ``sizes`` characters.

    One pass over the text for each size: ``substr`` would count characters from the start for each piece.
    """

    def of(n):
        pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))
        return pieces if size is None else F.when(size == n, pieces).otherwise(F.array().cast("array<string>"))

    return F.explode(F.array_distinct(F.concat(*map(of, sizes)))).alias("piece")


def lookup(df: DataFrame, master: DataFrame, on: str = "code", how: str = "inner") -> DataFrame:
    """Rows of ``df`` with the columns of the one ``master`` row of the same code.

    No broadcast hint: AQE decides by the master's real size, and splits hot
    codes where it has to shuffle both sides. So hand over a stored master, not the
    aggregate that makes it.
    """
    return df.join(master, on, how)


def union_lists(*dfs: DataFrame) -> DataFrame:
    """All rows of all lists, duplicates included."""
    return reduce(DataFrame.unionByName, dfs)
