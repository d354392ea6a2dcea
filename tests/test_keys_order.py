import random

import pytest
from pyspark.sql import functions as F

from quotemill.operators import keys, order


def column(df, name=None):
    return sorted(r[0] for r in (df.select(name) if name else df).collect())


def ids(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_missing_and_present(spark):
    wanted, existing = ids(spark, ["a", "b", "b", None]), ids(spark, ["b", "c", "b"])
    rows = lambda df: sorted((r.k for r in df.collect()), key=str)
    assert rows(keys.missing(wanted, existing, "k")) == [None, "a"]
    assert rows(keys.present(wanted, existing, "k")) == ["b", "b"]
    assert rows(keys.missing(wanted, ids(spark, [None]), "k")) == [None, "a", "b", "b"]
    assert rows(keys.present(wanted, ids(spark, [None]), "k")) == []
    assert rows(keys.missing(wanted, wanted.where("k = 'a'"), "k")) == [None, "b", "b"]


def test_lookup_count_union(spark):
    facts, master = ids(spark, ["1", "1", "2", "9"], "code"), ids(spark, ["1", "2"], "code")
    master = master.withColumn("name", F.concat(F.lit("n"), "code"))
    assert column(keys.lookup(facts, master), "name") == ["n1", "n1", "n2"]
    assert keys.lookup(facts, master, how="left").count() == 4
    assert keys.key_count(facts, "code").first().n == 3
    assert column(keys.union_lists(facts, facts, master.select("code"))).count("1") == 5


def test_matching_is_literal(spark):
    titles = ids(spark, ["a_b.zip", "axb.zip", "x%y", "a_b", None], "title")
    given = lambda *n: column(keys.containing(titles, [x for x in n if x is not None]))
    joined = lambda *n: column(keys.matching(titles, ids(spark, n)))

    def hits(*needles):
        assert given(*needles) == joined(*needles)
        return given(*needles)

    assert hits("a_b") == ["a_b", "a_b.zip"]
    assert hits("%") == ["x%y"]
    assert hits("b.zip", "x%") == ["a_b.zip", "axb.zip", "x%y"]
    assert hits() == [] and hits(None) == []
    assert len(hits("")) == 4


@pytest.mark.parametrize("n_needles", [10, 500])
def test_matching_against_brute_force(spark, n_needles):
    rng = random.Random(n_needles)
    word = lambda lo, hi: "".join(rng.choice("abc_%台") for _ in range(rng.randint(lo, hi)))
    titles = [word(0, 12) for _ in range(2000)] + ["aaaaaaaaaaaa"] * 1000
    needles = [word(3, 7) for _ in range(n_needles)]
    expect = sorted(t for t in titles if any(n in t for n in needles))
    assert column(keys.matching(ids(spark, titles, "title"), ids(spark, needles))) == expect


@pytest.mark.parametrize("piece", [1, 3, 8, 40])
def test_matching_long_and_short_needles(spark, piece):
    """Needles beside each other that share most of their pieces, and some that are not in the titles."""
    rng = random.Random(piece)
    word = lambda lo, hi: "".join(rng.choice("ab𝄞台\n") for _ in range(rng.randint(lo, hi)))
    titles = [word(0, 60) for _ in range(600)] + ["a" * 30] * 300
    cut = lambda t, n: t[(i := rng.randint(0, len(t))) : i + n]
    needles = [cut(rng.choice(titles), rng.randint(6, 30)) + rng.choice(["", "", "b"]) for _ in range(150)]
    needles = [n for n in needles if len(n) > 5] + ["台𝄞台𝄞b", "?", "z" * 50]
    expect = sorted(t for t in titles if any(n in t for n in needles))
    got = keys.matching(ids(spark, titles, "title"), ids(spark, needles), piece=piece)
    assert column(got) == expect and 0 < len(expect) < len(titles)


def test_matching_in_very_long_texts(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh台") for _ in range(100_000)) for _ in range(4)]
    needles = [texts[0][50_000:50_040], texts[1][-25:], texts[2][:11] + "z", "no" * 10, texts[3][99_000:99_009] + "#"]
    got = keys.matching(ids(spark, texts + ["short", None], "title"), ids(spark, needles))
    assert column(got) == sorted(texts[:2])


def test_matching_many_titles_of_one_piece(spark):
    """A piece that all titles and needles have is not what they meet by."""
    titles = [f"集保_{i:07d}.zip" for i in range(3000)]
    needles = [f"集保_{i:07d}.zip" for i in range(0, 6000, 100)]
    assert keys.matching(ids(spark, titles, "title"), ids(spark, needles)).count() == 30


def test_many_needles_with_an_empty_one(spark):
    needles = [f"n{i:03d}" for i in range(100)] + [""]
    assert keys.matching(ids(spark, ["x", "", None], "title"), ids(spark, needles)).count() == 2


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 16])
def test_carry_down(spark, block):
    rng = random.Random(block)
    rows, expect = [], []
    for part in ["hot", "b", None]:
        last = ""
        for pos in range(600 if part == "hot" else 40):
            head = f"h{pos}" if rng.random() < 0.05 else None
            last = head or last
            rows.append((part, pos, head))
            expect.append((part, pos, head, last))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "part string, pos bigint, head string")
    got = order.carry_down(df, "head", "part", "pos", "type", block)
    assert got.columns == ["part", "pos", "head", "type"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expect, key=str)


def test_row_index_is_the_sorted_position(spark):
    df = spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("v")
    )
    got = order.with_row_index(df.repartition(13), F.col("v").desc(), "id").collect()
    expect = sorted(((r.v, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.row_index)] == expect
    assert sorted(r.row_index for r in got) == list(range(20_000))


def test_row_index_of_nothing(spark):
    assert order.with_row_index(spark.range(0), "id").count() == 0


def test_a_shared_sort_value_is_split(spark, all_partitions):
    rows = order.with_row_index(spark.range(50_000).withColumn("v", F.lit(1)), "v", "id")
    files = rows.select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(files) > 4 and max(r["count"] for r in files) < 25_000


def test_capital_order_and_first_row(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 5)], "stock string, v int")
    assert [r.stock for r in order.by_capital(df, "v").collect()] == ["d", "a", "b", "c"]
    assert [r.stock for r in order.top_n(df, F.col("v").desc_nulls_last(), "stock").collect()] == [
        "d", "a", "b",
    ]
    assert [r.stock for r in order.first_row(df, "stock").collect()] == ["a"]
    assert order.first_row(df.where("v > 9"), "stock").count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10).withColumn("v", F.col("id").cast("string"))
    assert "TakeOrderedAndProject" in plan(order.top_n(df, "v"))
    text = plan(keys.last_wins(df, "k", "id"))
    assert "partial_max_by" in text and "Window" not in text
    indexed = plan(order.with_row_index(df, "v", "id"))
    assert "Window" not in indexed and "Exchange" not in indexed
    carried = plan(order.carry_down(df, "v", "k", "id", "c"))
    assert "SinglePartition" not in carried


def final_plan(df):
    df = df.withColumn("ran", F.lit(1))
    df.tail(1)
    return plan(df)


@pytest.mark.parametrize("join", [keys.missing, keys.present])
def test_hot_keys_of_both_sides(spark, tmp_path, skewed_joins, join):
    """A third of the rows on each side has one key: the left is split, the right reduced first."""
    hot = lambda n, key: F.when(F.col("id") % 3 == 0, key).otherwise(F.col("id") % n)
    spark.range(900_000).select(hot(50_000, 70_000).alias("k"), "id").repartition(8).write.parquet(
        str(tmp_path / "w")
    )
    spark.range(300_000).select(hot(25_000, 80_000).alias("k")).repartition(8).write.parquet(
        str(tmp_path / "e")
    )
    wanted, existing = spark.read.parquet(str(tmp_path / "w")), spark.read.parquet(str(tmp_path / "e"))
    result = join(wanted, existing, "k")
    text = final_plan(result).split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in text
    n = wanted.where("k < 25000").count()
    assert result.count() == (n if join is keys.present else 900_000 - n)


def test_hot_codes_in_a_lookup(spark, tmp_path, skewed_joins):
    spark.range(900_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50_000).alias("code"), "id"
    ).repartition(8).write.parquet(str(tmp_path / "f"))
    spark.range(60_000).select(F.col("id").alias("code"), (F.col("id") * 2).alias("v")).write.parquet(
        str(tmp_path / "m")
    )
    facts, stored = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "m"))
    result = keys.lookup(facts, stored)
    assert "SortMergeJoin(skew=true)" in final_plan(result)
    assert result.where("v = code * 2").count() == 900_000


def test_carry_down_shuffles_rows_by_block(spark, skewed_joins):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id", F.col("id").cast("string").alias("v"))
    text = final_plan(order.carry_down(df, "v", "k", "id", "c", 100)).split("Initial Plan")[0]
    rows = [line for line in text.splitlines() if "Exchange" in line]
    # rows, their summary, the blocks' starts; only the summary goes by part alone
    assert len(rows) == 3 and sum("block" in line for line in rows) == 2
