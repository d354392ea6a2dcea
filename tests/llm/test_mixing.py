import re
from collections import Counter, defaultdict

import pytest
from llm_cases import ODD
from pyspark.sql import functions as F
from quotemill.llm import mixing
from quotemill.llm.queries import QUERIES

WEIGHTS = (5, 2, 1)


def targets_by_rounds(sizes, share=1.5, cap=2):
    """Share out, stop who is above, share out the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in stopped else weight[s] * level for s in names}
        stopped |= over


SIZES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 1000, "c": 3, None: 50},
    {"a": 0, "b": 10},
    {f"s{i}": (i * 37 % 11 + 1) * 1000 for i in range(23)},
    {"é": 5, "z": 7, "Z": 9, "𝄞": 100},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r for r in mixing.source_targets(df).collect()}
    want = targets_by_rounds(sizes)
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)
    assert all(r.slots <= 2 * r.blocks for r in got.values())


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n)).withColumn("k", F.lit(3))
    image = [r[0] for r in df.select(mixing.permuted("id", "n", "7, k")).collect()]
    assert sorted(image) == list(range(n))
    if n == 1000:
        assert sum(i == x for i, x in enumerate(image)) < 10
        assert image != [r[0] for r in df.select(mixing.permuted("id", "n", "8, k")).collect()]


def mixed(spark, n=300, **how):
    rows = [(i, i, f"s{i % 5}" if i % 3 else "hot", i * 7 % 90) for i in range(n)]
    df = spark.createDataFrame(rows, "row long, doc_id long, source string, size long")
    return rows, mixing.mix(df, block_words=16, shard_slots=64, **how)


def test_totals_are_exact_and_no_word_comes_more_than_twice(spark):
    rows, mix = mixed(spark)
    sources = {r.source_no: r for r in mix.sources.collect()}
    uses, slots, taken = Counter(), defaultdict(set), Counter()
    for s in mix.spans.collect():
        taken[s.source_no] += s.words
        slots[s.source_no].add((s.epoch, s.block))
        uses.update((s.row, w) for w in range(s.first_word, s.first_word + s.words))
    size = {r[0]: r[3] for r in rows}
    assert all(0 <= w < size[row] for row, w in uses) and max(uses.values()) <= 2
    for no, source in sources.items():
        assert len(slots[no]) == source.slots
        assert abs(taken[no] - source.target) <= 16
    # a block comes once before any comes twice
    for no, used in slots.items():
        firsts = {b for e, b in used if e == 0}
        assert all(b in firsts or sources[no].slots < sources[no].blocks for e, b in used if e == 1)


def test_shards_are_full_and_drawn(spark):
    _, mix = mixed(spark, n=900)
    per = Counter()
    for r in mix.spans.select("shard", "source_no", "epoch", "block").distinct().collect():
        per[r.shard, r.source_no] += 1
    full = Counter()
    for (shard, _), n in per.items():
        full[shard] += n
    assert all(full[s] == 64 for s in range(max(full)))
    hot = [per[s, 0] for s in range(max(full))]
    assert len(set(hot)) > 1  # drawn, not dealt out evenly


def test_same_seed_same_mix(spark):
    one, again, other = (mixed(spark, seed=s)[1].spans.collect() for s in (1, 1, 2))
    assert sorted(one) == sorted(again) != sorted(other)


def test_query_on_odd_rows(spark, documents):
    rows = [(*r, "en", s) for r, s in zip(ODD, [None, "a", "b", "a", None, "é", "a", "b", None, "a", "a", "c"], strict=True)]
    got = QUERIES["op4_mixing"](spark, documents(rows)).collect()
    assert len(got) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, count(t)) for d, t, *_ in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)


def test_empty_table(spark, documents):
    assert QUERIES["op4_mixing"](spark, documents([], files=1)).collect() == []


def test_mixed_documents_hold_the_words_taken(spark):
    texts = {i: " ".join(f"w{i}x{j}" for j in range(i * 13 % 200)) for i in range(40)}
    rows = [(i, t, f"s{i % 4}", len(t), "clash") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, size string")
    mix = mixing.mixed_documents(docs, block_words=16, shard_slots=64)
    assert mix.columns == docs.columns
    seen = Counter()
    for r in mix.collect():
        words = texts[r.doc_id].split()
        places = [words.index(w) for w in r.text.split()]
        assert places and places == sorted(places) and r.n_chars == len(r.text) and r["size"] == "clash"
        assert len(places) < len(words) or r.text == texts[r.doc_id]
        assert places == list(range(places[0], places[-1] + 1))
        seen.update((r.doc_id, p) for p in places)
    assert max(seen.values()) <= 2


def test_mixed_texts_are_cut_from_their_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TASK_SLOTS", 8)
    texts = {i: "  " + "".join(f"w{i}x{j}" + (" ", "\n\n", "\t ", " \x0b")[j % 4] for j in range(i * 13 % 300)) for i in range(60)}
    texts[60], texts[61], texts[62] = None, "", " \n "
    names = ["doc_id", "text", "source", "row", "record", "words", "_h", "_value", "all", "runs"]
    docs = spark.createDataFrame([(i, t, "hot" if i % 3 else "s", *"abcdefg") for i, t in texts.items()], names)
    mixed = mixing.mixed_documents(docs, block_words=16, shard_slots=64)
    assert mixed.columns == names
    rows = mixed.collect()
    assert rows and all(r.text in texts[r.doc_id] and (r.text == r.text.strip() or r.text == texts[r.doc_id]) for r in rows)
    assert any("\n\n" in r.text and r.text != texts[r.doc_id] for r in rows) and {tuple(r)[3:] for r in rows} == {tuple("abcdefg")}


def test_slots_are_made_in_many_tasks(spark, all_partitions, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "TASK_SLOTS", 500)
    docs = spark.range(4000).select(F.col("id").alias("row"), F.col("id").alias("doc_id"), F.lit("only").alias("source"), F.lit(200).alias("size"))
    sources = mixing.source_targets(docs)
    slots = mixing._drawn_slots(sources, 64, 0)
    slots.select("ordinal", F.spark_partition_id().alias("task")).write.parquet(f"{tmp_path}/slots")
    made = spark.read.parquet(f"{tmp_path}/slots")
    per = [r["count"] for r in made.groupBy("task").count().collect()]
    total = sources.first().slots
    assert sum(per) == total == made.select("ordinal").distinct().count() and max(per) < total / 10


def test_query_columns_of_sources(spark, documents):
    rows = [(i, "w " * (i % 50), "en", f"s{i % 4}" if i % 5 else None) for i in range(200)]
    got = QUERIES["op4_mixing"](spark, documents(rows)).collect()
    sizes = Counter()
    for i, t, _, s in rows:
        sizes[s] += len(t.split())
    want = targets_by_rounds(dict(sizes))
    source = {i: s for i, _, _, s in rows}
    assert all(r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]]) for r in got)


def test_copies_of_one_doc_id_share_by_their_texts(spark, documents):
    rows = [(i % 40, f"word{i} " * (20 + i), "en", "ab"[i % 2]) for i in range(120)]
    taken = []
    for files in (1, 5):
        got = QUERIES["op4_mixing"](spark, documents(rows, files=files, name=f"f{files}")).collect()
        taken.append(Counter((r.doc_id, r["size"], r.taken) for r in got))
    assert taken[0] == taken[1]
