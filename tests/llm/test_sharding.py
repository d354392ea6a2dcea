import zlib
from collections import Counter

from llm_cases import DOCUMENTS, ODD
from pyspark.sql import functions as F
from quotemill.llm import sharding
from quotemill.llm.queries import QUERIES
from quotemill.llm.sharding import external_shuffle


def shuffled(spark, n, shards, **how):
    df = spark.range(n).withColumn("shard", F.lit("clash"))
    return external_shuffle(df, [F.col("id")], F.lit(10), shards, **how)


def test_rows_law_and_gapless_slots(spark, documents):
    rows = QUERIES["op1_sharding"](spark, documents(ODD + [(i, f"text {i}") for i in range(100, 200)])).collect()
    assert Counter((r.doc_id) for r in rows) == Counter(d for d, _ in ODD) + Counter(range(100, 200))
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].size == len(ODD[5][1].encode()) + 8
    assert by_id[6].text_crc32 == zlib.crc32(ODD[5][1].encode())
    assert (by_id[3].size, by_id[4].size) == (8, 8)


def test_more_shards_than_rows(spark, documents):
    rows = QUERIES["op1_sharding"](spark, documents([(1, "a"), (2, None)])).collect()
    assert len({r.shard for r in rows}) == 2 and {r.slot for r in rows} == {0}


def test_empty_table(spark, documents):
    assert QUERIES["op1_sharding"](spark, documents([], files=1)).collect() == []
    assert external_shuffle(spark.createDataFrame([], DOCUMENTS), [F.col("doc_id")], F.lit(1), 4).count() == 0


def test_same_result_however_the_input_is_split(spark):
    one = shuffled(spark, 1000, 7, seed=5).collect()
    df = spark.range(1000).repartition(13).withColumn("shard", F.lit("clash"))
    again = external_shuffle(df, [F.col("id")], F.lit(10), 7, seed=5).collect()
    assert sorted(one) == sorted(again)
    assert sorted(one) != sorted(shuffled(spark, 1000, 7, seed=6).collect())


def test_order_is_uniform(spark):
    """Correlation of place and id, and the number of neighbours kept, are those of a random order."""
    rows = shuffled(spark, 20_000, 1, bucket_bytes=1000).orderBy("slot").collect()
    ids = [r.record.id for r in rows]
    assert sorted(ids) == list(range(20_000))
    assert sum(b - a == 1 for a, b in zip(ids, ids[1:], strict=False)) < 10
    mean = sum(ids[:5000]) / 5000
    assert abs(mean - 10_000) < 5 * 20_000 / (12 * 5000) ** 0.5


def test_shards_hold_whole_documents(spark, documents, monkeypatch):
    written = []
    monkeypatch.setattr(sharding, "write_shards", lambda df, write=sharding.write_shards: written.append(write(df)) or written[-1])
    folder = documents([(i, f"text {i}", f"l{i % 3}", f"s{i % 5}") for i in range(100)] + ODD)
    rows = QUERIES["op1_sharding"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    shards = spark.read.parquet(*written).select("record.*").select(*docs.columns)
    assert len(rows) == docs.count() and Counter(shards.collect()) == Counter(docs.collect())
