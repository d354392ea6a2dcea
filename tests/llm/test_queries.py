"""Every query that SQL can express, against that SQL; and the pipeline against plain Python."""

import math
import re
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from llm_cases import ODD
from quotemill.llm.queries import ORACLES, QUERIES


def test_one_query_an_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf_dir).collect()]
    assert got and Counter(got) == Counter(want.fetchall())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def run(spark, folder):
    """The rows after each stage."""
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{i}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        kept[name] = docs.collect()
    return kept


def near_groups(rows):
    """Groups of equal or similar texts, by comparing all pairs."""
    sets = {}
    for r in rows:
        w = words(r.text.lower())
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    group = {d: d for d in sets}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {d: root(d) for d in sets}


def test_pipeline_on_the_given_documents(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    junk = [(10**6, "12 34 --", "en", "src0"), (10**6 + 1, "", "en", None), (10**6 + 2, None, None, None)]
    kept = run(spark, documents(rows + junk))
    clean = {r[0] for r in rows}
    named = {r.doc_id for r in kept["language_id"]}
    assert named == clean
    groups = near_groups(kept["language_id"])
    assert sorted(r.doc_id for r in kept["near_dedup"]) == sorted(set(groups.values()))
    size = {r.doc_id: len(words(r.text)) for r in kept["near_dedup"]}
    taken = Counter()
    for r in kept["mixing"]:
        taken[r.doc_id] += len(words(r.text))
    assert all(0 < n <= 2 * size[d] for d, n in taken.items())
    assert math.isclose(sum(taken.values()), 1.5 * sum(size.values()), rel_tol=0.01)
    assert Counter((r.doc_id, r.text) for r in kept["packing"]) == Counter((r.doc_id, r.text) for r in kept["mixing"])
    assert all(r.length == len(words(r.text)) <= r.padded_length for r in kept["packing"])


def test_pipeline_on_odd_rows_and_none(spark, documents):
    taught = [(i, "a word, not only this word") for i in range(20, 26)]
    kept = run(spark, documents([(*r, "en" if r[1] else None, None) for r in ODD + taught]))
    assert sum(r.text == "same row" for r in kept["near_dedup"]) == 1
    assert {r.doc_id for r in kept["near_dedup"]} == {None, 1, 6, 7, 9, 10, 20}
    assert corpus_pipeline.run(spark, documents([], files=1, name="none")).collect() == []
