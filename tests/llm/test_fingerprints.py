import hashlib

from llm_cases import ODD
from pyspark.sql import functions as F
from quotemill.llm import fingerprints as fp
from quotemill.llm.queries import QUERIES


def tree(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[1] for r in df.select("i", fp.fingerprint(F.col("text"))).orderBy("i").collect()]


LONG = "\n".join(" ".join(f"Word{i * j % 97} and number {j}." for j in range(12)) for i in range(40))


def expected(rows):
    """What the query has to return of doc_id, n_chars and edited text, by id and text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        out.append((doc_id, len(text), hashlib.sha256((text[: len(text) - k] + other[:k]).encode()).hexdigest()))
    return out


def test_query_against_plain_python(spark, documents):
    rows = ODD + [(i * 10**9, LONG[i : i * 50]) for i in range(20, 40)] + [(-5, "below zero")]
    got = QUERIES["op5_fingerprints"](spark, documents(rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(expected(rows), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(prints) == 1 and len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1
    long = [r for r in got if (r.doc_id or 0) >= 10**9]
    assert all(0.4 < r.near_edited < 0.95 for r in long)


def test_dense_ids_in_many_parts(spark):
    rows = [(i, f"text {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in fp.with_next(df, part_rows=7).collect()}
    assert got == {i: f"text {(i - 1) % 100}" for i in range(100)}


def test_parts_hold_equal_numbers_of_rows(spark, monkeypatch):
    """One id far from all others, a third of the ids null; also where ranges are cut further."""
    rows = [(10**15, "far"), (-(2**63), "least")]
    rows += [(i, f"text {i}") for i in range(4000)] + [(None, f"{i * 7919 % 2003:04d} null") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expect = sorted((t, order[(i + 1) % len(order)][1]) for i, (_, t) in enumerate(order))
    for quantiles in (4096, 48):
        monkeypatch.setattr(fp, "QUANTILES", quantiles)
        parted = fp._parted(df, 32)
        sizes = [r["count"] for r in parted.groupBy("part").count().collect()]
        assert len(sizes) > 40 and max(sizes) < len(rows) / 20
        assert sorted((r.text, r.next_text) for r in fp.with_next(df, 32).collect()) == expect


def test_one_row_and_no_row(spark, documents):
    (row,) = QUERIES["op5_fingerprints"](spark, documents([(3, "abcdef")], files=1)).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1
    assert QUERIES["op5_fingerprints"](spark, documents([], files=1, name="none")).collect() == []


def test_pieces_cover_the_text(spark):
    texts = [t or "" for _, t in ODD] + [LONG, "a..b!?\n\n", "𝄞" * 500, "\r\n \t"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fp.pieces(F.col("text")).alias("p"))
    for r in df.collect():
        assert "".join(r.p) == r.text and all(r.p)


def test_edits_change_their_branches_only(spark):
    changed = LONG.replace("number 7.", "number seven.", 1)
    a, b = tree(spark, LONG, changed)
    df = spark.createDataFrame([(a, b)], "a string, b string")
    forth, back, alike, same = df.select(
        fp.differing(F.col("a"), F.col("b")),
        fp.differing(F.col("b"), F.col("a")),
        fp.likeness(F.col("a"), F.col("b")),
        fp.differing(F.col("a"), F.col("a")),
    ).first()
    assert len(back) == 1 and len(forth) <= 1 and 0.98 < alike < 1 and same == []
    sections = [s.split(":")[0] for s in a.split("|")[1:]]
    others = [s.split(":")[0] for s in b.split("|")[1:]]
    assert len(sections) > 10 and len(set(sections) - set(others)) <= 2


def test_equal_roots_are_equal_texts(spark):
    prints = tree(spark, "a. b.", "a.b.", " a. b.", "a. b", "", None, "a. b.")
    assert prints[0] == prints[6] and prints[4] == prints[5] and len(set(prints)) == 5


def test_very_long_text(spark):
    text = "no end of sentence " * 100_000
    (a,) = tree(spark, text)
    assert max(len(s.split(" ")) for s in a.split("|")[1:]) <= fp.LONGEST_SECTION
