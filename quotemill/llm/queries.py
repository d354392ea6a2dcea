"""The registered queries of this package: thin uses of its operators on whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from . import (
    fingerprints,
    hard_negatives,
    language_id,
    mixing,
    near_dedup,
    nearest,
    packing,
    preferences,
    sharding,
    simhash,
    token_files,
    vector_codes,
    warc,
)
from .common import table, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_sharding(spark, sf):
    """All documents in 24 shards, written and read back; ``rows`` is the law that holds."""
    docs = table(spark, sf, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    place = F.col("_metadata.row_index")  # tells repeated rows of a file apart
    keyed = docs.select("*", place.alias("row"))
    shuffled = sharding.external_shuffle(keyed, [F.col("doc_id"), F.col("row")], size, shards=24, seed=1)
    shards = spark.read.schema(shuffled.schema).parquet(sharding.write_shards(shuffled))
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shards.select(
        "record.doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op4_mixing(spark, sf):
    """The words that the mix takes of each document."""
    docs = table(spark, sf, "documents")
    text = F.xxhash64("text").alias("content")
    sizes = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"), text)
    sources, rows, spans = mixing.mix(staged(sizes, "sizes"), ties=["content", "row"])
    taken = spans.groupBy("row").agg(F.sum("words").alias("taken"))
    return (
        rows.join(sources.select("source_no", "source_size", "target"), "source_no")
        .join(taken, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


@query()
def op8_packing(spark, sf):
    """All documents in token-budget batches, a token being a word."""
    docs = table(spark, sf, "documents")
    lengths = staged(docs.select("doc_id", word_count(F.col("text")).alias("length"), F.monotonically_increasing_id().alias("row")), "lengths")
    return packing.pack(lengths, "length", ["doc_id"], ties=["row"]).drop("row")


@query(
    r"""
with recursive
words as (
  select doc_id, list_filter(
    string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
    join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached as (
  select doc_id as start, doc_id as node from documents
  union
  select r.start, l.b from reached r join links l on l.a = r.node)
select d.doc_id, coalesce(max(s.n), 0)::bigint as n_shingles, min(r.node) as component_id, d.doc_id = min(r.node) as kept
from documents d join reached r on r.start = d.doc_id left join sizes s on s.doc_id = d.doc_id
group by d.doc_id
"""
)
def op7_near_dedup(spark, sf):
    """Components of the documents that share 85 in 100 of their 5-word shingles."""
    documents, groups = near_dedup.near_duplicates(table(spark, sf, "documents"), words=5, percent=85)
    component = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return documents.join(groups, "group", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


@query()
def op6_language_id(spark, sf):
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    filters = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.predict(docs.select("doc_id", "text"), filters).select(
        "record.doc_id", language_id.held_out(F.col("record.doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query()
def op10_token_files(spark, sf):
    """The ids of all documents, as the library's plain call gives them, written in ascending doc_id order and read back."""
    path = token_files.write(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0, special=True)
    return token_files.read(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4", copy=False)))


@query(
    """
with p as (select page_id, coalesce(html, '') as html from pages),
f as (select html, min(page_id) as first from p where octet_length(encode(html)) >= 100 group by html)
select page_id, octet_length(encode(p.html)) as payload_bytes, sha256(p.html) as payload_digest,
       case when f.first is null or f.first = page_id then 'response' else 'revisit' end as record_type,
       case when f.first <> page_id then f.first end as refers_to
from p left join f using (html)
"""
)
def op9_warc(spark, sf):
    """All pages written to archives and read back; a revisit has the payload of the record it refers to."""
    path = warc.write(table(spark, sf, "pages"))
    found = staged(warc.read(spark, path, payloads=False), "records")
    sound = found.where("defect is null")
    responses = sound.where("type = 'response'").select("id", "payload_bytes", "payload_digest")
    revisits = sound.where("type = 'revisit'").select(F.col("id").alias("own"), F.col("refers_to").alias("id"))
    whole = responses.select(
        warc.page_id(F.col("id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    return whole.unionByName(
        revisits.join(responses.dropDuplicates(["id"]), "id").select(
            warc.page_id(F.col("own")).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            F.lit("revisit").alias("record_type"),
            warc.page_id(F.col("id")).alias("refers_to"),
        )
    )


@query()
def op5_fingerprints(spark, sf):
    """Merkle fingerprints of all texts, of each with its last third edited, and how alike they are."""
    both = fingerprints.with_next(table(spark, sf, "documents").select("doc_id", "text"))
    n = F.length("text")
    third = F.expr("length(text) div 3")
    edited = F.concat(F.left("text", n - third), F.left("next_text", third))
    trees = both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        fingerprints.fingerprint(F.col("text")).alias("fingerprint"),
        fingerprints.fingerprint(edited).alias("edited_fingerprint"),
        fingerprints.fingerprint(F.col("next_text")).alias("next_fingerprint"),
    )
    return trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@query()
def op2_nearest(spark, sf):
    """The 20 largest inner products of every 20th embedding with all others."""
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


@query(
    """
with t as (select distinct conv_id, turn, role, coalesce(text, '') as text from conversations where conv_id is not null),
r as (select conv_id, max(turn) as turn, arg_max(text, turn) as reply from t where role = 'assistant' group by conv_id),
n as (
  select *, coalesce(lead(reply) over (order by conv_id desc), first_value(reply) over (order by conv_id desc)) as other
  from r),
p as (
  select n.conv_id, n.reply, n.other, count(t.turn) as before,
         coalesce(string_agg('<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10), '' order by t.turn), '') as prompt
  from n left join t on t.conv_id = n.conv_id and t.turn < n.turn
  group by n.conv_id, n.reply, n.other)
select conv_id, (before + case when reply = other then 1 else 0 end)::int as prefix_turns,
       prompt || case when reply = other then '<|assistant|>' || chr(10) || reply || '<|end|>' || chr(10) else '' end as prompt,
       case when reply = other then '' else '<|assistant|>' || chr(10) || reply || '<|end|>' || chr(10) end as chosen,
       case when reply = other then '' else '<|assistant|>' || chr(10) || other || '<|end|>' || chr(10) end as rejected,
       case when reply = other then '' else '14+' || (length(reply) + 8) end as chosen_trained,
       case when reply = other then '' else '14+' || (length(other) + 8) end as rejected_trained
from p
"""
)
def op3_preferences(spark, sf):
    """Each conversation up to its last reply is chosen; with another conversation's reply, rejected.

    The other one is that with the next smaller conv_id (the largest, for the smallest). Conversations
    without a reply make no pair.
    """
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    replies = turns.where("role = 'assistant' and pair_id is not null").groupBy("pair_id").agg(
        F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last")
    )
    replies = staged(replies.select("pair_id", F.col("last.turn").alias("last"), F.col("last.text").alias("reply")), "replies")
    others = fingerprints.with_next(replies.select(F.col("pair_id").alias("doc_id"), F.col("reply").alias("text")))
    before = turns.join(replies.select("pair_id", "last"), "pair_id").where("turn < last").drop("last")
    reply = lambda df, text: df.select("pair_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"), F.col(text).alias("text"))
    swapped = others.select(F.col("doc_id").alias("pair_id"), "next_text").join(replies, "pair_id")
    pairs = preferences.preference_pairs(
        before.unionByName(reply(replies, "reply")), before.unionByName(reply(swapped, "next_text"))
    )
    trained = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws("+", s["start"], s["length"])), ",")
    return pairs.select(
        F.col("pair_id").alias("conv_id"),
        "prefix_turns",
        "prompt",
        "chosen",
        "rejected",
        trained("chosen_spans").alias("chosen_trained"),
        trained("rejected_spans").alias("rejected_trained"),
    )


#: Rows of ``embeddings`` whose vector is sound, as lists of whole numbers.
_WHOLE_VECTORS = """
select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""


def _assignment(round_: int) -> str:
    """SQL: the nearest entry of each part, the lower index of equal ones."""
    return f"""
a{round_} as (
  select r, p, min(struct_pack(d := list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y), e := e)) as best
  from parts join b{round_} using (p) group by r, p)"""


def _codebook(round_: int) -> str:
    """SQL: the codebooks after a round; unused entries stay."""
    return f"""
m{round_} as (
  select p, e, list(mean order by i) as y from (
    select p, best.e as e, i, floor(sum(x[i]) / count(*)) as mean
    from a{round_ - 1} join parts using (r, p), range(1, 5) as t(i) group by p, best.e, i)
  group by p, e),
b{round_} as (select b.p, b.e, coalesce(m.y, b.y) as y from b{round_ - 1} b left join m{round_} m using (p, e))"""


@query(
    f"""
with whole as ({_WHOLE_VECTORS}),
rows as (select *, row_number() over (order by vec_id nulls last, v) as r from whole),
parts as (select r, vec_id, label, p, v[4 * p + 1:4 * p + 4] as x from rows, range(16) as t(p)),
b0 as (select p, r - 1 as e, x as y from parts where r <= 64),
{_assignment(0)}, {_codebook(1)}, {_assignment(1)}, {_codebook(2)}, {_assignment(2)},
coded as (
  select r, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error from a2 group by r),
book as (
  select sha256(string_agg(c, ',' order by p, e)) as digest
  from (select p, e, array_to_string(list_transform(y, lambda c: c::bigint::varchar), ',') as c from b2))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, digest as codebooks_sha256
from rows join coded using (r), book
"""
)
def op11_vector_codes(spark, sf):
    """All sound embeddings as codes of 16 parts, by codebooks of 64 entries after two rounds."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    rows, books = vector_codes.compress(vectors, "embedding", ["vec_id"])
    hexed = F.array_join(F.transform("code", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")
    coded = rows.select("record.vec_id", "record.label", hexed.alias("code"), "error")
    # grouped as a struct, so that the join shuffles both sides, and a label with many rows can be split
    by_label = coded.groupBy(F.struct(F.col("label").alias("of")).alias("key")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label.select("key.of", "label_error"), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256")
    )


@query(
    f"""
with whole as ({_WHOLE_VECTORS} and label is not null),
rows as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, v
  from whole),
scored as (
  select a.r as a, a.vec_id as anchor_id, a.label = b.label as same, b.r as b, b.vec_id, list_dot_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 100 = 0),
positives as (
  select * from scored where same
  qualify row_number() over (partition by a order by score desc, vec_id nulls last, b) <= 5),
mined as (
  select p.anchor_id, p.vec_id as positive_id,
         row_number() over (partition by p.a, p.b order by n.score desc, n.vec_id nulls last, n.b)::int as rank,
         n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
  from positives p join scored n on n.a = p.a and not n.same
  where 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score)
select * from mined where rank <= 10
"""
)
def op12_hard_negatives(spark, sf):
    """Negatives of every 100th embedding, 30 to 90 hundredths as near as each of its 5 positives."""
    vectors = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query()
def op13_simhash(spark, sf):
    """Components of the documents whose fingerprints differ in two bits at most."""
    found = simhash.near_groups(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )
