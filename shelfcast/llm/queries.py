"""The operators' named queries over whole tables, with production parameters, and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    importance, lexical, mixing, neighbours, perplexity, pieces, pii, preference, quantised, secrets, simhash, targets,
    toxicity,
)
from shelfcast.llm.common import hexadecimal, table
from shelfcast.llm.spans import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Documents resampled towards those labelled as good, as many as the labels' share of good ones."""
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Rendered turns of prompts and completions, conversations against their mismatched replies."""
    pairs = preference.mismatched_replies(table(spark, folder, "conversations"))
    return preference.formatted(pairs).withColumnRenamed("pair", "conv_id")


@query
def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of each document: weights 5, 2, 1 along the sources, 150 % of all words."""
    return mixing.taken(mixing.mixture(table(spark, folder, "documents"), mixing.by_rank((5.0, 2.0, 1.0))))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated toxicity of each document, with the ids of the nearest examples."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"), F.col("toxicity.predicted").alias("predicted"),
        F.transform("toxicity.evidence", lambda e: e["doc_id"]).alias("evidence_ids"),
    )


@query
def op5_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts, perplexity and verdict of each document."""
    return perplexity.judged(table(spark, folder, "documents"))


@query
def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors found for each vector whose id is divisible by 100."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of each document; sources own documents, and a document is a repository."""
    out = secrets.with_spans(table(spark, folder, "documents"), owner="source", repository="doc_id")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return out.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.RANK],
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.sha2(written(secrets.plain(F.col("spans"), secrets.BASE)), 256).alias("base_sha256"),
        written(secrets.plain(F.col("spans"))).alias("spans"),
    )


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and class of each document."""
    found = simhash.classes(table(spark, folder, "documents"), words=4, max_bits=4)
    return found.withColumn("fingerprint", hexadecimal(F.col("fingerprint")))


@query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them."""
    out = pieces.encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id", F.size("pieces.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("pieces.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded"), 256).alias("decoded_sha256"),
    )


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Confirmed personal data of each document."""
    out = pii.with_spans(table(spark, folder, "documents"))
    counts = [F.size(f"pii.{k}").cast("long").alias(f"n_{k}") for k in (*pii.BASE, "iban", "ssn")]
    return out.select(
        "doc_id", *counts,
        F.sha2(written(pii.spans("pii", pii.BASE)), 256).alias("base_sha256"),
        written(pii.spans("pii")).alias("spans"),
    )


@query
def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents of highest score for each benchmark item."""
    return lexical.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"), k=10)


@query
def op12_target_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of each document, a tenth drawn towards the benchmark's words."""
    return targets.resampled(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"),
        runs=1, buckets=10_000, seed=2024, share=10, least_words=20,
    )


@query
def op13_vector_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Links and class of each vector among those of its label, cosine 0.98 or more."""
    return quantised.classes(table(spark, folder, "embeddings"), least=0.98)


ORACLES["op2_preferences"] = """
with turns as (select conv_id as pair, turn, role, text from conversations),
last_reply as (
  select pair, turn as at_turn, text as reply from (
    select *, row_number() over (partition by pair order by turn desc, text desc nulls last) as k
    from turns where role = 'assistant') where k = 1),
other as (select pair, at_turn, lead(reply) over (order by pair) as reply from last_reply),
sides as (
  select pair, turn, role, text, 1 as c, 0 as r from turns union all
  select t.pair, turn, role,
    case when turn = at_turn and role = 'assistant' then reply else text end, 0, 1
  from turns t left join other o on t.pair = o.pair),
counted as (
  select pair, turn, role, text, cast(sum(c) as bigint) as in_chosen, cast(sum(r) as bigint) as in_rejected
  from sides group by all),
ends as (select pair as p, min(turn) as first_difference from counted where in_chosen <> in_rejected group by 1),
placed as (
  select *, first_difference is null or turn < first_difference as shared
  from counted left join ends on pair = p),
parts as (
  select *, 'prompt' as part, in_chosen as copies from placed where shared union all
  select *, 'chosen', in_chosen from placed where not shared union all
  select *, 'rejected', in_rejected from placed where not shared)
select pair as conv_id, part, turn, role,
  concat('<|', coalesce(role, ''), '|>', chr(10), coalesce(text, ''), '<|end|>', chr(10)) as content,
  copies, part <> 'prompt' and coalesce(role = 'assistant', false) as loss
from parts where copies > 0
"""

ORACLES["op11_lexical"] = r"""
with doc_words as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as words
  from documents where text is not null),
doc_size as (select doc_id, len(words) as n from doc_words where len(words) > 0),
totals as (select count(*) as docs, cast(sum(n) as bigint) as length from doc_size),
tf as (
  select doc_id, term, count(*) as tf from (select doc_id, unnest(words) as term from doc_words) group by all),
item_tf as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
    from benchmark where text is not null) group by all),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from tf, totals where term in (select term from item_tf) group by term, docs),
parts as (
  select doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // length)))) as part
  from tf join weights using (term) join doc_size using (doc_id), totals),
scores as (
  select item_id, doc_id, cast(sum(times * part) as bigint) as score
  from item_tf join parts using (term) group by all),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""

ORACLES["op12_target_importance"] = r"""
with crc_table as (
  select list_transform(range(256), lambda b: list_reduce(
    list_prepend(b, range(8)),
    lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as steps),
texts as (
  select 'raw' as side, doc_id as id, text from documents union all
  select 'target', item_id, text from benchmark),
words as (
  select side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') as words
  from texts),
uses as (select side, id, word, count(*) as n from (select side, id, unnest(words) as word from words) group by all),
buckets as (
  select word, cast(xor(list_reduce(
    list_prepend(cast(4294967295 as bigint), list_transform(
      range(strlen(word)), lambda i: cast(concat('0x', substr(hex(encode(word)), 2 * i + 1, 2)) as bigint))),
    lambda c, b: xor(c // 256, steps[(xor(c, b) % 256) + 1])), 4294967295) as bigint) % 10000 as bucket
  from (select distinct word from uses), crc_table),
totals as (
  select cast(sum(case when side = 'raw' then n else 0 end) as bigint) as all_raw,
    cast(sum(case when side = 'target' then n else 0 end) as bigint) as all_target from uses),
gains as (
  select bucket, cast(floor(1000 * ln(
    (cast(sum(case when side = 'target' then n else 0 end) as double) + 1) * cast(all_raw + 10000 as double)
    / ((cast(sum(case when side = 'raw' then n else 0 end) as double) + 1) * cast(all_target + 10000 as double))))
    as bigint) as gain
  from uses join buckets using (word), totals group by bucket, all_raw, all_target),
weights as (
  select id, cast(sum(n) as bigint) as n_features, cast(floor(sum(n * gain) / sum(n)) as bigint) as weight
  from uses join buckets using (word) join gains using (bucket) where side = 'raw' group by id),
scored as (
  select id as doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
      (cast(concat('0x', substr(sha256(concat('2024:', id)), 1, 8)) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from words left join weights using (id) where side = 'raw'),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () * 10 // 100 as drawn
  from scored where n_features >= 20)
select doc_id, n_features, weight, score, cast(case when rank <= drawn then rank end as bigint) as rank
from scored left join ranked using (doc_id)
"""

ORACLES["op13_vector_classes"] = """
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98),
reached as (
  select vec_id as a, vec_id as b from embeddings union
  select reached.a, links.b from reached join links on reached.b = links.a),
least as (select a as vec_id, min(b) as component_id from reached group by 1),
degree as (select a as vec_id, count(*) as n_links from links group by 1)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings left join degree using (vec_id) join least using (vec_id)
"""
