"""The registered queries of the corpus operators: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquarry.llm import ann, decontaminate, infill, language, negatives, packing, patterns, pitmanyor, quality, simhash, suffixes, urlfilter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Documents that score less are rejected.
QUALITY_CUT = 0.3


def crc_mod(column: str, n: int):
    return F.crc32(F.col(column).cast("string")) % n


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.trained(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    found = quality.scored(docs, net)
    return found.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.covered(F.col("spans"))
    return found.select(F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_pitmanyor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pitmanyor.scored(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2)
    return found.select(F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: (host, path prefix, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urlfilter.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"))


OP8_SQL = r"""
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(rule_host, rule_path, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, arg_max(verdict, length(rule_host || rule_path)) as verdict
  from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id)
select p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') as verdict from parts p left join best b using (page_id)
"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.trained(docs, crc_mod("doc_id", 4) != 2)
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = patterns.packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return found.withColumnRenamed("id", "doc_id")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.rearranged(table(spark, sf_dir, "documents"))
    digest = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(infill.restored(F.col("output"), F.col("form")), 256)}
    return found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *(c.alias(k) for k, c in digest.items()))


OP12_SQL = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as lab, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor, b.vec_id as other, a.lab = b.lab as same, coalesce(cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint), 0) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
tops as (select anchor, other as positive, score as p from (select *, row_number() over (partition by anchor order by score desc, other) as n from pairs where same) where n <= 5),
found as (
  select t.anchor, t.positive, t.p, q.other, q.score, row_number() over (partition by t.anchor, t.positive order by q.score desc, q.other) as n
  from tops t join pairs q on q.anchor = t.anchor and not q.same and 80 * t.p <= 100 * q.score and 100 * q.score <= 100 * t.p)
select anchor as anchor_id, positive as positive_id, cast(n as int) as rank, other as negative_id, p as positive_score, score as negative_score from found where n <= 5
"""

OP13_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (select doc_id, t, string_split(t, chr(10)) as ls, [cast('0x' || substr(h, 8 * k + 1, 8) as bigint) for k in range(4)] as h from d),
counted as (select *, case when t = '' then 0 when ends_with(t, chr(10)) then len(ls) - 1 else len(ls) end as n from drawn),
placed as (select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b from counted),
cut as (select *, least(length(t), coalesce(list_sum(list_transform(ls[1:a], lambda x: length(x) + 1)), 0)) as x, least(length(t), coalesce(list_sum(list_transform(ls[1:b], lambda x: length(x) + 1)), 0)) as z from placed),
formed as (select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain' when h[4] % 100 < 50 then 'spm' else 'psm' end as form from cut),
parts as (select *, left(t, cast(x as bigint)) as p, substr(t, cast(x as bigint) + 1, cast(z - x as bigint)) as m, substr(t, cast(z as bigint) + 1) as s from formed)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(x as bigint) end as prefix_chars, case when form <> 'plain' then cast(z - x as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from parts
"""

OP2_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
sized as (select item, ws, least(10, len(ws)) as n from b where len(ws) > 0),
windows as (select distinct item, n, array_to_string(ws[i:i + n - 1], ' ') as win from (select item, ws, n, unnest(range(1, len(ws) - n + 2)) as i from sized)),
places as (select doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') as win from (
  select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, (select distinct n from sized) where len(ws) >= n)),
hits as (select p.doc_id, p.i, p.n, w.item from places p join windows w on p.n = w.n and p.win = w.win),
covered as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id),
items as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by doc_id)
select d.doc_id, len(d.ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join items using (doc_id)
"""

OP3_SQL = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x, octet_length(encode(coalesce(text, ''))) as n from documents),
pieces as (select doc_id, base, substr(x, 2 * base + 1, 1422) as piece from (select doc_id, x, unnest(range(0, n, 512)) as base from d where n >= 200)),
w as (select doc_id, base + j as i, md5(substr(piece, 2 * j + 1, 400)) as k from (select doc_id, base, piece, unnest(range(0, least(512, length(piece) // 2 - 199))) as j from pieces)),
r as (select doc_id, i from w where k in (select k from w group by k having count(*) > 1)),
s as (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 200 then 0 else 1 end as new from r),
g as (select doc_id, i, sum(new) over (partition by doc_id order by i) as span from s),
spans as (select doc_id, min(i) as a, max(i) + 200 as z from g group by doc_id, span),
gaps as (select spans.*, x, coalesce(lag(z) over (partition by doc_id order by a), 0) as before from spans join d using (doc_id)),
cut as (select doc_id, count(*) as n_spans, sum(z - a) as n_removed, max(z) as last, string_agg(x[2 * before + 1:2 * a], '' order by a) as head from gaps group by doc_id)
select d.doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(head || x[2 * last + 1:], x))) as kept_sha256
from d left join cut using (doc_id)
"""

OP6_SQL = r"""
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
g as (select page_id, payload, max(page_id) over (partition by payload) as last, cast(cast(unhex(sha1(payload)) as bit) as varchar) as bits from p)
select page_id, octet_length(payload) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + list_sum(list_transform(range(0, 5), lambda j: (ascii(substr(bits, cast(5 * k + j + 1 as bigint), 1)) - 48) * (16 >> cast(j as int)))) as bigint), 1)), '') as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to
from g
"""

QUERIES = {f.__name__: f for f in (op1_quality, op2_decontaminate, op3_suffixes, op4_simhash, op5_packing, op6_warc, op7_pitmanyor, op8_url_filter, op9_language, op10_nearest, op11_patterns, op12_negatives, op13_infill)}
#: The others are learned, sampled or tokenized, or need a hash that SQL lacks: they are tested by brute force and held-out rows.
ORACLE_SQL: dict[str, str] = {"op2_decontaminate": OP2_SQL, "op3_suffixes": OP3_SQL, "op6_warc": OP6_SQL, "op8_url_filter": OP8_SQL, "op12_negatives": OP12_SQL, "op13_infill": OP13_SQL}
