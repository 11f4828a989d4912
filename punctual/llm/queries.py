"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from punctual.llm import bpe, dedup, html, jaccard, langid, merkle, mixing, quality, search, secrets, suffixes, vectors, warc
from punctual.llm.common import table
from punctual.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query()
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out()))
    return langid.predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


@query()
def op2_html_template(spark: SparkSession, sf: str) -> DataFrame:
    texts = html.extract(table(spark, sf, "pages")).withColumnRenamed("id", "page_id")
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.coded(docs, ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query("""
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex from p),
b as (
  select *, row_number() over (partition by hex order by page_id) as rn, min(page_id) over (partition by hex) as first_id,
         list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (
           (('0x' || substr(hex, (i * 5 // 4)::int + 1, 2))::int >> (3 - i * 5 % 4)::int) & 31)::int + 1, 1)) as letters
  from d
)
select page_id, payload_bytes, array_to_string(letters, '') as payload_digest,
       case when rn = 1 then 'response' else 'revisit' end as record_type, case when rn > 1 then first_id end as refers_to
from b""")
def op4_warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    records = warc.archived(table(spark, sf, "pages")).withColumnRenamed("id", "page_id")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(r"""
with j as (
  select doc_id, row_number() over (partition by sha order by doc_id) as rn, min(doc_id) over (partition by sha) as keep_id,
         count(*) over (partition by sha) as group_size, sha
  from (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as sha from documents)
)
select doc_id, keep_id, group_size, rn = 1 as kept, sha as text_sha256 from j""")
def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return dedup.copies(docs).withColumnRenamed("id", "doc_id")


@query(r"""
with d as (
  select doc_id, source, source is null as no_source, coalesce(source, '') as name,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, md5(cast(doc_id as varchar)) as spot
  from documents
),
g as (select no_source, name, sum(size)::bigint as source_size from d group by no_source, name),
s as (select *, [3, 1, 2][(row_number() over (order by no_source, name) - 1) % 3 + 1] as weight from g),
filled as (
  select coalesce(sum(source_size * 2) over before, 0) as full_size, coalesce(sum(weight) over before, 0) as full_weight
  from s window before as (order by source_size / weight, name rows between unbounded preceding and 1 preceding)
),
level as (
  select max_by(a, a / b) as a, max_by(b, a / b) as b
  from (
    select (select sum(source_size) from s) * 3 - full_size * 2 as a, ((select sum(weight) from s) - full_weight) * 2 as b
    from filled
  )
),
t as (select *, least(source_size * 2.0::double, weight * (select a::double from level) / (select b::double from level)) as target from s),
r as (
  select d.*, source_size, target, row_number() over (partition by d.no_source, d.name order by size, spot, doc_id) as pos,
         case when source_size > 0 then target / source_size else 0.0::double end as expected,
         ('0x' || substr(md5('mix' || d.name), 1, 8))::bigint / 4294967296.0::double as u
  from d join t on d.no_source = t.no_source and d.name = t.name
)
select doc_id, size::bigint as size, source_size, target,
       (least(floor(pos * expected + u) - floor((pos - 1) * expected + u), ceil(expected)) * size)::bigint as taken
from r""")
def op9_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs).withColumnRenamed("id", "doc_id")
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return jaccard.joined(docs).withColumnRenamed("id", "doc_id").drop("key")


@query(r"""
with d as (select doc_id, source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d),
win as (
  select doc_id, unnest(list_transform(range(1, greatest(len(words) - 3, 1)), lambda i: words[i : i + 4])) as win,
         unnest(range(1, greatest(len(words) - 3, 1))) as pos
  from w
),
twin as (select doc_id, pos, count(*) over (partition by doc_id, win) > 1 as twice from win),
cover as (select distinct doc_id, pos + k as pos from twin, range(5) as r(k) where twice),
rep as (select doc_id, count(*) as n from cover group by doc_id),
ln as (
  select doc_id, source, line, regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g') as flat
  from (select doc_id, source, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup as (select doc_id, count(*) - count(distinct line) as n from ln group by doc_id),
norm as (select doc_id, source, lower(trim(flat)) as line, len(string_split(trim(flat), ' ')) as n from ln),
often as (
  select source, line from norm group by source, line
  having count(distinct doc_id) > greatest(10, 0.002::double * (select count(*) from d where d.source is not distinct from norm.source))
),
gone as (
  select doc_id, sum(n) as n from norm where exists (
    select 1 from often where often.source is not distinct from norm.source and often.line = norm.line) group by doc_id
),
j as (
  select w.doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
         coalesce(rep.n, 0)::bigint as n_repeat_words, coalesce(gone.n, 0)::bigint as n_removed_words
  from w left join dup using (doc_id) left join rep using (doc_id) left join gone using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - n_removed_words >= n_words * 0.5::double as kept,
       n_removed_words
from j""")
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return quality.judge(docs).withColumnRenamed("id", "doc_id")


@query()
def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    base = F.filter("found", lambda s: s["kind"] != "random")
    return secrets.scan(docs).select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("found")).alias("spans"),
    )


@query()
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = suffixes.without_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", kept)


@query(r"""
with recursive d as (
  select *, row_number() over () as no,
         concat(case when source is null then '-' else strlen(source) || ':' || source end,
                case when lang is null then '-' else strlen(lang) || ':' || lang end) as middle,
         case when text is null then '-' else strlen(text) || ':' || text end as last,
         case when doc_id is null then '-' else length(doc_id::varchar) || ':' || doc_id end as first,
         list_reduce(
           list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''),
             lambda c: list_concat([ascii(c)::bigint], list_transform(range(8), lambda i: -1::bigint))))),
           lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as crc
  from documents
),
leaves as (
  select no, doc_id, lang,
         sha256(concat(first, middle, case when n_chars is null then '-' else length(n_chars::varchar) || ':' || n_chars end, last)) as leaf,
         sha256(concat(first, middle, case when n_chars is null then '-' else length((n_chars + 1)::varchar) || ':' || (n_chars + 1) end, last)) as tampered,
         coalesce(xor(crc, 4294967295) % 7 = 0, false) as touched
  from d
),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf, no) - 1 as pos, count(*) over (partition by lang) as size
  from leaves
),
tree as (
  select lang, 0 as lvl, pos, leaf as h, size from placed
  union all
  select lang, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (size + 1) // 2 from tree where size > 1
  group by lang, lvl, pos // 2, size
),
subs as (
  select lang, h as subroot, lvl, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as size
  from tree where size = 1
),
top as (
  select 0 as lvl, pos, subroot as h, size from subs
  union all
  select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (size + 1) // 2 from top where size > 1
  group by lvl, pos // 2, size
),
steps as (
  select p.no, t.lvl, p.pos >> t.lvl as at, s.h
  from placed p join (select distinct lang, lvl, size from tree where size > 1) t on p.lang is not distinct from t.lang
  left join tree s on s.lang is not distinct from p.lang and s.lvl = t.lvl and s.pos = xor(p.pos >> t.lvl, 1)
  union all
  select p.no, u.lvl + t.lvl, u.pos >> t.lvl, s.h
  from placed p join subs u on p.lang is not distinct from u.lang
  join (select distinct lvl, size from top where size > 1) t on true
  left join top s on s.lvl = t.lvl and s.pos = xor(u.pos >> t.lvl, 1)
),
fold as (
  select no, 0 as lvl, case when touched then tampered else leaf end as h from placed
  union all
  select f.no, f.lvl + 1, sha256(case when s.h is null then f.h when s.at % 2 = 0 then f.h || s.h else s.h || f.h end)
  from fold f join steps s on f.no = s.no and f.lvl = s.lvl
),
folded as (select no, max_by(h, lvl) as h from fold group by no),
proof as (select no, string_agg(h, '' order by lvl) as h from steps group by no),
root as (select h from top where size = 1)
select p.doc_id, p.leaf, u.subroot, root.h as root, sha256(coalesce(proof.h, '')) as proof_sha256,
       folded.h as folded_root, folded.h = root.h as verified
from placed p join subs u on p.lang is not distinct from u.lang join folded on p.no = folded.no
left join proof on p.no = proof.no, root""")
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    parts = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.row_hash(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"])
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    made = merkle.manifest(docs, parts, "lang", "doc_id", {"changed": F.when(touched, F.unhex(tampered))})
    return merkle.proofs(made, "changed").withColumnRenamed("id", "doc_id").drop("group")


@query(r"""
with t as (
  select doc_id, no, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select *, row_number() over () as no from documents)
),
post as (select doc_id, no, term, count(*)::bigint as tf from t group by doc_id, no, term),
size as (select no, sum(tf)::bigint as n from post group by no),
total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from size),
m as (select no, 100 - 50 + (50 * n * n_docs) // n_terms as m from size, total),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w
      from (select term, count(*) as df from post group by term), total),
q as (
  select distinct item_id, no, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select *, row_number() over () as no from benchmark)
),
s as (
  select q.item_id, q.no, post.doc_id, post.no as doc_no, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from q join post on q.term = post.term join w on w.term = q.term join m on m.no = post.no
  group by q.item_id, q.no, post.doc_id, post.no
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by no order by score desc, doc_id nulls last) as rank from s where score > 0)
where rank <= 50""")
def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    made = search.index(table(spark, sf, "documents").select("doc_id", "text"))
    return search.search(made, table(spark, sf, "benchmark")).withColumnRenamed("id", "doc_id")


@query("""
with recursive v as (
  select vec_id, row_number() over () as no, embedding::double[] as e,
         coalesce(len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
                  and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as usable
  from embeddings
),
link as (
  select a.no as a, b.no as b from v a join v b on a.no <> b.no and a.usable and b.usable and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95::double
),
walk as (
  select no, no as other from v
  union
  select w.no, l.b from walk w join link l on w.other = l.a
),
least as (select w.no, min(v.vec_id) as component_id from walk w join v on w.other = v.no group by w.no),
n as (select a, count(*)::bigint as n_links from link group by a)
select v.vec_id, coalesce(n.n_links, 0)::bigint as n_links, component_id, v.vec_id is not distinct from component_id as kept
from v join least using (no) left join n on n.a = v.no""")
def op13_vector_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = vectors.joined(table(spark, sf, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
