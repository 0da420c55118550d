"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, decontam, divergence, fingerprints, hardneg, langid, lines, neardup, packing, pii, secrets,
               sharding, substrings)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(vocabulary_path())
    return bpe.digests(bpe.decode(bpe.encode(documents(spark, sf_dir), ranks), ranks))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(substrings.remove_repeats(documents(spark, sf_dir)))


#: Key of the surrogates of the registered query; a user passes their own.
SURROGATE_KEY = "corpus surrogates"


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(documents(spark, sf_dir), SURROGATE_KEY).select("doc_id", "n_entities", "text")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(lines.dedup_lines(documents(spark, sf_dir)))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(fingerprints.compare_with_edits(documents(spark, sf_dir)))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(secrets.build_index(documents(spark, sf_dir))))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.build_index(documents(spark, sf_dir))
    return decontam.digests(decontam.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(sharding.shard(documents(spark, sf_dir)))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_components(documents(spark, sf_dir), shingle=2, percent=80)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.select(
        F.col("vec_id").alias("id"), label.alias("label"), hardneg.whole_numbers(F.col("embedding")).alias("vector"),
        (F.col("vec_id") % 100 == 0).alias("anchor")))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def queries() -> dict:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_pii_surrogates": op3_pii_surrogates,
        "op4_language_id": op4_language_id,
        "op5_line_dedup": op5_line_dedup,
        "op6_fingerprints": op6_fingerprints,
        "op7_secret_scan": op7_secret_scan,
        "op8_decontamination": op8_decontamination,
        "op9_sharding": op9_sharding,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_packing": op12_packing,
        "op13_source_divergence": op13_source_divergence,
    }


#: White space of the contracts as a DuckDB string expression.
_WS = "(chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))"
#: A-Z to a-z only.
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = f"""
with l as (
  select doc_id, pos, line, {_LOW.format(f"trim(line, {_WS})")} as k
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
        from documents)),
common as (
  select k, max(doc_id) as last from l where length(k) >= 40
  group by k having count(distinct doc_id) >= 5),
m as (
  select l.doc_id, l.pos, l.line, (c.k is not null and l.doc_id <> c.last) as gone
  from l left join common c on l.k = c.k)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""

#: Windows of the items meet the documents' words by their first word, then word by word.
_OP8 = f"""
with w as (
  select doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")},
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
b as (
  select item_id, regexp_extract_all({_LOW.format("coalesce(text, '')")},
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from benchmark),
win as (
  select distinct item_id, ws[k:k + 9] as p
  from (select item_id, ws, unnest(range(1, greatest(2, len(ws) - 8))) as k from b where len(ws) > 0)),
pos as (
  select doc_id, k, ws[k:k + 9] as t
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as k from w)),
occ as (
  select pos.doc_id, pos.k, win.item_id, len(win.p) as n
  from pos join win on win.p = pos.t[1:len(win.p)] and win.p[1] = pos.t[1]),
hit as (
  select doc_id, count(distinct h) as n_hit from (select doc_id, unnest(range(k, k + n)) as h from occ) group by doc_id),
ids as (
  select doc_id, count(distinct item_id) as n_items,
         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from occ group by doc_id)
select w.doc_id, len(w.ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit using (doc_id) left join ids using (doc_id)
"""

_OP2 = """
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
win as (
  select doc_id, k, array_to_string(ws[k:k + 19], ' ') as p
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as k from d)),
late as (
  select doc_id, k from (
    select doc_id, k, row_number() over (partition by p order by doc_id, k) as r from win) where r > 1),
gone as (select distinct doc_id, unnest(range(k, k + 20)) as k from late),
w as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as k from d),
kept as (
  select w.doc_id, count(*) as n_kept, string_agg(word, ' ' order by w.k) as kept
  from w anti join gone on w.doc_id = gone.doc_id and w.k = gone.k group by w.doc_id)
select d.doc_id, len(ws) as n_words, len(ws) - coalesce(n_kept, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id
"""


_OP11 = """
with e as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id as id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from e a join e b on a.vec_id % 100 = 0 and len(a.v) = len(b.v)),
pos as (
  select * from s where same and id <> anchor_id
  qualify row_number() over (partition by ar order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id,
       (row_number() over (partition by p.ar, p.br order by n.score desc, n.id))::int as rank,
       n.id as negative_id, p.score as positive_score, n.score as negative_score
from pos p join s n on n.ar = p.ar and not n.same and 100 * n.score between 30 * p.score and 90 * p.score
qualify rank <= 10
"""

#: Every group against every kept term, zeros written out: plain, and slow on large tables.
_OP13 = f"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ts
  from documents),
w as (select r, lang, source, unnest(ts) as term from d),
kept as (select lang, term from w group by lang, term having count(distinct r) >= 3),
v as (select lang, count(*) as n_terms from kept group by lang),
c as (select w.lang, w.source, w.term, count(*)::hugeint as n from w join kept using (lang, term) group by all),
g as (select distinct lang, source from d),
size as (select lang, source, sum(n)::hugeint as size from c group by all),
dense as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(s.size, 0) + v.n_terms) as p
  from g join kept k on g.lang = k.lang join v on v.lang = g.lang
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join size s on s.lang = g.lang and s.source = g.source),
whole as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n) + 1)) // (any_value(total) + any_value(n_terms)) as q
  from c join (select lang, sum(n)::hugeint as total from c group by lang) using (lang) join v using (lang)
  group by lang, term),
pair as (
  select a.lang, a.source, b.source as item, coalesce(f, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source as s, y.source as o, sum(((x.p - y.p) * (x.p - y.p)) // y.p) as f
             from dense x join dense y on x.lang = y.lang and x.term = y.term and x.source <> y.source
             group by all) t on t.lang = a.lang and t.s = a.source and t.o = b.source),
listed as (
  select lang, source, 'pair' as part, item, value from pair
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // q from dense join whole using (lang, term)
  where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from listed)
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_substring_dedup": _OP2, "op5_line_dedup": _OP5, "op8_decontamination": _OP8,
            "op11_hard_negatives": _OP11, "op13_source_divergence": _OP13}
