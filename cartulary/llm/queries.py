"""The contract queries: one thin query an operator, over whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file; CARTULARY_TOKENIZER overrides it."""
    if "CARTULARY_TOKENIZER" in os.environ:
        return os.environ["CARTULARY_TOKENIZER"]
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.chat import digest, expand_prefix_targets

    odd = spark.sql(
        r"select -7L conv_id, id turn, if(id = 0, 'user', 'assistant') role, r'\### Assistant: </turn> ok' text from range(0, 2, 1, 1)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(expand_prefix_targets(rows.unionByName(odd)))


OP2_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped as (
  select *, replace(replace(replace(replace(r, '&', '&amp;'), '###', '&head;'), '</turn>', '&end;'), ':', '&colon;') as er,
    replace(replace(replace(t, '&', '&amp;'), '###', '&head;'), '</turn>', '&end;') as et from rows
), placed as (
  select *, sum(4 + length(er) + 2 + length(et) + 9) over w as upto,
    row_number() over (partition by conv_id order by turn desc nulls last, r desc, t desc) = 1 as is_last
  from escaped window w as (partition by conv_id order by turn nulls first, r, t rows unbounded preceding)
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t)) as turns_sha256,
  coalesce(sum(length(t)) filter (r = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, r, t) filter (r = 'assistant'), '')) as loss_sha256,
  (sum(upto) filter (r = 'assistant' or is_last))::bigint as formatted_chars
from placed group by conv_id
"""


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.jaccard import link_documents

    return link_documents(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.common import work_dir
    from cartulary.llm.warc import read_archives, write_archives

    path = work_dir(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).drop("url")


#: Documents arrive in so many batches.
ARRIVALS = 4


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.common import work_dir
    from cartulary.llm.sharding import ShardStore

    docs = table(spark, sf_dir, "documents")
    store = ShardStore(spark, work_dir(spark, "shards"))
    for k in range(ARRIVALS):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == k))
    store.compact()
    return store.read().select("doc_id", F.length("text").cast("bigint").alias("text_chars"), F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


OP5_SQL = "select doc_id, length(text)::bigint as text_chars, md5(text) as text_md5, lang, source, n_chars from documents"


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.decontamination import find_contamination

    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "dedup.n_lines",
        F.col("dedup.n_removed").alias("n_removed_lines"),
        F.col("dedup.n_single").alias("n_single_lines"),
        F.length("text").cast("bigint").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
        "dedup.emptied",
    )


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.divergence import audit_sources

    return audit_sources(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents
), terms as (
  select d, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from docs
), kept as (
  select lang, term, count(*) as in_lang from terms group by all having count(distinct d) >= 10
), counts as (
  select lang, source, term, count(*) as n from terms semi join kept using (lang, term) group by all
), groups as (
  select distinct lang, source from docs
), langs as (
  select lang, count(term) as v, coalesce(sum(in_lang), 0) as n from (select distinct lang from docs) left join kept using (lang) group by all
), totals as (
  select g.lang, g.source, l.v, coalesce(sum(c.n), 0) + 2 * l.v as whole, l.n + 2 * l.v as lang_whole from groups g join langs l using (lang) left join counts c using (lang, source) group by g.lang, g.source, l.v, l.n
), shares as (
  select t.lang, t.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // t.whole as p, 1 + (1000000000::hugeint * (k.in_lang + 2)) // t.lang_whole as q
  from totals t join kept k using (lang) left join counts c on c.lang = t.lang and c.source = t.source and c.term = k.term
), pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from shares where n > 0 and p > q
)
select lang, source, part, item, value, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from found qualify part = 'pair' or rank <= 10
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.fim import digest, fill_in_middle

    return digest(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))


OP12_SQL = r"""
with told as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), numbers as (
  select *, len(u)::bigint as n, [('0x' || substr(h, 1 + 8 * k, 8))::bigint for k in range(4)] as h4 from told
), cuts as (
  select *, least(h4[1] % (n + 1), h4[2] % (n + 1)) as a, greatest(h4[1] % (n + 1), h4[2] % (n + 1)) as b,
    case when n = 0 or regexp_matches(t, '<[PSM]>') or h4[3] % 100 >= 90 then 'plain' when h4[4] % 100 < 20 then 'spm' else 'psm' end as form from numbers
), pieces as (
  select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from cuts
)
select doc_id, n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars, case when form <> 'plain' then length(m) end::bigint as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from pieces
"""


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartulary.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_packing, op2_chat_formatting, op3_jaccard_join, op4_warc, op5_sharding, op6_quality_rules, op7_toxicity, op8_decontamination, op9_line_dedup, op10_license_scans, op11_source_divergence, op12_fill_in_middle, op13_source_mixing)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": OP2_SQL, "op5_sharding": OP5_SQL, "op11_source_divergence": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
