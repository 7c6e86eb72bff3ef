"""Registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bpe, chat, clustering, jaccard, language, mixing, quality, tokencount, toxicity, urlfilter, warc, webp
from .common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted", "evidence")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_and_digest(docs: DataFrame, block_chars: int = bpe.BLOCK_CHARS) -> DataFrame:
    ranks = bpe.read_ranks(_tokenizer("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(bpe.decode(bpe.encode(docs, ranks, _pattern(), block_chars=block_chars), ranks))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_digest(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


#: The conversation that holds the template's own marks.
MARKS = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    real = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKS).alias("text"))
    return chat.read_back(chat.format_chats(real.unionByName(own)))


def op7_webp_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.media_digests(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op8_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs, _tokenizer("piece_bpe_32k.model")))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.centroid_clusters(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    found = (op1_toxicity, op2_warc, op3_quality_rules, op4_byte_bpe, op5_mixing, op6_chat_format, op7_webp_media, op8_ngram_jaccard, op8_ngram_links, op9_url_filters, op10_token_counts, op11_language_id, op12_centroid_clustering, op13_token_alignment)
    return {f.__name__: f for f in found}


def _values(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def oracle_sql() -> dict[str, str]:
    words = r"'[^\x20\x09-\x0D]+'"
    checks = []
    for r in quality.RULES:
        checks += [f"{r.measure} >= {r.low}"] * (r.low is not None) + [f"{r.measure} <= {r.high}"] * (r.high is not None)
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in urlfilter.default_rules())
    replaced = "replace(x, '\\', '\\b')"
    for control, letter in chat.LETTERS.items():
        replaced = f"replace({replaced}, '{control}', '\\{letter}')"
    return {
        "op12_centroid_clustering": clustering.clusters_sql(),
        "op2_warc": """
with p as (select page_id, coalesce(html, '') as t, sha256(coalesce(html, '')) as d from pages),
f as (select *, octet_length(t::blob) as n, min(page_id) over (partition by d) as first from (select page_id, d, encode(t) as t from p))
select page_id, n::bigint as payload_bytes, d as payload_digest,
  case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id <> first then first end as refers_to from f""",
        "op3_quality_rules": f"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {words}) as w from documents),
win as (select doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) as i from d),
twice as (select doc_id, i, count(*) over (partition by doc_id, array_to_string(w[i:i+7], ' ')) as c from win),
cover as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 8)) as j from twice where c > 1) group by doc_id),
runs as (select doc_id, count(*) as n from (select doc_id, w, unnest(range(2, len(w) + 1)) as i from d) where w[i] = w[i-1] group by doc_id),
lines as (select doc_id, count(*) as n, count(distinct line) as u from (select doc_id, unnest(string_split(t, chr(10))) as line from d) where regexp_matches(line, {words}) group by doc_id),
m as (select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(l.n - l.u, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
  greatest(len(w), 1)::double as k, coalesce(l.n, 1)::double as n_lines, coalesce(r.n, 0) as run, length(regexp_replace(t, '[^!]', '', 'g')) as marks,
  len(list_filter(w, lambda x: lower(x) in ({_values(quality.STOP_WORDS)}))) as stop_words
  from d left join cover c using (doc_id) left join lines l using (doc_id) left join runs r using (doc_id)),
q as (select *, word_chars / k as mean_word_length, n_symbols / k as symbol_ratio, marks / k as exclaimed_ratio, n_dup_lines / n_lines as dup_line_ratio, stop_words / k as stop_word_ratio, run / k as same_as_before_ratio,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {" and ".join(checks)} as kept from q""",
        "op6_chat_format": f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values (-7, 0, 'user', '{MARKS}'), (-7, 1, 'assistant', '{MARKS}'))),
e as (select *, contains(text, '</s>') or contains(role, '</s>') or contains(role, '[/INST]') or starts_with(role, '\\') as esc from t),
r as (select *, case when esc then 1 + length({replaced.replace("(x,", "(role,")}) + length({replaced.replace("(x,", "(text,")}) else length(role) + length(text) end + 20 as n from e)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn), '')) as loss_sha256,
  sum(n)::bigint as formatted_chars from r group by conv_id""",
        "op8_ngram_jaccard": rf"""
with recursive d as (select doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '', ''), {words}) as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i+3], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) as i from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
sets as (select doc_id, md5(string_agg(g, chr(10) order by g)) as h from s group by doc_id),
first as (select h, min(doc_id) as rep from sets group by h),
u as (select s.* from s join first on s.doc_id = first.rep),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from u a join u b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 185 * k >= 85 * (p.n + q.n)),
both_ways as (select x, y from l union all select y, x from l),
reach(a, b) as (select rep, rep from first union select r.a, e.y from reach r join both_ways e on e.x = r.b),
low as (select a, min(b) as m from reach group by a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(low.m, d.doc_id) as component_id
from d left join n using (doc_id) left join sets using (doc_id) left join first using (h) left join low on low.a = first.rep""",
        "op8_ngram_links": rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {words}) as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i+3], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) as i from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
sets as (select doc_id, md5(string_agg(g, chr(10) order by g)) as h from s group by doc_id),
first as (select h, min(doc_id) as rep, count(*) as copies from sets group by h),
u as (select s.* from s join first on s.doc_id = first.rep),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from u a join u b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 185 * k >= 85 * (p.n + q.n)),
both_ways as (select x, y from l union all select y, x from l),
reach(a, b) as (select rep, rep from first union select r.a, e.y from reach r join both_ways e on e.x = r.b),
low as (select a, min(b) as m from reach group by a),
others as (select x, sum(copies) as links from both_ways join first on rep = y group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(low.m, d.doc_id) as component_id, coalesce(first.copies - 1 + coalesce(others.links, 0), 0)::bigint as n_links
from d left join n using (doc_id) left join sets using (doc_id) left join first using (h) left join low on low.a = first.rep left join others on others.x = first.rep""",
        "op9_url_filters": rf"""
with r(verdict, rhost, rpath) as (values {rules}),
p as (select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, coalesce(regexp_extract(url, '://[^/?#]*(/[^?#]*)', 1), '') as path from pages),
f as (select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(verdict, length(rhost || rpath)) as verdict
  from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select p.page_id, host, path, rule, coalesce(f.verdict, case when regexp_matches(host, '(^|[^a-z0-9])({"|".join(urlfilter.UNWANTED)})([^a-z0-9]|$)') then 'block' else 'allow' end) as verdict
from p left join f using (page_id)""",
    }
