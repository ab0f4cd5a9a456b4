"""The thin queries of this subpackage over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.chat_format import format_conversations, read_formatted
from strata.llm.common import materialise
from strata.llm.conversation_repair import RepairParams, damage, repair_reports
from strata.llm.embedding_dedup import NearDupParams, near_duplicates
from strata.llm.html_extract import ExtractParams, extract_text
from strata.llm.quality_rules import quality_figures
from strata.llm.ranked_search import SearchParams, rank_documents
from strata.llm.registry import ORACLE_SQL, QUERIES, register
from strata.llm.repeated_text import RepeatParams, remove_repeats
from strata.llm.sentence_pieces import encode_digests
from strata.llm.simhash import SimHashParams, simhash_components
from strata.llm.source_mix import mix_sources
from strata.llm.token_blocks import read_tokens, tokens_folder, write_tokens
from strata.llm.url_filter import GlobRule, HostRule, filter_urls
from strata.llm.warc import archive_folder, read_records, write_archives
from strata.sources.tables import read_table

__all__ = ["ORACLE_SQL", "QUERIES"]

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"
END_ID = 2


@register("op10_quality_rules")
def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, tokeniser fertility and verdict of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_figures(docs, public_tokenizers.path(PIECE_MODEL))


@register("op5_sentence_pieces")
def sentence_pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with spans and decoded again, as digests."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_digests(docs, public_tokenizers.path(PIECE_MODEL))


@register("op7_token_blocks")
def token_blocks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as block files and read back."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return read_tokens(write_tokens(docs, tokens_folder(spark), public_tokenizers.path(BYTE_MODEL), END_ID))


@register("op9_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash_components(docs, SimHashParams(shingle_words=4, max_distance=4, seed=42))


URL_RULES = (
    HostRule("allow", "org", "/"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)
# Where no host rule fits: binary files, log-in and cart pages go, anything else stays.
URL_GLOBS = tuple(GlobRule("block", g) for g in (
    "*/**.pdf", "*/**.exe", "*/**.zip", "*/**.jpg", "*/**.png", "*/**/login", "*/**/login/**", "*/login", "*/login/**",
    "*/cart", "*/cart/**", "ads.*/**", "tracker.*/**",
))


@register("op1_url_filters", """
    WITH u AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), c AS (
      SELECT page_id, regexp_extract(rest, '^[^?#]*') AS rest FROM u
    ), p AS (
      SELECT page_id,
             translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path
      FROM c
    ), r AS (
      SELECT *, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
      END AS rule FROM p
    )
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, CASE
      WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
      WHEN rule IS NOT NULL THEN 'block'
      WHEN regexp_matches(path, '^/.*(\\.pdf|\\.exe|\\.zip|\\.jpg|\\.png)$', 's') THEN 'block'
      WHEN regexp_matches(path, '^/(.*/)?login(/.*)?$', 's') OR regexp_matches(path, '^/cart(/.*)?$', 's') THEN 'block'
      WHEN regexp_matches(host, '^(ads|tracker)\\.') AND starts_with(path, '/') THEN 'block'
      ELSE 'allow' END AS verdict
    FROM r
""")
def url_filters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return filter_urls(read_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, URL_GLOBS)


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@register("op4_chat_format", r"""
    WITH t AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), e AS (
      SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE)', '\1\\\2\3', 'g'))
                + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 WHEN 'system' THEN 16 END AS chars
      FROM t
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars) AS BIGINT) AS formatted_chars, false AS rewrites
    FROM e GROUP BY conv_id
""")
def chat_format_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings only, formatted, written and read back."""
    table = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                 F.lit(CONTROL_TEXT).alias("text")) for i, role in enumerate(("user", "assistant"))])).alias("t")).select("t.*")
    formatted = materialise(spark, format_conversations(table.unionByName(extra)), "formatted-conversations")
    return read_formatted(formatted)


@register("op3_warc", """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
    ), k AS (
      SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN keeper IS NOT NULL AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN keeper <> page_id THEN keeper END AS refers_to
    FROM p LEFT JOIN k USING (payload_digest)
""")
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back through the index."""
    index = write_archives(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), archive_folder(spark))
    return read_records(index).drop("url")


@register("op2_embedding_dedup")
def embedding_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every embedding."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), NearDupParams(threshold=0.9))

MIX_WEIGHTS = (5.0, 2.0, 1.0)


@register("op8_source_mix")
def source_mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix_sources(docs, MIX_WEIGHTS, cap=3.0).select("doc_id", "size", "source_size", "target", "taken")


@register("op6_repeated_text")
def repeated_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in repeated strings of 400 bytes, removed."""
    return remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"), RepeatParams(min_length=400))


@register("op11_html_extract", r"""
    WITH a AS (
      SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS body FROM pages
    ), l AS (
      SELECT page_id, url, list_transform(
        string_split(regexp_replace(body, '</?(?:p|h1)>', chr(1), 'g'), chr(1)),
        lambda x: trim(regexp_replace(
          regexp_replace(replace(replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '&quot;?', '"', 'g'),
                         '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS lines
      FROM (SELECT page_id, url, regexp_replace(body, '</?b>', '', 'g') AS body FROM a)
    ), t AS (
      SELECT page_id, url, array_to_string(list_filter(lines, lambda x: x <> ''), chr(10)) AS text FROM l
    )
    SELECT page_id, url, text, length(text) AS n_chars FROM t
""")
def html_extract_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), ExtractParams())


@register("op12_ranked_search", r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
    ), i AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ), t AS (
      SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM d
    ), p AS (
      SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY ALL
    ), w AS (
      SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM p, t GROUP BY term, n_docs
    ), s AS (
      SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // all_terms)))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN p USING (term), t GROUP BY item_id, doc_id
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 50
""")
def ranked_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return rank_documents(read_table(spark, sf_dir, "benchmark", "item_id", "text"),
                          read_table(spark, sf_dir, "documents", "doc_id", "text"), SearchParams(k=50))


@register("op13_conversation_repair")
def conversation_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    table = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair_reports(damage(table), table, RepairParams())
