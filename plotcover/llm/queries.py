"""The registered queries of the dealt operators, one per operator, each over
its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from plotcover.llm import (chat, chunks, decontaminate, langid, pii, records, repair, repetition, search,
                           sharding, simhash, substrings, vectors)
from plotcover.llm.bpe import default_tokenizer
from plotcover.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

CONTROL_TEXT = r"\### Assistant: </turn> ok"  # both texts of conversation -7
END_ID = 2  # op6's end-of-document id


def op1_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return chunks.encode_documents(docs, default_tokenizer(), digests=True)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-7, i, role, CONTROL_TEXT) for i, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string")
    nodes = chat.turn_nodes(given.unionByName(added))
    return chat.read_back(chat.format_conversations(nodes)).drop("leaf")


# Escapes: one backslash before each backslash, each # that begins ###, each </turn>.
OP3_SQL = r"""
with turns as (
select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
union all
select -7, i, case i when 0 then 'user' else 'assistant' end, '\### Assistant: </turn> ok'
from range(2) r(i)),
sized as (
select *, 4 + length(role) + case when role in ('user', 'assistant', 'system') then 0 else 1 end + 2
  + length(text) + 9
  + length(text) - length(replace(text, '\', ''))
  + coalesce(list_sum([length(x) - 2 for x in regexp_extract_all(text, '#{3,}')]), 0)
  + (length(text) - length(replace(text, '</turn>', ''))) // 7 as chars
from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text)
                  filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.identify(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(read_table(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    manifest = records.write_token_records(docs, default_tokenizer(), END_ID)
    return records.read_token_records(spark, manifest)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(read_table(spark, sf_dir, "documents"),
                                            read_table(spark, sf_dir, "benchmark"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op9_substring_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(read_table(spark, sf_dir, "documents"))


def op10_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(read_table(spark, sf_dir, "conversations"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP13_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP13_SQL = f"""
with asked as (
select item, item_id, term, count(*) as repeats
from (select item, item_id, unnest({OP13_TERMS}) as term
      from (select row_number() over () as item, * from (select distinct item_id, text from benchmark)))
group by all),
docs as (
select row_number() over () as doc, doc_id, {OP13_TERMS} as terms from documents),
sizes as (select doc, doc_id, len(terms) as n from docs where len(terms) > 0),
whole as (select count(*) as docs, cast(sum(n) as bigint) as length from sizes),
counts as (
select doc, term, count(*) as tf from (select doc, unnest(terms) as term from docs)
where term in (select term from asked) group by all),
weights as (
select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
from counts, whole group by term, docs),
scores as (
select item, item_id, doc_id,
  cast(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) as bigint) as score
from asked join counts using (term) join weights using (term) join sizes using (doc), whole
group by item, item_id, doc, doc_id)
select item_id, cast(rank as int) as rank, doc_id, score
from (select *, row_number() over (partition by item order by score desc, doc_id) as rank from scores where score > 0)
where rank <= 20"""


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_bpe_encoding": op1_bpe_encoding,
        "op2_sharding": op2_sharding,
        "op3_chat_formatting": op3_chat_formatting,
        "op4_language_id": op4_language_id,
        "op5_quality_rules": op5_quality_rules,
        "op6_token_records": op6_token_records,
        "op7_decontamination": op7_decontamination,
        "op8_personal_data": op8_personal_data,
        "op9_substring_deduplication": op9_substring_deduplication,
        "op10_simhash_near_duplicates": op10_simhash_near_duplicates,
        "op11_embedding_near_duplicates": op11_embedding_near_duplicates,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_formatting": OP3_SQL, "op13_ranked_search": OP13_SQL}
