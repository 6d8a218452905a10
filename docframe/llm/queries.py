"""The operators' queries, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm import bpe, html_text, merkle, search, sharding, toxicity, wordpiece
from docframe.llm.common import documents
from docframe.llm.exact_dedup import exact_dedup
from docframe.llm.minhash import minhash_components
from docframe.llm.packing import pack
from docframe.llm.quality import quality
from docframe.llm.simhash import simhash_components
from docframe.llm.suffix_dedup import suffix_dedup


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), keep="largest")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).drop("removed", "row_hash")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(documents(spark, sf_dir), bpe.vocabulary_path(wordpiece.VOCABULARY))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old shards are those of the sources, by hash: a third of all rows lies in one of them."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(sharding.SHARDS))
    return sharding.reshard(documents(spark, sf_dir), old)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), bpe.vocabulary_path())


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), bpe.vocabulary_path())


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampering_check(documents(spark, sf_dir)).drop("source", "at")


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_simhash": op2_simhash,
        "op3_quality": op3_quality,
        "op4_token_counts": op4_token_counts,
        "op5_html_text": op5_html_text,
        "op6_toxicity": op6_toxicity,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_sharding": op8_sharding,
        "op9_packing": op9_packing,
        "op10_bpe": op10_bpe,
        "op11_search": op11_search,
        "op12_merkle": op12_merkle,
        "op13_minhash": op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": """
            select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(coalesce(d.text, '')) as text_sha256
            from documents d join (select coalesce(text, '') as t, max(doc_id) as keep_id, count(*) as group_size from documents group by 1) g
              on coalesce(d.text, '') = g.t""",
        "op11_search": r"""
            with found as (
              select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
              from documents),
            asked as (
              select row_number() over () as q, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
              from benchmark),
            wanted as (select q, item_id, t, count(*) as c from asked group by all),
            total as (select count(*) filter (len(ts) > 0) as n_docs, sum(len(ts))::bigint as n_terms from found),
            lengths as (select k, doc_id, len(ts)::bigint as n, 100 - 25 + ((25 * len(ts)::bigint * n_docs) // n_terms) as m from found, total where len(ts) > 0),
            held as (select k, t, count(*) as tf from (select k, unnest(ts) as t from found) where t in (select t from wanted) group by all),
            dfs as (select t, count(*) as df from held group by t),
            weights as (select t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint as w from dfs, total),
            scored as (
              select q, item_id, doc_id, k, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
              from wanted join held using (t) join weights using (t) join lengths using (k) group by all)
            select item_id, rank, doc_id, score
            from (select *, row_number() over (partition by q order by score desc, doc_id) as rank from scored where score > 0) where rank <= 20""",
    }
