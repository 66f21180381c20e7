"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cargolens.sources.tables import table


def op1_consensus_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.html_main import main_text
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "path")


def op2_context_mixing_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.lm_mixing import score_documents
    return score_documents(table(spark, sf_dir, "documents"))


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.shards import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.quality import line_quality
    return line_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "line_chars", "removed_chars")


def op5_exact_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from cargolens.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from cargolens.llm.tokens import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).drop("th")


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.mixing import pareto_mix
    return pareto_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.topk import top_k
    return top_k(table(spark, sf_dir, "embeddings"))


def op10_interval_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.repeats import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from cargolens.llm.token_files import document_checksums
    return document_checksums(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from cargolens.llm.alignment import align_documents
    return align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_bit_sliced_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargolens.llm.resampling import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


#: exact integer inner products of all query rows with all other rows
OP9_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
  from embeddings
  where embedding is not null and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda x: not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 50 = 0),
r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_ball_tree_top_k": OP9_SQL}
