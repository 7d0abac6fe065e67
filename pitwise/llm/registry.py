"""The queries of this subpackage over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.llm import (
    four_russians,
    lattice_lm,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    preference,
    quality,
    secrets,
    spelling,
    sql,
    template,
    token_counts,
    vantage,
)
from pitwise.llm.common import ship, table, tokenizer_path, word_count

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary of operators 1 and 9.
BYTE_BPE = "byte_bpe_50k.json"
#: The pieces of operator 6.
PIECES = "piece_bpe_32k.model"


def op1_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return secrets.digest(found)


def op3_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4))


def op4_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"))


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op6_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_documents(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op7_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents")))


def op8_template_deduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract(table(spark, sf_dir, "pages"))


def op9_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op10_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_replies(table(spark, sf_dir, "conversations"))
    return preference.digest(preference.format_pairs(pairs))


def op11_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), rate=97)


def op12_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return four_russians.hard_negatives(four_russians.shifted_labels(table(spark, sf_dir, "embeddings")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


def base_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 5 counts before any rule is learned."""
    docs = table(spark, sf_dir, "documents")
    stats = quality.with_features(quality.text_stats(docs, keep=[docs["doc_id"]]))
    return quality.digest(quality.decided(stats.withColumn("doc_id", F.col("keep.doc_id")), [])).drop("kept", "rule")


def base_unigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of operator 6, to six places."""
    scored = lattice_lm.score_documents(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))
    return scored.drop("score").withColumn("base_score", F.round("base_score", 6))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7's sources with their targets, to three places."""
    sizes = table(spark, sf_dir, "documents").select("source", word_count(F.col("text")).alias("size"))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    return mixing.targets(totals).withColumn("target", F.round("target", 3))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    own = [
        op1_cost_balanced_packing,
        op2_secret_ledger,
        op3_min_max_hash,
        op4_vantage_trees,
        op5_decision_list,
        op6_subword_lattice,
        op7_splitting_tree_mix,
        op8_template_deduction,
        op9_heap_token_counts,
        op10_preference_formatting,
        op11_pivotal_grams,
        op12_four_russians,
        op13_line_dedup,
        base_quality_counts,
        base_unigram_scores,
        mix_targets,
    ]
    return {q.__name__: _shipped(q) for q in own}


def oracle_sql() -> dict[str, str]:
    """Of the others, the tests hold the results against brute force; their base columns have queries of their own."""
    return {
        "op2_secret_ledger": sql.SECRETS,
        "op3_min_max_hash": sql.NEAR_DUPLICATES,
        "op4_vantage_trees": sql.NEAREST,
        "op10_preference_formatting": sql.PREFERENCES,
        "op11_pivotal_grams": sql.SPELLING,
        "op12_four_russians": sql.HARD_NEGATIVES,
        "op13_line_dedup": sql.LINES,
        "base_quality_counts": sql.QUALITY_COUNTS,
        "base_unigram_scores": sql.UNIGRAM_SCORES,
        "mix_targets": sql.MIX_TARGETS,
    }
