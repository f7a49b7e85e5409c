"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.llm import (best_fit_ga, dialogue_repair, hmm_lm, length_histogram, line_rules, oracles, pii_boost, prefix_trie,
                        qda_quality, rans_tokens, secret_scan, simhash_mih, suffix_decontam, url_templates)
from civica.llm.common import held_out, read_table
from civica.session import scratch_path, ship_package

QUALITY_THRESHOLD = 0.3
END_ID = 2


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    return public_tokenizers.path(name)


#: Fixed by the contract: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled through the document whose number ends its path:
    bad if that document is of low quality or toxic."""
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id") \
        .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    path = url_templates.with_host_and_path(pages, "url")
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.[a-z]+|/)?$", 1)
    rows = path.withColumn("_number", number.try_cast("long"))
    labelled = rows.join(labels, rows["_number"] == labels["doc_id"], "left").select("page_id", "url", "bad")
    return url_templates.judge_urls(labelled, URL_RULES)


def op2_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.suffix_sums(length_histogram.length_histogram(
        read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op3_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_decontam.suffix_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                           places=False)
    items = F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))
    return suffix_decontam.contamination(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"), "contaminated",
        F.col("longest").alias("longest_match"))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.hmm_scores(read_table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(read_table(spark, sf_dir, "documents"), with_text=False)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_scan.secret_spans(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"),
                                     public_tokenizers.PATTERN)
    return secret_scan.secret_report(spans)


def op7_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_mih.simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_mih.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def packed(docs: DataFrame) -> DataFrame:
    return best_fit_ga.pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID)


def op8_best_fit_ga(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))


def op9_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    rans_tokens.write_token_files(read_table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), 1, False)
    return rans_tokens.read_token_files(spark, path, with_ids=False)


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learnt from."""
    return read_table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0)) \
        .select("doc_id", F.col("quality").alias("label"))


def op10_qda_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = qda_quality.quality_scores(read_table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir))
    return scores.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = dialogue_repair.damaged(read_table(spark, sf_dir, "conversations"))
    return dialogue_repair.repair_report(rows, dropped)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_symbols(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(turns))


def op13_pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.pii_report(pii_boost.pii_spans(read_table(spark, sf_dir, "documents")))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_templates, op2_length_histogram, op3_suffix_decontamination, op4_hmm,
                            op5_line_rules, op6_secret_scan, op7_simhash_mih, op8_best_fit_ga, op9_rans_tokens, op10_qda_quality,
                            op11_dialogue_repair, op12_prefix_trie, op13_pii_boost)
}
_ORACLE_SQL: dict[str, str] = {
    "op1_url_templates": oracles.url_templates_sql(URL_RULES),
    "op3_suffix_decontamination": oracles.DECONTAMINATION,
    "op5_line_rules": oracles.line_rules_sql(),
}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(f) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE_SQL)
