"""Queries of this package, and the same result in SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    blas_ranking,
    chat_prefix,
    hyper_minhash,
    merkle_manifest,
    ngram_trie,
    pareto_mix,
    positional_index,
    prefix_hash,
    rank_profiles,
    rule_ensemble,
    simhash_gph,
    unit_dedup,
    warc_index,
)
from siltstone.llm.queries_sql import OP8_SQL, OP9_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from siltstone.session import pin, scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    root = scratch_path(spark, "warc")
    captures = warc_index.write_archives(pages, f"{root}/archives")
    manifest = warc_index.write_index(captures, f"{root}/index")
    keys = pages.select("url").distinct().mapInPandas(_url_keys, "key string")
    found = warc_index.fetch(warc_index.lookup(keys, manifest, f"{root}/index"), f"{root}/archives", payloads=False)
    return found.drop("payload", "url")


def _url_keys(frames):
    for frame in frames:
        yield frame["url"].map(warc_index.url_key).to_frame("key")


def op2_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    formatted = pin(chat_prefix.format_conversations(turns.union(added)), "formatted")
    return chat_prefix.read_examples(chat_prefix.expand(formatted, rest=True))


def _bucket(doc_id: str, parts: int):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def op3_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", _bucket("doc_id", 7) == 2)
    return ngram_trie.score(docs)[0]


def op4_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    learned = rank_profiles.learn(docs.filter(_bucket("doc_id", 3) != 1))
    found = rank_profiles.predict(docs, rank_profiles.collect_profiles(learned))
    return found.select("doc_id", (_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = pin(rule_ensemble.statistics(docs), "statistics")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").filter(_bucket("doc_id", 5) != 0)
    model = rule_ensemble.fit(stats.join(labels, "doc_id"), "quality")
    score = rule_ensemble.score_column(model)
    scored = stats.select("doc_id", (_bucket("doc_id", 5) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.fingerprints(_table(spark, sf_dir, "documents"))


def op7_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = unit_dedup.dedup_units(docs)
    lost = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "text", "removed", F.size("removed").cast("bigint").alias("n_removed"), lost.alias("removed_chars"))


def op8_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    ids = F.transform("items", lambda x: F.coalesce(x, F.lit("null")))
    return found.select(
        "doc_id", "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(ids)).cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = pin(docs.select("doc_id", "source", pareto_mix.word_count("text").alias("size")), "sized")
    mixed = pareto_mix.apply_plan(sized, pareto_mix.plan(sized))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_simhash_gph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_gph.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_blas_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blas_ranking.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.audit(_table(spark, sf_dir, "documents"), merkle_manifest.tampered_text())


QUERIES: dict[str, Query] = {
    "op1_warc_index": op1_warc_index,
    "op2_chat_prefix": op2_chat_prefix,
    "op3_ngram_trie": op3_ngram_trie,
    "op4_rank_profiles": op4_rank_profiles,
    "op5_rule_ensemble": op5_rule_ensemble,
    "op6_prefix_hash": op6_prefix_hash,
    "op7_unit_dedup": op7_unit_dedup,
    "op8_positional_index": op8_positional_index,
    "op9_pareto_mix": op9_pareto_mix,
    "op10_simhash_gph": op10_simhash_gph,
    "op11_blas_ranking": op11_blas_ranking,
    "op12_hyper_minhash": op12_hyper_minhash,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op8_positional_index": OP8_SQL, "op9_pareto_mix": OP9_SQL, "op11_blas_ranking": OP11_SQL,
    "op12_hyper_minhash": OP12_SQL, "op13_merkle_manifest": OP13_SQL,
}
