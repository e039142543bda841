"""The corpus pipeline: quality, near copies, repeated passages, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as
the next stage's docs. All stages but the last return the columns of documents (doc_id, text, lang,
source, n_chars); the last adds copies, the number of times the mix holds a document.

Nulls and ties follow the operators. A null text is a blank text. Rows that share an id are documents of
their own: near_copies keeps one row of every group of linked texts, whatever their ids, and rows that are
the same in every column are one. Rows without an id rank last in near_copies and repeated_passages; a
leak in one of them removes them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import pareto_mix, positional_index, rule_ensemble, simhash_gph, unit_dedup
from siltstone.session import pin

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ACCEPTED = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the rule ensemble accepts."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = rule_ensemble.fit(rule_ensemble.statistics(docs.select("doc_id", "text")).join(labels, "doc_id"), "quality")
    found = rule_ensemble.statistics(docs.select(*COLUMNS, F.col("text").alias("_body")), text="_body")
    return found.filter(rule_ensemble.score_column(model) >= ACCEPTED).select(*COLUMNS)


def _row_key() -> Column:
    """128 bits of all columns of a row: rows of one key are the same in every column."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in COLUMNS]
    return F.md5(F.concat_ws("\x00", *parts).cast("binary"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked SimHash fingerprints: the one with the smallest id, ties by digest."""
    found = simhash_gph.near_duplicates(docs, row=_row_key())
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    kept = pin(first.select(F.col("first.row").alias("_same")), "kept")
    # Texts are dealt out once: by the key that is joined and then made unique.
    own = docs.select(*COLUMNS, _row_key().alias("_same")).join(kept, "_same", "left_semi")
    return own.dropDuplicates(["_same"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that occur earlier; a document that loses all its words goes."""
    done = unit_dedup.dedup_units(docs.select(*COLUMNS))
    whole = (F.size("removed") == 0) | F.col("text").rlike(pareto_mix.WORD)
    n_chars = F.when(F.size("removed") == 0, F.col("n_chars")).otherwise(F.length("text")).cast("bigint")
    return done.filter(whole).withColumn("n_chars", n_chars).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a window of a benchmark item."""
    found = positional_index.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    leaked = pin(found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("_leaked")).distinct(), "leaked")
    return docs.join(leaked, F.col("doc_id").eqNullSafe(F.col("_leaked")), "left_anti").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents the mix takes, with their number of copies."""
    sized = docs.select(*COLUMNS, pareto_mix.word_count("text").alias("size"))
    mix = pareto_mix.plan(pin(sized.select("doc_id", "source", "size"), "sized"))
    mixed = pareto_mix.apply_plan(sized, mix)
    return mixed.filter("copies > 0").select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each pinned in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name)
    return docs


# The classifier's fit and the shingle hashes are not stated in SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None
