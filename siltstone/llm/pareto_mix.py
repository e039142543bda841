"""Mixing sources to target weights by Pareto order sampling.

Every document has a rate: how often the mix should hold it. The whole part of the rate is given as
certain copies. The rest is an inclusion probability p, and one more copy goes to the documents with
the smallest u / (1 - u) divided by p / (1 - p), u being a number in (0, 1) drawn from the document's
id: the order sampling scheme that yields a fixed size with unequal probabilities. "Size" is measured
in words here: the order is followed until the source's target is met as nearly as one document allows.

`plan` reduces all that to one row per source with a cut-off in that order; `apply_plan` then decides
each document from its own columns, so that texts are never shuffled.

Nulls, blanks and ties: a null or blank text has size 0 and takes nothing; a null source is a source
of its own, ranked last; a null id is drawn as the text "null". Rows that agree in id and size share
their place in the order. An empty table gives an empty mix. Columns of `docs` other than the named
ones are passed through; names starting with `_mix_` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.keys import dense_key
from siltstone.session import pin

WORD = r"[^\x20\x09-\x0D]+"
_BINS = 4096


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(doc_id: str | Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone, with 48 random bits."""
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(f":{seed}"))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 48))


def _targets(sources: DataFrame, weights: Sequence[float], cap: float, share: float) -> DataFrame:
    """Targets by weight, none above `cap` times its source, the excess shared again.

    One level rises until nothing overflows anew; each step is one small aggregate over the sources.
    """
    ranked = dense_key(sources, [F.col("source").asc_nulls_last()], "rank", start=0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = pin(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    most = F.lit(float(cap)) * F.col("source_size")
    total, heavy = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (total or 0)
    level, full = (total / heavy if heavy else 0.0), 0
    while True:
        over = F.lit(level) * F.col("weight") > most
        held, rest, n = ranked.agg(
            F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))
        ).first()
        if n == full or not rest:
            return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), most))
        level, full = (total - (held or 0.0)) / rest, n


def _places(rate: Column, cap: float, seed: str, doc_id: str, size: str) -> tuple[Column, Column]:
    """Certain copies at `rate`, and the place in the sampling order (null: no further copy)."""
    rate = F.least(rate, F.lit(float(cap)))
    whole = F.floor(rate)
    u, p = uniform(doc_id, seed), rate - whole
    odds = (u / (1 - u)) / (p / (1 - p))
    order = F.struct(odds.alias("odds"), F.col(doc_id).cast("string").alias("id"), F.col(size).alias("size"))
    return whole, F.when(p > 0, order)


def _bin(order: str) -> Column:
    odds = F.col(f"{order}.odds")
    return F.floor(odds / (1 + odds) * _BINS)


RESULTS = ("source_size", "target", "copies", "taken")


def _rate(target: str, source_size: str, own: Column, mean: str) -> Column:
    return F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(0.0) * own / F.col(mean)


def _weight(weight: str | None) -> Column:
    return F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)


def plan(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3,
    share: float = 1.0,
    seed: str = "mix",
    doc_id: str = "doc_id",
    size: str = "size",
    source: str = "source",
    weight: str | None = None,
) -> DataFrame:
    """One row per source: source_size, target, mean weight, and the cut-off in the sampling order.

    `weights` go to the sources in order of their names and repeat; the mix is `share` of all sizes.
    `weight` names a positive column that makes a document's rate higher or lower within its source.
    """
    named = docs.select(
        F.col(source).alias("source"), F.col(doc_id).alias("_id"), F.col(size).alias("_size"), _weight(weight).alias("_own")
    )
    totals = pin(named.groupBy("source").agg(
        F.sum("_size").alias("source_size"), F.sum(F.col("_own") * F.col("_size")).alias("_weighed")
    ), "sources")
    targets = _targets(totals.select("source", "source_size"), weights, cap, share)
    mean = F.expr("if(source_size > 0 and _weighed > 0, _weighed / source_size, 1.0)")
    totals = totals.select(F.col("source").alias("_s"), mean.alias("mean_weight"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    targets = pin(targets.join(totals, same).drop("_s", "weight"), "sources")

    side = targets.withColumnRenamed("source", "_s")
    rate = _rate("target", "source_size", F.col("_own"), "mean_weight")
    whole, order = _places(rate, cap, seed, "_id", "_size")
    rated = named.join(side, same, "left").select("source", "_size", whole.alias("_whole"), order.alias("_order"))
    rated = rated.withColumn("_bin", _bin("_order"))
    # Sums per source and bin; then only the one bin per source in which the target is met is sorted.
    bins = rated.groupBy("source", "_bin").agg(
        F.sum(F.col("_whole") * F.col("_size")).alias("whole"),
        F.sum(F.when(F.col("_bin").isNotNull(), F.col("_size"))).alias("more"),
    )
    by_source = Window.partitionBy("source")
    upto = by_source.orderBy(F.col("_bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumns({
        "base": F.sum("whole").over(by_source), "after": F.coalesce(F.sum("more").over(upto), F.lit(0)),
    })
    bins = bins.withColumn("before", F.col("after") - F.coalesce("more", F.lit(0)))
    bins = bins.join(side.select("_s", "target"), same).drop("_s")
    bins = bins.withColumn("open", F.col("target") - F.col("base"))
    met = bins.filter("_bin is not null and before <= open").groupBy(F.col("source").alias("_s")).agg(
        F.max(F.struct("_bin", "before", "open")).alias("met")
    )
    last = rated.select("source", "_bin", "_size", "_order").join(
        pin(met.select("_s", "met.*").withColumnRenamed("_bin", "_b"), "bins"),
        same & (F.col("_bin") == F.col("_b")),
    )
    ranked = Window.partitionBy("source").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("upto", F.col("before") + F.sum("_size").over(ranked))
    within = F.col("upto") - F.col("_size") / 2 <= F.col("open")
    cuts = last.groupBy("source").agg(
        F.max(F.when(within, F.col("_order"))).alias("cut"), F.first("_bin").alias("bin")
    )
    cuts = cuts.select(F.col("source").alias("_s"), "cut", "bin")
    return pin(targets.join(cuts, same, "left").drop("_s"), "mix")


def apply_plan(
    docs: DataFrame,
    mix: DataFrame,
    *,
    cap: float = 3,
    seed: str = "mix",
    doc_id: str = "doc_id",
    size: str = "size",
    source: str = "source",
    weight: str | None = None,
) -> DataFrame:
    """`docs` with source_size, target, copies and taken (words, repeats counted).

    Columns of `docs` with these names are replaced. They cannot be the id, size, source or weight at the same
    time, and names that start with `_mix_` are taken.
    """
    inputs = {doc_id.lower(), size.lower(), source.lower(), (weight or "").lower()}
    if inputs & set(RESULTS) or any(c.lower().startswith("_mix_") for c in docs.columns):
        raise ValueError(f"{', '.join(RESULTS)} are results, and names that start with _mix_ are taken")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in RESULTS])
    columns = docs.columns
    side = mix.select(*[F.col(c).alias(f"_mix_{c}") for c in mix.columns])
    joined = docs.join(side, F.col(source).eqNullSafe(F.col("_mix_source")), "left")
    rate = _rate("_mix_target", "_mix_source_size", _weight(weight), "_mix_mean_weight")
    whole, order = _places(rate, cap, seed, doc_id, size)
    joined = joined.withColumns({"_mix_whole": whole, "_mix_order": order})
    more = (_bin("_mix_order") < F.col("_mix_bin")) | (F.col("_mix_order") <= F.col("_mix_cut"))
    copies = F.col("_mix_whole") + F.coalesce(more, F.lit(False)).cast("bigint")
    return joined.select(
        *columns,
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        copies.cast("bigint").alias("copies"),
        (copies * F.col(size)).cast("bigint").alias("taken"),
    )
