"""SimHash near-duplicates found by the general pigeonhole principle.

Two fingerprints of 64 bits are linked when they differ in at most `distance` bits. The bits are
grouped into parts, correlated bits together, and part i gets a threshold t_i of its own, -1 meaning
that it is not looked at. If the t_i sum to distance - parts + 1, linked fingerprints are within t_i in
some part i. Thresholds are chosen by dynamic programming on candidate counts estimated from a bounded
sample, so the sample affects cost alone, never the result.

Copies are folded first: all further work is on distinct fingerprints. A bucket of more than
`bucket_cap` fingerprints is never paired. Its members instead list the values one bit away from them:
at distance 2 or less, two fingerprints have such a value in common, and all that share one are linked.
At most 65 fingerprints can share a value, so that way is exact and bounded as well.

Nulls, blanks and ties: a null or blank text has fingerprint 0 and is linked like any other. Rows may
repeat; a null id takes part, and a component's id is the smallest id that is not null. An empty table
gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.packed import LOWER
from siltstone.session import pin

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit b is set if it is set in over half the XXH64 values of the shingles, as a signed long."""
    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= shingle:
        pieces = [b" ".join(tokens)]
    else:
        pieces = map(b" ".join, zip(*[tokens[k:] for k in range(shingle)], strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(p, SEED) for p in pieces), dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(h), 1 << 16):
        part = h[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, row: Column | None = None
) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text. `row` is passed through as a column of that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), shingle) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(fps, pa.int64())], names=out.names)

    more = [] if row is None else [row.alias("row")]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *more)
    out = rows.drop("text").schema.add("fp", "long")
    return rows.mapInArrow(run, out)


def _bit_groups(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size, correlated ones together."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    spread = bits.std(axis=0)
    scaled = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1.0)
    likeness = np.abs(scaled.T @ scaled) / max(1, len(sample))
    np.fill_diagonal(likeness, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (likeness[b, list(free)].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: (likeness[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _within(sample: np.ndarray, mask: int, most: int) -> np.ndarray:
    """Share of ordered pairs of the sample within 0..most bits under the mask."""
    part, found = sample & np.uint64(mask), np.zeros(most + 1)
    for row in part:
        found += np.bincount(np.minimum(np.bitwise_count(part ^ row), most + 1), minlength=most + 2)[: most + 1]
    return np.cumsum(found) / max(1, len(part)) ** 2


def allocate(sample: Sequence[int], n: int, distance: int, parts: int) -> list[tuple[int, int]]:
    """(mask, threshold) per part, thresholds summing to distance - parts + 1 at the least estimated cost.

    Cost is the number of candidate pairs among `n` fingerprints plus the probes sent. Parts with
    threshold -1 are left out. Deterministic; an empty sample gives equal guesses.
    """
    values = np.array([x & (2**BITS - 1) for x in sample], dtype=np.uint64)
    groups = _bit_groups(values, parts) if len(values) else [list(range(k, BITS, parts)) for k in range(parts)]
    masks = [sum(1 << b for b in g) for g in groups]
    cost = []
    for mask, group in zip(masks, groups, strict=True):
        share = _within(values, mask, distance) if len(values) else np.zeros(distance + 1)
        probes = np.cumsum([len(list(combinations(group, t))) if t < 3 else float("inf") for t in range(distance + 1)])
        cost.append([0.0, *(share * n * n / 2 + probes * n)])  # index t + 1
    # best[s]: least cost with thresholds (each raised by 1) summing to s
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for own in cost:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for s, (c, chosen) in best.items():
            for t, more in enumerate(own):
                key, value = s + t, (c + more, (*chosen, t - 1))
                if key not in step or value < step[key]:
                    step[key] = value
        best = step
    chosen = best[distance + 1][1]
    return [(m, t) for m, t in zip(masks, chosen, strict=True) if t >= 0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(mask: int, most: int) -> list[int]:
    """All changes of at most `most` bits under the mask, as signed longs."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    return [_signed(sum(1 << b for b in c)) for t in range(most + 1) for c in combinations(bits, t)]


def near_pairs(
    prints: DataFrame, *, distance: int = 2, parts: int = 3, bucket_cap: int = 64, sample_size: int = 2048
) -> DataFrame:
    """(a, b), a < b: links between the distinct fingerprints `prints` (fp).

    Links found by way of an oversized bucket are given as stars, so that everything within `distance`
    is connected and every link is true; other links are given in full. `distance` is at most 2.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distance is 0, 1 or 2")
    n = prints.count()
    sample = prints.orderBy(F.xxhash64("fp", F.lit(1)), "fp").limit(sample_size).collect()
    chosen = allocate([r.fp for r in sample], n, distance, parts)

    keys = [F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for k, (m, _) in enumerate(chosen)]
    index = prints.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.part", "key.value")
    index = pin(index, "index")
    large = pin(index.groupBy("part", "value").count().filter(F.col("count") > bucket_cap).drop("count"), "large")

    flips = F.create_map(*[x for k, (m, t) in enumerate(chosen) for x in (F.lit(k), F.array(*map(F.lit, _flips(m, t))))])
    probes = index.select("fp", "part", F.explode(F.transform(F.element_at(flips, F.col("part")), lambda f: F.col("value").bitwiseXOR(f))).alias("value"))

    small = index.join(large, ["part", "value"], "left_anti")
    other = probes.withColumnRenamed("fp", "other")
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    paired = small.join(other, ["part", "value"]).filter((F.col("fp") != F.col("other")) & (differ <= distance))
    paired = paired.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))

    crowded = probes.join(large, ["part", "value"], "left_semi").select("fp").distinct()
    around = F.array(*[F.lit(x) for x in _flips(2**BITS - 1, 1 if distance else 0)])
    shared = crowded.select("fp", F.explode(F.transform(around, lambda f: F.col("fp").bitwiseXOR(f))).alias("value"))
    if distance == 1:  # a value one bit off links at 2 bits: keep the pair's own values only
        ball = crowded.select("fp", F.explode(F.transform(around, lambda f: F.col("fp").bitwiseXOR(f))).alias("other"))
        stars = ball.join(crowded.withColumnRenamed("fp", "other"), "other").filter("fp < other").select(F.col("fp").alias("a"), F.col("other").alias("b"))
    else:
        groups = shared.groupBy("value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
        stars = groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return paired.union(stars).distinct()


def near_duplicates(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 2, row: Column | None = None
) -> DataFrame:
    """(doc_id, row if given, fp, root, component_id): each fingerprint, one that stands for all it is linked to,
    and the smallest id of these. Where ids repeat, only `root` tells components apart."""
    own = pin(fingerprints(docs, text=text, doc_id=doc_id, shingle=shingle, row=row), "fingerprints")
    classes = pin(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(near_pairs(classes.select("fp"), distance=distance)).withColumnRenamed("node", "fp")
    rooted = classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = pin(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "labels")
    return own.join(labels, "fp").select(*own.columns, "root", "component_id")
