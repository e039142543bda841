"""Document fingerprints from prefix polynomial hashes.

For a text with code points c_0..c_(n-1) the prefix array holds, for two prime moduli, the sums of
c_j * B^j over every prefix. Two spans are equal (but for a chance of about 2^-61) if the differences of
their prefix sums agree after both are brought to the same power of B, so any span equality costs a few
operations, and the longest common extension of two positions is found by binary search on its length.

The fingerprint of a text is the pair of whole-text sums with the length, as 24 hex digits. The likeness
of two prefix arrays is the longest common extension of the starts plus that of the ends (without
overlap), over the longer length; 1.0 for equal texts, empty ones included.

`with_next` puts every document beside the next one in descending id order (after the last: the first)
with one shuffle of the texts: ids are cut into ranges, each range is streamed in order by one task, and
only the first document of each range is sent to the range before it as well.

Nulls, blanks and ties: a null text is empty; null ids come last in descending order; rows that share an
id are ordered by their text. A single document is its own successor. An empty table gives an empty
result. Names starting with `_ph_` are reserved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


PRIMES = (2147483629, 2147483587)  # below 2^31, so that products fit 64 bits
BASES = (1103515245, 1299709111)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the bases 0..n-1; doubled in length when more are needed."""
    if not _POWERS:
        _POWERS.extend(np.ones(1, dtype=np.uint64) for _ in PRIMES)
    for k, (p, b) in enumerate(zip(PRIMES, BASES, strict=True)):
        while len(_POWERS[k]) < n:
            own = _POWERS[k]
            step = np.uint64(pow(b, len(own), p))
            _POWERS[k] = np.concatenate([own, own * step % np.uint64(p)])
    return _POWERS


@dataclass
class Prefix:
    """Prefix sums of one text for both moduli (unreduced sums of reduced terms)."""

    size: int
    sums: list[np.ndarray]

    def span(self, k: int, start: int, length: int) -> int:
        return int(self.sums[k][start + length] - self.sums[k][start]) % PRIMES[k]


def prefix(points: np.ndarray) -> Prefix:
    """Prefix arrays of code points."""
    n, sums = len(points), []
    terms = points.astype(np.uint64) + np.uint64(1)  # so that leading zeros count
    for p, power in zip(PRIMES, _powers(n + 1), strict=True):
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms * power[:n] % np.uint64(p), out=out[1:])
        sums.append(out)
    return Prefix(n, sums)


def equal_spans(a: Prefix, i: int, b: Prefix, j: int, length: int) -> bool:
    """Is a[i : i + length] equal to b[j : j + length]?"""
    power = _powers(max(i, j) + 1)
    return all(
        a.span(k, i, length) * int(power[k][j]) % p == b.span(k, j, length) * int(power[k][i]) % p
        for k, p in enumerate(PRIMES)
    )


def common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """Length of the longest common run that starts at a[i] and b[j]."""
    low, high = 0, min(a.size - i, b.size - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(a, i + low, b, j + low, middle - low):
            low = middle
        else:
            high = middle - 1
    return low


def common_end(a: Prefix, b: Prefix, most: int) -> int:
    """Length of the longest common ending, `most` at most."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(a, a.size - middle, b, b.size - middle, middle):
            low = middle
        else:
            high = middle - 1
    return low


def likeness(a: Prefix, b: Prefix) -> float:
    longest = max(a.size, b.size)
    if longest == 0:
        return 1.0
    start = common_extension(a, 0, b, 0)
    return (start + common_end(a, b, min(a.size, b.size) - start)) / longest


def fingerprint(a: Prefix) -> str:
    return "".join(f"{a.span(k, 0, a.size):08x}" for k in range(len(PRIMES))) + f"{a.size:08x}"


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _ranges(named: DataFrame, most_bytes: int, at_most: int) -> np.ndarray:
    """Bounds between ranges of ids, descending ranges of about `most_bytes` of text each."""
    rows, size = named.agg(F.count("_ph_id"), F.sum(F.octet_length("_ph_text"))).first()
    ranges = min(at_most, -(-int(size or 0) // most_bytes))
    if ranges <= 1 or not rows:
        return np.zeros(0)
    # About 50 ids a range are enough to place the bounds; every document goes to some range.
    some = named.filter("_ph_id is not null").select("_ph_id").sample(min(1.0, 50 * ranges / rows), seed=7)
    ids = some.toArrow().column(0).to_numpy().astype(np.float64)
    return np.unique(np.quantile(ids, np.arange(1, ranges) / ranges)) if len(ids) else np.zeros(0)


def with_next(
    docs: DataFrame,
    per_pair: Callable[[str, str], tuple],
    schema: str,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    bytes_per_range: int = 32 << 20,
    ranges_at_most: int = 20_000,
) -> DataFrame:
    """(doc_id, *per_pair(text, text of the next document)) for every document; ids are numbers."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(F.col(doc_id).alias("_ph_id"), F.coalesce(F.col(text), F.lit("")).alias("_ph_text"))
    bounds = _ranges(named, bytes_per_range, ranges_at_most)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        # Range 0 has the largest ids; null ids follow all others.
        values = ids.astype("float64").to_numpy()
        found = len(bounds) - np.searchsorted(bounds, values, side="left")
        return pd.Series(np.where(np.isnan(values), len(bounds), found).astype(np.int32))

    placed = named.withColumn("_ph_range", place("_ph_id") if len(bounds) else F.lit(0))
    first = placed.groupBy("_ph_range").agg(F.max("_ph_id").alias("_ph_head")).orderBy("_ph_range").collect()
    # One row per range: its head goes to the range before as well, that of the first to the last.
    heads = [(r["_ph_range"], r["_ph_head"], first[k - 1]["_ph_range"]) for k, r in enumerate(first)]
    heads = spark.createDataFrame(heads, f"_ph_range int, _ph_head {kind}, _ph_before int")
    headed = placed.join(F.broadcast(heads), "_ph_range")
    here = F.struct(F.col("_ph_range").alias("range"), F.lit(0).alias("closes"))
    back = F.struct(F.col("_ph_before").alias("range"), F.lit(1).alias("closes"))
    sent = F.when(F.col("_ph_id").eqNullSafe(F.col("_ph_head")), F.array(here, back)).otherwise(F.array(here))
    every = headed.select("_ph_id", "_ph_text", F.explode(sent).alias("_ph_to"))
    every = every.select("_ph_to.range", "_ph_id", "_ph_text", "_ph_to.closes")
    dealt = every.repartition(max(1, len(first)), "range").sortWithinPartitions(
        "range", "closes", F.col("_ph_id").desc_nulls_last(), "_ph_text"
    )
    result = f"doc_id {kind}, {schema}"
    arrow = to_arrow_schema(spark.createDataFrame([], result).schema)
    names, types = arrow.names, arrow.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out_ids, out = None, [], []

        def flush() -> pa.RecordBatch:
            values = list(zip(*out, strict=True))
            batch = pa.RecordBatch.from_arrays([pa.array(out_ids, types[0]), *[pa.array(v, t) for v, t in zip(values, types[1:], strict=True)]], names=names)
            out_ids.clear()
            out.clear()
            return batch

        for batch in batches:
            for k in range(batch.num_rows):
                closes, ident, own = batch.column(3)[k].as_py(), batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
                if held is not None:
                    out_ids.append(held[0])
                    out.append(per_pair(held[1], own))
                # Rows that share a head's id close the range before once; the first of them does.
                held = None if closes else (ident, own)
                if len(out) >= 2000:
                    yield flush()
        if out:
            yield flush()

    return dealt.mapInArrow(run, result)


@lru_cache(maxsize=2)
def prefix_of(text: str) -> Prefix:
    """A document is met twice in a row: as the next one, then as the own one."""
    return prefix(points_of(text))


def describe(own: str, after: str) -> tuple:
    """Fingerprints of a text, of the text with its last third replaced by the start of the next one, and likenesses."""
    points, other = points_of(own), points_of(after)
    third = len(points) // 3
    edited = np.concatenate([points[: len(points) - third], other[:third]])
    a, b, c = prefix_of(own), prefix(edited), prefix_of(after)
    digest = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
    return len(points), digest, fingerprint(a), fingerprint(b), likeness(a, b), likeness(a, c)


DESCRIBED = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    return with_next(docs, describe, DESCRIBED, **options)
