"""Near copies by HyperMinHash: compressed registers propose and estimate, full shingle sets decide.

A text is the set of its runs of `shingle` words (A-Z in lower case; a shorter text is one run). Its
sketch has BUCKETS registers of 16 bits. A shingle's hash names a bucket, and a bucket keeps the smallest
rest of a hash as its number of leading zeros (6 bits) and the MANTISSA bits that follow the leading one.
Buckets that stay empty are filled from up to ROUNDS hashes more and then from one hash of their own, so
that every register is the minimum of one random order of all shingles: two registers agree with the
probability of the sets' Jaccard similarity, for small sets too.

Texts with the same words in the same order are folded into classes first, by a digest of 128 bits. Each
class gets BANDS keys, packed from ROWS registers each; classes that share a key are candidates. At a
similarity of 0.8 a pair misses every key with a probability of 5e-8. The share of equal registers, less
the expected share of accidental agreement (from the set sizes), estimates the similarity; pairs more than
SLACK below the threshold go, which a pair at the threshold does with a probability under 1e-8. All others
are compared on their full sets.

Only components are asked for, so a key's classes need not be compared all with all. Keys with at most
SMALL classes are compared in pairs. In a larger one everything is compared with one pivot, the class that
shares the most keys with the most others; in a group of near copies that is one close to their common
origin, and linked classes become components. Keys that still hold several components are narrowed down
by two exact bounds. A class cannot have more in common with another than those of its shingles that occur
in any other class of these keys at all. And, with the keys of one largest component taken together and p
the shingles that most of their classes have: two sets that share no shingle outside p have at most as much
in common as either has with p. So a pair is left if both overlap p enough, or if it shares one of the rare
shingles outside p; these make new, small keys. In what large keys there are among them, classes outside of
the largest component become pivots, round by round, and meet the classes of other components that the
bounds allow, until no two components are left to compare. No pair that shares a key and could join two
components is left out.

Nulls, blanks and ties: a text without words has an empty set and is linked with nothing. Rows may repeat;
a null id takes part, and a component's id is the smallest id that is not null (null if there is none). An
empty table gives an empty result. Very long texts are taken whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.packed import Chunk, Words, chunks, mixed, powers, word_hashes, words
from siltstone.session import pin

BUCKETS, ROWS, BANDS = 128, 4, 32  # BUCKETS = ROWS * BANDS
MANTISSA = 10
ROUNDS = 4
SLACK = 0.22
SMALL = 8
PIVOTS = 16
ROWS_A_TASK = 1 << 13  # of the documents or pairs; a task that writes a table costs more than some thousand rows do

_REST = 57  # bits of a hash behind its bucket number
_ODD = np.uint64(0xD6E8FEB86659FD93)
_ODD_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_SALTS = np.random.Generator(np.random.PCG64(1212)).integers(0, 1 << 64, ROUNDS + 1 + BUCKETS, dtype=np.uint64)
_AT_ONCE = 1 << 20


def _kept(df: DataFrame, label: str, rows: int) -> DataFrame:
    """`pin`, written by as many tasks as a table that goes with `rows` documents or pairs is worth."""
    return pin(df.coalesce(1 + rows // ROWS_A_TASK), label)


def _text_digests(w: Words) -> list[bytes | None]:
    """128-bit digest of the words of each row, null without words."""
    size = w.ends - w.starts
    offsets = np.concatenate([[0], np.cumsum(size + 1)])
    held = np.full(offsets[-1], 0x20, dtype=np.uint8)
    letters = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    held[letters] = w.data[np.repeat(w.starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())] if len(size) else held
    data, at = memoryview(held), offsets[w.rows]
    return [hashlib.md5(data[a:b]).digest() if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def shingle_sets(chunk: Chunk, shingle: int) -> tuple[np.ndarray, np.ndarray, Words]:
    """(hashes, bounds, words): row i has the distinct sorted shingles hashes[bounds[i]:bounds[i + 1]]."""
    w = words(chunk)
    n, size = len(w.starts), np.diff(w.rows)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    if n:
        np.cumsum(word_hashes(w) * powers(_ODD, n), out=prefix[1:])
    inverse = powers(_ODD_INVERSE, n + 1)
    count = np.where(size > 0, np.maximum(size - shingle + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(size)), count)
    first = w.rows[row] + np.arange(bounds[-1]) - bounds[row]
    last = np.minimum(first + shingle, w.rows[row + 1])
    hashes = mixed((prefix[last] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64))
    order = np.lexsort((hashes, row))
    hashes = hashes[order]  # row is in order already
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(len(size) + 1)), w


def _packed(rest: np.ndarray, step: int) -> np.ndarray:
    """Registers of the smallest rests: leading zeros and mantissa, marked by the step that filled them."""
    # Doubles hold the position of the leading one; a rest of zero has all zeros.
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    length -= (rest < (np.uint64(1) << np.maximum(length - 1, 0).astype(np.uint64))) & (length > 0)
    zeros = np.minimum(_REST - length, 63).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(64 - _REST + 1))) >> np.uint64(64 - MANTISSA)
    return (zeros << np.uint64(MANTISSA) | mantissa ^ np.uint64(step * 0x155 & 0x3FF)).astype(np.uint16)


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, BUCKETS) sketches of the sets hashes[bounds[i]:bounds[i + 1]]; rows without shingles are zero."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    out = np.zeros((n, BUCKETS), dtype=np.uint16)
    empty = np.ones((n, BUCKETS), dtype=bool)
    empty[size == 0] = False
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    for step in range(ROUNDS + 1):
        open_rows = np.flatnonzero(empty.any(axis=1))
        if len(open_rows) == 0:
            return out
        own = size[open_rows]
        at = np.repeat(np.arange(len(open_rows)), own)
        place = np.repeat(bounds[open_rows] - np.concatenate([[0], np.cumsum(own)[:-1]]), own) + np.arange(own.sum())
        h = mixed(hashes[place] ^ _SALTS[step])
        least = np.full(len(open_rows) * BUCKETS, none)
        np.minimum.at(least, at * BUCKETS + (h & np.uint64(BUCKETS - 1)).astype(np.int64), h >> np.uint64(64 - _REST))
        least = least.reshape(-1, BUCKETS)
        fill = empty[open_rows] & (least != none)
        values = out[open_rows]
        values[fill] = _packed(least[fill], step)
        out[open_rows] = values
        empty[open_rows] &= ~fill
    row, bucket = np.nonzero(empty)
    cost = np.concatenate([[0], np.cumsum(size[row])])
    first = 0
    while first < len(row):
        last = max(int(np.searchsorted(cost, cost[first] + _AT_ONCE, side="right")) - 1, first + 1)
        r, b, own = row[first:last], bucket[first:last], size[row[first:last]]
        starts = np.concatenate([[0], np.cumsum(own)[:-1]])
        place = np.repeat(bounds[r] - starts, own) + np.arange(own.sum())
        h = mixed(hashes[place] ^ np.repeat(_SALTS[ROUNDS + 1 + b], own)) >> np.uint64(64 - _REST)
        out[r, b] = _packed(np.minimum.reduceat(h, starts), ROUNDS + 1)
        first = last
    return out


def accidental(sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Expected share of registers that agree although their shingles differ, from the two set sizes.

    In a bucket with a load of x shingles the smallest rest has the density x * exp(-x * u); two rests agree
    when they fall into the same cell, and the cells between 2^-(k+1) and 2^-k are 2^-(k+1+MANTISSA) wide.
    """
    x, y = (np.maximum(s / BUCKETS, 1.0)[:, None] for s in (sizes_a, sizes_b))
    high = 0.5 ** np.arange(_REST)[None, :]
    low = high / 2
    both = x + y
    inside = x * y / both * (np.exp(-both * low) - np.exp(-both * high)) * (low / (1 << MANTISSA))
    return inside.sum(axis=1) / ((1 - np.exp(-x)) * (1 - np.exp(-y)))[:, 0]


def estimates(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers (pairs x BUCKETS), corrected for accidental agreement."""
    chance = accidental(sizes_a, sizes_b)
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, digest, n_shingles, registers) of `docs` (doc_id, text); digest and registers are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                hashes, bounds, w = shingle_sets(chunk, shingle)
                size = np.diff(bounds)
                held = registers(hashes, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.last - chunk.first),
                        pa.array(_text_digests(w), pa.binary()),
                        pa.array(size),
                        pa.array([held[k].tobytes() if size[k] else None for k in range(len(size))], pa.binary()),
                    ],
                    names=["doc_id", "digest", "n_shingles", "registers"],
                )

    return docs.mapInArrow(run, "doc_id bigint, digest binary, n_shingles bigint, registers binary")


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(digest, held) of `rows` (text): the sorted distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                hashes, bounds, w = shingle_sets(chunk, shingle)
                held = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(_text_digests(w), pa.binary()), pa.array(held, pa.binary())], names=["digest", "held"])

    return rows.select("text").mapInArrow(run, "digest binary, held binary")


def _members(classes: DataFrame) -> DataFrame:
    """(key, cls): the packed registers of every band."""
    band = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * _ODD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint64).reshape(-1, BANDS)
            own = batch.column(0).take(pa.array(np.repeat(np.arange(len(held)), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(mixed(held + band).view(np.int64).ravel()), own], names=["key", "cls"])

    return classes.select("cls", "registers").mapInArrow(run, "key bigint, cls bigint")


def _may_link(sizes_a: np.ndarray, sizes_b: np.ndarray, x: pa.Array, y: pa.Array, least: float) -> np.ndarray:
    """Whether the estimate from the registers reaches `least` less SLACK and the set sizes allow it, per pair."""
    keep = np.minimum(sizes_a, sizes_b) >= least * np.maximum(sizes_a, sizes_b) - 1e-9
    for k in range(0, len(keep), 4096):
        part = slice(k, k + 4096)
        held = (np.frombuffer(b"".join(c[part].to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for c in (x, y))
        keep[part] &= estimates(*held, sizes_a[part], sizes_b[part]) >= least - SLACK
    return keep


def _likely(pairs: DataFrame, classes: DataFrame, least: float, count: int) -> DataFrame:
    """Those of the `count` pairs (a, b) whose estimate reaches `least` less SLACK and whose sizes allow it."""
    own = classes.select("cls", "n_shingles", "registers")
    first = pairs.join(own.toDF("a", "size_a", "x"), "a")
    both = first.join(own.toDF("b", "size_b", "y"), "b").select("a", "b", "size_a", "size_b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array(_may_link(batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4), batch.column(5), least))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.coalesce(1 + count // ROWS_A_TASK).mapInArrow(run, "a bigint, b bigint")


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their sets x and y.

    If `pairs` have sizes and registers (size_a, size_b, p, q), sets are compared only where these allow it.
    """
    estimated = "p" in pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            if estimated:
                keep = _may_link(batch.column(4).to_numpy(), batch.column(5).to_numpy(), batch.column(6), batch.column(7), percent / 100)
            for k in np.flatnonzero(keep).tolist():
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[k] = 100 * common >= percent * (len(both) - common)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    columns = ["a", "b", "x", "y", *(["size_a", "size_b", "p", "q"] if estimated else [])]
    return pairs.select(*columns).mapInArrow(run, "a bigint, b bigint")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs (cls, other) as (a, b), a < b, each once."""
    return pairs.filter("cls <> other").select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def links(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int, rows: int, sets: DataFrame | None = None
) -> DataFrame:
    """The pairs (a, b) that are links: estimated from registers, then confirmed on the full sets.

    The sets are drawn from the texts of likely pairs, unless `sets` (cls, n, registers, held) has them already.
    `rows` is the number of documents.
    """
    pairs = _kept(pairs, "pairs", rows)
    count = pairs.count()
    if sets is not None:
        first = pairs.join(sets.toDF("a", "size_a", "p", "x"), "a")
        return _similar(first.join(sets.toDF("b", "size_b", "q", "y"), "b").coalesce(1 + count // ROWS_A_TASK), percent)
    likely = pin(_likely(pairs, classes, percent / 100, count), "likely")
    asked = likely.select(F.col("a").alias("cls")).union(likely.select(F.col("b").alias("cls"))).distinct()
    sets = _class_sets(docs, classes, asked, shingle, rows)
    tasks = 1 + likely.count() // ROWS_A_TASK
    first = likely.join(sets.select(F.col("cls").alias("a"), F.col("held").alias("x")), "a")
    both = first.join(sets.select(F.col("cls").alias("b"), F.col("held").alias("y")), "b")
    return _similar(both.coalesce(tasks), percent)


def _class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int, rows: int, sized: bool = False) -> DataFrame:
    """(cls, held): the sets of the classes `wanted` (cls), from one text each; if `sized`, (cls, n, registers, held)."""
    asked = _kept(classes.select("cls", "digest", "least").join(wanted, "cls", "left_semi"), "asked", rows)
    ids = asked.select(F.col("least").alias("_asked")).distinct()
    # Rows that share an id may have other texts: the digest decides again.
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_asked")), "left_semi")
    sets = _sets(texts, shingle).groupBy("digest").agg(F.first("held").alias("held")).join(asked.select("cls", "digest"), "digest")
    if sized:
        sets = sets.join(classes.select("digest", F.col("n_shingles").alias("n"), "registers"), "digest")
    return _kept(sets.select("cls", *(["n", "registers"] if sized else []), "held"), "sets", rows)


def _first_pairs(members: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare first, and the members (key, cls) of larger keys without the pivots they met."""
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = _kept(members.join(buckets, "key"), "shared", rows)
    few = shared.filter(F.col("size") <= SMALL).groupBy("key").agg(F.collect_set("cls").alias("all"))
    full = few.select(F.explode("all").alias("cls"), "all").select("cls", F.explode("all").alias("other")).filter("cls < other")
    large = shared.filter(F.col("size") > SMALL)
    central = large.groupBy("cls").agg(F.sum("size").alias("weight"))
    large = _kept(large.select("key", "cls").join(central, "cls"), "large", rows)
    pivots = large.groupBy("key").agg(F.max(F.struct("weight", "cls")).alias("top")).select("key", F.col("top.cls").alias("pivot"))
    stars = _kept(large.select("key", "cls").join(pivots, "key"), "stars", rows)
    return _ordered(stars.select("cls", F.col("pivot").alias("other")).union(full)), stars.filter("cls <> pivot").select("key", "cls")


def _open(members: DataFrame, roots: DataFrame, rows: int) -> DataFrame:
    """Members (key, cls, ..., root) of the keys that hold more than one component."""
    placed = members.drop("root").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    placed = _kept(placed, "placed", rows)
    spans = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    return _kept(placed.join(spans, "key", "left_semi"), "open", rows)


def _spread_out(rows: DataFrame) -> DataFrame:
    """One row per shingle of the sets `held`, the last column; the columns before are whole numbers and repeat."""
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                held = [np.frombuffer(x, np.int64) for x in part.column(len(names)).to_pylist()]
                at = pa.array(np.repeat(np.arange(len(held)), [len(x) for x in held]))
                yield pa.RecordBatch.from_arrays([*[part.column(i).take(at) for i in range(len(names))], pa.array(np.concatenate(held))], names=[*names, "hash"])

    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*names, "hash"]))


def _bounded(members: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """`members` (key, cls, root) that may have a link in their key, with their size `n` and `cap`.

    `cap` is how many of a class's shingles occur in any other class of these keys; it bounds the intersection
    with every one of them. In a key whose smallest set has `least_n` shingles, the similarity is then at most
    cap / (n + max(least_n, cap) - cap).
    """
    every = _spread_out(sets.select("cls", "held"))
    alone = every.groupBy("hash").agg(F.count(F.lit(1)).alias("times"), F.min("cls").alias("cls")).filter("times = 1")
    alone = alone.groupBy("cls").agg(F.count(F.lit(1)).alias("alone"))
    sized = sets.select("cls", "n").join(alone, "cls", "left").select("cls", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("cap"))
    placed = _kept(members.join(sized, "cls"), "bounded", rows)
    least = placed.groupBy("key").agg(F.min("n").alias("least_n"))
    union = F.col("n") + F.greatest("least_n", "cap") - F.col("cap")
    return placed.join(least, "key").filter(100 * F.col("cap") >= percent * union).drop("least_n")


def _parts(members: DataFrame) -> DataFrame:
    """(key, root, size): the components of every key and their numbers of members."""
    return members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))


def _largest(parts: DataFrame) -> DataFrame:
    """(key, root): the component with the most members of every key, from its `_parts`."""
    return parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("top")).select("key", F.col("top.root").alias("root"))


def _narrowed(members: DataFrame, sets: DataFrame, percent: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of different components that overlap the common shingles enough, and new keys of rare shingles.

    Members are (key, cls, root, n, cap), as in the result. Keys with the same largest component make a frame;
    p is what more than half of its classes have.
    """
    frames = _largest(_parts(members)).select("key", F.col("root").alias("frame"))
    placed = members.join(frames, "key").select("frame", "cls", "root", "n", "cap").distinct()
    placed = _kept(placed, "frames", rows)
    shingles = pin(_spread_out(placed.join(sets.select("cls", "held"), "cls").select("frame", "cls", "root", "n", "cap", "held")), "shingles")
    sizes = placed.groupBy("frame").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least_n"))
    counts = shingles.groupBy("frame", "hash").agg(
        F.count(F.lit(1)).alias("times"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    counts = _kept(counts.filter("times > 1").join(sizes.select("frame", "classes"), "frame"), "counts", rows)
    common = counts.filter("2 * times > classes").select("frame", "hash")
    rare = counts.filter("2 * times <= classes and low <> high").select("frame", "hash")
    keys = shingles.join(rare, ["frame", "hash"]).select(F.xxhash64("frame", "hash").alias("key"), "cls", "root", "n", "cap")

    inside = shingles.join(common, ["frame", "hash"], "left_semi").groupBy("frame", "cls").agg(F.count(F.lit(1)).alias("inside"))
    near = placed.join(inside, ["frame", "cls"]).join(sizes.select("frame", "least_n"), "frame")
    near = _kept(near.filter((100 + percent) * F.col("inside") >= percent * (F.col("n") + F.col("least_n"))), "near", rows)
    other = near.filter("root <> frame").select("frame", *[F.col(c).alias(f"other_{c}") for c in ("cls", "root", "n", "inside")])
    enough = (100 + percent) * F.least("inside", "other_inside") >= percent * (F.col("n") + F.col("other_n"))
    met = near.join(other, "frame").filter((F.col("root") != F.col("other_root")) & enough)
    return _ordered(met.select("cls", F.col("other_cls").alias("other"))), keys.distinct()


def _more_pairs(members: DataFrame, count: int, percent: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of different components for up to `count` pivots a key, and the members that are left."""
    parts = _parts(members)
    rest = parts.join(_largest(parts), ["key", "root"], "left_anti")
    order = Window.partitionBy("key").orderBy("size", "root", "cls")
    outside = members.join(rest, ["key", "root"]).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= count)
    pivots = _kept(outside.select("key", *[F.col(c).alias(f"other_{c}") for c in ("cls", "root", "n", "cap")]), "pivots", rows)
    common = F.least("cap", "other_cap")
    may = (F.col("root") != F.col("other_root")) & (100 * common >= percent * (F.col("n") + F.col("other_n") - common))
    met = members.join(pivots, "key").filter(may).select("cls", F.col("other_cls").alias("other"))
    left = members.join(pivots.select("key", F.col("other_cls").alias("cls")), ["key", "cls"], "left_anti")
    return _ordered(met), left


def _joined(roots: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """`roots` (cls, root) after the links `found` (a, b): only components that they join are worked on."""
    def side(name: str) -> DataFrame:
        return roots.select(F.col("cls").alias(name), F.col("root").alias(f"root_{name}"))

    named = found.join(side("a"), "a", "left").join(side("b"), "b", "left")
    edges = named.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    moved = components(edges).toDF("cls", "to")
    if not moved.limit(1).count():
        return roots
    after = roots.join(moved.toDF("root", "to"), "root", "left").select("cls", F.coalesce("to", "root").alias("root"))
    # Classes without a link so far are their own roots.
    return _kept(after.union(moved.join(roots, "cls", "left_anti").select("cls", F.col("to").alias("root"))), "roots", rows)


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): set sizes and the smallest id each row is linked to."""
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    own = pin(sketches(texts, shingle), "sketches")
    rows = own.count()
    worded = own.filter("digest is not null")
    classes = worded.groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    )
    classes = _kept(classes.withColumn("cls", F.monotonically_increasing_id()), "classes", rows)
    pairs, open_members = _first_pairs(pin(_members(classes), "members"), rows)
    roots = components(links(texts, classes, pairs, shingle, percent, rows)).withColumnRenamed("node", "cls")
    members = _open(open_members, roots, rows)
    if members.limit(1).count():
        sets = _class_sets(texts, classes, members.select("cls").distinct(), shingle, rows, sized=True)
        members = _open(_bounded(members, sets, percent, rows), roots, rows)
        pairs, members = _narrowed(members, sets, percent, rows)
        roots = _joined(roots, links(texts, classes, pairs, shingle, percent, rows, sets), rows)
        members, count = _open(members, roots, rows), PIVOTS
        while members.limit(1).count():
            pairs, left = _more_pairs(members, count, percent, rows)
            roots = _joined(roots, links(texts, classes, pairs, shingle, percent, rows, sets), rows)
            members = _open(left, roots, rows)
            count *= 4
    rooted = classes.select("digest", "least", "cls").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = _kept(rooted.select("digest", "root").join(smallest, "root").select("digest", "component_id"), "labels", rows)
    alone = own.filter("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = worded.select("doc_id", "n_shingles", "digest").join(labels, "digest").select("doc_id", "n_shingles", "component_id")
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
