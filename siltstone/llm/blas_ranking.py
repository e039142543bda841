"""Ranked lexical search by dense matrix products over compact vocabulary tiles.

The items' terms make a vocabulary; each document is reduced to the vocabulary terms it holds and their
counts. A term's impact in a document is an integer that does not depend on the item, so the scores of a
tile of documents for a tile of items are one product: impacts (documents x terms) times membership
(terms x items, 0 or 1) in float64. A tile's terms are only those of its items. Terms are cut into tiles
once more where the largest possible partial sum would reach 2^53, so every product is exact; the partial
sums of several tiles are added as 64-bit integers.

Each task keeps the best documents of every item over all of its tiles. A tile's candidates are the
scores that reach the item's present k-th best, equal scores included; ties are settled by ascending id
before anything is dropped. A window over the items then ranks what the tasks kept.

Items are taken in rounds of bounded size: a round's terms and membership are what is sent to every task
(at most ROUND_BYTES of terms and ROUND_ITEMS items); more items take more rounds over the documents.

Nulls, ties and repeated rows: a null or blank text has no terms; a document without terms counts
nowhere, an item without terms has no rows. Every row of items is an item of its own and every row of
documents a document of its own, also where ids repeat; null ids rank behind all others of the same score.
Empty tables give empty results. Very long texts are counted whole. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.packed import LETTER_DIGIT, Chunk, chunks, words
from siltstone.operators.keys import dense_key
from siltstone.session import pin

ROUND_BYTES = 16 << 20
ROUND_ITEMS = 1 << 14
ITEM_TILE = 256
DOC_TILE = 256
EXACT = 1 << 53
PER_TERM = 1_000_000  # (10^9 * tf) div (1000 * tf + 20 * m) stays below it, as m is at least 50

POSTINGS = "doc_id bigint, n bigint, codes binary, counts binary"
FOUND = "item bigint, doc_id bigint, score bigint"


def terms(chunk: Chunk) -> tuple[pa.Array, np.ndarray]:
    """All terms of a chunk, and for each row the place of its first one (and of the end)."""
    w = words(chunk, LETTER_DIGIT)
    size = w.ends - w.starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    held = w.data[np.repeat(w.starts - offsets[:-1], size) + np.arange(offsets[-1])]
    array = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(held)])
    return array, w.rows


def _item_terms(items: DataFrame) -> DataFrame:
    """(item, term) of `items` (item, text), each term of an item once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                array, rows = terms(chunk)
                own = np.repeat(np.arange(chunk.first, chunk.last), np.diff(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), array], names=["item", "term"])

    return items.mapInArrow(run, "item bigint, term binary").distinct()


@dataclass
class Round:
    """A batch of items: its terms in order, and the pairs (item, term) as numbers."""

    vocabulary: pa.Array
    item: np.ndarray
    code: np.ndarray

    def tiles(self, weight: np.ndarray) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """(items, [(codes, membership)]): tiles of items, and the vocabulary tiles of each."""
        known = np.unique(self.item)
        for k in range(0, len(known), ITEM_TILE):
            items = known[k : k + ITEM_TILE]
            own = np.isin(self.item, items)
            codes, column = np.unique(self.code[own], return_inverse=True)
            member = np.zeros((len(codes), len(items)))
            member[column, np.searchsorted(items, self.item[own])] = 1.0
            yield items, [(codes[a:b], member[a:b]) for a, b in exact_cuts(weight[codes])]


def exact_cuts(weight: np.ndarray) -> list[tuple[int, int]]:
    """Runs of terms whose impacts sum to less than 2^53 in any document."""
    cuts, first, total = [], 0, 0
    for k, w in enumerate(weight.tolist()):
        most = w * PER_TERM
        if total + most >= EXACT and k > first:
            cuts.append((first, k))
            first, total = k, 0
        total += most
    return [*cuts, (first, len(weight))]


def postings(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """POSTINGS of `docs` (doc_id, text): vocabulary terms and their counts, for rows with any term at all."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        width = max(len(known), 1)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                array, rows = terms(chunk)
                code = pc.index_in(array, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
                hit = code >= 0
                found, count = np.unique(row[hit] * width + code[hit], return_counts=True)
                bounds = np.searchsorted(found, np.arange(len(rows)) * width)
                codes, counts = (found % width).astype(np.int32), count.astype(np.int32)
                any_term = np.flatnonzero(np.diff(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(any_term + chunk.first)),
                        pa.array(np.diff(rows)[any_term]),
                        pa.array([codes[bounds[k] : bounds[k + 1]].tobytes() for k in any_term], pa.binary()),
                        pa.array([counts[bounds[k] : bounds[k + 1]].tobytes() for k in any_term], pa.binary()),
                    ],
                    names=["doc_id", "n", "codes", "counts"],
                )

    return docs.mapInArrow(run, POSTINGS)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Number of documents of `rows` (POSTINGS) that hold each of the `size` terms; one number a term meets on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.int32)
            total += np.bincount(codes, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["code", "df"])

    found = rows.select("codes").mapInArrow(run, "code bigint, df bigint").groupBy("code").agg(F.sum("df").alias("df"))
    out = np.zeros(size, dtype=np.int64)
    table = found.toPandas()
    out[table["code"].to_numpy(np.int64)] = table["df"].to_numpy(np.int64)
    return out


def weights(total: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for df in frequency.tolist()], dtype=np.int64)


class Best:
    """The best `k` documents of every item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, dtype=np.int64)
        self.held = [np.zeros(0, dtype=np.int64)] * 4  # item, score, 1 for a null id, id
        self.waiting: list[list[np.ndarray]] = []
        self.room = 0

    def add(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        """Scores (documents x items) of a tile."""
        doc, item = np.nonzero(scores >= self.floor)
        self.waiting.append([item, scores[doc, item], null[doc], ids[doc]])
        self.room += len(item)
        if self.room > 4 * self.k * len(self.floor):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, null, ids = (np.concatenate(parts) for parts in zip(self.held, *self.waiting, strict=True))
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        start = np.searchsorted(item, np.arange(len(self.floor)))
        place = np.arange(len(item)) - start[item]
        keep = place < self.k
        self.held = [column[order][keep] for column in (score, null, ids)]
        self.held.insert(0, item[keep])
        last = place == self.k - 1
        self.floor[item[last]] = score[order][last]
        self.waiting, self.room = [], 0
        return self.held


def impacts(n: np.ndarray, code: np.ndarray, count: np.ndarray, doc: np.ndarray, weight: np.ndarray, total: int, length: int) -> np.ndarray:
    """Impact of each posting (doc, code, count); n: terms of each document."""
    m = 100 - 50 + (50 * n * total) // max(length, 1)
    count = count.astype(np.int64)
    return weight[code] * ((1_000_000_000 * count) // (1000 * count + 20 * m[doc]))


def _best(rows: DataFrame, items: Round, weight: np.ndarray, total: int, length: int, k: int) -> DataFrame:
    """FOUND: the best `k` rows of every item in each partition of `rows` (POSTINGS)."""
    held = rows.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = held.value
        tiles = [(own, parts, Best(len(own), k)) for own, parts in items.tiles(weight)]
        column = np.full(len(weight), -1, dtype=np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(first, DOC_TILE)
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                codes = [np.frombuffer(x, dtype=np.int32) for x in part.column(2).to_pylist()]
                code = np.concatenate(codes)
                count = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.int32)
                doc = np.repeat(np.arange(part.num_rows), [len(x) for x in codes])
                impact = impacts(part.column(1).to_numpy(), code, count, doc, weight, total, length)
                for _, parts, best in tiles:
                    scores = np.zeros((part.num_rows, len(best.floor)), dtype=np.int64)
                    for own, member in parts:
                        column[own] = np.arange(len(own))
                        at = column[code]
                        hit = at >= 0
                        dense = np.zeros((part.num_rows, len(own)))
                        dense[doc[hit], at[hit]] = impact[hit]
                        scores += (dense @ member).astype(np.int64)
                        column[own] = -1
                    best.add(scores, null, ids)
        for own, _, best in tiles:
            item, score, null, ids = best.settle()
            yield pa.RecordBatch.from_arrays([pa.array(own[item]), pa.array(ids, mask=null > 0), pa.array(score)], names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, FOUND)


def _rounds(numbered: DataFrame, known: DataFrame) -> Iterator[Round]:
    """Items of `known` (item, term) in consecutive batches of bounded size."""
    sizes = known.groupBy((F.col("item") / ITEM_TILE).cast("bigint").alias("tile")).agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    first, last, held = 0, 0, 0
    spans = []
    for tile, size in sizes.orderBy("tile").toLocalIterator():  # one number for 256 items
        if held and (held + size > ROUND_BYTES or (tile - first + 1) * ITEM_TILE > ROUND_ITEMS):
            spans.append((first, last))
            first, held = tile, 0
        last, held = tile, held + size
    if held:
        spans.append((first, last))
    for low, high in spans:
        table = known.filter(F.col("item").between(low * ITEM_TILE, high * ITEM_TILE + ITEM_TILE - 1)).toArrow()
        column = table.column("term").combine_chunks()
        vocabulary = pc.unique(column).cast(pa.binary())
        vocabulary = vocabulary.take(pc.array_sort_indices(vocabulary))
        code = pc.index_in(column.cast(pa.binary()), value_set=vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        yield Round(vocabulary, table.column("item").to_numpy().astype(np.int64), code)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best rows of `docs` (doc_id, text) for every row of `items` (item_id, text)."""
    numbered = pin(dense_key(items.select("item_id", "text"), ["item_id", "text"], "item", start=0), "items")
    known = pin(_item_terms(numbered.select("item", "text")), "item_terms")
    found = None
    for batch in _rounds(numbered, known):
        rows = pin(postings(docs.select("doc_id", "text"), batch.vocabulary), "postings")
        total, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = weights(total, document_frequencies(rows, len(batch.vocabulary)))
        best = pin(_best(rows, batch, weight, total, length, k), "best")
        found = best if found is None else found.union(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
