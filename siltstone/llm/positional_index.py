"""Benchmark decontamination with a distributed positional inverted index.

`build_index` turns the training documents into blocks of a few megabytes; a block is one row that
holds, for every term, the sorted word positions at which it occurs, documents being laid one after
another with a gap that no phrase can span. The index is a table in the shared folder.

`find` looks up windows of test words. In each block a window starts from its rarest term there; the
position lists of the others, shifted by their offsets in the window, are intersected with what is left,
rarest first. With `slop` 0 that gives exact phrases; with `slop` s every word may be up to s places off
its place relative to the rarest one (proximity).

Terms are kept as 64-bit hashes. If the test terms are few enough (`TERMS_AT_MOST`), postings of other
terms, which nobody can ask for, are left out of the index; otherwise all terms are kept. Windows go to
the blocks in batches of bounded size.

Nulls, blanks and ties: a null or blank text has no words and gets a row without hits; an item without
words has no windows; items that share an id count as one; a null id stands as null. Every row of the
documents is reported on its own, also when rows repeat. Empty tables give empty or hit-free results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.packed import LETTER_DIGIT, chunks, word_hashes, words
from siltstone.session import pin

GAP = 1024
TERMS_AT_MOST = 1 << 22
BATCH_BYTES = 4 << 20


def _hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes of every text."""
    out: list[np.ndarray] = []
    for chunk in chunks(pa.array(texts, pa.string())):
        found = words(chunk, LETTER_DIGIT)
        out.extend(np.split(word_hashes(found), found.rows[1:-1]))
    return out


def _members(h: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every value in the sorted `terms`, and whether it is there."""
    at = np.minimum(np.searchsorted(terms, h), max(0, len(terms) - 1))
    return at, terms[at] == h if len(terms) else np.zeros(len(h), dtype=bool)


def test_terms(items: DataFrame, text: str = "text") -> np.ndarray | None:
    """Sorted hashes of all words of the items, or None if there are more than `TERMS_AT_MOST`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                own = np.unique(word_hashes(words(chunk, LETTER_DIGIT)))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["term"])

    found = items.select(F.col(text).alias("text")).mapInArrow(run, "term bigint").distinct()
    rows = found.limit(TERMS_AT_MOST + 1).toArrow().column(0).to_numpy()
    return None if len(rows) > TERMS_AT_MOST else np.sort(rows.view(np.uint64))


_INDEX = "block bigint, doc_ids array<{kind}>, lengths array<int>, terms binary, counts binary, postings binary"


def build_index(docs: DataFrame, terms: np.ndarray | None = None, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per block of documents: ids, numbers of words, terms, postings per term, positions."""
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(terms)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, block = kept.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk, LETTER_DIGIT)
                lengths = np.diff(found.rows)
                h = word_hashes(found)
                at = np.arange(len(h)) + np.repeat(np.arange(len(lengths)) * GAP, lengths)
                if terms is not None:
                    known = _members(h, terms)[1]
                    h, at = h[known], at[known]
                order = np.argsort(h, kind="stable")
                own, counts = np.unique(h[order], return_counts=True)
                ids = batch.column(0).slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([own.tobytes()], pa.binary()),
                        pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([at[order].astype(np.int64).tobytes() if len(at) and at[-1] >> 32 else at[order].astype(np.uint32).tobytes()], pa.binary()),
                    ],
                    names=["block", "doc_ids", "lengths", "terms", "counts", "postings"],
                )
                block += 1

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return pin(rows.mapInArrow(run, _INDEX.format(kind=kind)), "positions")


@dataclass
class Windows:
    """A batch of windows: term numbers (-1 pads), number of words, number of the item; and the items."""

    vocabulary: np.ndarray
    terms: np.ndarray
    sizes: np.ndarray
    item: np.ndarray
    names: list[str | None]


def make_windows(rows: list[tuple[str | None, str | None]], size: int) -> Windows:
    """Windows of `size` consecutive words of (item id, text); a shorter item is one window."""
    names = sorted({name for name, _ in rows}, key=lambda n: (n is None, n or ""))
    number = {name: k for k, name in enumerate(names)}
    hashed = _hashes([text for _, text in rows])
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]))
    found: set[tuple[int, tuple[int, ...]]] = set()
    for (name, _), h in zip(rows, hashed, strict=True):
        own = np.searchsorted(vocabulary, h).tolist()
        for k in range(max(1, len(own) - size + 1) if own else 0):
            found.add((number[name], tuple(own[k : k + size])))
    every = sorted(found)
    terms = np.full((len(every), size), -1, dtype=np.int64)
    for k, (_, w) in enumerate(every):
        terms[k, : len(w)] = w
    sizes = (terms >= 0).sum(axis=1)
    return Windows(vocabulary, terms, sizes, np.array([i for i, _ in every], dtype=np.int64), names)


def match_block(w: Windows, terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, slop: int) -> list[tuple[int, np.ndarray]]:
    """(window, start positions) for the windows that occur in a block."""
    place, known = _members(w.vocabulary, terms)
    starts = np.concatenate([[0], np.cumsum(counts)])
    often = np.where(known, counts.astype(np.int64)[place] if len(counts) else 0, 0)  # by number in the vocabulary
    found = []
    per_word = np.where(w.terms >= 0, often[w.terms] if len(often) else 0, np.iinfo(np.int64).max)
    for k in np.flatnonzero(per_word.min(axis=1) > 0) if len(per_word) else ():
        offsets = np.argsort(per_word[k, : w.sizes[k]], kind="stable")
        left = None
        for o in offsets:
            t = place[w.terms[k, o]]
            own = postings[starts[t] : starts[t + 1]].astype(np.int64)
            if left is None:
                left = own - o
                continue
            low = np.searchsorted(own, left + o - slop)
            ok = low < len(own)
            ok[ok] = own[low[ok]] <= left[ok] + o + slop
            left = left[ok]
            if not len(left):
                break
        if len(left):
            found.append((int(k), left))
    return found


_MATCH = "block bigint, row int, hits array<int>, items array<string>"


def _find(index: DataFrame, windows: Windows, slop: int) -> DataFrame:
    """(block, row, hits, items) for documents with an occurrence; hits are word numbers in the text."""
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for block, lengths, terms, counts, postings in zip(*[batch.column(k) for k in range(5)], strict=True):
                lengths = np.asarray(lengths.values, dtype=np.int64)
                base = np.concatenate([[0], np.cumsum(lengths)]) + np.arange(len(lengths) + 1) * GAP
                counts = np.frombuffer(counts.as_buffer(), dtype=np.int32)
                raw = postings.as_buffer()
                positions = np.frombuffer(raw, dtype=np.int64 if counts.sum() * 8 == raw.size and raw.size else np.uint32)
                found = match_block(w, np.frombuffer(terms.as_buffer(), dtype=np.uint64), counts, positions, slop)
                if not found:
                    continue
                mark = np.zeros(base[-1] + 1 + GAP, dtype=np.int32)
                pairs = set()
                for k, at in found:
                    # With slop a first word may lie before its document; the span is cut to the document.
                    doc = np.searchsorted(base, at + w.sizes[k] // 2, side="right") - 1
                    low = np.clip(at - slop, base[doc], base[doc] + lengths[doc])
                    high = np.clip(at + w.sizes[k] + slop, base[doc], base[doc] + lengths[doc])
                    np.add.at(mark, low, 1)
                    np.add.at(mark, high, -1)
                    pairs.update((int(d), int(w.item[k])) for d in np.unique(doc))
                hit = np.cumsum(mark) > 0
                items: dict[int, list[str | None]] = {}
                for d, i in sorted(pairs):
                    items.setdefault(d, []).append(w.names[i])
                hits = [np.flatnonzero(hit[base[d] : base[d] + lengths[d]]).astype(np.int32) for d in items]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.as_py()] * len(items), pa.int64()),
                        pa.array(list(items), pa.int32()),
                        pa.array(hits, pa.list_(pa.int32())),
                        pa.array(list(items.values()), pa.list_(pa.string())),
                    ],
                    names=["block", "row", "hits", "items"],
                )

    return index.select("block", "lengths", "terms", "counts", "postings").mapInArrow(run, _MATCH)


def find(
    index: DataFrame, items: DataFrame, *, size: int = 10, slop: int = 0, text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """(doc_id, n_words, hits, items) for every indexed document.

    `hits` are the numbers of the words inside an occurrence of a window, `items` the distinct ids (as
    text) of items with an occurring window; both are empty where nothing occurs.
    """
    if slop >= GAP or size + slop >= GAP:
        raise ValueError(f"size and slop together stay below {GAP}")
    named = items.select(F.col(item_id).cast("string").alias("name"), F.col(text).alias("text"))
    bytes_, rows = named.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    batches = 1 + max((bytes_ or 0) // BATCH_BYTES, rows // (1 << 16))
    bucket = F.pmod(F.xxhash64("name"), F.lit(batches))
    parts = []
    for k in range(batches):
        batch = [(r.name, r.text) for r in named.filter(bucket == k).select("name", "text").toLocalIterator()]
        parts.append(_find(index, make_windows(batch, size), slop))
    found = parts[0]
    if batches > 1:
        for more in parts[1:]:
            found = found.union(more)
        found = found.groupBy("block", "row").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    docs = index.select("block", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("row", "doc"))
    docs = docs.select("block", "row", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.lengths").cast("bigint").alias("n_words"))
    joined = docs.join(pin(found, "matches"), ["block", "row"], "left")
    return joined.select(
        "doc_id", "n_words",
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(
    docs: DataFrame, items: DataFrame, *, size: int = 10, slop: int = 0, text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """Index the documents for the words of the items and report occurrences per document (see `find`)."""
    index = build_index(docs, test_terms(items, item_text), text=text, doc_id=doc_id)
    return find(index, items, size=size, slop=slop, text=item_text, item_id=item_id)
