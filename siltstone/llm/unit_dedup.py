"""Substring dedup by hashing lines, parts of lines, and windows of words.

Words are compared in lower case (A-Z) with one space between them. Three things are hashed:

* whole lines, of any length in the default mode and of `evidence` words or more in line mode;
* units, the pieces of a line that end in punctuation: the shortest run of whole units with at least
  `evidence` words that begins at a unit;
* windows of `min_words` words, whatever their punctuation. Hashing all of them would multiply the
  input, so runs of a few words are chosen by their hashes alone (winnowing): every window holds a chosen
  run, equal windows the same one. All windows that hold a chosen run which occurs twice are hashed.

Digests of all documents are grouped. The occurrence in the smallest doc_id, and there the first, is
kept; the words under any other occurrence are marked, so every run of `min_words` words that occurs
earlier is marked to its last word. Whole lines are cut whatever their length; other marked stretches are
cut if they have at least `min_words` words. White space after a cut goes too; the cuts are returned as
code point offsets into the original text, so text and cuts together give the original's layout.
Line mode hashes lines alone.

Nulls, blanks and ties: a null text stays null; texts that repeat nothing stay as they are; a
null id ranks last; rows that share an id count as one document when occurrences are ranked, each being
cut on its own. Empty tables give empty results. A column that has the name of the cuts is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.packed import Chunk, Words, chunks, mixed, powers, word_hashes, words
from siltstone.session import pin

_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".,;:!?"]] = True
_LAST = (1 << 63) - 1
_ODD = np.uint64(0xD6E8FEB86659FD93)
_ODD_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


@dataclass
class Evidence:
    """Hashed runs of units: row, first and one past the last word, digest, earlier in the same row."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    digest: np.ndarray
    again: np.ndarray


def evidence(chunk: Chunk, w: Words, unit: str, least: int) -> Evidence:
    """The runs of whole units that stand for a chunk's rows."""
    n = len(w.starts)
    row_of = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Evidence(none, none, none, none.astype(np.uint64), none.astype(bool))
    newlines = np.concatenate([[0], np.cumsum(w.data == 10)])
    closes = np.ones(n, dtype=bool)
    closes[:-1] = (newlines[w.starts[1:]] > newlines[w.ends[:-1]]) | (row_of[1:] != row_of[:-1])
    if unit != "line":
        closes |= _STOPS[w.data[w.ends - 1]]
    stop = np.flatnonzero(closes) + 1
    start = np.concatenate([[0], stop[:-1]])
    row = row_of[start]
    end_of_row = w.rows[row + 1]
    if unit == "line":
        first, last = start, stop
        keep = last - first >= least
    else:
        at = np.searchsorted(stop, start + least)
        last = np.where(at < len(stop), stop[np.minimum(at, len(stop) - 1)], n + 1)
        # Near the end of a row, the last run that is long enough also covers the rest.
        short = last > end_of_row
        back = np.searchsorted(start, end_of_row - least, side="right") - 1
        first = np.where(short, start[np.maximum(back, 0)], start)
        last = np.where(short, end_of_row, last)
        keep = (first >= w.rows[row]) & (last - first >= least)
        keep[1:] &= ~(short[1:] & short[:-1] & (row[1:] == row[:-1]))
    first, last, row = first[keep], last[keep], row[keep]
    power, inverse = powers(_ODD, n + 1), powers(_ODD_INVERSE, n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(word_hashes(w) * power[:n], out=prefix[1:])
    digest = mixed((prefix[last] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64))
    _, seen = np.unique(digest ^ mixed(row.astype(np.uint64)), return_index=True)
    again = np.ones(len(digest), dtype=bool)
    again[seen] = False
    return Evidence(row, first, last, digest, again)


def _prefix(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Sums of word hashes, and the factors that make a run's hash independent of its place."""
    n = len(w.starts)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    if n:
        np.cumsum(word_hashes(w) * powers(_ODD, n), out=prefix[1:])
    return prefix, powers(_ODD_INVERSE, n + 1)


def _runs(prefix: np.ndarray, inverse: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Digests of the runs of `size` words that begin at `first`."""
    return mixed((prefix[first + size] - prefix[first]) * inverse[first] ^ np.uint64(0x5DEECE66D * size))


@dataclass
class Chosen:
    """Runs of `size` words chosen by their hashes: row, first word, digest, met more than once in the row."""

    row: np.ndarray
    first: np.ndarray
    digest: np.ndarray
    twice: np.ndarray
    once: np.ndarray


def chosen(w: Words, prefix: np.ndarray, inverse: np.ndarray, size: int, window: int) -> Chosen:
    """The run of `size` words with the least hash of every window of `window` words."""
    span, n = window - size + 1, len(w.starts)
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return Chosen(none, none, none.astype(np.uint64), none.astype(bool), none.astype(bool))
    every = _runs(prefix, inverse, np.arange(n - size + 1), size)
    at = np.arange(n - window + 1)
    row = np.searchsorted(w.rows, at, side="right") - 1
    inside = at + window <= w.rows[row + 1]
    first = at + np.argmin(np.lib.stride_tricks.sliding_window_view(every, span), axis=1)
    first, keep = np.unique(first[inside], return_index=True)
    row, digest = row[inside][keep], every[first]
    _, seen, back, times = np.unique(digest ^ mixed(row.astype(np.uint64)), return_index=True, return_inverse=True, return_counts=True)
    once = np.zeros(len(first), dtype=bool)
    once[seen] = True
    return Chosen(row, first, digest, times[back] > 1, once)


def _around(w: Words, found: Chosen, hit: np.ndarray, size: int, window: int) -> np.ndarray:
    """First words of the windows that hold one of the chosen runs `hit`."""
    low, high = found.first[hit] - (window - size), found.first[hit] + 1
    row = found.row[hit]
    low, high = np.maximum(low, w.rows[row]), np.minimum(high, w.rows[row + 1] - window + 1)
    mark = np.zeros(len(w.starts) + 2, dtype=np.int64)
    np.add.at(mark, low, 1)
    np.add.at(mark, np.maximum(high, low), -1)
    return np.flatnonzero(np.cumsum(mark) > 0)


def _held(row: np.ndarray, digest: np.ndarray, lists: list[np.ndarray | None]) -> np.ndarray:
    """Whether a row's list has the digest."""
    salt = mixed(np.arange(len(lists), dtype=np.uint64))
    given = [x ^ salt[k] for k, x in enumerate(lists) if x is not None and len(x)]
    return np.isin(digest ^ salt[row], np.concatenate(given)) if given else np.zeros(len(digest), dtype=bool)


_LINE = np.uint64(0xA0761D6478BD642F)


def _evidences(chunk: Chunk, w: Words, unit: str, least: int) -> list[Evidence]:
    """Whole lines, and in the default mode runs of units."""
    lines = evidence(chunk, w, "line", least if unit == "line" else 1)
    lines.digest = lines.digest ^ _LINE
    return [lines] if unit == "line" else [lines, evidence(chunk, w, unit, least)]


def _lists(column: pa.Array) -> list[np.ndarray | None]:
    return [np.asarray(x.values, dtype=np.int64).view(np.uint64) if x.is_valid else None for x in column]


def digests(docs: DataFrame, unit: str, least: int, window: int, text: str, doc_id: str) -> DataFrame:
    """(digest, id, run): every digest once per row of `docs`; a null id becomes the largest long.

    `run` is set for the runs that are chosen to find windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(1)):
                w = words(chunk)
                parts = [(x.row[~x.again], x.digest[~x.again], False) for x in _evidences(chunk, w, unit, least)]
                if unit != "line":
                    c = chosen(w, *_prefix(w), min(least, window), window)
                    parts.append((c.row[c.once], c.digest[c.once], True))
                for row, digest, is_run in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(digest.view(np.int64)), pa.array(ids[chunk.first + row], pa.int64()), pa.array(np.full(len(row), is_run))],
                        names=["digest", "id", "run"],
                    )

    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))
    return docs.select(key.alias("id"), F.col(text).alias("text")).mapInArrow(run, "digest bigint, id bigint, run boolean")


def windows(docs: DataFrame, unit: str, least: int, window: int) -> DataFrame:
    """(digest, id): the windows of `docs` (id, text, lost, runs) that hold one of the chosen runs `runs`.

    Windows within whole lines that are cut anyhow are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(least, window)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(1)):
                n = chunk.last - chunk.first
                lost, runs = _lists(batch.column(2).slice(chunk.first, n)), _lists(batch.column(3).slice(chunk.first, n))
                w = words(chunk)
                prefix, inverse = _prefix(w)
                c = chosen(w, prefix, inverse, size, window)
                first = _around(w, c, _held(c.row, c.digest, runs), size, window)
                lines = _evidences(chunk, w, unit, least)[0]
                drop = lines.again | _held(lines.row, lines.digest, lost)
                covered = np.concatenate([[0], np.cumsum(_marked(len(w.starts), lines, drop))])
                first = first[covered[first + window] - covered[first] < window]
                row = np.searchsorted(w.rows, first, side="right") - 1
                digest = _runs(prefix, inverse, first, window)
                _, seen = np.unique(digest ^ mixed(row.astype(np.uint64)), return_index=True)
                seen.sort()
                yield pa.RecordBatch.from_arrays([pa.array(digest[seen].view(np.int64)), pa.array(ids[chunk.first + row[seen]], pa.int64())], names=["digest", "id"])

    return docs.select("id", "text", "lost", "runs").mapInArrow(run, "digest bigint, id bigint")


def _marked(n: int, found: Evidence, drop: np.ndarray) -> np.ndarray:
    """Which of n words lie under the runs `drop`."""
    mark = np.zeros(n + 1, dtype=np.int64)
    np.add.at(mark, found.first[drop], 1)
    np.add.at(mark, found.last[drop], -1)
    return np.cumsum(mark)[:-1] > 0


def _cuts(
    chunk: Chunk, lost: list[np.ndarray | None], later: list[np.ndarray | None], unit: str, least: int, min_words: int
) -> list[list[tuple[int, int]]]:
    """Byte spans to cut from every row, given the digests of lines and units, and of windows, that are kept elsewhere."""
    w = words(chunk)
    n = len(w.starts)
    kinds = [_marked(n, x, x.again | _held(x.row, x.digest, lost)) for x in _evidences(chunk, w, unit, least)]
    whole = kinds[0]
    marked = np.logical_or.reduce(kinds)
    if unit != "line":
        size = min(least, min_words)
        prefix, inverse = _prefix(w)
        c = chosen(w, prefix, inverse, size, min_words)
        has = np.array([x is not None for x in later], dtype=bool)
        first = np.flatnonzero(has[np.searchsorted(w.rows, np.arange(n), side="right") - 1]) if has.any() else np.zeros(0, dtype=np.int64)
        row = np.searchsorted(w.rows, first, side="right") - 1
        fits = first + min_words <= w.rows[row + 1]
        first, row = first[fits], row[fits]
        found = first[_held(row, _runs(prefix, inverse, first, min_words), later)]
        # Within a row: what lies wholly behind the first occurrence.
        own = _around(w, c, c.twice, size, min_words)
        row = np.searchsorted(w.rows, own, side="right") - 1
        _, seen, back = np.unique(_runs(prefix, inverse, own, min_words) ^ mixed(row.astype(np.uint64)), return_index=True, return_inverse=True)
        own = own[own >= own[seen][back] + min_words]
        found = np.concatenate([found, own])
        mark = np.zeros(n + 1, dtype=np.int64)
        np.add.at(mark, found, 1)
        np.add.at(mark, found + min_words, -1)
        marked |= np.cumsum(mark)[:-1] > 0
    # Stretches that are too short keep what is not a whole line.
    row_of = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
    for first, last in _stretches(marked, row_of):
        if last - first < min_words:
            marked[first:last] = whole[first:last]
    spans: list[list[tuple[int, int]]] = [[] for _ in lost]
    for first, last in _stretches(marked, row_of):
        row = int(row_of[first])
        end = w.starts[last] if last < w.rows[row + 1] else chunk.bounds[row + 1]
        spans[row].append((int(w.starts[first] - chunk.bounds[row]), int(end - chunk.bounds[row])))
    return spans


def _stretches(marked: np.ndarray, row_of: np.ndarray) -> list[tuple[int, int]]:
    """[first, last) of the marked words that are adjacent in a row."""
    value = np.concatenate([[-1], np.where(marked, row_of, -1), [-1]])
    edge = np.flatnonzero(value[1:] != value[:-1])
    value = value[1:]
    return [(int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True) if value[a] >= 0]


def dedup_units(
    docs: DataFrame,
    *,
    unit: str = "clause",
    evidence_words: int | None = None,
    min_words: int = 25,
    text: str = "text",
    doc_id: str = "doc_id",
    cuts: str = "removed",
) -> DataFrame:
    """`docs` with repeated passages cut from the text, and the cuts as array<struct<start, end>>.

    `unit` is "clause" or "line". `evidence_words` is 8, or in line mode 1. The id is a whole number.
    """
    if unit not in ("clause", "line"):
        raise ValueError(f"unknown unit {unit}")
    if evidence_words is None:
        evidence_words = 1 if unit == "line" else 8
    docs = docs.drop(cuts)
    every = digests(docs, unit, evidence_words, min_words, text, doc_id)
    kept = every.groupBy("digest", "run").agg(F.min("id").alias("keeper"), F.max("id").alias("other"))
    kept = pin(kept.filter("keeper <> other").select("digest", "run", "keeper"), "repeated")
    met = every.join(kept, ["digest", "run"]).filter("run or id <> keeper").groupBy("id").agg(
        F.collect_set(F.when(~F.col("run"), F.col("digest"))).alias("lost"), F.collect_set(F.when(F.col("run"), F.col("digest"))).alias("runs")
    )
    met = pin(met, "met")
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))
    lost = met.select(F.col("id").alias("_lost_id"), F.col("lost").alias("_lost"))
    if unit != "line":
        rows = docs.select(key.alias("id"), F.col(text).alias("text")).join(met.filter(F.size("runs") > 0), "id")
        dense = pin(windows(rows, unit, evidence_words, min_words), "windows")
        again = dense.groupBy("digest").agg(F.min("id").alias("keeper"), F.max("id").alias("other"))
        again = pin(again.filter("keeper <> other").select("digest", "keeper"), "again")
        late = dense.join(again, "digest").filter("id <> keeper").groupBy("id").agg(F.collect_set("digest").alias("_later"))
        lost = lost.join(late.withColumnRenamed("id", "_lost_id"), "_lost_id", "left")
    else:
        lost = lost.withColumn("_later", F.lit(None).cast("array<bigint>"))
    joined = docs.join(pin(lost, "lost"), key == F.col("_lost_id"), "left").drop("_lost_id")

    place = docs.columns.index(text)
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([*docs.schema.fields, T.StructField(cuts, spans_type)])
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, lists, later = batch.column(place), batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            for chunk in chunks(column):
                size = chunk.last - chunk.first
                given = _lists(lists.slice(chunk.first, size)), _lists(later.slice(chunk.first, size))
                spans = _cuts(chunk, *given, unit, evidence_words, min_words)
                texts, offsets = [], []
                for k, own in enumerate(spans):
                    value = column[chunk.first + k]
                    if not own:
                        texts.append(value.as_py())
                        offsets.append([])
                        continue
                    raw = value.as_buffer().to_pybytes()
                    kept, at, seen, done = [], 0, 0, []
                    for a, b in own:
                        kept.append(raw[at:a].decode())
                        seen += len(kept[-1])
                        done.append({"start": seen, "end": seen + len(raw[a:b].decode())})
                        seen, at = done[-1]["end"], b
                    kept.append(raw[at:].decode())
                    texts.append("".join(kept))
                    offsets.append(done)
                columns = [c.slice(chunk.first, size) for c in batch.columns[:-2]]
                columns[place] = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(offsets, arrow_spans)], names=out.names)

    return joined.select(*docs.columns, "_lost", "_later").mapInArrow(run, out)
