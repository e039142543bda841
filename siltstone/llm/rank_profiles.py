"""Language identification by rank-order n-gram profiles.

Words are runs of letters in lower case with a space on both sides; n-grams of 1 to 3 characters of such
padded words are counted. A language's profile is its most frequent n-grams in order of count, learned
from all training texts. A document is ranked in the same way, and its distance to a profile is the sum,
over the document's n-grams, of how far each is out of place; one that the profile lacks counts as the
profile's length. The nearest profile names the language.

The score is 1 - distance / (largest possible distance), between 0 and 1.

Nulls, blanks and ties: a text that is null or has no letter is `und` with score 0, as is every text if
nothing was learned. Equal counts are ordered by n-gram, equal distances by language name. Training rows
without a language are not used. More than `LANGUAGES_AT_MOST` languages are refused. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
LANGUAGES_AT_MOST = 1000
_SIZE = 0x110000
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point itself if it is a letter, else a space."""
    if not _LETTERS:
        table = np.full(_SIZE, 32, dtype=np.int64)
        points = [k for k in range(_SIZE) if chr(k).isalpha()]
        table[points] = points
        _LETTERS.append(table)
    return _LETTERS[0]


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers (21 bits a character, the last character lowest)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.full(len(points) + 2, 32, dtype=np.int64)
    c[1:-1] = _letters()[points]
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)  # runs of other characters become one space
    c = c[keep]
    one, two = c[c != 32], (c[:-1] << 21) | c[1:]
    middle = c[1:-1] != 32  # a 3-gram does not go over a space
    three = (two[:-1] << 21) | c[2:]
    return np.concatenate([one, two, three[middle]])


def ranked(text: str, most: int) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first; equal counts by n-gram."""
    own, counts = np.unique(grams(text), return_counts=True)
    if len(own) > 4 * most:  # what is rarer than the `most`-th cannot get in
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        own, counts = own[counts >= least], counts[counts >= least]
    return own[np.argsort(-counts, kind="stable")][:most]


def learn(docs: DataFrame, *, most: int = 300, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, place): the `most` most frequent n-grams of every language, from all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                own, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own), pa.string()), pa.array(own), pa.array(counts)], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                found = grams(value.as_py())
                held.setdefault(name.as_py(), []).append(found)
                size += len(found)
                if size > 6_000_000:
                    yield from flush()
                    size = 0
        yield from flush()

    named = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    named = named.filter("lang is not null and text is not null")
    counted = named.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A group limit before the shuffle: no task gets more than `most` rows per language and input task.
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return counted.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < most).select("lang", "gram", "place")


@dataclass
class Profiles:
    """Languages by name, all their n-grams sorted, and each one's place per language (`most`: lacking)."""

    langs: list[str]
    grams: np.ndarray
    places: np.ndarray
    most: int


def collect_profiles(learned: DataFrame, most: int = 300) -> Profiles:
    """Profiles in memory: `most` rows a language, `LANGUAGES_AT_MOST` languages."""
    rows = learned.limit(LANGUAGES_AT_MOST * most + 1).toPandas()
    langs = sorted(rows["lang"].unique())
    if len(langs) > LANGUAGES_AT_MOST or len(rows) > LANGUAGES_AT_MOST * most:
        raise ValueError(f"more than {LANGUAGES_AT_MOST} languages")
    every = np.unique(rows["gram"].to_numpy(dtype=np.int64))
    places = np.full((len(every), len(langs)), most, dtype=np.int64)
    number = rows["lang"].map({n: k for k, n in enumerate(langs)}).to_numpy(dtype=np.int64)
    places[np.searchsorted(every, rows["gram"].to_numpy(dtype=np.int64)), number] = rows["place"].to_numpy(dtype=np.int64)
    return Profiles(langs, every, places, most)


def nearest(text: str | None, profiles: Profiles) -> tuple[str, float]:
    """Name and score of the nearest profile."""
    own = ranked(text, profiles.most) if text else np.zeros(0, dtype=np.int64)
    if not len(own) or not len(profiles.langs):
        return UNDETERMINED, 0.0
    at = np.minimum(np.searchsorted(profiles.grams, own), len(profiles.grams) - 1)
    known = profiles.grams[at] == own
    place = np.arange(len(own))[known, None]
    far = np.abs(profiles.places[at[known]] - place)
    far = np.where(profiles.places[at[known]] == profiles.most, profiles.most, far)
    total = far.sum(axis=0) + profiles.most * (len(own) - int(known.sum()))
    best = int(total.argmin())
    return profiles.langs[best], 1.0 - float(total[best]) / (profiles.most * len(own))


def predict(docs: DataFrame, profiles: Profiles, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score) for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(x.as_py(), shared.value) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
