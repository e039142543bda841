"""Quality classifier: a sparse ensemble of rules.

Statistics of every text are computed in one pass (`statistics`). `fit` learns from a bounded sample of
labelled rows: shallow trees are grown one after another on the residuals of the ones before, every path
from a root becomes a conjunctive rule over statistics, and a lasso logistic regression over the rules
leaves most weights at zero. What is left is compiled to one Spark column expression (`score_column`),
so scoring is plain arithmetic on the statistics' columns.

Nulls, blanks and ties: a null or blank text has all statistics 0 and gets a score. Labels that are null
are not used; equal rows are harmless. Without labels, or with one class only, the score is that class's
share (0.5 without labels). Statistics' columns are prefixed with `q_`, so other columns may have any
name that is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.packed import chunks, word_hashes, words
from siltstone.session import pin

STATISTICS = (
    "q_words", "q_word_bytes", "q_upper", "q_digit", "q_stop", "q_symbol", "q_bang", "q_space",
    "q_lines", "q_distinct", "q_repeat", "q_top_word", "q_initial_upper", "q_ends_symbol",
)
SAMPLE_AT_MOST = 20_000


def _of(chars: str) -> np.ndarray:
    flag = np.zeros(256, dtype=np.float64)
    flag[[ord(c) for c in chars]] = 1
    return flag


_CLASSES = [
    _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of("0123456789"), _of(".,;:"), _of("#$%&*@^~|<>=_{}[]\\/+"), _of("!?"), _of(" \t\r\n"),
]
_SYMBOL = _of("#$%&*@^~|<>=_{}[]\\/+!?") > 0


def _row_statistics(chunk) -> np.ndarray:
    """Statistics (columns) of the rows of a chunk; all 0 for a text without words."""
    w = words(chunk)
    n_rows = len(chunk.bounds) - 1
    size = np.diff(chunk.bounds).astype(np.float64)
    n = np.diff(w.rows).astype(np.float64)
    row_of = np.repeat(np.arange(n_rows), np.diff(w.rows))

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(row_of, weights=values, minlength=n_rows)

    out = np.zeros((n_rows, len(STATISTICS)))
    # A count of every byte value per row gives all character classes at once.
    row_of_byte = np.repeat(np.arange(n_rows), np.diff(chunk.bounds)) * 256
    seen = np.bincount(row_of_byte + chunk.data, minlength=n_rows * 256).reshape(n_rows, 256)
    upper, digit, stop, symbol, bang, space = (seen @ c for c in _CLASSES)
    lines = seen[:, 10] + 1.0
    h = word_hashes(w)
    own = h ^ (row_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    new = np.ones(len(own), dtype=bool)
    new[1:] = own[order][1:] != own[order][:-1]
    group = np.flatnonzero(new)
    times = np.diff(np.append(group, len(own)))
    rows = row_of[order][group]
    distinct = np.bincount(rows, minlength=n_rows)
    top = np.zeros(n_rows)
    np.maximum.at(top, rows, times)
    repeat = np.zeros(len(h))
    if len(h) > 1:
        repeat[1:] = (h[1:] == h[:-1]) & (row_of[1:] == row_of[:-1])
    first = chunk.data[w.starts]
    capital = (first >= 65) & (first <= 90)
    ends = _SYMBOL[chunk.data[w.ends - 1]]
    some, bytes_ = np.maximum(n, 1), np.maximum(size, 1)
    full = n > 0
    for k, values in enumerate((
        n, per_row(w.ends - w.starts) / some, upper / bytes_, digit / bytes_, stop / bytes_, symbol / bytes_, bang / bytes_,
        space / bytes_, lines / some, distinct / some, per_row(repeat) / some, top / some, per_row(capital) / some, per_row(ends) / some,
    )):
        out[:, k] = np.where(full, values, 0.0)
    return out


def statistics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """`docs` without its text, plus the statistics of the whole text."""
    kept = [c for c in docs.columns if c != text and c not in STATISTICS]
    schema = docs.select(*kept).schema
    for name in STATISTICS:
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(batch.num_columns - 1)):
                found = _row_statistics(chunk)
                columns = [c.slice(chunk.first, chunk.last - chunk.first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, found.T)], names=schema.names)

    return docs.select(*kept, F.col(text)).mapInArrow(run, schema)


Rule = tuple[tuple[int, bool, float], ...]
"""Conditions (statistic, at most?, threshold), all of which have to hold."""


@dataclass
class Model:
    intercept: float
    rules: list[tuple[Rule, float]]


def _grow(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], depth: int, least: int) -> tuple[list[Rule], np.ndarray]:
    """All paths of a least-squares tree, and its prediction."""
    paths: list[Rule] = []
    value = np.zeros(len(x))

    def split(rows: np.ndarray, path: Rule) -> None:
        if path:
            paths.append(path)
        own, best = target[rows], (1e-9, -1, 0.0)
        if len(path) < depth and len(rows) >= 2 * least:
            total = own.sum()
            for f, points in enumerate(cuts):
                place = np.searchsorted(points, x[rows, f], side="left")  # value <= points[k] for k >= place
                count = np.cumsum(np.bincount(place, minlength=len(points) + 1))[:-1]
                sums = np.cumsum(np.bincount(place, weights=own, minlength=len(points) + 1))[:-1]
                other = len(rows) - count
                ok = (count >= least) & (other >= least)
                if ok.any():
                    gain = np.where(ok, sums**2 / np.maximum(count, 1) + (total - sums) ** 2 / np.maximum(other, 1) - total**2 / len(rows), 0)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, float(points[k]))
        if best[1] < 0:
            value[rows] = own.mean() if len(rows) else 0.0
            return
        _, f, point = best
        low = x[rows, f] <= point
        split(rows[low], (*path, (f, True, point)))
        split(rows[~low], (*path, (f, False, point)))

    split(np.arange(len(x)), ())
    return paths, value


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for f, most, point in rule:
        ok &= (x[:, f] <= point) == most
    return ok


def _lasso(z: np.ndarray, y: np.ndarray, strength: float, rounds: int) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal gradient steps."""
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    b, weights = float(np.log(mean / (1 - mean))), np.zeros(z.shape[1])
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / len(z) + 1)
    point, b_point, t = weights, b, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(z @ point + b_point)))
        moved = point - step * (z.T @ (p - y) / len(y))
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * strength, 0)
        b_moved = b_point - step * float((p - y).mean())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        point = moved + (t - 1) / t_next * (moved - weights)
        b_point = b_moved + (t - 1) / t_next * (b_moved - b)
        weights, b, t = moved, b_moved, t_next
    return b, weights


def learn(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, least: int = 5, strength: float = 5e-4, rounds: int = 600) -> Model:
    """Fit on a matrix of statistics and labels 0/1. Deterministic."""
    if len(y) == 0:
        return Model(0.0, [])
    if y.min() == y.max():
        return Model(8.0 if y[0] else -8.0, [])
    cuts = []
    for f in range(x.shape[1]):
        points = np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65), method="lower"))
        near = np.unique(x[:, f])
        after = near[np.minimum(np.searchsorted(near, points, side="right"), len(near) - 1)]
        cuts.append(np.unique((points + after) / 2)[:-1])  # midway, so that unseen values fall sensibly
    logit, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        paths, value = _grow(x, y - 1 / (1 + np.exp(-logit)), cuts, depth, least)
        logit = logit + 1.0 * value
        for rule in paths:
            rules.setdefault(tuple(sorted(rule)), None)
    names = list(rules)
    z = np.stack([_holds(x, r) for r in names], axis=1).astype(np.float64) if names else np.zeros((len(y), 0))
    _, once = np.unique(z, axis=1, return_index=True)  # rules that hold for the same rows say the same
    names, z = [names[k] for k in sorted(once)], z[:, sorted(once)]
    b, weights = _lasso(z, y, strength, rounds)
    return Model(b, [(r, float(v)) for r, v in zip(names, weights, strict=True) if abs(v) > 1e-6])


def fit(labelled: DataFrame, label: str, *, at_most: int = SAMPLE_AT_MOST, key: str = "doc_id", **options) -> Model:
    """Learn from statistics with a label column (0/1; null rows are left out).

    At most `at_most` rows are used: those with the smallest hash of `key`, a sample that does not depend
    on the order or the partitions of the table.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    wanted = labelled.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), *STATISTICS, place.alias("h"))
    wanted = pin(wanted, "labelled")
    n = wanted.count()
    if n > at_most:  # about half more than is wanted, so that the tasks do not send `at_most` rows each
        wanted = wanted.filter(F.col("h") < int((1 << 40) * min(1.0, 1.5 * at_most / n)))
    rows = wanted.orderBy("h", "y", *STATISTICS).limit(at_most).toPandas()
    return learn(rows[list(STATISTICS)].to_numpy(dtype=np.float64), rows["y"].to_numpy(dtype=np.float64), **options)


def score_column(model: Model) -> Column:
    """The model as one expression over the statistics: a probability of label 1."""
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        met = F.lit(True)
        for f, most, point in rule:
            column = F.col(STATISTICS[f])
            met = met & ((column <= point) if most else (column > point))
        total = total + F.when(met, F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))
