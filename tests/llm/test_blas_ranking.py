import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import blas_ranking
from llm.conftest import SCHEMA

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    """(item_id, rank, doc_id, score) by the stated formula; `docs` and `items` are (id, text)."""
    held = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    held = [(doc_id, tf) for doc_id, tf in held if tf]
    total, length = len(held), sum(tf.total() for _, tf in held)
    df = Counter(t for _, tf in held for t in tf)
    out = []
    for item_id, text in items:
        asked = set(terms_of(text))
        scored = []
        for doc_id, tf in held:
            m = 100 - 50 + (50 * tf.total() * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in asked
                if t in tf
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=repr)


def found(docs, items, **more):
    df = blas_ranking.search(docs, items, **more)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def edge_items(spark):
    rows = [(0, "w001 w002, W003"), (0, "w001 w002, W003"), (1, None), (2, "  "), (None, "w010"), (3, "ünïcode 😀 text w399"), (4, "absent")]
    return spark.createDataFrame(rows, "item_id bigint, text string"), rows


def test_edge_rows(edges, edge_items):
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(edges, edge_items[0]) == brute(docs, edge_items[1])


def test_clashing_columns(edges, edge_items):
    names = ("item", "term", "rank", "score", "n", "codes", "counts", "df", "code")
    more = edges.selectExpr("*", *[f"'x' as {name}" for name in names])
    items = edge_items[0].selectExpr("*", *[f"'x' as {name}" for name in ("item", "term", "rank", "doc_id", "score")])
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(more, items) == brute(docs, edge_items[1])


def test_given_tables(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(documents, items, k=7) == brute(docs, [(r.item_id, r.text) for r in items.collect()], 7)


def test_ties_over_tiles_rounds_and_terms(spark, monkeypatch):
    """Hundreds of equal scores over small tiles, several rounds, and cuts below 2^53."""
    monkeypatch.setattr(blas_ranking, "ROUND_BYTES", 64)
    monkeypatch.setattr(blas_ranking, "ITEM_TILE", 2)
    r = random.Random(4)
    docs = [(k, r.choice(["a b c", "c d e f", "a c c", "b g", ""]), "en", "s", 1) for k in range(900)]
    r.shuffle(docs)
    items = [(k, text) for k, text in enumerate(["a", "c b", "d g a", "e", "c", "b b f", "none"])]
    got = found(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string"), k=20)
    assert got == brute([d[:2] for d in docs], items, 20)


def test_partial_sums_stay_exact():
    weight = np.array([9_000_000_000, 10, 9_000_000_000, 5], dtype=np.int64)
    cuts = blas_ranking.exact_cuts(weight)
    assert cuts == [(0, 1), (1, 2), (2, 3), (3, 4)] or all(
        int(weight[a:b].sum()) * blas_ranking.PER_TERM < blas_ranking.EXACT for a, b in cuts if b - a > 1
    )
    assert [k for a, b in cuts for k in range(a, b)] == [0, 1, 2, 3]
    assert blas_ranking.exact_cuts(np.full(10, 1000, dtype=np.int64)) == [(0, 10)]


def test_cut_tiles_give_the_same_scores(edges, edge_items, monkeypatch):
    """Vocabulary tiles of one or two terms: the workers get the cuts through the membership that they build."""
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    batch = next(blas_ranking._rounds(edge_items[0], blas_ranking._item_terms(edge_items[0].selectExpr("coalesce(item_id, 9) as item", "text"))))
    weight = np.full(len(batch.vocabulary), 3_000, dtype=np.int64)
    whole = [parts for _, parts in batch.tiles(weight)]
    monkeypatch.setattr(blas_ranking, "EXACT", 7_000 * blas_ranking.PER_TERM)
    cut = [parts for _, parts in batch.tiles(weight)]
    assert max(len(p) for p in cut) > max(len(p) for p in whole) == 1
    for a, b in zip(whole, cut, strict=True):
        assert np.array_equal(np.concatenate([codes for codes, _ in b]), a[0][0])
        assert np.array_equal(np.concatenate([member for _, member in b]), a[0][1])
    assert docs


def test_empty_tables(spark, no_docs, edges, edge_items):
    assert found(no_docs, edge_items[0]) == []
    assert found(edges, edge_items[0].limit(0)) == []
