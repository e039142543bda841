import random
import re

import numpy as np
import pyarrow as pa

from siltstone.llm import hyper_minhash
from siltstone.llm.packed import chunks
from llm.conftest import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size=4):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1)))


def brute(rows, percent=80):
    """(doc_id, n_shingles, component_id, kept) of rows (doc_id, text)."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                root[top(a)] = top(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(k)] = min(least.get(top(k), doc_id), doc_id)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        own = least.get(top(k))
        out.append((doc_id, len(sets[k]), own, doc_id == own))
    return sorted(out, key=repr)


def found(df, **more):
    result = hyper_minhash.near_duplicates(df, **more)
    assert result.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_edge_rows(edges):
    assert found(edges) == brute(pairs_of(edges))


def test_clashing_columns(edges):
    names = ("digest", "cls", "least", "key", "a", "b", "x", "y", "held", "registers", "n_shingles", "component_id", "kept", "root")
    assert found(edges.selectExpr("*", *[f"'x' as {name}" for name in names])) == brute(pairs_of(edges))


def test_given_documents(documents):
    assert found(documents) == brute(pairs_of(documents))


def test_empty_table(no_docs):
    assert found(no_docs) == []


def edited(words, r, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return " ".join(words)


def test_pairs_at_the_threshold(spark):
    """Sets of 4 to 400 shingles, cut so that pairs lie on both sides of 80 %."""
    r = random.Random(2)
    rows = []
    for k, n in enumerate([4, 5, 6, 8, 11, 20, 40, 90, 200, 400] * 6):
        words = [f"k{k}w{r.randrange(10**6)}" for _ in range(n + 3)]
        rows.append((2 * k, " ".join(words), "en", "s", 1))
        lost = round(0.2 * n) + k % 3 - 1
        rows.append((2 * k + 1, " ".join(words[: len(words) - max(lost, 0)]), "en", "s", 1))
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(pairs_of(df))
    assert found(df) == want
    assert 0 < sum(not row[-1] for row in want) < len(rows) / 2


def test_large_group_and_its_neighbours(spark):
    """Hundreds of near copies of one text, and chains that are similar to some of them only."""
    r = random.Random(7)
    base = [f"b{k}" for k in range(150)]
    rows = [(k, edited(base, r, r.randrange(9)), "en", "s", 1) for k in range(300)]
    rows += [(1000 + k, " ".join([f"o{k}x{j}" for j in range(3 * k)] + base[: 150 - 2 * k]), "en", "s", 1) for k in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(df) == brute(pairs_of(df))


def test_larger_keys_are_compared_in_rounds(spark, monkeypatch):
    """With one pivot first and two classes a key later, nothing is lost."""
    monkeypatch.setattr(hyper_minhash, "SMALL", 2)
    monkeypatch.setattr(hyper_minhash, "PIVOTS", 1)
    r = random.Random(9)
    line = [f"l{k}" for k in range(40)]
    rows = [(k, " ".join(line + [f"t{k // 3}y{j}" for j in range(25)] + ([f"z{k}"] if k % 3 else [])), "en", "s", 1) for k in range(90)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(pairs_of(df))
    assert found(df) == want
    assert sum(row[-1] for row in want) == 30


def test_registers_agree_as_often_as_the_sets():
    r = np.random.default_rng(3)
    for size in (1, 3, 10, 60, 300, 5000):
        share, guess = [], []
        for _ in range(40):
            common = r.integers(0, 1 << 63, size, dtype=np.uint64)
            own = [r.integers(0, 1 << 63, max(size // 2, 1), dtype=np.uint64) for _ in range(2)]
            sets = [np.unique(np.concatenate([common, x])) for x in own]
            held = hyper_minhash.registers(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]))
            share.append(len(common) / (len(common) + 2 * len(own[0])))
            sizes = [np.array([len(x)]) for x in sets]
            guess.append(hyper_minhash.estimates(held[:1], held[1:], *sizes)[0])
        assert abs(np.mean(guess) - np.mean(share)) < 0.04


def test_accidental_agreement_is_as_expected():
    r = np.random.default_rng(5)
    for size in (200, 2000, 20000):
        n = 60
        held = hyper_minhash.registers(r.integers(0, 1 << 63, n * size, dtype=np.uint64), np.arange(n + 1) * size)
        equal = np.mean([(held[a] == held[b]).mean() for a in range(n) for b in range(a)])
        expected = hyper_minhash.accidental(np.array([size]), np.array([size]))[0]
        assert 0.5 < (equal + 1e-5) / (expected + 1e-5) < 2


def test_sketch_of_a_long_row_is_that_of_its_words():
    column = pa.array(["A b  c\td e", "a B c d e", None, "x"])
    (chunk,) = list(chunks(column))
    hashes, bounds, w = hyper_minhash.shingle_sets(chunk, 4)
    assert list(np.diff(bounds)) == [2, 2, 0, 1]
    digests = hyper_minhash._text_digests(w)
    assert digests[0] == digests[1] and digests[2] is None and digests[3] is not None


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    """However many partitions shuffles have: on tables of some thousand rows a task costs more than its rows."""
    files = {}

    def pin(df, label, real=hyper_minhash.pin):
        held = real(df, label)
        files[label] = max(files.get(label, 0), len(held.inputFiles()))
        return held

    monkeypatch.setattr(hyper_minhash, "pin", pin)
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    r = random.Random(5)
    base = [f"b{k}" for k in range(60)]
    df = spark.createDataFrame([(k, edited(base, r, r.randrange(7)), "en", "s", 1) for k in range(60)], SCHEMA)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert found(df) == brute(pairs_of(df))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    few = {"classes", "shared", "large", "stars", "pairs", "likely", "asked", "sets", "placed", "open", "labels"}
    assert {label: n for label, n in files.items() if label in few and n > 1} == {}
