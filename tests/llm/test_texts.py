import collections
import hashlib
import random
from itertools import combinations

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import SCHEMA, edge_rows, prose

from pyspark.sql import functions as F

from siltstone.llm import components, pareto_mix, positional_index, prefix_hash, simhash_gph, unit_dedup
from siltstone.llm.queries import QUERIES

# ---- prefix hashes


@settings(max_examples=100, deadline=None)
@given(st.text("ab😀", max_size=40), st.text("ab😀", max_size=40), st.integers(0, 40), st.integers(0, 40))
def test_spans_and_extensions(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    x, y = prefix_hash.prefix(prefix_hash.points_of(a)), prefix_hash.prefix(prefix_hash.points_of(b))
    n = min(len(a) - i, len(b) - j)
    for k in range(n + 1):
        assert prefix_hash.equal_spans(x, i, y, j, k) == (a[i : i + k] == b[j : j + k])
    want = next((k for k in range(n) if a[i + k] != b[j + k]), n)
    assert prefix_hash.common_extension(x, i, y, j) == want
    assert (prefix_hash.fingerprint(x) == prefix_hash.fingerprint(y)) == (a == b)


def plain_likeness(a, b):
    if not a and not b:
        return 1.0
    short = min(len(a), len(b))
    start = next((k for k in range(short) if a[k] != b[k]), short)
    end = next((k for k in range(short - start) if a[-1 - k] != b[-1 - k]), short - start)
    return (start + end) / max(len(a), len(b))


def check_next(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (ident, text, *_) in enumerate(order):
        own, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(own) // 3
        edited = own[: len(own) - third] + after[:third]
        want.append((ident, len(own), hashlib.sha256(edited.encode()).hexdigest(), round(plain_likeness(own, edited), 9), round(plain_likeness(own, after), 9)))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("size", [32 << 20, 2000])
def test_next_documents_of_edge_rows(clashing, size):
    check_next(edge_rows(), prefix_hash.fingerprints(clashing, bytes_per_range=size).collect())


def test_next_document_over_many_ranges(spark):
    rows = [(k * k - 500, prose(k, k % 50)) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    check_next(rows, prefix_hash.fingerprints(frame, bytes_per_range=1500).collect())


def test_one_and_no_document(spark, no_docs):
    only = prefix_hash.fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")).first()
    assert only.near_next == 1.0 and only.near_edited == pytest.approx(4 / 6)
    assert prefix_hash.fingerprints(no_docs).count() == 0


def test_prefix_query(spark, sf_dir, documents):
    check_next([(r.doc_id, r.text) for r in documents.collect()], QUERIES["op6_prefix_hash"](spark, sf_dir).collect())


# ---- repeated passages


def test_passage_inside_lines_is_cut_once(spark, edges):
    rows = {(r.doc_id, r.source): r for r in unit_dedup.dedup_units(edges).collect()}
    assert rows[(5, "a")].removed == []
    cut = rows[(6, "b")]
    assert len(cut.removed) == 1
    original = next(t for i, t, *_ in edge_rows() if i == 6)
    s = cut.removed[0]
    assert cut.text == original[: s.start] + original[s.end :]
    assert 40 <= len(original[s.start : s.end].split()) <= 62
    assert original[s.start : s.end].strip() in prose(1, 60) + " " + prose(7, 20)
    # The same text under a larger id goes; rows that share an id stay both.
    assert rows[(7, "a")].removed == [] and len(rows[(8, "c")].text.split()) < 8
    assert rows[(1, "a")].removed == [] and rows[(2, "a")].text is None and rows[(9, "a")].removed == []


def brute_lines(rows, least):
    seen, out = {}, {}
    for ident, text in sorted(rows):
        kept, drop = [], False
        for line in text.split("\n"):
            words = line.lower().split()
            key = tuple(words)
            if len(words) >= least and key in seen:
                drop = True
                continue
            seen[key] = ident
            kept.append(line)
        out[ident] = ("\n".join(kept), drop)
    return out


def test_line_mode_against_brute_force(spark):
    r = random.Random(8)
    lines = [prose(k, r.randrange(3, 12)) for k in range(60)]
    rows = [(k, "\n".join(r.choice(lines) if r.random() < 0.4 else prose(1000 + 50 * k + j, 9, 5000) for j in range(8))) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: r for r in unit_dedup.dedup_units(frame, unit="line", evidence_words=5, min_words=5).collect()}
    for ident, (text, dropped) in brute_lines(rows, 5).items():
        assert got[ident].text.strip("\n") == text.strip("\n")
        assert bool(got[ident].removed) == dropped


def test_planted_passages_go_and_clean_documents_stay(spark):
    passage = prose(77, 70, 3000)
    rows = []
    for k in range(60):
        body = prose(500 + k, 120, 4000)
        if k % 3 == 0:
            words = body.split()
            at = random.Random(k).randrange(len(words))
            body = " ".join([*words[:at], passage, *words[at:]])
        rows.append((k, body))
    got = {r.doc_id: r for r in unit_dedup.dedup_units(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for ident, body in rows:
        if ident % 3 or ident == 0:
            assert got[ident].text == body and got[ident].removed == []
        else:
            lost = sum(len(body[s.start : s.end].split()) for s in got[ident].removed)
            assert 50 <= lost <= 75


def test_dedup_of_no_rows_and_clashing_names(no_docs, clashing, edges):
    assert unit_dedup.dedup_units(no_docs).count() == 0
    texts = lambda f: sorted([r.text or "" for r in unit_dedup.dedup_units(f).collect()])
    assert texts(clashing) == texts(edges)


def test_passage_query_keeps_offsets(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op7_unit_dedup"](spark, sf_dir).collect():
        kept, at = [], 0
        for s in r.removed:
            kept.append(texts[r.doc_id][at : s.start])
            at = s.end
        assert r.text == "".join(kept) + (texts[r.doc_id] or "")[at:] or texts[r.doc_id] is None


# ---- positional index


def plain_words(text):
    out, run = [], b""
    for c in (text or "").encode():
        c += 32 if 65 <= c <= 90 else 0
        if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
            run += bytes([c])
        elif run:
            out.append(run)
            run = b""
    return [*out, run] if run else out


def brute_hits(text, items, size):
    w, hits, found = plain_words(text), set(), set()
    for name, body in items:
        own = plain_words(body)
        for k in range(max(1, len(own) - size + 1) if own else 0):
            window = own[k : k + size]
            for j in range(len(w) - len(window) + 1):
                if w[j : j + len(window)] == window:
                    hits.update(range(j, j + len(window)))
                    found.add(name)
    return len(w), sorted(hits), sorted(found, key=str)


ITEMS = [("i1", "w001 W002, w003"), ("i1", prose(2, 12)), ("i2", None), ("i3", "..."), ("i4", "“text” 😀"), (None, prose(2, 80)[30:120]), ("i5", prose(4, 30))]


@pytest.mark.parametrize("terms", ["few", "all"])
@pytest.mark.parametrize("batch", [4 << 20, 60])
def test_matches_against_brute_force(spark, clashing, monkeypatch, terms, batch):
    monkeypatch.setattr(positional_index, "BATCH_BYTES", batch)
    items = spark.createDataFrame(ITEMS, "item_id string, text string").selectExpr("*", "1 as name")
    index = positional_index.build_index(clashing, positional_index.test_terms(items) if terms == "few" else None)
    got = positional_index.find(index, items, size=5).collect()
    have = sorted(((r.doc_id, r.n_words, sorted(r.hits), sorted(r.items, key=str)) for r in got), key=repr)
    want = sorted(((i, *brute_hits(t, ITEMS, 5)) for i, t, *_ in edge_rows()), key=repr)
    assert have == want
    assert any(h[2] for h in have)


def test_proximity_finds_moved_words(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "d c b a"), (3, "a q q q q q b c d")], "doc_id bigint, text string")
    items = spark.createDataFrame([("i", "a b c d")], "item_id string, text string")
    near = {r.doc_id: r.items for r in positional_index.contaminated(docs, items, slop=1).collect()}
    assert near == {1: ["i"], 2: [], 3: []}
    exact = {r.doc_id: r.items for r in positional_index.contaminated(docs, items).collect()}
    assert exact == {1: [], 2: [], 3: []}


def test_phrases_do_not_go_over_documents(spark, no_docs, edges):
    docs = spark.createDataFrame([(1, "x a b"), (2, "c d y")], "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame([("i", "a b c d")], "item_id string, text string")
    assert all(r.hits == [] for r in positional_index.contaminated(docs, items).collect())
    assert positional_index.contaminated(no_docs, items).count() == 0
    none = spark.createDataFrame([], "item_id string, text string")
    assert all(r.hits == [] for r in positional_index.contaminated(edges, none).collect())


# ---- mixing


def test_targets_cap_and_copies(spark):
    rows = [(k, "a" if k % 3 else "b" if k % 2 else None, 1 + k % 20) for k in range(3000)] + [(9000, "zero", 0), (9001, "tiny", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    mix = pareto_mix.plan(docs)
    got = pareto_mix.apply_plan(docs, mix).collect()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(target[s] <= 3 * sizes[s] for s in sizes)
    for s in ("a", "b", None):
        assert abs(taken[s] - target[s]) <= 20
    again = pareto_mix.apply_plan(docs.repartition(9), pareto_mix.plan(docs.repartition(3))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_unequal_probabilities_within_a_source(spark):
    rows = [(k, "a", 1, 3.0 if k % 2 else 1.0) for k in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, w double")
    mix = pareto_mix.plan(docs, share=0.3, weight="w")
    got = pareto_mix.apply_plan(docs, mix, weight="w").collect()
    odd, even = sum(r.copies for r in got if r.doc_id % 2), sum(r.copies for r in got if r.doc_id % 2 == 0)
    assert abs(odd + even - 2400) <= 1
    assert 2.5 < odd / even < 3.5


def test_mix_of_edge_rows(clashing, no_docs):
    sized = clashing.withColumn("size", pareto_mix.word_count("text"))
    mixed = pareto_mix.apply_plan(sized, pareto_mix.plan(sized))
    rows = mixed.filter("copies >= 0").collect()
    assert len(rows) == 13 and all(r.taken <= 3 * r.size for r in rows)
    assert len(mixed.columns) == len(set(mixed.columns))
    assert all(r.target > 0 and r.fp == "x" for r in rows if r.size)
    with pytest.raises(ValueError, match="are results"):
        pareto_mix.apply_plan(sized.withColumnRenamed("size", "taken"), pareto_mix.plan(sized), size="taken")
    with pytest.raises(ValueError, match="_mix_"):
        pareto_mix.apply_plan(sized.withColumn("_mix_bin", F.lit(1)), pareto_mix.plan(sized))
    none = no_docs.withColumn("size", pareto_mix.word_count("text"))
    assert pareto_mix.apply_plan(none, pareto_mix.plan(none)).count() == 0


# ---- near copies


def plain_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    pieces = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    ones = [0] * 64
    for p in pieces:
        h = xxhash.xxh64_intdigest(p, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(pieces))


def plain_components(prints, distance=2):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= distance:
            root[top(a)] = top(b)
    return {v: top(v) for v in values}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def check_components(rows, got):
    prints = {i: plain_print(t) for i, t in rows}
    root = plain_components(prints.values())
    least = {}
    for i, f in prints.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert {r.doc_id: (r.fp, r.component_id) for r in got} == {i: (signed(f), least[root[f]]) for i, f in prints.items()}


@pytest.mark.parametrize(("cap", "distance"), [(64, 2), (1, 2), (1, 1), (64, 1), (64, 0), (3, 2)])
def test_pairs_against_brute_force(spark, cap, distance):
    r = random.Random(cap + distance)
    centres = [r.getrandbits(64) for _ in range(12)] + [0]
    prints = {c ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 5))) for c in centres for _ in range(12)}
    frame = spark.createDataFrame([(signed(p),) for p in sorted(prints)], "fp bigint")
    for parts in (2, 3, 4) if distance == 2 else (2,):
        edges = simhash_gph.near_pairs(frame, distance=distance, bucket_cap=cap, parts=parts).collect()
        mask = (1 << 64) - 1
        assert all(((e.a ^ e.b) & mask).bit_count() <= distance and e.a < e.b for e in edges)
        found = collections.defaultdict(set)
        for e in edges:
            found[e.a & mask].add(e.b & mask)
            found[e.b & mask].add(e.a & mask)
        root = plain_components(prints, distance)
        seen = {}
        for start in prints:
            reach, todo = {start}, [start]
            while todo:
                todo.extend(found[todo[0]] - reach)
                reach |= found[todo.pop(0)]
            seen[start] = frozenset(reach)
        assert all((seen[a] == seen[b]) == (root[a] == root[b]) for a, b in combinations(sorted(prints), 2))


def test_thresholds_sum_as_the_principle_asks():
    r = random.Random(1)
    sample = [r.getrandbits(64) for _ in range(200)]
    for parts in (2, 3, 4, 6):
        chosen = simhash_gph.allocate(sample, 10**6, 2, parts)
        assert sum(t for _, t in chosen) - (parts - len(chosen)) == 2 - parts + 1
    skewed = [x & ~0xFFFFF for x in sample]
    assert sum(m.bit_count() for m, _ in simhash_gph.allocate(skewed, 10**6, 2, 3)) <= 64


def test_near_copies_of_edge_rows(spark, clashing, no_docs):
    got = simhash_gph.near_duplicates(clashing).collect()
    assert len(got) == 13
    assert {(r.fp, r.component_id) for r in got if r.doc_id in (2, 3, 4)} == {(0, 2)}
    assert {r.component_id for r in got if r.doc_id in (7, 8)} == {7}
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert simhash_gph.near_duplicates(no_docs).count() == 0


def test_near_copy_query(spark, sf_dir, documents):
    check_components([(r.doc_id, r.text) for r in documents.collect()], simhash_gph.near_duplicates(documents).collect())
    row = QUERIES["op10_simhash_gph"](spark, sf_dir).first()
    assert len(row.fingerprint) == 16


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(6)
    edges = [(k, k + 1) for k in range(100)] + [(200, 200 + k) for k in range(1, 50)] + [(300, 300), (7, 3), (3, 7)]
    r.shuffle(edges)
    got = {row.node: row.root for row in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(101)}, **{k: 200 for k in range(200, 250)}}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_tasks_contract_their_edges_first(spark, monkeypatch):
    """A chain in a few tasks takes one look, not a round for each doubling; many small shares give the same."""
    tables = []
    monkeypatch.setattr(components, "pin", lambda df, label, real=components.pin: tables.append(label) or real(df, label))
    edges = spark.createDataFrame([(k, k + 1) for k in range(400)], "a bigint, b bigint").repartition(3)
    assert {(row.node, row.root) for row in components.components(edges).collect()} == {(k, 0) for k in range(401)}
    assert len(tables) <= 3
    monkeypatch.setattr(components, "EDGES_AT_ONCE", 50)
    got = sorted((row.node, row.root) for row in components.components(edges).collect())
    assert got == [(k, 0) for k in range(401)]


# ---- pipeline


def test_near_copies_stage_against_brute_force(spark, sf_dir, documents):
    import corpus_pipeline

    rows = [(r.doc_id, r.text) for r in documents.collect()]
    root = plain_components([plain_print(t) for _, t in rows])
    least = {}
    for i, t in rows:
        key = root[plain_print(t)]
        least[key] = min(i, least.get(key, i))
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    assert sorted(r.doc_id for r in stage(spark, documents, sf_dir).collect()) == sorted(least.values())


def test_leaks_and_mix_stages_against_their_operators_results(spark, sf_dir, documents):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    hit = {r.doc_id for r in QUERIES["op8_positional_index"](spark, sf_dir).filter("contaminated").collect()}
    kept = {r.doc_id for r in stages["benchmark_leaks"](spark, documents, sf_dir).collect()}
    assert kept == {r.doc_id for r in documents.collect()} - hit and hit
    mixed = {r.doc_id: (r.copies, r.taken) for r in QUERIES["op9_pareto_mix"](spark, sf_dir).filter("copies > 0").collect()}
    assert {r.doc_id: (r.copies, r.taken) for r in stages["source_mix"](spark, documents, sf_dir).collect()} == mixed


def test_two_runs_agree(spark, sf_dir):
    import corpus_pipeline

    def rows():
        return sorted((tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()), key=repr)

    assert rows() == rows()


def test_stages_keep_columns_and_take_effect(spark, sf_dir, documents):
    import corpus_pipeline

    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[4] < counts[3]
    prints = [plain_print(r.text) for r in docs.collect()]
    assert len(prints) > 50
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert all(1 <= r.copies <= 3 for r in last)


def test_stages_on_edge_rows(spark, edges, no_docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (8, 1, None), (2, 0, 0), (None, 1, 1), (5, None, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(4, 30)), (None, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    extra = edges.selectExpr("*", "'x' as removed", "1 as hits", "'y' as _kept", "2 as copies")
    near = stages["near_copies"](spark, extra, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in near), key=repr) == sorted([1, 2, 5, 6, 7, 9, 10, None], key=repr)
    same_id = spark.createDataFrame([(7, prose(8, 50), "en", "a", 3), (7, prose(21, 50), "en", "a", 3), (7, prose(21, 50), "de", "a", 3)], edges.schema)
    two = stages["near_copies"](spark, edges.union(same_id), str(tmp_path)).collect()
    assert sorted((r.text for r in two if r.doc_id == 7)) == sorted([prose(8, 50), prose(21, 50)])
    assert len(two) == len(near) + 1
    passages = stages["repeated_passages"](spark, extra, str(tmp_path)).collect()
    assert {5, 6, 7, 9, 1, 2} <= {r.doc_id for r in passages}
    assert all(r.n_chars == len(r.text) for r in passages if r.doc_id == 6)
    leaks = stages["benchmark_leaks"](spark, extra, str(tmp_path)).collect()
    assert 5 not in {r.doc_id for r in leaks} and len(leaks) == 12
    assert stages["quality"](spark, extra, str(tmp_path)).columns == edges.columns
    for stage in stages.values():
        assert stage(spark, no_docs, str(tmp_path)).count() == 0
