import collections
import math
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import ngram_trie, rank_profiles, rule_ensemble
from siltstone.llm.elias_fano import EliasFano
from siltstone.llm.queries import QUERIES
from siltstone.session import scratch


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**63), max_size=200), st.lists(st.integers(0, 2**63), min_size=1, max_size=30))
def test_elias_fano_against_lists(values, asked):
    values.sort()
    ef = EliasFano(EliasFano.encode(np.array(values, dtype=np.uint64)))
    assert ef.access(np.arange(len(values))).tolist() == values
    x = np.array(asked + values[:5], dtype=np.uint64)
    assert ef.successor(x).tolist() == np.searchsorted(np.array(values, dtype=np.uint64), x).tolist()


def test_elias_fano_is_small_and_searches_stretches():
    r = np.random.default_rng(1)
    values = np.sort(r.integers(0, 10**7, 100_000))
    ef = EliasFano(EliasFano.encode(values))
    assert ef.nbytes < 100_000 * (2 + math.log2(100) + 1) / 8
    first = r.integers(0, 90_000, 500)
    x = values[first + r.integers(0, 50, 500)]
    want = [int(np.searchsorted(values[a : a + 30], v)) + a for a, v in zip(first.tolist(), x.tolist(), strict=True)]
    assert ef.successor(x, first, first + 30).tolist() == want


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute_score(rows, order=3, min_count=2, discount=0.5, gain=8.0):
    """The model of ngram_trie with dictionaries; (n_tokens, n_known, N, base, score) per row."""
    counts = [collections.Counter() for _ in range(order + 1)]
    train = 0
    for text, held in rows:
        if held:
            continue
        train += 1
        w = tokens(text)
        for k in range(len(w)):
            for n in range(1, order + 1):
                if k - n + 1 >= 0:
                    counts[n][tuple(w[k - n + 1 : k + 1])] += 1
        counts[2][("<s>", w[0])] += 1
        if len(w) > 1:
            counts[3][("<s>", w[0], w[1])] += 1
    n_all, types = sum(counts[1].values()), len(counts[1])
    hot_from = max(1, int(ngram_trie.HOT_SHARE * n_all))
    one = lambda w: math.log10((counts[1][(w,)] + 1) / (n_all + types + 1))
    kept, back = [{}, {}], [{}, {}]

    def low(gram):
        """log10 p by the levels below len(gram)."""
        n = len(gram)
        if n == 1:
            return one(gram[0])
        if gram in kept[n] if n < len(kept) else False:
            return ngram_trie.from_code(kept[n][gram])
        weight = back[n].get(gram[:-1], 0.0) if n < len(back) else 0.0
        return weight + low(gram[1:])

    for n in range(2, order + 1):
        level, sums, lows = {}, collections.defaultdict(float), collections.defaultdict(float)
        for gram, c in counts[n].items():
            context = gram[:-1]
            if n == 2:
                if context != ("<s>",) and counts[1][context] < min_count:
                    continue
                big = train if context == ("<s>",) else counts[1][context]
            else:
                if context not in kept[n - 1] or gram[1:] not in kept[n - 1]:
                    continue
                big = counts[n - 1][context]
            if counts[1][gram[-1:]] < min_count:
                continue
            code = int(ngram_trie.to_code(np.array([10.0 ** low(gram[1:])]))[0])
            p = 10.0 ** (code / -20)
            if c >= min_count and c * math.log(max(c / (big * p), 1.0)) - max(c - big * p, 0) >= gain:
                level[gram] = int(ngram_trie.to_code(np.array([(c - discount) / big]))[0])
                sums[context] += (c - discount) / big
                lows[context] += p
        kept.append(level)
        weights = {}
        for context in sums:
            big = train if context == ("<s>",) else counts[n - 1][context]
            b = max(1 - sums[context], 1e-6) / max(1 - lows[context], 1e-3)
            weights[context] = math.log10(b) if big > hot_from else float(ngram_trie.from_weight(ngram_trie.to_weight(np.array([b])))[0])
        back.append(weights)
    out = []
    for text, _ in rows:
        w = ["<s>", *tokens(text)]
        total = base = 0.0
        for k in range(1, len(w)):
            longest = min(order, k + 1)
            total += low(tuple(w[k - longest + 1 : k + 1])) if longest > 1 else one(w[k])
            base += one(w[k])
        out.append((len(w) - 1, sum(counts[1][(t,)] > 0 for t in w[1:]), n_all, base, total))
    return out


def texts(seed, n=120):
    r = random.Random(seed)
    phrases = [" ".join(r.choice("abcdefghijklmnop") * 2 for _ in range(6)) for _ in range(8)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(r.randrange(0, 12)):
            words.append(r.choice(phrases) if r.random() < 0.5 else f"w{r.randrange(40)}")
        rows.append((k, " ".join(words) if k % 17 else None, k % 7 == 2))
    return rows


def check_scores(spark, rows, monkeypatch=None, **options):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean").repartition(5)
    options.setdefault("gain", 8.0)
    got = {r.doc_id: r for r in ngram_trie.score(frame, **options)[0].collect()}
    want = brute_score([(t, h) for _, t, h in rows], gain=options["gain"])
    assert len(got) == len(rows)
    for (ident, _, held), (n, known, total, base, score) in zip(rows, want, strict=True):
        r = got[ident]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, held)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert r.score == pytest.approx(score, abs=1e-6), ident
    return got


def test_scores_without_pruning_against_brute_force(spark):
    check_scores(spark, texts(4), gain=0.0)


def test_scores_against_brute_force(spark):
    got = check_scores(spark, texts(1))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_with_many_shards_and_hot_contexts(spark, monkeypatch):
    monkeypatch.setattr(ngram_trie, "SHARD_ENTRIES", 40)
    monkeypatch.setattr(ngram_trie, "BLOCK_BYTES", 500)
    check_scores(spark, texts(2, 200))


def test_probabilities_sum_to_at_most_one(spark):
    rows = texts(3)
    vocabulary = sorted({t for x, h in [(t, h) for _, t, h in rows] if not h for t in (x or "").split()})
    for context in ("", "aa", rows[1][1].split()[0] if rows[1][1] else "aa"):
        tries = [(10_000 + k, f"{context} {w}".strip(), True) for k, w in enumerate(vocabulary)] + [(9_999, context, True)]
        got = {r.doc_id: r.score for r in ngram_trie.score(spark.createDataFrame(rows + tries, "doc_id bigint, text string, held_out boolean"), gain=8.0)[0].collect()}
        # p(context w </s>) / p(context </s>) differ by the end token only; compare the first word after START.
        if not context:
            want = brute_score([(t, h) for _, t, h in rows + tries])
            total = sum(10.0 ** (want[len(rows) + k][4]) for k in range(len(vocabulary)))
            assert total <= 1.0 + 1e-9
        assert all(v <= 1e-9 for v in got.values())


def test_scores_of_edge_rows(spark, edges, no_docs, clashing):
    held = clashing.selectExpr("*", "doc_id % 2 = 1 as held_out")
    rows = ngram_trie.score(held)[0].collect()
    assert len(rows) == 13
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 7}) == 1
    assert ngram_trie.score(no_docs.selectExpr("*", "true as held_out"))[0].count() == 0
    untrained = ngram_trie.score(edges.selectExpr("*", "true as held_out"))[0].collect()
    assert {r.score for r in untrained} == {0.0} and {r.train_tokens for r in untrained} == {0}


def test_lm_query_counts_and_gain(spark, sf_dir, documents):
    rows = documents.select("doc_id", "text").collect()
    counts = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update(tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in QUERIES["op3_ngram_trie"](spark, sf_dir).collect()}
    for r in rows:
        own, w = got[r.doc_id], tokens(r.text)
        assert (own.n_tokens, own.n_known, own.train_tokens) == (len(w), sum(counts[t] > 0 for t in w), n)
        assert own.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_query_drops_no_ngram_with_the_count(spark, sf_dir, documents):
    rows = documents.select("doc_id", "text").collect()
    want = brute_score([(r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows], gain=0.0)
    got = {r.doc_id: r.score for r in QUERIES["op3_ngram_trie"](spark, sf_dir).collect()}
    for r, (*_, score) in zip(rows, want, strict=True):
        assert got[r.doc_id] == pytest.approx(score, abs=1e-6)


def brute_grams(text):
    padded = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    found = collections.Counter()
    for n in (1, 2, 3):
        for k in range(len(padded) - n + 1):
            g = padded[k : k + n]
            if g.strip() and " " not in g[1:-1]:
                found[g] += 1
    return found


def brute_rank(counter, most):
    return sorted(counter, key=lambda g: (-counter[g], sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))))[:most]


def test_profiles_against_brute_force(spark):
    r = random.Random(5)
    letters = {"aa": "abcdéfg hi", "bb": "defgh ijkß", "cc": "ijklmn opö"}
    rows = [(k, "".join(r.choice(letters[lang]) for _ in range(r.randrange(0, 400))) + " X1!", lang) for k in range(60) for lang in [r.choice(list(letters))]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    most = 40
    learned = rank_profiles.collect_profiles(rank_profiles.learn(frame, most=most), most)
    totals = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        totals[lang].update(brute_grams(text))
    profiles = {lang: {g: k for k, g in enumerate(brute_rank(c, most))} for lang, c in totals.items()}
    got = {r.doc_id: r for r in rank_profiles.predict(frame, learned).collect()}
    for ident, text, _ in rows:
        own = brute_rank(brute_grams(text), most)
        far = {lang: sum(abs(p[g] - k) if g in p else most for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert got[ident].lang_pred == best
        assert got[ident].score == pytest.approx(1 - far[best] / (most * len(own)))


def test_profiles_of_edge_rows(edges, no_docs, clashing):
    learned = rank_profiles.collect_profiles(rank_profiles.learn(clashing))
    rows = rank_profiles.predict(clashing, learned).collect()
    assert len(rows) == 13 and {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows)
    nothing = rank_profiles.collect_profiles(rank_profiles.learn(no_docs))
    assert rank_profiles.predict(no_docs, nothing).count() == 0
    assert {r.lang_pred for r in rank_profiles.predict(edges, nothing).collect()} == {"und"}


def test_language_query_on_held_out_rows(spark, sf_dir, documents):
    langs = {r.doc_id: r.lang for r in documents.collect()}
    rows = [r for r in QUERIES["op4_rank_profiles"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.95 * len(rows)


def test_statistics_and_scores_of_edge_rows(spark, clashing, no_docs):
    rows = rule_ensemble.statistics(clashing).collect()
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert all(r[n] == 0.0 for r in blank for n in rule_ensemble.STATISTICS)
    assert rule_ensemble.statistics(no_docs).count() == 0
    caps = rule_ensemble.statistics(spark.createDataFrame([("AA bb AA\nC1!",)], "text string")).first()
    assert (caps.q_words, caps.q_lines, caps.q_distinct, caps.q_ends_symbol) == (4, 0.5, 0.75, 0.25)
    assert caps.q_upper == pytest.approx(5 / 12)


def test_rules_find_conjunctions_and_compile(spark):
    r = np.random.default_rng(2)
    x = r.random((600, len(rule_ensemble.STATISTICS)))
    y = ((x[:, 2] > 0.5) & (x[:, 5] <= 0.4)).astype(float)
    model = rule_ensemble.learn(x, y)
    frame = spark.createDataFrame(x.tolist(), list(rule_ensemble.STATISTICS))
    scores = np.array([s[0] for s in frame.select(rule_ensemble.score_column(model)).collect()])
    by_hand = model.intercept + sum(w * rule_ensemble._holds(x, rule) for rule, w in model.rules)
    assert np.allclose(scores, 1 / (1 + np.exp(-by_hand)))
    assert ((scores >= 0.5) == (y == 1)).mean() > 0.98
    assert len(model.rules) < 200


def test_degenerate_labels(spark, edges):
    assert rule_ensemble.learn(np.zeros((0, 14)), np.zeros(0)).intercept == 0
    assert rule_ensemble.learn(np.zeros((3, 14)), np.ones(3)).rules == []
    stats = rule_ensemble.statistics(edges).selectExpr("*", "cast(null as int) as quality")
    assert rule_ensemble.fit(stats, "quality").rules == []


def test_sample_bound_does_not_depend_on_partitions(spark):
    r = random.Random(4)
    rows = [(k, float(r.random() < 0.5), *[r.random() for _ in rule_ensemble.STATISTICS]) for k in range(400)]
    frame = spark.createDataFrame(rows, ["doc_id", "quality", *rule_ensemble.STATISTICS])
    a = rule_ensemble.fit(frame.repartition(7), "quality", at_most=100, trees=3)
    b = rule_ensemble.fit(frame.coalesce(1), "quality", at_most=100, trees=3)
    assert a == b


def test_quality_query_on_held_out_rows(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op5_rule_ensemble"](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.85 * len(held)


def test_replies_leave_in_shares():
    """A shard's answers are not one Arrow batch, which both sides would hold whole."""
    rows = [(0, k, bytes(300_000), None, None, None, None) for k in range(20)] + [(0, -1, None, 1, 2, "f", 3)]
    table = ngram_trie._reply_table(rows)
    assert max(batch.nbytes for batch in table.to_batches()) < 2_000_000
    assert table.column("block").to_pylist() == [row[1] for row in rows]


def folder_bytes(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(path) for f in files if f.endswith((".parquet", ".level")))


def test_answers_and_levels_are_small(spark):
    """Answers take some bits for each token and are kept once a level; a trie's node takes some bytes."""
    r = np.random.default_rng(3)
    drawn = np.minimum(r.zipf(1.3, (400, 500)), 5000)
    frame = spark.createDataFrame([(k, " ".join(f"w{x}" for x in row), k % 7 == 2) for k, row in enumerate(drawn.tolist())], "doc_id bigint, text string, held_out boolean")
    with scratch(spark) as path:
        files = ngram_trie.score(frame.coalesce(1))[1].filter("level > 1").collect()
        local = path.removeprefix("file://").removeprefix("file:")
        sizes = {name: folder_bytes(f"{local}/{name}") for name in os.listdir(local)}
    answers = sum(size for name, size in sizes.items() if name.startswith(("pairs-", "answers-")))
    assert answers < 0.25 * drawn.size
    assert sum(f.level_bytes for f in files) < 8 * sum(f.types for f in files)


def test_questions_do_not_widen_with_the_shards():
    """Contexts of a shard are a stretch of the nodes, so their steps are as small with many shards as with one."""
    r = np.random.default_rng(4)
    n, nodes = 60_000, 1_000_000
    context, word = r.integers(0, nodes, n), r.integers(1, 50, n)
    b = ngram_trie.Block(word, np.array([n]), np.ones(n, dtype=bool), np.zeros(n, dtype=bool))

    def sent(shards):
        asked = ngram_trie._asked(context, np.full(n, 3), word, np.ones(n, dtype=bool), 1000, shards, nodes)
        assert set(zip(asked.c.tolist(), asked.w.tolist(), strict=True)) == set(zip(context.tolist(), word.tolist(), strict=True))
        assert (asked.c[asked.pair] == context[asked.tokens]).all() and (asked.w[asked.pair] == word[asked.tokens]).all()
        return sum(len(body) for _, body in ngram_trie._ask_pairs(b, asked, np.full(n, 3), np.full(n, -2.0)))

    assert sent(20) < 1.1 * sent(1)


def test_counts_in_bytes():
    counts = np.array([2, 254, 255, 256, 3, 1 << 40])
    held = ngram_trie._narrow_counts(counts)
    assert ngram_trie._counts({k: a.view(np.uint8) for k, a in held.items()}).tolist() == counts.tolist()
