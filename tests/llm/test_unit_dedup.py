import random

from llm.conftest import prose

from siltstone.llm import unit_dedup


def words_of(seed, n, vocabulary=5000):
    r = random.Random(seed)
    return [f"v{r.randrange(vocabulary)}" for _ in range(n)]


def deduped(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    return {r.doc_id: r for r in unit_dedup.dedup_units(frame).collect()}


def test_short_repeated_lines_are_cut(spark):
    lines = {n: prose(40 + n, n, 5000) for n in (1, 3, 7, 8, 10, 24)}
    rows, own = [], {}
    for k in range(12):
        own[k] = [prose(800 + 10 * k + j, 12, 9000) for j in range(7)]
        body = [x for pair in zip(own[k], lines.values(), strict=False) for x in pair]
        rows.append((k, "\n".join(body)))
    got = deduped(spark, rows)
    assert got[0].text == rows[0][1]
    for k in range(1, 12):
        assert got[k].text.strip("\n").split("\n") == own[k][: len(lines)]
        assert len(got[k].removed) == len(lines)


def test_passages_without_stops_are_cut_to_the_word(spark):
    r = random.Random(5)
    plain = words_of(1, 51)
    long_sentences = [w + "." if k % 26 == 13 else w for k, w in enumerate(words_of(2, 51))]
    rows, want = [], {}
    for k in range(40):
        passage = (plain, long_sentences)[k % 2]
        body = words_of(100 + k, 90)
        at = r.randrange(91)
        rows.append((k, " ".join([*body[:at], *passage, *body[at:]])))
        want[k] = " ".join(body) if k > 1 else rows[-1][1]
    got = deduped(spark, rows)
    assert {k: " ".join(r.text.split()) for k, r in got.items()} == want


def test_windows_against_brute_force(spark):
    """Runs of 25 words or more that occur earlier go, shorter ones stay; also two runs side by side and within a row."""
    parts = [words_of(500 + k, n) for k, n in enumerate((24, 25, 26, 40, 60))]
    r, rows = random.Random(9), []
    for k in range(30):
        body = words_of(2000 + k, 60, 10**6)
        for p in r.sample(range(5), 2) if k % 3 else [2, 3]:
            body = body + parts[p] + (words_of(3000 + 7 * k + p, 5, 10**6) if k % 3 else [])
        rows.append((k, " ".join(body)))
    seen, want = set(), {}
    for k, text in rows:
        w, first, gone = text.split(), {}, set()
        grams = [tuple(w[i : i + 25]) for i in range(len(w) - 24)]
        for i, g in enumerate(grams):
            if g in seen or i >= first.setdefault(g, i) + 25:
                gone.update(range(i, i + 25))
        seen.update(grams)
        want[k] = [x for i, x in enumerate(w) if i not in gone]
    got = deduped(spark, rows)
    assert {k: r.text.split() for k, r in got.items()} == want
