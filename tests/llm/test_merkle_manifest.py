import hashlib
import zlib

from siltstone.llm import merkle_manifest
from llm.conftest import SCHEMA, edge_rows

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def fold(nodes):
    """Root of `nodes`, and for each of them its siblings (left, right) level by level."""
    paths, below, level = [[] for _ in nodes], [[k] for k in range(len(nodes))], list(nodes)
    while len(level) > 1:
        above, held = [], []
        for first in range(0, len(level), 8):
            run = level[first : first + 8]
            for slot in range(len(run)):
                for k in below[first + slot]:
                    paths[k].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            above.append(sha("".join(run)))
            held.append([k for part in below[first : first + 8] for k in part])
        level, below = above, held
    return level[0], paths


def brute(rows):
    by = {}
    for row in rows:
        by.setdefault(row[2], []).append(row)
    langs = sorted(by, key=lambda lang: (lang is not None, (lang or "").encode()))
    found = []
    for lang in langs:
        own = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        found.append((own, *fold([leaf(*r) for r in own])))
    root, tops = fold([subroot for _, subroot, _ in found])
    out = []
    for (own, subroot, paths), top in zip(found, tops, strict=True):
        for row, path in zip(own, paths, strict=True):
            text = row[1]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf(row[0], text, *row[2:])
            for left, right in path + top:
                h = sha(left + h + right)
            proof = sha("".join(left + right for left, right in path + top))
            out.append((row[0], leaf(*row), subroot, root, proof, h, h == root))
    return sorted(out, key=repr)


def audited(df):
    found = merkle_manifest.audit(df, merkle_manifest.tampered_text())
    assert tuple(found.columns) == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_edge_rows(edges):
    assert audited(edges) == brute(edge_rows())


def test_clashing_columns(edges):
    names = ("tree", "pos", "h", "n", "left", "right", "path", "leaf", "root", "seen", "up", "_at")
    more = edges.selectExpr("*", *[f"'x' as {name}" for name in names])
    assert audited(more) == brute(edge_rows())


def test_given_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = audited(documents)
    assert found == brute(rows)
    assert 0 < sum(row[-1] for row in found) < len(found)


def test_many_languages_and_deep_trees(spark):
    """9 and 65 languages make trees of their own on top; one language holds most rows, others one."""
    rows = [(k, f"Text {k}", f"l{k % 97:02d}" if k < 97 else "l00", "s", k) for k in range(700)]
    assert audited(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_one_row_and_none(spark, no_docs):
    rows = [(3, "A", None, None, None)]
    found = audited(spark.createDataFrame(rows, SCHEMA))
    assert found == brute(rows)
    assert found[0][1] == found[0][2] == found[0][3]
    assert audited(no_docs) == []
