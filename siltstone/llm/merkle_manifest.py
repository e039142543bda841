"""Merkle manifest of a table: one tree per language, their roots under one root, a proof for every row.

Leaves are digests of rows. Inside a language they stand by ascending id; every `FANOUT` consecutive
nodes become the digest of their joined digests until one node remains. The languages' roots, in order
of the language, are folded the same way into the root of the manifest.

A level is one window over blocks of consecutive nodes: lag and lead at the offsets 1 .. FANOUT - 1,
masked by a node's slot in its run and by the run's length, give the siblings to the left and to the
right; the first child of a run hashes the parent. Blocks hold whole runs and a fixed number of nodes,
so a language with most of the rows spreads like any other. Proofs come down the levels: a node's path
is its own siblings followed by its parent's path.

Nulls, ties and repeated rows: a null value counts as `-`, a null language is a language of its own and
comes first, a null id comes before all others and is never tampered with. Rows that share language and
id stand in the order of their digests. An empty table gives an empty result. Long texts are hashed where
they are read; only digests move. Other columns than the five named ones are not read, so their names
cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.keys import dense_key
from siltstone.session import pin

FANOUT = 8
BLOCK = FANOUT * FANOUT  # nodes that one window partition holds
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: `-` for null, otherwise its length in bytes, a colon, and itself."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(text: Column | None = None) -> Column:
    """Digest of a row of FIELDS, with another text if one is given."""
    values = [F.col(name) for name in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return digest(*[field(value) for value in values])


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _siblings(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, pos, n, h, ...) with the joined digests to the left and right in their runs."""
    order = Window.partitionBy("tree", F.expr(f"pos div {BLOCK}")).orderBy("pos")
    slot = F.col("pos") % FANOUT
    run = F.least(F.lit(FANOUT), F.col("n") - F.col("pos") + slot)
    left = [F.when(slot >= k, F.lag("h", k).over(order)) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("h", k).over(order)) for k in range(1, FANOUT)]
    return nodes.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})


def _levels(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all trees of `nodes` (tree, pos, n, h, ...), lowest first, and (tree, h) of their roots.

    A tree of one node is done; higher levels carry it along unchanged. The driver sees one number a level.
    """
    levels = []
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        level = pin(_siblings(nodes), label)
        levels.append(level)
        parent = F.when(F.col("n") > 1, digest(F.col("h"), F.col("right"))).otherwise(F.col("h"))
        nodes = level.filter(f"pos % {FANOUT} = 0").select(
            "tree", F.expr(f"pos div {FANOUT}").alias("pos"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), parent.alias("h")
        )
    return levels, nodes.select("tree", "h")


def _descend(levels: Sequence[DataFrame], tops: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(tree, pos, path, *keep of tops) of the lowest nodes, from `tops` (tree, path, *keep) of the roots."""
    paths = tops.withColumn("pos", F.lit(0).cast("bigint"))
    for level in reversed(levels):
        own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.slice("path", 1, 0))
        above = paths.withColumnRenamed("pos", "up")
        below = level.select("tree", "pos", "n", "left", "right", F.expr(f"pos div {FANOUT}").alias("up"))
        joined = below.join(above, ["tree", "up"])
        paths = joined.select("tree", "pos", F.concat(own, "path").alias("path"), *keep)
    return paths


def manifest(leaves: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, str | None]:
    """(doc_id, lang, leaf, *keep, path, subroot) of `leaves` (doc_id, lang, leaf, *keep), and the root.

    The names in `keep` must differ from the others given here and must not start with `_`.
    """
    ids = ("doc_id", "lang", "leaf", *keep)
    numbered = dense_key(pin(leaves.select(*ids), "leaves"), ["lang", "doc_id", "leaf", *keep], "_at", start=0)
    numbered = pin(numbered, "numbered")
    langs = pin(numbered.groupBy("lang").agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("n")), "languages")
    langs = pin(dense_key(langs, ["lang"], "tree", start=0), "trees")
    own = langs.select(F.col("lang").alias("_lang"), "tree", "n", "_start")
    placed = numbered.join(own, F.col("lang").eqNullSafe(F.col("_lang")))
    nodes = placed.select("tree", (F.col("_at") - F.col("_start")).alias("pos"), "n", F.col("leaf").alias("h"), *ids)
    # Trees of one leaf only make no level: the rows are needed all the same.
    nodes = pin(nodes, "nodes")
    levels, roots = _levels(nodes, "level")
    roots = pin(roots.withColumnRenamed("h", "subroot"), "subroots")
    tops = roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("h"))
    top_levels, top = _levels(tops.withColumn("n", F.lit(roots.count()).cast("bigint")), "top")
    root = top.select("h").first()  # one row
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = top.select("tree", none.alias("path"))
    high = _descend(top_levels, start, ()).select(F.col("pos").alias("tree"), "path")
    tops = pin(high.join(roots, "tree"), "tops")
    if not levels:
        return nodes.join(tops, "tree").select(*ids, "path", "subroot"), root and root[0]
    upper = _descend(levels[1:], tops, ["subroot"]).withColumnRenamed("pos", "up")
    lowest = levels[0].withColumn("up", F.expr(f"pos div {FANOUT}")).join(pin(upper, "paths"), ["tree", "up"])
    step = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.slice("path", 1, 0))
    return lowest.select(*ids, F.concat(step, "path").alias("path"), "subroot"), root and root[0]


def tampered_text(every: int = 3) -> Column:
    """The text, with A-Z in lower case where `every` divides the crc32 of the decimal id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(hit, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


def audit(docs: DataFrame, tampered: Column) -> DataFrame:
    """Each row's leaf, its proof, and whether the leaf of the `tampered` text still leads to the root."""
    leaves = docs.select("doc_id", "lang", leaf().alias("leaf"), leaf(tampered).alias("seen"))
    proofs, root = manifest(leaves, keep=["seen"])
    known = F.lit(root).cast("string")
    found = folded(F.col("seen"), F.col("path"))
    return proofs.select(
        "doc_id", "leaf", "subroot", known.alias("root"), path_digest(F.col("path")).alias("proof_sha256"), found.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
