"""Keyed joins that hold when the lookup side grows or one key dominates.

Joins are left to the adaptive optimizer: it broadcasts a side whose measured bytes are below
`spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles both sides and splits partitions of the
left side that are too large (`spark.sql.adaptive.skewJoin`, for inner, left, semi and anti joins alike),
repeating the matching lookup rows for each piece. Nothing is counted while a plan is built, and the
number of pieces follows from the size of the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.keys import placed_rows
from siltstone.session import pin_sized

# A batch of changes is sent to every executor if its files have at most this many bytes.
BATCH_BYTES = 16 << 20

Residual = Callable[[str, str], Column]


def _matched(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, residual: Residual | None
) -> DataFrame:
    if residual is None:
        return left.join(right, list(on), how)
    l, r = left.alias("l"), right.alias("r")
    same = reduce(and_, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on])
    joined = l.join(r, same & residual("l", "r"), how)
    if how in ("left_semi", "left_anti"):
        return joined
    extra = [F.col(f"r.{c}") for c in right.columns if c not in on]
    return joined.select("l.*", *extra)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    residual: Residual | None = None,
) -> DataFrame:
    """Join a large left side to a lookup on `on` (inner, left, left_semi or left_anti).

    Join keys come first in the result, as with a join by names, unless a residual is given. Any column
    type may stand beside the keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} is not supported")
    return _matched(left, right, on, how, residual)


def pair_rows(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    all_targets: bool = True,
    size: int | None = None,
) -> DataFrame:
    """Match a large target with a batch of changes, both unique per key.

    The result holds both rows as structs `d` (target) and `s` (source), one of them NULL without a
    partner; without `all_targets`, target rows that no change refers to are left out. A batch of at most
    `BATCH_BYTES` is broadcast, so that the target is read in place and not shuffled. A larger one takes
    an outer join on the key. Either way gives the same rows. `size` is given if the batch is pinned already.
    """
    if size is None:
        source, size = pin_sized(source, "batch")  # read up to four times below, computed once
    t = target.select(*key, F.struct(*target.columns).alias("d"))
    s = source.select(*key, F.struct(*source.columns).alias("s"))
    if size > BATCH_BYTES:
        how = "full_outer" if all_targets else "right_outer"
        return t.join(s, list(key), how).select("d", "s")
    keys = F.broadcast(source.select(*key))
    matched = target.select(*key).join(keys, list(key), "left_semi")  # at most the batch's rows
    unmatched = s.join(F.broadcast(matched), list(key), "left_anti")
    missing = F.lit(None).cast(t.schema["d"].dataType).alias("d")
    found = t.join(F.broadcast(s), list(key), "left" if all_targets else "inner")
    return found.select("d", "s").unionByName(unmatched.select(missing, "s"))


def attach_keys(
    fact: DataFrame, dims: Mapping[str, tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """Resolve surrogate keys: `{key column: (dimension, natural key columns)}`.

    Rows without a partner are dropped (inner join); `unmatched` lists them with the key they lack.
    """
    for key, (dim, on) in dims.items():
        fact = keyed_join(fact, dim.select(key, *on), on)
    return fact


def unmatched(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The rows that `attach_keys` drops, with `missing_key`: the first surrogate key not found."""
    marked, tests = fact, []
    for key, (dim, on) in dims.items():
        marked = mark_known(marked, dim, on, f"_has_{key}")
        tests.append(F.when(~F.col(f"_has_{key}"), key))
    missing = F.coalesce(*tests)
    return marked.select(*fact.columns, missing.alias("missing_key")).filter("missing_key is not null")


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Join a fact to its dimensions by surrogate key."""
    for key, dim in dims.items():
        fact = keyed_join(fact, dim, [key])
    return fact


def mark_known(df: DataFrame, reference: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Add a boolean that tells whether the key exists in `reference`. Keeps every row once."""
    known = reference.select(*on).distinct().withColumn(flag, F.lit(True))
    joined = keyed_join(df, known, on, "left")
    return joined.select(*df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def lookup_current(df: DataFrame, dim: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Attributes of the current version; NULL when the key is unknown."""
    current = dim.filter(F.col("is_current")).select(*on, *take)
    return keyed_join(df, current, on, "left").select(*df.columns, *take)


def asof_version(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    ts: str,
    take: Sequence[str],
    closed: bool = True,
    how: str = "inner",
) -> DataFrame:
    """Version valid at `ts`. `closed` says whether `valid_to` itself still belongs to the version.

    The key equality stays in the condition, so the join hashes and the range is a residual test.
    """
    versions = dim.select(*on, *take, "valid_from", "valid_to")

    def valid(l: str, r: str) -> Column:
        at, end = F.col(f"{l}.{ts}"), F.col(f"{r}.valid_to")
        until = (at <= end) if closed else (at < end)
        return (at >= F.col(f"{r}.valid_from")) & (end.isNull() | until)

    return keyed_join(df, versions, on, how, valid).select(*df.columns, *take)


def asof_carried(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    ts: str,
    take: Sequence[str],
    closed: bool = True,
    how: str = "inner",
) -> DataFrame:
    """`asof_version` for histories of any length, if the versions of a key do not overlap.

    Rows and versions are sorted together by key and instant, and every row takes the last version before it.
    A key with a hundred thousand versions, or a third of all rows, is cut by the range partitions like any
    other; what is open at a cut is carried over as one version per partition. Nothing is multiplied.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how!r} is not supported")
    present = reduce(and_, [F.col(c).isNotNull() for c in on])
    held = F.struct(*take, F.col("valid_to").alias("_until"))
    versions = dim.filter(present & F.col("valid_from").isNotNull()).select(*on, F.col("valid_from").alias("_at"), held.alias("_v"))
    rows = df.select(*on, F.col(ts).alias("_at"), F.struct(*df.columns).alias("_fact"))
    both = rows.unionByName(versions, allowMissingColumns=True)
    is_row = F.col("_fact").isNotNull()
    sorted_rows = placed_rows(both.withColumn("_is_row", is_row), [*on, "_at", "_is_row"])

    before = Window.partitionBy("_part", *on).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max_by(F.struct(*on, "_v"), F.when(F.col("_v").isNotNull(), F.col("_pos")))
    ends = sorted_rows.groupBy("_part").agg(last.alias("_end"))  # one row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("_part", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    carried = sorted_rows.withColumn("_v", F.last("_v", ignorenulls=True).over(before)).filter("_is_row")
    joined = carried.join(F.broadcast(carry), "_part")
    same = reduce(and_, [F.col(f"_carry.{c}") == F.col(c) for c in on])
    found = F.coalesce(F.col("_v"), F.when(same, F.col("_carry._v")))
    joined = joined.select("_fact", "_at", found.alias("_v"))
    end = F.col("_v._until")
    valid = F.col("_v").isNotNull() & (end.isNull() | ((F.col("_at") <= end) if closed else (F.col("_at") < end)))
    if how == "inner":
        joined = joined.filter(valid)
    return joined.select("_fact.*", *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in take])


def left_on(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join of two large frames on several columns; `other` has unique keys."""
    return df.join(other, list(columns), "left")


def new_keys(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key has no partner in `dim`."""
    return keyed_join(df, dim.select(*on).distinct(), on, "left_anti")


def keys_with_history(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of keys that occur more than once."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*key)
    return keyed_join(df, repeated, key, "left_semi")


def join_aggregates(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of two frames that are already aggregated to `on`."""
    return a.join(b, list(on), "left")
