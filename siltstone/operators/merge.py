"""Slowly changing dimensions, upserts and table comparison as plain joins.

Source and target are unique per key on the side that is matched, so every join here meets at most
one row per key and side. Small batches of changes are broadcast, see `pair_rows`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.predicates import Differs, changed
from siltstone.operators.dedupe import latest
from siltstone.operators.joins import pair_rows
from siltstone.operators.keys import continue_key
from siltstone.session import pin_sized

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")
Interval = Literal["half_open", "closed_day"]


def end_of(opening: Column, interval: Interval) -> Column:
    """`valid_to` of the version that ends when the next one opens."""
    return F.date_sub(opening, 1) if interval == "closed_day" else opening


def open_versions(delta: DataFrame, ts: str, run_ts: Column | None = None) -> DataFrame:
    """First version of every row: valid from its change instant, open-ended, current."""
    start = F.col(ts) if run_ts is None else F.coalesce(F.col(ts), run_ts)
    end = F.lit(None).cast(delta.schema[ts].dataType)
    opened = {"valid_from": start, "valid_to": end, "is_current": F.lit(True)}
    return delta.withColumns(opened).drop(ts)


def decide(pairs: DataFrame, ts: str, differs: Differs) -> DataFrame:
    """Mark pairs whose tracked attributes differ, and those of them that are too old."""
    both = F.col("d").isNotNull() & F.col("s").isNotNull()
    differing = both & F.coalesce(differs("d", "s"), F.lit(False))
    late = F.coalesce(F.col(f"s.{ts}") < F.col("d.valid_from"), F.lit(False))
    return pairs.withColumn("_differs", differing).withColumn("_late", F.col("_differs") & late)


def scd2_apply(
    dim: DataFrame,
    delta: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str] | Differs,
    ts: str,
    interval: Interval = "half_open",
    late: Literal["reject", "apply"] = "reject",
    run_ts: Column | None = None,
    surrogate: str | None = None,
) -> DataFrame:
    """Close the current version of every key whose tracked attributes changed and open a new one.

    `delta` holds one row per key (see `change_set`) with the dimension's attributes and the change
    instant `ts`; a missing instant is replaced by `run_ts` for both the closing and the opening.
    Untracked attributes are carried only by a newly opened version. Changes older than the current
    version are left out (`late="reject"`, list them with `late_changes`) or applied as they come.
    Closed history passes by without being joined. Write the result (or `pin` it) before applying
    the next batch: the dimension is read more than once. With `surrogate`, new versions continue its
    numbering in key order; only they are placed and numbered, the others are passed through.
    """
    differs = tracked if callable(tracked) else changed(tracked)
    if run_ts is not None:
        delta = delta.withColumn(ts, F.coalesce(F.col(ts), run_ts))
    attributes = [c for c in dim.columns if c not in (*VERSION_COLUMNS, surrogate)]
    current = dim.filter(F.col("is_current"))
    history = dim.filter(~F.col("is_current"))

    delta, size = pin_sized(delta, "batch")

    def decided(all_targets: bool) -> DataFrame:
        pairs = decide(pair_rows(current, delta, key, all_targets, size), ts, differs)
        applies = F.col("_differs") & ~F.col("_late") if late == "reject" else F.col("_differs")
        return pairs.withColumn("_replaces", applies)

    replaces, opening = F.col("_replaces"), F.col(f"s.{ts}")
    in_dim, in_delta = F.col("d").isNotNull(), F.col("s").isNotNull()

    def version(side: str, start: Column, end: Column, is_open: Column) -> Column:
        number = [] if surrogate is None else [
            (F.col(f"d.{surrogate}") if side == "d" else F.lit(None).cast("bigint")).alias(surrogate)
        ]
        return F.struct(
            *number,
            *[F.col(f"{side}.{c}").alias(c) for c in attributes],
            start.alias("valid_from"),
            end.cast(dim.schema["valid_to"].dataType).alias("valid_to"),
            is_open.alias("is_current"),
        )

    closed_end = F.when(replaces, end_of(opening, interval)).otherwise(F.col("d.valid_to"))
    kept = F.when(in_dim, version("d", F.col("d.valid_from"), closed_end, ~replaces))
    opened = F.when(
        in_delta & (~in_dim | replaces), version("s", opening, F.lit(None), F.lit(True))
    )
    if surrogate is None:
        both = F.explode(F.array_compact(F.array(kept, opened)))
        merged = decided(True).select(both.alias("v")).select("v.*")
        return history.select(*merged.columns).unionByName(merged)
    stays = decided(True).filter(in_dim).select(kept.alias("v")).select("v.*")
    new = decided(False).select(opened.alias("v")).filter("v is not null").select("v.*")
    added = continue_key(dim, new, list(key), surrogate)
    return history.select(*stays.columns).unionByName(stays).unionByName(added)


def late_changes(
    dim: DataFrame, delta: DataFrame, key: Sequence[str], tracked: Sequence[str] | Differs, ts: str
) -> DataFrame:
    """Changes that `scd2_apply(late="reject")` leaves out."""
    differs = tracked if callable(tracked) else changed(tracked)
    current = dim.filter(F.col("is_current"))
    pairs = decide(pair_rows(current, delta, key, all_targets=False), ts, differs)
    return pairs.filter("_late").select("s.*")


def merge_actions(
    dim: DataFrame, delta: DataFrame, key: Sequence[str], tracked: Sequence[str] | Differs
) -> DataFrame:
    """What a merge would do per changed key: insert, update or none."""
    differs = tracked if callable(tracked) else changed(tracked)
    current = dim.filter(F.col("is_current"))
    pairs = pair_rows(current, delta, key, all_targets=False)
    action = (
        F.when(F.col("d").isNull(), "insert").when(differs("d", "s"), "update").otherwise("none")
    )
    return pairs.select(*[F.col(f"s.{k}").alias(k) for k in key], action.alias("merge_action"))


def scd2_from_log(
    log: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str | Column],
    ts: str,
    batch: str,
    interval: Interval = "half_open",
    order: Sequence[str | Column] | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """The whole version history from a change log in one pass, whatever order it arrived in.

    A missing change instant is replaced by `run_ts`, as in `scd2_apply`.

    First the latest row per key and batch is kept; after that a key has at most one row per batch,
    which bounds the groups of the two neighbour lookups by the number of batches, not by the data.
    """
    per_batch = latest(log, [*key, batch], order or [ts])  # a readable instant wins over a missing one
    if run_ts is not None:
        per_batch = per_batch.withColumn(ts, F.coalesce(F.col(ts), run_ts))
    in_time = Window.partitionBy(*key).orderBy(ts, batch)
    state = F.struct(
        *[(F.col(t) if isinstance(t, str) else t).alias(f"t{i}") for i, t in enumerate(tracked)]
    )
    versions = (
        per_batch.withColumn("_state", state)
        .withColumn("_before", F.lag("_state").over(in_time))
        .filter(F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before")))
    )
    following = F.lead(ts).over(in_time)
    attributes = [c for c in log.columns if c not in (ts, batch)]
    return versions.select(
        *attributes,
        F.col(batch),
        F.col(ts).alias("valid_from"),
        end_of(following, interval).alias("valid_to"),
        following.isNull().alias("is_current"),
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    update_columns: Sequence[str],
    run_ts: Column | None = None,
    stamp: str | None = "_updated_at",
    size: int | None = None,
) -> DataFrame:
    """Matched rows take only `update_columns` (and the stamp) from the source; others are inserted.

    Applying the same source twice gives the same rows. `size` is given if the source is pinned already.
    """
    now = F.localtimestamp() if run_ts is None else run_ts
    pairs = pair_rows(target, source, key, size=size)
    in_target, in_source = F.col("d").isNotNull(), F.col("s").isNotNull()

    def value(c: str) -> Column:
        if c == stamp:
            return F.when(in_source, now).otherwise(F.col(f"d.{c}"))
        if c in update_columns:
            return F.when(in_source, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}"))
        return F.when(in_target, F.col(f"d.{c}")).otherwise(F.col(f"s.{c}"))

    return pairs.select(*[value(c).alias(c) for c in target.columns])


def state_as_of(history: DataFrame, instant: Column, interval: Interval = "half_open") -> DataFrame:
    """Versions valid at `instant`, one per key, by a filter on the history."""
    end = F.col("valid_to")
    until = (instant <= end) if interval == "closed_day" else (instant < end)
    return history.filter((F.col("valid_from") <= instant) & (end.isNull() | until))


def log_as_of(
    log: DataFrame, key: Sequence[str], ts: str, instant: Column, tie: Sequence[str | Column] = ()
) -> DataFrame:
    """Latest row per key not newer than `instant`."""
    return latest(log.filter(F.col(ts) <= instant), key, [ts, *tie])


def table_diff(a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows that differ between two tables: only_a, only_b or changed, with both values."""
    left = a.withColumn("_in_a", F.lit(True)).alias("a")
    right = b.withColumn("_in_b", F.lit(True)).alias("b")
    pairs = left.join(right, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key], "full_outer")
    kind = (
        F.when(F.col("b._in_b").isNull(), "only_a")
        .when(F.col("a._in_a").isNull(), "only_b")
        .when(changed(columns)("a", "b"), "changed")
    )
    values = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in columns for side in ("a", "b")]
    keys = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in key]
    return pairs.select(*keys, kind.alias("difference"), *values).filter("difference is not null")
