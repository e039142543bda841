"""The daily load as one job per business date, rerunnable and correctable, and the backfill below it.

Tables below `base`: `silver_sales` (by business_date), `dim_item` (versions), `fact` (by date_key), and, a
folder per business date each, the logs `dq_log`, `scd2_log` and `load_log` and the table `late_items`.

Dates may come in any order, and again with other content. A date newer than all others is merged into
the item dimension. Any other date is a correction: the versions of the items that it held or holds are
drawn up again from silver, keys of versions that stay are kept, and facts whose version is gone are
given the one that replaced it. Either way the dimension is the one that the present silver dates give
when they are loaded in order. Everything of a date is replaced when the date is run again.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.predicates import changed_tsql
from siltstone.operators.joins import asof_version, keyed_join
from siltstone.operators.keys import dense_key
from siltstone.operators.merge import late_changes, merge_actions
from siltstone.operators.quality import dq_log, enforce, load_log
from siltstone.plans import daily
from siltstone.session import pin, scratch
from siltstone.sources import storage, tables

KEY = "menu_item_key"
STEPS = ("silver_sales", "dim_item", "fact")
_TRACKED = changed_tsql("unit_price", ["category", "item_name"])
_VERSION = ("item_id", *daily.ITEM_ATTRIBUTES, "valid_from", "valid_to", "is_current")


def _log_items(spark: SparkSession, base: str, day: datetime.date, counts: dict[str, int]) -> None:
    log = spark.createDataFrame(list(counts.items()), "outcome string, row_count bigint")
    log.write.mode("overwrite").parquet(f"{base}/scd2_log/business_date={day}")


def _late_items(base: str, dim: DataFrame, items: DataFrame, day: datetime.date) -> int:
    """Keep the day's items that are older than the current version and differ from it, as a table."""
    late = late_changes(dim, items, ["item_id"], _TRACKED, "business_date")
    return tables.observed_write(late.drop("business_date"), f"{base}/late_items/business_date={day}")


def _merge_items(spark: SparkSession, base: str, sales: DataFrame) -> dict[str, int]:
    """Apply a date newer than all others; returns how many versions were inserted, closed, re-opened, late."""
    path = f"{base}/dim_item"
    if not tables.versions(spark, path):
        first = dense_key(daily.item_history(spark.read.parquet(f"{base}/silver_sales")), ["item_id", "valid_from"], KEY)
        counts = {"inserted": tables.observed_write(first, tables.version_path(path, 1)), "closed": 0, "reopened": 0, "late": 0}
    else:
        dim, items = tables.read_current(spark, path), pin(daily.items_of_day(sales), "items")
        planned = dict(merge_actions(dim, items, ["item_id"], _TRACKED).groupBy("merge_action").count().collect())
        tables.write_overwrite(daily.merge_items(dim, sales, KEY), path)
        moved = planned.get("update", 0)
        counts = {"inserted": planned.get("insert", 0), "closed": moved, "reopened": moved, "late": 0}
    return counts


def _repair_items(spark: SparkSession, base: str, touched: DataFrame) -> dict[str, int]:
    """Draw up the versions of the `touched` items (item_id) again from all silver dates.

    Versions that open on the same date as before keep their key. Facts that point to a version that no
    longer exists, or no longer covers their date, are given the one that does; only their dates are rewritten.
    """
    path = f"{base}/dim_item"
    dim = tables.read_current(spark, path)
    touched = pin(touched.distinct(), "touched")
    silver = spark.read.parquet(f"{base}/silver_sales")
    history = daily.item_history(keyed_join(silver, touched, ["item_id"], "left_semi"))
    before = pin(keyed_join(dim, touched, ["item_id"], "left_semi"), "before")
    known = before.select("item_id", "valid_from", KEY)
    fresh = pin(history.join(known, ["item_id", "valid_from"], "left").select(KEY, *_VERSION), "fresh")
    highest = dim.agg(F.max(KEY)).first()[0] or 0
    added = dense_key(fresh.filter(F.col(KEY).isNull()).drop(KEY), ["item_id", "valid_from"], KEY, start=highest + 1)
    after = pin(fresh.filter(F.col(KEY).isNotNull()).unionByName(added), "after")
    gone = pin(before.join(after.select(KEY), KEY, "left_anti"), "gone")
    rest = keyed_join(dim, touched, ["item_id"], "left_anti")
    tables.write_overwrite(rest.select(KEY, *_VERSION).unionByName(after.select(KEY, *_VERSION)), path)
    _rekey_facts(spark, base, before, after)
    return {"inserted": added.count(), "closed": gone.count(), "reopened": 0, "repaired": after.count()}


def _rekey_facts(spark: SparkSession, base: str, before: DataFrame, after: DataFrame) -> None:
    """Point facts of the versions `before` to those of `after` that cover their date."""
    path = f"{base}/fact"
    if not storage.exists(spark, path):
        return
    facts = spark.read.parquet(path)
    named = facts.select(KEY, "date_key").distinct().join(before.select(KEY, "item_id"), KEY)
    dated = named.withColumn("business_date", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    new = asof_version(dated, after.withColumnRenamed(KEY, "_new"), ["item_id"], "business_date", ["_new"], how="left")
    moved = pin(new.filter(~F.col("_new").eqNullSafe(F.col(KEY))).select(KEY, "date_key", "_new"), "moved")
    days = [r[0] for r in moved.select("date_key").distinct().collect()]  # one entry per date
    if days:
        hit = facts.filter(F.col("date_key").isin(days)).join(moved.withColumn("_moved", F.lit(True)), [KEY, "date_key"], "left")
        # A version may be gone with its item: then there is nothing left to sell on that date.
        key = F.when(F.col("_moved"), F.col("_new")).otherwise(F.col(KEY))
        rows = hit.withColumn(KEY, key).filter(F.col(KEY).isNotNull()).select(*facts.columns)
        tables.replace_by_key(rows, path, "date_key", days)


def _write_day(df: DataFrame, path: str, key: str, value) -> int:
    """Replace one date of a partitioned table and return the number of its rows."""
    rows = pin(df, "day")
    if storage.exists(df.sparkSession, path):
        tables.replace_by_key(rows, path, key, [value])
    else:
        tables.write_partitioned(rows, path, [key])
    return rows.count()


def run_day(
    spark: SparkSession,
    base: str,
    day: datetime.date,
    raw_sales: DataFrame,
    raw_inventory: DataFrame,
    stores: DataFrame,
    known_items: DataFrame,
    order: tuple[str | Column, ...],
) -> DataFrame:
    """Gates, silver, item versions and fact of one business date; returns its load log.

    A date whose gates fail raises after its measurements are logged, and no table is touched. Columns of
    `order` break ties between copies of a row.
    """
    with scratch(spark, "day"):  # the job's intermediate tables go with it
        return _run_day(spark, base, day, raw_sales, raw_inventory, stores, known_items, order)


def _run_day(
    spark: SparkSession,
    base: str,
    day: datetime.date,
    raw_sales: DataFrame,
    raw_inventory: DataFrame,
    stores: DataFrame,
    known_items: DataFrame,
    order: tuple[str | Column, ...],
) -> DataFrame:
    at = F.col("business_date") == F.lit(day)
    raw = pin(daily.with_business_date(raw_sales).filter(at), "raw-day")
    metrics = pin(dq_log([daily.gates_in_one_pass(raw, known_items)]), "gates")
    metrics.drop("business_date").write.mode("overwrite").parquet(f"{base}/dq_log/business_date={day}")
    enforce(metrics)

    sales = pin(daily.silver_sales(raw, order), "silver-day")
    stock = daily.silver_inventory(daily.with_business_date(raw_inventory).filter(at), order)
    held, newest = _held_items(spark, base, day)

    def items() -> int:
        dim = f"{base}/dim_item"
        of_day = pin(daily.items_of_day(sales), "items")
        late = _late_items(base, tables.read_current(spark, dim), of_day, day) if tables.versions(spark, dim) else 0
        if newest is None or newest < day or not tables.versions(spark, dim):
            counts = _merge_items(spark, base, sales)
        else:
            counts = _repair_items(spark, base, held.union(of_day.select("item_id")))
        _log_items(spark, base, day, {**counts, "late": late})
        tables.retire_versions(spark, dim)
        return sum(counts.values())

    def fact() -> int:
        dim = tables.read_current(spark, f"{base}/dim_item")
        return _write_day(daily.fact_daily_sales(sales, stock, stores, dim), f"{base}/fact", "date_key", int(f"{day:%Y%m%d}"))

    log = load_log(
        spark, "daily", day,
        [
            ("silver_sales", lambda: _write_day(sales, f"{base}/silver_sales", "business_date", day)),
            ("dim_item", items),
            ("fact", fact),
        ],
    )
    path = f"{base}/load_log/business_date={day}"
    log.drop("business_date").write.mode("overwrite").parquet(path)
    log = spark.read.parquet(path).withColumn("business_date", F.lit(day))
    failed = log.filter("status = 'FAILED'").first()
    if failed:
        raise RuntimeError(f"daily load of {day}, step {failed['step']}: {failed['message']}")
    return log


def _held_items(spark: SparkSession, base: str, day: datetime.date) -> tuple[DataFrame, datetime.date | None]:
    """Items that silver holds for the date from an earlier run, and the newest date in silver.

    A date whose run broke off after silver counts as loaded: its next run repairs the dimension.
    """
    path = f"{base}/silver_sales"
    if not storage.exists(spark, path):
        return spark.createDataFrame([], "item_id string"), None
    silver = spark.read.parquet(path)
    held = pin(silver.filter(F.col("business_date") == F.lit(day)).select("item_id").distinct(), "held")
    return held, silver.agg(F.max("business_date")).first()[0]


def loaded(spark: SparkSession, base: str) -> set[datetime.date]:
    """Dates whose last run went through, from the load log."""
    if not storage.exists(spark, f"{base}/load_log"):
        return set()
    log = spark.read.schema("step string, status string, business_date date").parquet(f"{base}/load_log")
    done = log.groupBy("business_date").agg(F.count_if(F.col("step").isin(*STEPS) & (F.col("status") == "SUCCESS")).alias("n"))
    return {r[0] for r in done.filter(F.col("n") == len(STEPS)).collect()}  # one entry per date


def passing_days(metrics: DataFrame) -> list[datetime.date]:
    """Dates whose gates all hold, in order."""
    held = metrics.groupBy("business_date").agg(F.bool_and("passed").alias("ok")).filter("ok")
    return sorted(r[0] for r in held.select("business_date").collect())  # one entry per date


def backfill(
    spark: SparkSession,
    base: str,
    days: Sequence[datetime.date],
    raw_sales: DataFrame,
    raw_inventory: DataFrame,
    stores: DataFrame,
    metrics: DataFrame,
    order: tuple[str | Column, ...],
) -> None:
    """Load all `days` at once into empty tables, as if they had been run one after the other.

    `metrics` are the gates of the dates. Silver, the versions, the fact and the logs are one set-based pass
    each; the load log comes last, so a backfill that broke off is simply done again.
    """
    wanted = pin(spark.createDataFrame([(d,) for d in days], "business_date date"), "days")
    raw = daily.with_business_date(raw_sales).join(wanted, "business_date", "left_semi")
    counted = daily.with_business_date(raw_inventory).join(wanted, "business_date", "left_semi")
    tables.write_partitioned(dq_log([metrics]), f"{base}/dq_log", ["business_date"])  # of the dates left out as well

    tables.write_partitioned(daily.silver_sales(raw, order), f"{base}/silver_sales", ["business_date"])
    sales = spark.read.parquet(f"{base}/silver_sales")
    tables.write_overwrite(dense_key(daily.item_history(sales), ["item_id", "valid_from"], KEY), f"{base}/dim_item")
    dim = tables.read_current(spark, f"{base}/dim_item")
    facts = daily.fact_daily_sales(sales, daily.silver_inventory(counted, order), stores, dim)
    tables.write_partitioned(facts, f"{base}/fact", ["date_key"])

    def per_day(rows: DataFrame, step: str) -> DataFrame:
        return rows.groupBy("business_date").agg(F.count(F.lit(1)).alias("rows_affected")).withColumn("step", F.lit(step))

    opened = dim.groupBy("item_id", F.col("valid_from").alias("business_date")).agg(F.count(F.lit(1)).alias("n"))
    first = dim.groupBy("item_id").agg(F.min("valid_from").alias("_first"))
    kind = F.when(F.col("business_date") == F.col("_first"), F.array(F.lit("inserted"))).otherwise(F.array(F.lit("closed"), F.lit("reopened")))
    outcomes = opened.join(first, "item_id").select("business_date", F.explode(kind).alias("outcome"))
    outcomes = pin(outcomes.groupBy("business_date", "outcome").agg(F.count(F.lit(1)).alias("row_count")), "outcomes")
    tables.write_partitioned(outcomes, f"{base}/scd2_log", ["business_date"])

    written = spark.read.parquet(f"{base}/fact").withColumn("business_date", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    moved = outcomes.groupBy("business_date").agg(F.sum("row_count").alias("rows_affected")).withColumn("step", F.lit("dim_item"))
    counts = per_day(sales, "silver_sales").unionByName(moved).unionByName(per_day(written, "fact"))
    steps = wanted.withColumn("step", F.explode(F.array(*[F.lit(s) for s in STEPS])))
    log = steps.join(counts, ["business_date", "step"], "left").select(
        F.lit("daily").alias("pipeline_name"), "business_date", "step", F.coalesce("rows_affected", F.lit(0)).alias("rows_affected"),
        F.lit("SUCCESS").alias("status"), F.lit(None).cast("string").alias("message"), F.localtimestamp().alias("logged_at"),
    )
    tables.write_partitioned(log, f"{base}/load_log", ["business_date"])


def catch_up(
    spark: SparkSession,
    base: str,
    raw_sales: DataFrame,
    raw_inventory: DataFrame,
    stores: DataFrame,
    known_items: DataFrame,
    order: tuple[str | Column, ...],
    single: int = 1,
) -> list[datetime.date]:
    """Load every date whose gates hold and that the log does not show as loaded; returns these dates.

    With no date loaded, all but the last `single` are one backfill; those, and later stragglers, are jobs of
    their own in order. Run again after a failure, it goes on from the log. If the gates of all dates fail,
    only their measurements are logged and the result is empty.
    """
    metrics = pin(daily.gates_in_one_pass(raw_sales, known_items), "gates")
    done = loaded(spark, base)
    days = [d for d in passing_days(metrics) if d not in done]
    at_once = [] if done else days[: max(len(days) - single, 0)]
    if at_once:
        backfill(spark, base, at_once, raw_sales, raw_inventory, stores, metrics, order)
    elif not days and not done:  # no table comes to be, but the measurements are kept
        tables.write_partitioned(dq_log([metrics]), f"{base}/dq_log", ["business_date"])
    for day in days[len(at_once) :]:
        run_day(spark, base, day, raw_sales, raw_inventory, stores, known_items, order)
    return days
