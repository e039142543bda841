"""The daily job: dates in order, corrected, out of order, broken off, and loaded at once."""

import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators.quality import DataQualityError
from siltstone.plans import daily, daily_job
from siltstone.plans.registered import daily as registered
from siltstone.sources import storage, tables

RAW = (
    "business_date string, store_id string, item_id string, item_name string, category string, unit_price string, "
    "qty_sold string, gross_sales string, txn_count string, _n int"
)
STOCK = "business_date string, store_id string, item_id string, begin_qty string, received_qty string, sold_qty string, waste_qty string, end_qty string, _n int"
ORDER = ("_n",)


def at(n):
    return datetime.date(2026, 5, n)


def line(n, item, price, store="S1", name=None, qty=2):
    return (str(at(n)), store, item, name or f"item {item}", "c", str(price), str(qty), str(qty * price), "1", 1)


@pytest.fixture
def job(spark, tmp_path):
    """Runs dates of a list of sales lines in tables of a name."""
    stores = daily.dim_store(spark.createDataFrame([("S1", "East"), ("S2", "West")], "store_id string, region string")).cache()

    class Job:
        def inputs(self, lines):
            sales = spark.createDataFrame(lines, RAW)
            stock = spark.createDataFrame([(r[0], r[1], r[2], "9", "0", "2", "1", "6", 1) for r in lines], STOCK)
            return sales, stock, stores, sales.select("item_id").distinct(), ORDER

        def run(self, name, lines, *days):
            for n in days:
                daily_job.run_day(spark, f"{tmp_path}/{name}", at(n), *self.inputs(lines))

        def catch_up(self, name, lines, single=1):
            return daily_job.catch_up(spark, f"{tmp_path}/{name}", *self.inputs(lines), single=single)

        def state(self, name):
            """(versions, facts by item and version) without surrogate keys."""
            base = f"{tmp_path}/{name}"
            items = tables.read_current(spark, f"{base}/dim_item")
            facts = spark.read.parquet(f"{base}/fact").join(items, daily_job.KEY, "left")
            assert items.select(daily_job.KEY).distinct().count() == items.count()
            return (
                rows(items, "item_id", "item_name", "unit_price", "valid_from", "valid_to", "is_current"),
                rows(facts, "date_key", "store_key", "item_id", "valid_from", "qty_sold", "gross_sales", "waste_cost"),
            )

        def table(self, name, path):
            return spark.read.parquet(f"{tmp_path}/{name}/{path}")

        def base(self, name):
            return f"{tmp_path}/{name}"

    return Job()


LINES = [
    line(1, "A", 1.0), line(1, "B", 5.0), line(2, "A", 2.0), line(2, "B", 5.0), line(2, "C", 7.0),
    line(3, "A", 2.0), line(3, "B", 6.0), line(4, "A", 1.0), line(4, "B", 6.0), line(4, "C", 7.0),
]


def test_a_corrected_date_equals_corrected_data(spark, job):
    """Another price, an item that was not sold after all, one that was; facts of later dates change version."""
    kept = [r for r in LINES if r[0] != str(at(2))]
    corrected = [*kept, line(2, "A", 1.0), line(2, "B", 5.5), line(2, "D", 3.0)]
    job.run("t", LINES, 1, 2, 3, 4)
    job.run("t", corrected, 2)
    job.run("fresh", corrected, 1, 2, 3, 4)
    assert job.state("t") == job.state("fresh")
    versions = job.state("t")[0]
    assert all(v[4] is None or v[3] <= v[4] for v in versions)
    # Version keys that stay are kept: A opened on the first date before and after.
    items = tables.read_current(spark, job.base("t") + "/dim_item")
    assert items.filter("item_id = 'A' and valid_from = date'2026-05-01'").count() == 1
    assert len(tables.versions(spark, job.base("t") + "/dim_item")) == 2


def test_a_price_that_changes_on_rerun_leaves_no_inverted_interval(job):
    job.run("t", LINES, 1, 2)
    again = [r for r in LINES if r[0] == str(at(1))] + [line(2, "A", 3.0), line(2, "B", 5.0), line(2, "C", 7.0)]
    job.run("t", again, 2)
    job.run("fresh", again, 1, 2)
    assert job.state("t") == job.state("fresh")


def test_dates_out_of_order_and_late_items_as_a_table(job):
    job.run("t", LINES, 1, 4, 3, 2)
    job.run("fresh", LINES, 1, 2, 3, 4)
    assert job.state("t") == job.state("fresh")
    late = job.table("t", "late_items")
    assert rows(late.filter("business_date = date'2026-05-02'"), "item_id", "unit_price")[0][0] == "A"
    assert job.table("fresh", "late_items").count() == 0
    log = job.table("t", "scd2_log")
    assert log.filter("outcome = 'repaired' and row_count > 0").select("business_date").distinct().count() == 2


def test_an_emptied_date(job):
    """A correction that leaves one sale of another item only."""
    rest = [r for r in LINES if r[0] != str(at(2))] + [line(2, "Z", 1.0, store="S2")]
    job.run("t", LINES, 1, 2, 3)
    job.run("t", rest, 2)
    job.run("fresh", rest, 1, 2, 3)
    assert job.state("t") == job.state("fresh")


def test_random_corrections(job):
    r = random.Random(11)

    def day_lines(n):
        return [line(n, item, r.choice([1.0, 2.0, 3.0])) for item in "ABCD" if r.random() < 0.7] or [line(n, "A", 1.0)]

    present = {n: day_lines(n) for n in range(1, 5)}

    def lines():
        return [x for own in present.values() for x in own]

    job.run("t", lines(), 3, 1, 4)
    for n in (2, 3):
        present[n] = day_lines(n)
        job.run("t", lines(), n)
    job.run("fresh", lines(), 1, 2, 3, 4)
    assert job.state("t") == job.state("fresh")


def test_backfill_equals_single_jobs_and_goes_on_from_the_log(spark, job):
    bad = [line(5, "", 1.0), line(5, "A", 1.0)]  # half of the rows have no item: the gate of that date fails
    lines = [*LINES, *bad]
    assert job.catch_up("t", lines) == [at(n) for n in (1, 2, 3, 4)]
    job.run("fresh", LINES, 1, 2, 3, 4)
    assert job.state("t") == job.state("fresh")
    assert job.catch_up("t", lines) == []
    assert daily_job.loaded(spark, job.base("t")) == {at(n) for n in (1, 2, 3, 4)}
    logged = {(d, s): n for d, s, n in rows(job.table("t", "load_log"), "business_date", "step", "rows_affected")}
    assert logged[at(2), "silver_sales"] == logged[at(2), "fact"] == 3
    outcomes = {(d, o): n for d, o, n in rows(job.table("t", "scd2_log"), "business_date", "outcome", "row_count")}
    assert (outcomes[at(1), "inserted"], outcomes[at(2), "inserted"], outcomes[at(2), "reopened"]) == (2, 1, 1)
    assert job.table("t", "dq_log").filter("not passed").select("business_date").distinct().count() == 1
    with pytest.raises(DataQualityError):
        job.run("t", lines, 5)
    # A date that comes later, and one whose log was lost, are single jobs.
    storage.remove_folder(spark, job.base("t") + "/load_log/business_date=2026-05-03")
    more = [*LINES, line(6, "A", 9.0)]
    assert job.catch_up("t", more) == [at(3), at(6)]
    job.run("fresh", more, 6)
    assert job.state("t") == job.state("fresh")


def test_a_backfill_that_broke_off_is_done_again(spark, job, monkeypatch):
    write = tables.write_partitioned

    def broken(df, path, by):
        if path.endswith("/fact"):
            raise OSError("lost")
        return write(df, path, by)

    monkeypatch.setattr(tables, "write_partitioned", broken)
    with pytest.raises(OSError):
        job.catch_up("t", LINES)
    monkeypatch.undo()
    assert daily_job.loaded(spark, job.base("t")) == set()
    job.catch_up("t", LINES, single=2)
    job.run("fresh", LINES, 1, 2, 3, 4)
    assert job.state("t") == job.state("fresh")
    assert job.table("t", "fact").select(F.countDistinct("date_key")).first()[0] == 4


def test_no_date_passes_its_gates(spark, job):
    """The measurements of the dates are kept; there is nothing to load, also not when it is tried again."""
    lines = [line(1, "", 1.0), line(1, "A", 1.0), line(2, "", 1.0)]
    for _ in range(2):
        assert job.catch_up("t", lines) == []
        failed = job.table("t", "dq_log").filter("not passed and rule_name = 'NULL_BUSINESS_KEYS'")
        assert rows(failed, "business_date", "failed_rows", "total_rows") == [(at(1), 1, 2), (at(2), 1, 1)]
    assert not tables.versions(spark, job.base("t") + "/dim_item")
    assert job.catch_up("t", [*lines, line(3, "A", 1.0)]) == [at(3)]


def test_daily_pipeline_without_a_passing_date(spark, tmp_path):
    """Every date of a store that sells the same item twice a day fails its gate for duplicates."""
    days = [datetime.datetime(1996, 5, n) for n in (1, 2, 3)]
    sold = [(4 * n + k, 8, 1, 1, 2.0, 20.0, 0.0, day) for n, day in enumerate(days) for k in (1, 2)]
    tables_ = {
        "lineitem": (sold, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
        "supplier": ([(1, 0)], "s_suppkey long, s_nationkey int"),
        "nation": ([(0, "here", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "East")], "r_regionkey int, r_name string"),
    }
    for name, (values, schema) in tables_.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = registered.daily_pipeline(spark, str(tmp_path))
    assert found.columns == ["date_key", "fact_rows", "gross_sales", "waste_cost", "items", "changed_by_rerun"]
    assert found.collect() == []
