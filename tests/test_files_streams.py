import json
import os

import pytest
from conftest import instant, plan, rows
from pyspark.sql import functions as F

from siltstone.operators.layout import cluster_by, clustering_info, pruned_files, zorder_by
from siltstone.plans import shapes
from siltstone.session import pin, scratch, temp_view
from siltstone.sources import files, storage, tables
from siltstone.sources.evolve import read_evolving_csv, rescue
from siltstone.sources.headers import files_by_header, first_records
from siltstone.streaming import ingest as streams
from siltstone.streaming import warehouse


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as handle:
        handle.write(text)


def test_reordered_and_added_columns_bind_by_name(spark, tmp_path):
    put(f"{tmp_path}/in/1.csv", "a,b\n1,2\n")
    put(f"{tmp_path}/in/2.csv", "b,a\n4,3\n")
    put(f"{tmp_path}/in/3.csv", 'a,b,c\n5,6,"x,y"\n')
    got = read_evolving_csv(spark, f"{tmp_path}/in")
    assert rows(got, "a", "b", "c") == [("1", "2", None), ("3", "4", None), ("5", "6", "x,y")]


def test_short_rows_are_kept(spark, tmp_path):
    put(f"{tmp_path}/in/1.csv", "a,b\n1\n2,3\n")
    got = files.read_raw_csv(spark, f"{tmp_path}/in", ["a", "b"])
    assert rows(got, "a", "b") == [("1", None), ("2", "3")]


def test_evolving_ingest_adds_a_column_and_reruns_add_nothing(spark, tmp_path):
    args = (spark, f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/chk")
    put(f"{tmp_path}/in/1.csv", "a,b\n1,2\n")
    assert streams.ingest_evolving_csv(*args).count() == 1
    assert streams.ingest_evolving_csv(*args).count() == 1
    put(f"{tmp_path}/in/2.csv", "a,c\n3,4\n")
    got = streams.ingest_evolving_csv(*args)
    assert rows(got, "a", "b", "c") == [("1", "2", None), ("3", None, "4")]


def test_records_that_do_not_fit_are_kept_whole(spark, tmp_path):
    put(f"{tmp_path}/in/1.csv", 'a,b\n1,2\n3,4,extra\n"x\ny",6\n7\n\n8,"say ""hi"", you"\n')
    put(f"{tmp_path}/in/2.csv", "b,a,new\n20,10,n\n21,11,\n")
    put(f"{tmp_path}/in/3.csv", "a,b\n")
    put(f"{tmp_path}/in/4.csv", "")
    args = (spark, f"{tmp_path}/in")
    want = [("1", "2", None), ("3", "4", "3,4,extra"), ("7", None, "7"), ("8", 'say "hi", you', None), ("x\ny", "6", None)]
    known = [*want, ("10", "20", '{"new":"n"}'), ("11", "21", None)]
    got = streams.ingest_evolving_csv(*args, f"{tmp_path}/b1", f"{tmp_path}/c1", known=["a", "b"])
    assert rows(got, "a", "b", "_rescued_data") == sorted(known, key=repr)
    got = streams.ingest_evolving_csv(*args, f"{tmp_path}/b2", f"{tmp_path}/c2", files_per_batch=1)
    all_columns = [(*w[:2], None, w[2]) for w in want] + [("10", "20", "n", None), ("11", "21", None, None)]
    assert rows(got, "a", "b", "new", "_rescued_data") == sorted(all_columns, key=repr)
    assert got.select("_source_file").distinct().count() == 2


def test_single_lines_can_be_split(spark, tmp_path):
    put(f"{tmp_path}/in/1.csv", "a,b\n" + "".join(f"{k},x\n" for k in range(1000)) + "1,2,3\n")
    got = read_evolving_csv(spark, f"{tmp_path}/in", multiline=False)
    assert got.count() == 1001
    assert rows(got.filter("_rescued_data is not null"), "a", "_rescued_data") == [("1", "1,2,3")]


def test_declared_feeds_keep_what_does_not_fit(spark, tmp_path):
    put(f"{tmp_path}/in/1.csv", "a,b\n1,2\n3,4,5\n6\n")
    put(f"{tmp_path}/js/1.json", '{"a":"1"}\n{"a":\n')

    def drain(kind, folder, schema, options):
        return streams.ingest(spark, f"{tmp_path}/{folder}", kind, f"{tmp_path}/b{folder}", f"{tmp_path}/c{folder}", schema, options, 1)

    got = drain("csv", "in", files.text_schema(["a", "b"]), {"header": "true"})
    assert rows(got, "a", "b", "_rescued_data") == sorted([("1", "2", None), ("3", "4", "3,4,5"), ("6", None, "6")], key=repr)
    got = drain("json", "js", "a string", None)
    assert rows(got, "a", "_rescued_data") == sorted([("1", None), (None, '{"a":')], key=repr)


def test_headers_are_read_without_the_files(spark, tmp_path):
    """Bytes that the local file system hands out per file; the files are a hundred times as long."""
    for n in range(3):
        put(f"{tmp_path}/in/{n}.csv", 'id,"two\nlines",id,\n' + "0123456789,abcdefghij,k,l\n" * 2_000_000)
    jvm = spark.sparkContext._jvm

    def read():
        found = jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(found.get(k).getBytesRead() for k in range(found.size()) if found.get(k).getScheme() == "file")

    before = read()
    groups = files_by_header(spark, f"{tmp_path}/in")
    assert (read() - before) / 3 < 1_000_000 < os.path.getsize(f"{tmp_path}/in/0.csv") / 40
    assert list(groups) == [("id", "two\nlines", "id_2", "_c3")]
    assert len(groups["id", "two\nlines", "id_2", "_c3"]) == 3
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(1 << 40)


def test_headers_of_odd_files(spark, tmp_path):
    """Names with signs, a header longer than the lines first asked for, one that never closes, blank and empty files."""
    put(f"{tmp_path}/in/a b%20+ü.csv", "\ufeffid,x\n1,2\n")
    put(f"{tmp_path}/in/long.csv", '\n\nid,"' + "\n" * 100 + 'x"\n1,2\n')
    put(f"{tmp_path}/in/open.csv", 'id,"x\n' + "y\n" * 99)
    put(f"{tmp_path}/in/blank.csv", "\n \n" * 50)
    put(f"{tmp_path}/in/empty.csv", "")
    found = {file.rsplit("/", 1)[1]: header for file, header in first_records(spark, f"{tmp_path}/in")}
    assert found == {"a b%20+ü.csv": "id,x", "long.csv": 'id,"' + "\n" * 100 + 'x"', "open.csv": 'id,"x' + "\ny" * 99}
    put(f"{tmp_path}/odd/a b%20+ü.csv", "id,x\n1,2\n")
    put(f"{tmp_path}/odd/c d.csv", "id,y\n3,4\n")
    got = streams.ingest_evolving_csv(spark, f"{tmp_path}/odd", f"{tmp_path}/b", f"{tmp_path}/c")
    assert rows(got, "id", "x", "y") == sorted([("1", "2", None), ("3", None, "4")], key=repr)


def test_ingest_takes_each_file_once(spark, tmp_path):
    def drain():
        schema = files.text_schema(["a"])
        return streams.ingest(
            spark, f"{tmp_path}/in", "csv", f"{tmp_path}/b", f"{tmp_path}/c", schema, {"header": "true"}
        ).count()

    put(f"{tmp_path}/in/1.csv", "a\n1\n2\n")
    assert (drain(), drain()) == (2, 2)
    put(f"{tmp_path}/in/2.csv", "a\n3\n")
    assert drain() == 3


def test_rescued_fields(spark, tmp_path):
    lines = [{"id": 1, "x": "y"}, {"id": 2, "new": 5}, {"x": None}]
    put(f"{tmp_path}/in/1.jsonl", "\n".join(json.dumps(v) for v in lines))
    got = streams.ingest_rescued(spark, f"{tmp_path}/in", f"{tmp_path}/b", f"{tmp_path}/c", ["id", "x"])
    assert rows(got, "id", "x", "_rescued_data") == sorted(
        [("1", "y", None), ("2", None, '{"new":"5"}'), (None, None, None)], key=repr
    )


def test_copy_into_matches_by_regular_expression(spark, tmp_path):
    put(f"{tmp_path}/in/orders_batch0.csv", "a\n1\n")
    put(f"{tmp_path}/in/orders_batch1.csv", "a\n2\n")
    assert rows(files.copy_into(spark, f"{tmp_path}/in", ".*batch0.*", ["a"]), "a") == [("1",)]


def test_load_day_reads_only_its_files(spark, tmp_path):
    put(f"{tmp_path}/sales_20260501.csv", "a\n1\n")
    put(f"{tmp_path}/sales_20260502.csv", "a\n2\n")
    assert rows(files.load_day(spark, str(tmp_path), "sales", "2026-05-02", ["a"]), "a") == [("2",)]
    put(f"{tmp_path}/readme.csv", "a\n9\n")
    one = files.load_range(spark, str(tmp_path), "2026-05-01", "2026-05-01", ["a"], r"sales_(\d{8})")
    assert rows(one, "a") == [("1",)]


def test_path_conditions_prune_files(spark, tmp_path):
    for n in (1, 2, 3):
        put(f"{tmp_path}/sales_2026050{n}.csv", f"a\n{n}\n")

    def files_read(df):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().get("numFiles").get().value()

    root = str(tmp_path)
    day = ("2026-05-02", "2026-05-02")
    assert files_read(files.load_range(spark, root, *day, ["a"], r"sales_(\d{8})")) == 1
    assert files_read(files.copy_into(spark, root, ".*0503.*", ["a"])) == 1


def test_versions_stay_readable_until_the_next_is_complete(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.write_overwrite(spark.range(3), base)
    storage_dir = f"{base}/v=2"
    put(f"{storage_dir}/part-0.parquet", "not complete")
    assert tables.versions(spark, base) == [1]
    assert tables.read_current(spark, base).count() == 3
    tables.write_overwrite(spark.range(5), base, version=2)
    assert tables.read_current(spark, base).count() == 5
    assert tables.read_current(spark, base, version=1).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, base, version=9)


def test_replace_by_key_clears_empty_partitions_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "n int, d int")
    tables.write_partitioned(df, path, ["d"])
    for _ in range(2):
        new = spark.createDataFrame([(9, 10), (8, 30)], "n int, d int")
        tables.replace_by_key(new, path, "d", [10, 20])
        assert rows(spark.read.parquet(path), "n", "d") == [(3, 30), (9, 10)]


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(spark.range(20).select("id", (F.col("id") % 4).alias("d")), path, ["d"])
    text = plan(spark.read.parquet(path).filter("d = 1"))
    assert "PartitionFilters: [isnotnull(d" in text


def test_upsert_partitions_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "id string, s string, m int")
    tables.write_partitioned(target, path, ["m"])
    untouched = set(os.listdir(f"{path}/m=2"))
    # The row of key a arrives with another month: it stays where it is and is not inserted twice.
    source = spark.createDataFrame([("a", "y", 3), ("c", "n", 3)], "id string, s string, m int")
    for _ in range(2):
        tables.upsert_partitions(spark, path, source, ["id"], ["s"], "m")
        assert rows(spark.read.parquet(path), "id", "s", "m") == [("a", "y", 1), ("b", "x", 2), ("c", "n", 3)]
    assert set(os.listdir(f"{path}/m=2")) == untouched


def test_scratch_of_a_job_goes_with_it(spark, tmp_path):
    with scratch(spark, "job") as folder:
        outer = pin(spark.range(3))
        with scratch(spark, "part") as inner:
            held = temp_view(spark.range(5), "five")
            assert spark.sql("select count(*) from five").first()[0] == 5
            assert inner.startswith(folder) and inner in held.inputFiles()[0]
        assert not storage.exists(spark, inner)
        assert outer.count() == 3 and folder in outer.inputFiles()[0]
    assert not storage.exists(spark, folder)
    with pytest.raises(RuntimeError), scratch(spark, "job") as folder:
        pin(spark.range(1))
        raise RuntimeError("lost")
    assert not storage.exists(spark, folder)
    assert folder not in pin(spark.range(1)).inputFiles()[0]


def test_json_lines_that_cannot_be_read_are_kept(spark, tmp_path):
    put(f"{tmp_path}/a.json", '{"a":"1","z":"2"}\n{"a":\nnot json\n\n{"a":null}\n')
    got = files.read_raw_jsonl(spark, str(tmp_path), "a string")
    assert rows(got, "a", "_rescued_data") == sorted([("1", None), (None, '{"a":'), (None, "not json"), (None, None)], key=repr)


def test_pin_survives_as_a_table(spark):
    pinned = pin(spark.range(10).withColumn("r", F.rand()))
    assert rows(pinned) == rows(pinned)
    assert storage.exists(spark, pinned.inputFiles()[0])


@pytest.mark.parametrize("layout", [cluster_by, zorder_by])
def test_layout_keeps_rows_and_narrows_files(spark, tmp_path, layout):
    df = spark.range(20000).select((F.col("id") * 7919 % 20000).alias("a"), (F.col("id") % 100).alias("b"))
    layout(df, ["a"], 8).write.parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 20000 and back.select("a").distinct().count() == 20000
    info = clustering_info(spark, f"{tmp_path}/t", "a")
    assert info.agg(F.sum("row_count")).first()[0] == 20000
    assert pruned_files(info, 100, 200).first()["files_read"] <= 2


def test_overlap_depth_by_brute_force(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") * 37 % 500).alias("a")).repartition(6)
    df.write.parquet(f"{tmp_path}/t")
    spark.range(600, 700).select(F.col("id").alias("a")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    info = clustering_info(spark, f"{tmp_path}/t", "a").collect()
    for one in info:
        want = sum(o["min_value"] <= one["max_value"] and o["max_value"] >= one["min_value"] for o in info)
        assert one["overlap_depth"] == want


CUSTOMER = "customer_id string, full_name string, email string, phone string, city string, state string, signup_date string, updated_at string"
ORDER = "order_id string, customer_id string, order_ts string, status string, channel string, items string, order_total string"


def test_warehouse_stream_from_baseline_to_increment(spark, tmp_path):
    base = str(tmp_path)
    run = F.lit("2026-06-01 00:00:00").cast("timestamp_ntz")

    def land(feed, schema, values):
        spark.createDataFrame(values, schema).write.mode("append").parquet(f"{base}/raw_{feed}")

    feeds = {
        "customers": (f"{base}/raw_customers", spark.createDataFrame([], CUSTOMER).schema),
        "orders": (f"{base}/raw_orders", spark.createDataFrame([], ORDER).schema),
    }
    c1 = ["C000001", "Customer 1", "c1@example.com", "703", "Fairfax", "VA", "2025-01-01", "2026-05-01 00:00:00"]
    land("customers", CUSTOMER, [c1])
    land("orders", ORDER, [("O1", "C000001", "2026-05-01 10:00:00", "placed", "web", "2", "10.00"),
                           ("O2", "CX", "2026-05-01 11:00:00", "placed", "web", "2.5", "n/a")])
    assert warehouse.maintain(spark, base, feeds, run) == 1
    assert warehouse.maintain(spark, base, feeds, run) == 0

    moved = [*c1[:4], "Denver", "CO", c1[6], "2026-05-02 00:00:00"]
    land("customers", CUSTOMER, [moved])
    land("orders", ORDER, [("O1", "C000001", "2026-05-01 10:00:00", "shipped", "app", "9", "11.00"),
                           ("O3", "C000001", "2026-06-02 10:00:00", "placed", "web", "1", "5.00")])
    assert warehouse.maintain(spark, base, feeds, run) == 1
    versions = rows(warehouse.read_customers(spark, base), "customer_sk", "city", "valid_to", "is_current")
    assert versions == [(1, "Fairfax", instant("2026-05-02T00:00:00"), False), (2, "Denver", None, True)]
    facts = warehouse.read_orders(spark, base)
    got = rows(facts, "order_id", "customer_sk", "status", "channel", "items", "order_total")
    assert [(r[0], r[1], r[2], r[3], str(r[4]), str(r[5])) for r in got] == [
        ("O1", 1, "shipped", "web", "2", "11.00"),
        ("O2", None, "placed", "web", "3", "None"),
        ("O3", 2, "placed", "web", "1", "5.00"),
    ]

    # A batch that is repeated after a failure leaves the same tables.
    batch = None
    for name, (path, schema) in feeds.items():
        part = spark.read.schema(schema).parquet(path).withColumn(warehouse.FEED, F.lit(name))
        part = part.filter("updated_at >= '2026-05-02'") if name == "customers" else part.filter(
            "order_id <> 'O2' and (status = 'shipped' or order_id = 'O3')"
        )
        batch = part if batch is None else batch.unionByName(part, allowMissingColumns=True)
    warehouse.apply_batch(base, run)(batch, 1)
    assert rows(warehouse.read_customers(spark, base), "customer_sk", "city", "valid_to", "is_current") == versions
    assert rows(warehouse.read_orders(spark, base), "order_id", "customer_sk", "status", "channel", "items", "order_total") == got


def test_shape_counts(spark, sf_dir):
    raw = shapes.pos_raw(spark, sf_dir)
    assert raw.count() == shapes.table(spark, sf_dir, "lineitem").count()
    batches = dict(rows(shapes.orders_raw(spark, sf_dir).groupBy("batch").count()))
    assert set(batches) == {0, 1, 2, 3}


def test_warehouse_takes_orders_after_the_first_batch_and_sets_late_changes_aside(spark, tmp_path):
    base = str(tmp_path)
    run = F.lit("2026-06-01 00:00:00").cast("timestamp_ntz")
    feeds = {
        "customers": (f"{base}/raw_customers", spark.createDataFrame([], CUSTOMER).schema),
        "orders": (f"{base}/raw_orders", spark.createDataFrame([], ORDER).schema),
    }
    os.makedirs(f"{base}/raw_orders")
    one = ("C1", "One", "a@x", "1", "Here", "VA", "2025-01-01", "2026-05-01 00:00:00")

    def land(feed, schema, values):
        spark.createDataFrame(values, schema).write.mode("append").parquet(f"{base}/raw_{feed}")

    land("customers", CUSTOMER, [one])
    assert warehouse.maintain(spark, base, feeds, run) == 1
    assert warehouse.read_orders(spark, base).count() == 0
    land("orders", ORDER, [("O1", "C1", "2026-05-01 10:00:00", "new", "x", "1", "5.00")])
    land("customers", CUSTOMER, [(*one[:4], "Earlier", *one[5:7], "2020-01-01 00:00:00")])
    assert warehouse.maintain(spark, base, feeds, run) == 1
    assert rows(warehouse.read_orders(spark, base), "order_id", "customer_sk") == [("O1", 1)]
    assert rows(warehouse.read_customers(spark, base), "city", "is_current") == [("Here", True)]
    assert rows(warehouse.read_late(spark, base), "customer_id", "city", "batch") == [("C1", "Earlier", 1)]


@pytest.mark.parametrize("emptied", [True, False])
def test_replace_by_key_with_an_empty_frame(spark, tmp_path, emptied):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (3, 30)], "n int, d int")
    tables.write_partitioned(df, path, ["d"])
    empty = df.filter("n > 99") if emptied else spark.createDataFrame([], df.schema)
    tables.replace_by_key(empty, path, "d", [10])
    assert rows(spark.read.schema(df.schema).parquet(path), "n", "d") == [(3, 30)]


def test_csv_with_doubled_quotes_and_line_breaks(spark, tmp_path):
    put(f"{tmp_path}/a.csv", 'a,b\n"say ""hi"", ok",2\n"two\nlines","3"\n,""\n')
    got = rows(files.read_raw_csv(spark, str(tmp_path), ["a", "b"], multiline=True))
    assert got == sorted([('say "hi", ok', "2"), ("two\nlines", "3"), (None, None)], key=repr)


def test_every_json_line_is_read_or_kept(spark):
    lines = ['{"a":"1","b":"2"}', '{"a":"1"', "not json", "[1]", "", " ", '{"a":null}', '{"a":{"x":1}}']
    got = rescue(spark.createDataFrame([(x,) for x in lines], "value string"), ["a"])
    assert rows(got, "a", "_rescued_data") == sorted(
        [("1", '{"b":"2"}'), (None, '{"a":"1"'), (None, "not json"), (None, "[1]"), (None, None), ('{"x":1}', None)], key=repr
    )
    texts = ['[{"a":"1"},{"a":"2","c":"3"}]', "[]", "[broken", '{"a":"1"}']
    got = rescue(spark.createDataFrame([(x,) for x in texts], "value string"), ["a"], array=True)
    assert rows(got, "a", "_rescued_data") == sorted(
        [("1", None), ("2", '{"c":"3"}'), (None, "[broken"), (None, '{"a":"1"}')], key=repr
    )


def test_continuous_ingest_gives_its_query(spark, tmp_path):
    base = str(tmp_path)
    os.makedirs(f"{base}/landing")
    query = streams.ingest_continuously(
        spark, f"{base}/landing", "csv", f"{base}/bronze", f"{base}/checkpoint", "n string", {"header": "true"}, every="1 second"
    )
    try:
        for k in (1, 2):
            put(f"{base}/landing/{k}.csv", f"n\n{k}\n")
            query.processAllAvailable()
            assert spark.read.parquet(f"{base}/bronze").count() == k
    finally:
        query.stop()
