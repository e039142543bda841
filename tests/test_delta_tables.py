"""Bucketed tables, the dimension on them, and the key index of partitioned tables."""

import os
import random

import pytest
from conftest import instant, rows
from pyspark.sql import functions as F

from siltstone.operators.merge import scd2_apply
from siltstone.session import pin
from siltstone.sources import buckets, key_index, storage, tables
from siltstone.streaming.dimension import Dimension

SCHEMA = "id string, city string, ts timestamp_ntz"


def batch(spark, n, city, day, first=0):
    at = F.lit(f"2026-05-{day:02d} 00:00:00").cast("timestamp_ntz")
    return spark.range(first, first + n).select(F.col("id").cast("string").alias("id"), F.lit(city).alias("city"), at.alias("ts"))


def dimension(path, count=32):
    return Dimension(str(path), ("id",), ("city",), "ts", "sk", count)


def test_bucket_versions_and_retirement(spark, tmp_path):
    base = str(tmp_path)
    df = spark.range(100).withColumn("v", F.lit(0))
    state = buckets.write(df, base, ["id"], buckets.State(0, 8), note="x")
    assert rows(buckets.read(spark, base, df.schema)) == rows(df)
    for version in (2, 3, 4):
        one = df.filter("id = 7").withColumn("v", F.lit(version))
        hit = buckets.touched(one, ["id"], 8)
        rest = buckets.read(spark, base, df.schema, buckets=hit).filter("id <> 7")
        state = buckets.write(rest.unionByName(one), base, ["id"], state, hit)
        assert len(hit) == 1 and state.notes == {"note": "x"}
    assert rows(buckets.read(spark, base, df.schema).filter("id = 7")) == [(7, 4)]
    assert rows(buckets.read(spark, base, df.schema, version=2).filter("id = 7")) == [(7, 2)]
    assert buckets.retire(spark, base) == 2  # the bucket as versions 1 and 2 had it
    assert buckets.versions(spark, base) == [3, 4]
    assert rows(buckets.read(spark, base, df.schema, version=3).filter("id = 7")) == [(7, 3)]
    assert buckets.read(spark, base, df.schema).count() == 100
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, base, df.schema, version=1)
    with pytest.raises(ValueError, match="not to be written"):
        buckets.write(df, base, ["id"], state, [0])


def test_an_emptied_bucket_and_an_empty_table(spark, tmp_path):
    base = str(tmp_path)
    df = spark.range(3)
    state = buckets.write(df.limit(0), base, ["id"], buckets.State(0, 4))
    assert buckets.read(spark, base, df.schema).count() == 0
    state = buckets.write(df, base, ["id"], state)
    hit = buckets.touched(df.filter("id = 1"), ["id"], 4)
    kept = buckets.read(spark, base, df.schema, buckets=hit).filter("id <> 1")
    buckets.write(kept, base, ["id"], state, hit)
    assert rows(buckets.read(spark, base, df.schema)) == [(0,), (2,)]


def test_bytes_of_a_batch_grow_with_the_batch(spark, tmp_path):
    """One and eight changed keys in tables of 20,000 and 40,000 rows, with buckets of the same size."""
    written = {}
    for size, count in ((20_000, 64), (40_000, 128)):
        kept = dimension(tmp_path / str(size), count)
        kept.start(batch(spark, size, "here", 1))
        whole = storage.bytes_below(spark, f"{kept.base}/current/data/batch=1")
        for version, n in ((2, 1), (3, 8)):
            kept.apply(batch(spark, n, f"there {version}", version, first=100), version)
            written[size, n] = sum(
                storage.bytes_below(spark, f"{kept.base}/{place}={version}") for place in ("current/data/batch", "aside/batch")
            )
            assert written[size, n] < 2.5 * n * whole / count
        assert kept.current(spark).count() == size
        assert kept.versions(spark).count() == size + 9
        # Only what the last two versions need is left.
        assert storage.bytes_below(spark, f"{kept.base}/current/data") < 1.5 * whole
    for n in (1, 8):
        assert written[40_000, n] < 1.5 * written[20_000, n]
    assert written[20_000, 8] < 12 * written[20_000, 1]


def test_the_same_versions_as_on_a_frame(spark, tmp_path):
    """Batches with changes, repeats, new keys, late and null instants, against `scd2_apply`; a batch runs twice."""
    r, kept = random.Random(3), dimension(tmp_path, 4)
    run = F.lit("2026-06-01 00:00:00").cast("timestamp_ntz")

    def delta(version):
        keys = r.sample(range(60), 25)
        values = [
            (str(k), r.choice(["a", "b", None]), None if k % 17 == 0 else instant(f"2026-05-{r.randrange(1, 8) + 4 * version:02d}T00:00:00"))
            for k in keys
        ]
        return spark.createDataFrame(values, SCHEMA)

    first = delta(0)
    kept.start(first, run)
    frame = pin(kept.current(spark))
    for version in (2, 3, 4):
        change = delta(version - 2)
        frame = pin(scd2_apply(frame, change, ["id"], ["city"], "ts", run_ts=run, surrogate="sk"))
        kept.apply(change, version, run)
        if version == 3:
            kept.apply(change, version, run)
    columns = ["sk", "id", "city", "valid_from", "valid_to", "is_current"]
    assert rows(kept.versions(spark), *columns) == rows(frame, *columns)
    assert kept.closed(spark).count() > 0
    assert set(kept.late(spark).columns) == {"id", "city", "valid_from", "version"}
    assert kept.late(spark).count() > 0


def months(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("K"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("id"), F.lit("old").alias("status"),
        (F.floor(F.col("id") / (n // 10))).cast("int").alias("m"),
    )


def test_only_candidate_partitions_are_opened(spark, tmp_path):
    """All files of the partitions that hold no key of the batch are damaged: the upsert does not notice."""
    path = str(tmp_path / "t")
    df = months(spark, 5000)
    tables.write_partitioned(df, path, ["m"])
    table = spark.read.schema(df.schema).parquet(path)
    key_index.add_files(spark, table, path, ["id"], "m")
    source = spark.createDataFrame([("K000601", "new", 9), ("K004999", "new", 9)], df.schema)
    found, unknown = key_index.candidates(spark, table, path, source, ["id"], "m")
    assert (sorted(found), unknown) == ([1, 9], [])
    for m in range(10):
        if m not in (1, 9):
            for name in os.listdir(f"{path}/m={m}"):
                if name.endswith(".parquet"):
                    with open(f"{path}/m={m}/{name}", "wb") as handle:
                        handle.write(b"nothing to read")
    assert tables.upsert_partitions(spark, path, source, ["id"], ["status"], "m", schema=df.schema) == 2
    held = spark.read.schema(df.schema).parquet(path)
    assert rows(held.filter("m in (1, 9) and status = 'new'"), "id", "m") == [("K000601", 1), ("K004999", 9)]
    # Files of the rewritten partitions are indexed; entries of the old ones are passed over, and dropped on request.
    found, unknown = key_index.candidates(spark, held, path, source, ["id"], "m")
    assert (sorted(found), unknown) == ([1, 9], [])
    before = spark.read.parquet(key_index.index_path(path)).select("file").distinct().count()
    key_index.compact(spark, held, path, ["id"], "m")
    assert spark.read.parquet(key_index.index_path(path)).select("file").distinct().count() == before - 2


def test_the_filter_never_misses_and_seldom_errs(spark, tmp_path):
    """Interleaved keys: smallest and largest do not help, the filter decides."""
    path = str(tmp_path / "t")
    df = months(spark, 40_000).withColumn("m", (F.crc32("id") % 8).cast("int"))
    tables.write_partitioned(df, path, ["m"])
    key_index.add_files(spark, df.sparkSession.read.schema(df.schema).parquet(path), path, ["id"], "m")
    table = spark.read.schema(df.schema).parquet(path)
    assert spark.read.parquet(key_index.index_path(path)).agg(F.max("slots")).first()[0] == 4
    for known in (True, False):
        opened = 0
        for k in range(0, 8):
            name = f"K{k * 1987:06d}" if known else f"K{k * 1987:06d}x"
            one = spark.createDataFrame([(name,)], "id string")
            found, _ = key_index.candidates(spark, table, path, one, ["id"], "m")
            opened += len(found)
            if known:
                assert table.filter(F.col("id") == name).first()["m"] in found
        assert opened <= (8 if known else 0) + 2


def test_index_by_slot_and_batches_over_all_partitions(spark, tmp_path, monkeypatch):
    """Every slot has its own range, and partitions are named the same whichever keys are tested first."""
    path = str(tmp_path / "t")
    number = F.crc32("id") % 8
    df = months(spark, 40_000).withColumn("m", F.when(number < 7, number).cast("int"))  # one partition is null
    tables.write_partitioned(df, path, ["m"])
    table = spark.read.schema(df.schema).parquet(path)
    key_index.add_files(spark, table, path, ["id"], "m")
    index = spark.read.parquet(key_index.index_path(path))
    per_file = index.groupBy("file").agg(F.max("slots").alias("slots"), F.count_distinct("slot").alias("n"), F.count_distinct("low").alias("lows"))
    assert rows(per_file, "slots", "n", "lows") == [(4, 4, 4)] * 8
    for keys, parts in ((table, [None, 0, 1, 2, 3, 4, 5, 6]), (table.filter("m = 3"), [3]), (table.filter("m = 3 or id = 'K000002'"), None)):
        found = []
        for early in (1, 64, 1 << 40):
            monkeypatch.setattr(key_index, "EARLY", early)
            found.append(key_index.candidates(spark, table, path, keys.select("id"), ["id"], "m")[0])
            assert len(set(found[-1])) == len(found[-1])
        assert {*found[0]} == {*found[1]} == {*found[2]} >= {*(parts or [])}


def test_partition_values_with_odd_characters(spark, tmp_path):
    path = str(tmp_path / "t")
    values = ["a b", "x/y", "1+1", "100%", "k=v", "007", "ü:ö"]
    df = spark.createDataFrame([(f"k{i}", "x", v) for i, v in enumerate(values)], "id string, s string, m string")
    tables.write_partitioned(df, path, ["m"])
    assert sorted(r.part for r in key_index.live_files(spark, path, "m", df.schema["m"].dataType).collect()) == sorted(values)
    source = df.filter("id in ('k1', 'k5')").withColumn("s", F.lit("y"))
    for _ in range(2):
        tables.upsert_partitions(spark, path, source, ["id"], ["s"], "m", schema=df.schema)
    assert rows(spark.read.schema(df.schema).parquet(path), "id", "s", "m") == [
        (f"k{i}", "y" if i in (1, 5) else "x", v) for i, v in enumerate(values)
    ]


def test_files_of_other_writers_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("c", "x", None)], "id string, s string, m int")
    tables.write_partitioned(df, path, ["m"])
    read = spark.read.schema(df.schema).parquet
    tables.upsert_partitions(spark, path, df.filter("id = 'a'"), ["id"], ["s"], "m", schema=df.schema)
    spark.createDataFrame([("d", "x", 2)], df.schema).write.mode("append").partitionBy("m").parquet(path)
    source = spark.createDataFrame([("d", "y", 3), ("c", "y", 1), ("e", "y", None)], df.schema)
    for _ in range(2):
        tables.upsert_partitions(spark, path, source, ["id"], ["s"], "m", schema=df.schema)
        got = rows(read(path), "id", "s", "m")
        assert got == sorted([("a", "x", 1), ("b", "x", 2), ("c", "y", None), ("d", "y", 2), ("e", "y", None)], key=repr)
