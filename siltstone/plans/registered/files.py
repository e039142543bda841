"""Landed files, incremental ingestion and table writes.

Each query lands the given tables in the shared scratch folder in the format under test and reads
them back, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.plans import shapes
from siltstone.plans.registry import query
from siltstone.session import scratch, scratch_path, temp_view
from siltstone.sources import files, storage, tables
from siltstone.sources.evolve import read_evolving_csv
from siltstone.streaming import ingest as streams

POS_ALL = (*shapes.POS_COLUMNS, "loyalty_id")
# A blank CSV field is read as missing.
_POS_SQL = ", ".join(shapes.POS_COLUMNS).replace("sku", "nullif(sku, '') as sku")
_CLICK_SCHEMA = ", ".join(f"{c} string" for c in shapes.CLICK_COLUMNS)


def land_csv(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> str:
    """Write text columns as they are: no trimming."""
    writer = df.write.mode("append").options(**files.CSV_QUOTES).option("header", True)
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    (writer.partitionBy(*by) if by else writer).csv(path)
    return path


def land_pos(spark: SparkSession, d: str, path: str) -> DataFrame:
    """Sales lines in two header groups: the later files carry a loyalty column."""
    raw = shapes.pos_raw(spark, d)
    later = F.year("_ingest_ts") >= 1999
    land_csv(raw.filter(~later).select(*shapes.POS_COLUMNS), f"{path}/early")
    land_csv(raw.filter(later).select(*POS_ALL), f"{path}/later")
    return raw


PRODUCT_COLUMNS = ("sku", "name", "category", "brand", "list_price", "updated_at")


def land_products(spark: SparkSession, d: str, path: str) -> str:
    """One JSON array of at most 500 products per file."""
    number = F.regexp_extract("sku", r"(\d+)", 1).cast("bigint")
    products = shapes.products_raw(spark, d).withColumn("file", F.floor(number / 500))
    arrays = products.groupBy("file").agg(
        F.to_json(F.collect_list(F.struct(*PRODUCT_COLUMNS))).alias("value")
    )
    arrays.write.partitionBy("file").text(path)
    return path


@query("scan_csv", f"select {_POS_SQL} from pos_raw")
def scan_csv(spark, d):
    path = land_csv(
        shapes.pos_raw(spark, d).select(*shapes.POS_COLUMNS), scratch_path(spark, "landing")
    )
    return files.read_raw_csv(spark, path, shapes.POS_COLUMNS)


@query("scan_jsonl", f"select {', '.join(shapes.CLICK_COLUMNS)} from clicks_raw")
def scan_jsonl(spark, d):
    path = scratch_path(spark, "landing")
    shapes.clicks_raw(spark, d).select(*shapes.CLICK_COLUMNS).write.json(path)
    return files.read_raw_jsonl(spark, path, _CLICK_SCHEMA).select(*shapes.CLICK_COLUMNS)


@query("scan_json_array", "select sku, name, category, brand, list_price, updated_at from products_raw")
def scan_json_array(spark, d):
    path = land_products(spark, d, scratch_path(spark, "landing"))
    return files.read_raw_json_array(spark, path, ", ".join(f"{c} string" for c in PRODUCT_COLUMNS))


@query(
    "ingest_incremental",
    """select store_id, payment_type, count(*) as row_count, count(distinct txn_id) as sales,
              cast(0 as bigint) as added_by_rerun from pos_raw group by all""",
)
def ingest_incremental(spark, d):
    """Two drains over the same files; the second has to add nothing."""
    base = scratch_path(spark, "ingest")
    land_csv(shapes.pos_raw(spark, d).select(*shapes.POS_COLUMNS), f"{base}/landing")

    def drain():
        return streams.ingest(
            spark, f"{base}/landing", "csv", f"{base}/bronze", f"{base}/checkpoint",
            files.text_schema(shapes.POS_COLUMNS), {"header": "true"},
        )

    first = drain().count()
    bronze = drain()
    return (
        bronze.groupBy("store_id", "payment_type")
        .agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("txn_id").alias("sales"))
        .withColumn("added_by_rerun", F.lit(bronze.count() - first).cast("bigint"))
    )


@query(
    "ingest_two_rounds",
    """select case when year(_ingest_ts) >= 1999 then 'later' else 'early' end as arrival,
              store_id, count(*) as row_count from pos_raw group by all""",
)
def ingest_two_rounds(spark, d):
    """Files keep arriving between drains; each is taken once."""
    base = scratch_path(spark, "ingest")
    raw = shapes.pos_raw(spark, d)
    later = F.year("_ingest_ts") >= 1999
    for name, rows in (("early", raw.filter(~later)), ("later", raw.filter(later))):
        land_csv(rows.select(*shapes.POS_COLUMNS), f"{base}/landing/{name}")
        bronze = streams.ingest(
            spark, f"{base}/landing", "csv", f"{base}/bronze", f"{base}/checkpoint",
            files.text_schema(shapes.POS_COLUMNS), {"header": "true"},
        )
    arrival = F.regexp_extract(files.SOURCE_FILE, r"/landing/(\w+)/", 1).alias("arrival")
    return bronze.groupBy(arrival, "store_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("ingest_schema_evolution", f"select {_POS_SQL}, nullif(loyalty_id, '') as loyalty_id from pos_raw")
def ingest_schema_evolution(spark, d):
    base = scratch_path(spark, "ingest")
    raw = shapes.pos_raw(spark, d)
    later = F.year("_ingest_ts") >= 1999
    for name, rows, columns in (
        ("early", raw.filter(~later), shapes.POS_COLUMNS),
        ("later", raw.filter(later), POS_ALL),
    ):
        land_csv(rows.select(*columns), f"{base}/landing/{name}")
        bronze = streams.ingest_evolving_csv(
            spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint"
        )
    return bronze.select(*POS_ALL)


@query("evolve_union", f"select {_POS_SQL}, nullif(loyalty_id, '') as loyalty_id from pos_raw")
def evolve(spark, d):
    path = scratch_path(spark, "landing")
    land_pos(spark, d, path)
    return read_evolving_csv(spark, path).select(*POS_ALL)


@query(
    "ingest_rescued",
    """select event_id, user_id, event_type,
              case when device = 'client 2' then '{"device":"client 2","coupon":"' || sku || '"}' end
              as _rescued_data from clicks_raw""",
)
def ingest_rescued(spark, d):
    base = scratch_path(spark, "ingest")
    web = F.col("device") == "client 2"
    shapes.clicks_raw(spark, d).select(
        "event_id",
        "user_id",
        "event_type",
        F.when(web, F.col("device")).alias("device"),
        F.when(web, F.col("sku")).alias("coupon"),
    ).write.json(f"{base}/landing")
    bronze = streams.ingest_rescued(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint",
        ["event_id", "user_id", "event_type"],
    )
    return bronze.select("event_id", "user_id", "event_type", "_rescued_data")


@query(
    "audit_columns",
    """select cast(batch as varchar) as batch, count(*) as row_count, count(*) as with_file,
              count(*) as with_time from customers_raw group by 1""",
)
def audit_columns(spark, d):
    path = land_csv(shapes.customers_raw(spark, d), scratch_path(spark, "landing"), ("batch",))
    rows = files.with_audit(files.read_raw_csv(spark, path, shapes.CUSTOMER_COLUMNS))
    batch = F.regexp_extract(files.SOURCE_FILE, r"batch=(\d)", 1).alias("batch")
    return rows.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(files.SOURCE_FILE).alias("with_file"),
        F.count(files.INGEST_TS).alias("with_time"),
    )


@query(
    "load_history",
    "select cast(batch as varchar) as batch, count(*) as row_count, true as timed "
    "from customers_raw group by 1",
)
def load_history(spark, d):
    path = land_csv(shapes.customers_raw(spark, d), scratch_path(spark, "landing"), ("batch",))
    bronze = files.with_audit(files.read_raw_csv(spark, path, shapes.CUSTOMER_COLUMNS))
    per_file = files.load_history(bronze)
    batch = F.regexp_extract(files.SOURCE_FILE, r"batch=(\d)", 1).alias("batch")
    return per_file.groupBy(batch).agg(
        F.sum("row_count").alias("row_count"),
        F.max("last_load_time").isNotNull().alias("timed"),
    )


@query("copy_pattern", f"select {', '.join(shapes.CUSTOMER_COLUMNS)} from customers_raw where batch = 0")
def copy_pattern(spark, d):
    path = land_csv(shapes.customers_raw(spark, d), scratch_path(spark, "landing"), ("batch",))
    rows = files.copy_into(spark, path, ".*batch=0.*", shapes.CUSTOMER_COLUMNS)
    return rows.select(*shapes.CUSTOMER_COLUMNS)


@query(
    "csv_null_tokens",
    """select store_id, txn_id, line_id, nullif(sku, '') as sku,
              case when payment_type <> 'A-F' then payment_type end as payment_type,
              nullif(loyalty_id, '') as loyalty_id from pos_raw""",
)
def csv_null_tokens(spark, d):
    raw = shapes.pos_raw(spark, d)
    columns = ["store_id", "txn_id", "line_id", "sku", "payment_type", "loyalty_id"]
    returned = F.when(F.col("payment_type") == "A-F", "NULL").otherwise(F.col("payment_type"))
    path = land_csv(
        raw.withColumn("payment_type", returned).select(*columns), scratch_path(spark, "landing")
    )
    return files.csv_dialect(files.read_raw_csv(spark, path, columns))


@query(
    "load_day",
    f"""select {', '.join(shapes.ORDER_COLUMNS)} from orders_raw
        where substr(order_ts, 1, 7) = '1997-03'""",
)
def load_day(spark, d):
    """All orders are landed by month; one dated folder is read."""
    base = scratch_path(spark, "landing")
    raw = shapes.orders_raw(spark, d).drop("batch")
    month = F.concat(F.replace(F.left("order_ts", F.lit(7)), F.lit("-"), F.lit("")), F.lit("01"))
    land_csv(raw.withColumn("tag", month), f"{base}/orders", ("tag",))
    rows = files.load_day(
        spark, base, "orders", "1997-03-01", shapes.ORDER_COLUMNS, "{feed}/tag={tag}"
    )
    return rows.select(*shapes.ORDER_COLUMNS)


@query(
    "load_range",
    """select cast(substr(order_ts, 1, 7) || '-01' as date) as business_day, count(*) as row_count
       from orders_raw where substr(order_ts, 1, 7) between '1996-02' and '1999-11' group by 1""",
)
def load_range(spark, d):
    base = scratch_path(spark, "landing")
    raw = shapes.orders_raw(spark, d).drop("batch")
    month = F.concat(F.replace(F.left("order_ts", F.lit(7)), F.lit("-"), F.lit("")), F.lit("01"))
    land_csv(raw.withColumn("tag", month), f"{base}/orders", ("tag",))
    rows = files.load_range(
        spark, f"{base}/orders", "1996-02-01", "1999-11-30", shapes.ORDER_COLUMNS, r"tag=(\d{8})"
    )
    return rows.groupBy("business_day").agg(F.count(F.lit(1)).alias("row_count"))


@query("csv_quoted", """select cast(doc_id as varchar) as doc_id, '"' || text || '", it said' as quote from documents""")
def csv_quoted(spark, d):
    """Whole texts with quotes, commas and line breaks, written with doubled quotes and read back."""
    texts = shapes.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit('"'), "text", F.lit('", it said')).alias("quote")
    )
    path = land_csv(texts, scratch_path(spark, "landing"))
    return files.read_raw_csv(spark, path, ["doc_id", "quote"], multiline=True)


@query(
    "ingest_malformed",
    """select event_id % 23 = 5 as unreadable, count(*) as row_count,
              count(*) filter (where event_id % 23 <> 5) as with_id,
              count(distinct case when event_id % 23 = 5 then event_id end) as kept_lines
       from events group by 1""",
)
def ingest_malformed(spark, d):
    """Every 23rd line breaks off; its text is kept."""
    base = scratch_path(spark, "ingest")
    events = shapes.table(spark, d, "events")
    whole = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type"))
    broken = F.concat(F.lit('{"event_id":"'), F.col("event_id").cast("string"), F.lit('","event_ty'))
    events.select(F.when(F.col("event_id") % 23 == 5, broken).otherwise(whole).alias("value")).write.text(f"{base}/landing")
    bronze = streams.ingest_rescued(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", ["event_id", "event_type"]
    )
    return bronze.groupBy(F.col("_rescued_data").isNotNull().alias("unreadable")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("event_id").alias("with_id"), F.countDistinct("_rescued_data").alias("kept_lines")
    )


@query(
    "ingest_evolving_json",
    """select sku, name, case when regexp_extract(sku, '(\\d+)', 1)::bigint % 2 = 0
                              then '{"brand":"' || brand || '"}' end as _rescued_data
       from products_raw""".replace("\\\\d", "\\d"),
)
def ingest_evolving_json(spark, d):
    """Arrays of products in which some carry a field that is not declared."""
    base = scratch_path(spark, "ingest")
    number = F.regexp_extract("sku", r"(\d+)", 1).cast("bigint")
    brand = F.when(number % 2 == 0, F.col("brand"))
    products = shapes.products_raw(spark, d).withColumns({"file": F.floor(number / 500), "brand": brand})
    arrays = products.groupBy("file").agg(F.to_json(F.collect_list(F.struct("sku", "name", "brand"))).alias("value"))
    arrays.write.partitionBy("file").text(f"{base}/landing")
    bronze = streams.ingest_rescued(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", ["sku", "name"], array=True
    )
    return bronze.select("sku", "name", "_rescued_data")


NOTE_COLUMNS = ["store_id", "txn_id", "line_id", "note"]


def land_notes(spark: SparkSession, d: str, path: str) -> None:
    """Sales notes as raw CSV text under two headers, the later one with a loyalty column.

    Second lines of a sale carry a field too many, third lines break off after two fields, and the notes of
    fourth lines hold a line break.
    """
    raw = shapes.pos_raw(spark, d)
    arrival = F.when(F.year("_ingest_ts") >= 1999, "later").otherwise("early")
    note = F.when(F.col("line_id") == 4, F.concat(F.lit('"first, '), "payment_type", F.lit('\nsecond"'))).otherwise(F.col("payment_type"))
    ids = F.concat_ws(",", "store_id", "txn_id")
    loyalty = F.when(arrival == "later", F.concat(F.lit(","), F.coalesce("loyalty_id", F.lit("")))).otherwise("")
    more = F.when(F.col("line_id") == 2, ",one more").otherwise("")
    record = F.when(F.col("line_id") == 3, ids).otherwise(F.concat(F.concat_ws(",", ids, "line_id", note), loyalty, more))
    file = F.concat(arrival, F.lit("-"), F.crc32(F.col("txn_id").cast("binary")) % 8)
    records = raw.select(file.alias("file"), F.lit(1).alias("place"), record.alias("value"))
    header = F.concat(F.lit(",".join(NOTE_COLUMNS)), F.when(F.col("file").startswith("later"), ",loyalty_id").otherwise(""))
    headers = records.select("file").distinct().select("file", F.lit(0).alias("place"), header.alias("value"))
    placed = headers.union(records).repartition("file").sortWithinPartitions("file", "place")
    placed.select("file", "value").write.partitionBy("file").text(path)


@query(
    "ingest_csv_rescued",
    """select store_id, txn_id, case when line_id <> '3' then line_id end as line_id,
              case when line_id = '4' then 'first, ' || payment_type || chr(10) || 'second'
                   when line_id <> '3' then payment_type end as note,
              case when line_id = '2' then store_id || ',' || txn_id || ',2,' || payment_type
                     || case when year(_ingest_ts) >= 1999 then ',' || coalesce(loyalty_id, '') else '' end || ',one more'
                   when line_id = '3' then store_id || ',' || txn_id
                   when loyalty_id <> '' then '{"loyalty_id":"' || loyalty_id || '"}' end as _rescued_data
       from pos_raw""",
)
def ingest_csv_rescued(spark, d):
    """Records that do not fit their header, and a column that is not declared, are kept; no row is lost."""
    base = scratch_path(spark, "ingest")
    land_notes(spark, d, f"{base}/landing")
    bronze = streams.ingest_evolving_csv(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", known=NOTE_COLUMNS
    )
    return bronze.select(*NOTE_COLUMNS, files.RESCUED)


# ---- table writes ----


@query(
    "write_overwrite",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity + 1 as l_quantity
       from lineitem""",
)
def write_overwrite(spark, d):
    """The second version is computed from the first, which stays readable meanwhile."""
    base = scratch_path(spark, "table")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    tables.write_overwrite(shapes.table(spark, d, "lineitem").select(*columns), base)
    current = tables.read_current(spark, base)
    tables.write_overwrite(current.withColumn("l_quantity", F.col("l_quantity") + 1), base)
    return tables.read_current(spark, base)


def _monthly_orders(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate")
    return shapes.table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        (F.year(day) * 100 + F.month(day)).cast("int").alias("month_key"),
    )


_MONTH = "cast(strftime(o_orderdate, '%Y%m') as int)"


@query(
    "write_partitioned",
    f"""select {_MONTH} as month_key, count(*) as orders,
               cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as total
        from orders group by 1""",
)
def write_partitioned(spark, d):
    path = tables.write_partitioned(
        _monthly_orders(spark, d), scratch_path(spark, "table"), ["month_key"]
    )
    return spark.read.parquet(path).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").cast("decimal(18,2)").alias("total")
    )


@query(
    "replace_by_date",
    f"""select o_orderkey, {_MONTH} as month_key,
               case when {_MONTH} = 199801 then cast(0 as decimal(18,2))
                    else cast(o_totalprice as decimal(18,2)) end as total
        from orders where {_MONTH} <> 199802""",
)
def replace_by_date(spark, d):
    """January 1998 is replaced and, with no rows for it, February is cleared."""
    path = scratch_path(spark, "table")
    orders = _monthly_orders(spark, d)
    tables.write_partitioned(orders, path, ["month_key"])
    january = orders.filter(F.col("month_key") == 199801)
    again = january.withColumn("total", F.lit(0).cast("decimal(18,2)"))
    tables.replace_by_key(again, path, "month_key", [199801, 199802])
    return spark.read.parquet(path).select("o_orderkey", "month_key", "total")


@query(
    "replace_by_empty",
    f"select o_orderkey, {_MONTH} as month_key from orders where {_MONTH} <> 199801",
)
def replace_by_empty(spark, d):
    """January 1998 is replaced by an empty frame that was never read from anywhere."""
    path = scratch_path(spark, "table")
    orders = _monthly_orders(spark, d)
    tables.write_partitioned(orders, path, ["month_key"])
    tables.replace_by_key(spark.createDataFrame([], orders.schema), path, "month_key", [199801])
    return spark.read.parquet(path).select("o_orderkey", "month_key")


@query(
    "append_select",
    """select o_orderkey, o_orderstatus, 'first' as load_name from orders where o_orderstatus = 'F'
       union all
       select o_orderkey, o_orderstatus, 'second' from orders where o_orderstatus <> 'F'""",
)
def append_select(spark, d):
    path = scratch_path(spark, "table")
    orders = shapes.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    filled = F.col("o_orderstatus") == "F"
    tables.append_select(orders.filter(filled).withColumn("load_name", F.lit("first")), path)
    tables.append_select(orders.filter(~filled).withColumn("load_name", F.lit("second")), path)
    return spark.read.parquet(path)


@query(
    "temp_view",
    f"""select {_MONTH} as month_key, count(*) as orders, count(distinct o_custkey) as customers,
               cast(0 as bigint) as scratch_left from orders group by 1""",
)
def staged(spark, d):
    """Orders staged under a name, read twice by SQL, and gone with the job's scratch folder."""
    path = scratch_path(spark, "table")
    with scratch(spark, "staging") as folder:
        day = F.col("o_orderdate")
        rows = shapes.table(spark, d, "orders").select("o_custkey", (F.year(day) * 100 + F.month(day)).cast("int").alias("month_key"))
        temp_view(rows, "staged_orders")
        counts = spark.sql("select month_key, count(*) as orders from staged_orders group by 1")
        buyers = spark.sql("select month_key, count(distinct o_custkey) as customers from staged_orders group by 1")
        counts.join(buyers, "month_key").write.parquet(path)
        spark.catalog.dropTempView("staged_orders")
    left = int(storage.exists(spark, folder))
    return spark.read.parquet(path).withColumn("scratch_left", F.lit(left).cast("bigint"))


@query(
    "upsert_partitions",
    """select o_orderkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as status,
              cast(o_totalprice as decimal(18,2)) + case when o_orderkey % 7 = 0 then 1 else 0 end
              as total,
              cast(strftime(o_orderdate, '%Y%m') as int) as month_key
       from orders""",
)
def upsert_partitions(spark, d):
    """Part of the orders exist; a batch changes some of them and adds the rest."""
    path = scratch_path(spark, "table")
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    month = (F.year(day) * 100 + F.month(day)).cast("int").alias("month_key")
    orders = shapes.table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        month,
    )
    tables.write_partitioned(orders.filter(key % 5 != 0), path, ["month_key"])
    changed = orders.filter((key % 5 == 0) | (key % 7 == 0)).withColumns(
        {
            "status": F.when(key % 7 == 0, "X").otherwise(F.col("status")),
            "total": (F.col("total") + F.when(key % 7 == 0, 1).otherwise(0)).cast("decimal(18,2)"),
        }
    )
    tables.upsert_partitions(
        spark, path, changed, ["o_orderkey"], ["status", "total"], "month_key"
    )
    return spark.read.parquet(path).select("o_orderkey", "status", "total", "month_key")


@query(
    "skip_when_empty",
    "select cast(1 as bigint) as batches, count(*) as row_count from orders_raw",
)
def skip_when_empty(spark, d):
    """Two runs over the same input: the second has no data and does not call the batch function."""
    base = scratch_path(spark, "warehouse")
    raw = shapes.orders_raw(spark, d)
    raw.write.parquet(f"{base}/bronze")

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/applied/run={batch_id}")

    for _ in range(2):
        stream = spark.readStream.schema(raw.schema).parquet(f"{base}/bronze")
        streams.run_if_new_data(stream, apply, f"{base}/checkpoint")
    applied = spark.read.parquet(f"{base}/applied")
    return applied.agg(
        F.countDistinct("run").alias("batches"), F.count(F.lit(1)).alias("row_count")
    )
