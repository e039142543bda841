"""Headline timings as one JSON line.

BENCH_SF_DIR: folder of the given tables; BENCH_CPUS: local cores. The landed files are prepared
first and not timed, as the timed jobs start from files.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from siltstone.plans import lakehouse, retail, shapes  # noqa: E402
from siltstone.plans.registered import load_all  # noqa: E402
from siltstone.plans.registered.files import POS_ALL, land_csv, land_products  # noqa: E402
from siltstone.plans.registry import QUERIES  # noqa: E402
from siltstone.session import build_session, scratch_path  # noqa: E402

QUERY_NAMES = (
    "dedupe_latest",
    "clickstream_daily",
    "surrogate_keys",
    "scd2_from_log",
    "scd2_timestamp",
    "fact_upsert",
    "dq_log",
    "fact_daily_sales",
    "asof_version_join",
    "upsert_partitions",
    "date_range_rollup",
    "accuracy_by_group",
    "zorder_layout",
)


def land(spark, sf_dir, landing):
    raw = shapes.pos_raw(spark, sf_dir).repartition(8)
    later = F.year("_ingest_ts") >= 1999
    land_csv(raw.filter(~later).select(*shapes.POS_COLUMNS), f"{landing}/pos/early")
    land_csv(raw.filter(later).select(*POS_ALL), f"{landing}/pos/later")
    clicks = shapes.clicks_raw(spark, sf_dir).select(*shapes.CLICK_COLUMNS)
    clicks.repartition(8).write.json(f"{landing}/clicks")
    land_products(spark, sf_dir, f"{landing}/products")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    base = scratch_path(spark, "bench")
    land(spark, sf_dir, f"{base}/landing")

    seconds: dict[str, float] = {}

    def timed(name, run):
        begin = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    timed("bronze_ingest", lambda: lakehouse.bronze(spark, f"{base}/landing", base))
    timed("silver_transform", lambda: lakehouse.silver(spark, base))
    timed("gold_build", lambda: lakehouse.gold(spark, base))
    reports = {
        "q1_daily_revenue_by_category": retail.daily_revenue_by_category,
        "q2_top_products_with_views": retail.top_products_with_views,
        "q3_weekend_mix_by_region": retail.weekend_mix_by_region,
    }
    for name, report in reports.items():
        timed(name, lambda report=report: report(lakehouse.read_star(spark, base)).collect())
    pipeline = sum(seconds.values())
    for name in QUERY_NAMES:
        timed(name, lambda name=name: drain(QUERIES[name](spark, sf_dir)))

    source_rows = sum(
        spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "events", "part")
    )
    result = {
        "metric": "retail pipeline from landed files to reports, plus headline operators",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "pipeline_sec": round(pipeline, 3),
        "source_rows": source_rows,
        "pipeline_rows_per_sec": round(source_rows / pipeline),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
