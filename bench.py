"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local cores, BENCH_QUERIES a comma-separated choice of queries. Every query is
run once to warm up and then timed, its whole result going to the noop sink.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.intervals import LABELS
from barloom.session import local_session
from checks import inputs, queries

HEADLINE = (
    "ohlcv_1m", "ohlcv_1h", "ohlcv_1d", "ohlcv_1w", "vwap_1d", "user_hourly_bars", "rollup_1m_to_1h",
    "multi_interval_bars", "all_interval_counts",
    "upsert_keep_last", "duplicates_keep_last", "append_keep_first", "hybrid_series", "series_head_tail",
    "high_water_mark", "timeframe_availability", "freshness", "verify_per_ticker", "verify_totals", "plan_outcome",
    "resume_rows", "load_report", "prefilter_skip", "to_process", "progress",
    "category_filter", "asset_types", "batches", "universe_documents",
    "series_query", "series_profile", "store_stats", "day_coverage", "symbol_extract",
    "landed_bars", "market_day_report", "human_sizes",
    "store_upsert", "backfill_report", "stream_hourly_bars",
)


def one_scan_per_interval(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The plain way to the result of all_interval_counts: 25 scans of the ticks."""
    return [queries.ohlcv(label, spark, sf).groupBy("interval").agg(F.count("*"), *queries.spread()) for label in LABELS]


def drain(result: DataFrame | list[DataFrame]) -> None:
    for df in result if isinstance(result, list) else [result]:
        df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=8, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries.registry() | {"one_scan_per_interval": one_scan_per_interval}
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else (*HEADLINE, "one_scan_per_interval")
    drain(inputs.event_ticks(spark, sf))
    times = {}
    for name in names:
        drain(known[name](spark, sf))
        start = time.perf_counter()
        drain(known[name](spark, sf))
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(v for k, v in times.items() if k != "one_scan_per_interval"), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
