"""Time the headline queries on the derived bars; prints one JSON line.

The bars are derived and written once, outside the timing. Each query is run to a sink that
discards its rows, twice, and the faster run counts.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ohlcraft.operators import change, detect, merge, reshape  # noqa: E402
from ohlcraft.operators.indicators.compute import indicators  # noqa: E402
from ohlcraft.operators.indicators.families import FAMILIES  # noqa: E402
from ohlcraft.sources import derived  # noqa: E402

RUNS = 2


def _session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # the bars of the small scale fit one partition, but the work on them does not
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _queries(bars, hits):
    frames = [f.name for f in FAMILIES.values() if f.framed]
    recursive = [f.name for f in FAMILIES.values() if not f.framed and not f.by_date]
    breadth = [f.name for f in FAMILIES.values() if f.by_date]
    return {
        "change_pct": lambda: change.change_percentage(bars),
        "patterns_all": lambda: detect.detect_patterns(bars),
        "indicators_frames": lambda: indicators(bars, frames),
        "indicators_recursive": lambda: indicators(bars, recursive),
        "indicators_breadth": lambda: indicators(bars, breadth),
        "indicators_all_long": lambda: reshape.indicators_long(indicators(bars)),
        "insert_ignore_patterns": lambda: merge.new_rows(
            hits.where("pattern_id < 40"), hits, ["pattern_id", "chart_id"]),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = _session(cpus)
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        derived.bars(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{folder}/bars")
        bars = spark.read.parquet(f"{folder}/bars")
        detect.detect_patterns(bars).write.parquet(f"{folder}/hits")
        hits = spark.read.parquet(f"{folder}/hits")
        seconds = {}
        for name, query in _queries(bars, hits).items():
            runs = []
            for _ in range(RUNS):
                begin = time.perf_counter()
                query().write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - begin)
            seconds[name] = round(min(runs), 3)
        spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
