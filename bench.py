"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR``   folder of the tables (default /root/testdata/sf0.1)
``BENCH_CPUS``     local cores (default 8)
``BENCH_RUNS``     timed runs after one warm-up (default 3); the median counts
``BENCH_QUERIES``  comma-separated names instead of the headline ones
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hitloom.session import build_session  # noqa: E402
from hitloom.operators import explode_hits  # noqa: E402
from hitloom.sources import decode_events  # noqa: E402
from workload import fixture as fx  # noqa: E402
from workload.queries import queries  # noqa: E402

HEADLINE = [
    "q_map_channels",
    "q_subtract_reference",
    "q_pair_edges",
    "q_category_totals",
    "q_top2",
    "q_interpolate_curves",
    "q_linear_calib",
    "q_strip_full",
    "q_strip_short",
    "q_two_sided_full",
    "q_wire",
    "q_trigger",
    "q_hist1d",
    "q_hist1d_sales",
    "q_hist2d",
    "q_hist2d_sales",
    "q_strip_full_spread",
    "q_strip_batch",
    "q_stream_strip",
    "decode_stored",
]


def stored_messages(spark, sf_dir: str, shared: str):
    """The decoding of messages that are stored before the clock starts."""
    path = f"file://{shared}/messages"
    fx.encode(fx.single_hit_events(fx.hits(spark, sf_dir)), per_message=16).write.parquet(path)
    return lambda spark, sf_dir: explode_hits(decode_events(spark.read.parquet(path)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    shared = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir=f"file://{shared}",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = dict(queries())
    if "decode_stored" in names:
        registered["decode_stored"] = stored_messages(spark, sf_dir, shared)
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
