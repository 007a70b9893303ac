"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores. Every query is
run to the end into a sink that drops the rows, once to warm up and then ``BENCH_RUNS`` times; the
best time counts. ``ops`` times the band join on stored inputs, and with ``BENCH_DIRECT_JOIN`` set
also the same join left to the planner.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tickloom.operators.joins import band_join  # noqa: E402
from tickloom.plans import market  # noqa: E402
from tickloom.plans.queries import all_queries  # noqa: E402
from tickloom.session import local_session, materialize  # noqa: E402

HEADLINE = [
    "parse_trades", "parse_depth", "contract_trade_valid", "contract_orderbook_dlq",
    "dedup_exact", "dedup_books", "band_join", "asof_join", "feature_projection",
    "serving_features", "top_n_recent", "clean_training", "ffill_features", "scaled_features",
    "sequences", "train_test_split", "eval_metrics", "last_200", "chart_outer_join",
    "stream_contract_split", "stream_features",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(build) -> float:
    start = time.perf_counter()
    run(build())
    return time.perf_counter() - start


def direct_band_join(trades, books):
    """The join as a condition on the seconds, which Spark can only key on the symbol."""
    t, b = trades.alias("t"), books.alias("b")
    near = F.expr("t.timestamp div 1000 - b.timestamp div 1000 between -1 and 1")
    return t.join(b, (F.col("t.symbol") == F.col("b.symbol")) & near, "left")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    folder = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, **{
        "spark.driver.memory": "8g", "spark.checkpoint.dir": folder,
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    available = all_queries()
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    times = {}
    for name in chosen:
        build = lambda: available[name](spark, sf_dir)  # noqa: E731, B023
        seconds(build)
        times[name] = round(min(seconds(build) for _ in range(runs)), 3)

    trades = materialize(market.valid_trades(spark, sf_dir), "bench-trades")
    books = materialize(market.valid_books(spark, sf_dir), "bench-books")
    seconds(lambda: band_join(trades, books))
    ops = {"band_join_equality_sec": round(seconds(lambda: band_join(trades, books)), 3)}
    if os.environ.get("BENCH_DIRECT_JOIN"):  # takes minutes already at sf0.1
        ops["band_join_direct_sec"] = round(
            seconds(lambda: direct_band_join(trades, books)), 3)
    print(json.dumps({
        "metric": "headline queries, total wall clock",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "ops": ops,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
