"""Bench: prints one JSON line with the seconds of each headline query.

`queries` holds registered queries from the test tables to a full result. `models` holds the
the raw tables is preparation and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import AS_OF, QUERIES  # noqa: E402
from tidemark.operators import forest  # noqa: E402
from tidemark.plans import marts, staging  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import fixtures  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = (
    "parse_events", "validate_orders", "validate_inventory", "reject_summary", "dlq_envelope",
    "dlq_repair_orders", "stream_profiles", "schema_fingerprint", "stg_orders", "stg_clickstream",
    "stg_inventory", "mart_pipeline_health", "mart_anomaly_summary", "mart_stream_overview",
    "upsert_orders", "dq_report", "anomaly_scores", "stream_orders_validated",
)


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    began = time.perf_counter()
    fn()
    return round(time.perf_counter() - began, 3)


def bench_models(spark, root: str) -> dict[str, float]:
    """Build each model from stored tables into stored tables, in dependency order."""

    def store(df, name):
        df.write.mode("overwrite").parquet(f"{root}/{name}")

    def read(name):
        return spark.read.parquet(f"{root}/{name}")

    for topic, make in fixtures.RAW.items():
        store(make(spark, SF_DIR), topic)
    store(fixtures.stream_profiles(spark, SF_DIR), "profiles")
    store(fixtures.anomaly_log(read("profiles")), "anomalies")

    tie = [fixtures.SEQUENCE]
    builds = {
        "stg_orders": lambda: staging.stg_orders(read("orders_topic"), tie),
        "stg_clickstream": lambda: staging.stg_clickstream(read("clickstream_topic"), tie),
        "stg_inventory": lambda: staging.stg_inventory(read("inventory_topic")),
        "stg_stream_profiles": lambda: staging.stg_stream_profiles(read("profiles")),
        "stg_anomaly_log": lambda: staging.stg_anomaly_log(read("anomalies")),
        "mart_pipeline_health": lambda: marts.mart_pipeline_health(
            read("stg_stream_profiles"), read("stg_anomaly_log"), AS_OF
        ),
        "mart_anomaly_summary": lambda: marts.mart_anomaly_summary(read("stg_anomaly_log"), AS_OF),
        "mart_stream_overview": lambda: marts.mart_stream_overview(
            read("stg_orders"), read("stg_clickstream"), read("stg_inventory"), AS_OF
        ),
    }
    seconds = {name: timed(lambda b=b, n=name: store(b(), n)) for name, b in builds.items()}

    features = forest.feature_frame(read("profiles"))
    model = None

    def train():
        nonlocal model
        model = forest.fit(features, AS_OF)

    seconds["train_forest"] = timed(train)
    seconds["score_profiles"] = timed(lambda: run_all(forest.score(features, model, AS_OF)))
    return seconds


def main() -> None:
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    run_all(spark.read.parquet(f"{SF_DIR}/events.parquet"))  # start-up is not measured
    queries = {q: timed(lambda q=q: run_all(QUERIES[q](spark, SF_DIR))) for q in HEADLINES}
    models = bench_models(spark, tempfile.mkdtemp(prefix="tidemark-bench-"))
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "models": models,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
