"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Every query is written in full to a no-op sink. One JSON line goes to stdout.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from cohortloom.plans.registry import QUERIES

HEADLINE = [
    "profiles", "labelled_cases", "label_balance", "red_persistence", "adapted_profiles", "case_context",
    "layer1_dialogues", "turn_history", "token_totals", "pending_cases", "upsert_dialogues", "noise_stt",
    "noise_idiom", "layer2_dialogues", "noise_log", "noise_lineage", "quality_report", "contract_violations",
    "gold_committee", "bundle_roundtrip", "incremental_labels", "resume_run",
    # over time, by event
    "label_at_event", "red_episodes", "stream_resume", "windowed_label_share",
    # over all generated turns
    "layer2_generated", "noise_audit", "prompts_by_template",
    # named tables
    "upsert_bucketed", "gold_roundtrip", "distinct_cases_sketch", "parsed_variants",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cohortloom.tasks", cpus)  # the test tables are single files
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost more than the plans
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["rule_label_events"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
