"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import SparkSession

from wayline.suite import QUERIES

HEADLINE = (
    "normalize_entity", "quarantine_split", "dedup_last_wins", "detect_changes", "merge_upsert", "state_upsert",
    "replace_children", "normalize_images", "prefix_until_seen", "doc_dedup_collect", "insert_ignore",
    "token_frequency", "keyword_scores", "candidate_filter", "place_match", "accumulate_score", "category_rank",
    "popularity_rank", "check_unique", "cosine_top_k", "page_assemble", "daily_entity_load", "hourly_trend",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads


    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:  # compile and warm up
        run(name)
    timings = {name: round(median(run(name) for _ in range(3)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
