"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from feedloom.lens import QUERIES
from feedloom.session import build_session

HEADLINES = [
    "requirements_per_ad", "s3_batch_dedup", "s4_upsert_index", "s6_route_tombstones",
    "j1_concept_lookup", "j8_replaced_by_expand", "j9_occupation_hierarchy", "j12_logo_resolve",
    "k1_clean_html", "k2_lenient_date", "k3_trim_location", "k5_label_split",
    "k9_enriched_terms", "k10_typeahead_terms", "t2_words", "t3_prefix_grams", "t5_shingles",
    "t9_term_dictionary", "j15_enrichment_attach", "p1_normalise_ad", "k7_extracted_keywords",
    "r1_incremental_import",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "median_seconds_sum", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
