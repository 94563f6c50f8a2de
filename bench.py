"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strainwise.plans import registry
from strainwise.session import RECOMMENDED

HEADLINE = """
clean_binary_phenotypes clean_cc_phenotypes categorise_tests binarise_mic consensus_by_medium
formatted_annotation_per_gene decompose_mnv tiered_variant_categories variant_catalogue_map stage_annotations
categorised_genotypes genotype_extract drug_overview phenotype_counts ppv neutral_variants
predict_v1 predict_v2 lineage_marker_frequencies snv_sites load_known_genotypes register_deletions
upsert_samples sample_depth_summary combine_browser
""".split()


def main() -> None:
    from pyspark.sql import SparkSession

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.all_queries()
    # One pass over the tables starts the workers and the file cache; it is not counted.
    queries["ppv"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
