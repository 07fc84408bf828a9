"""Time the headline queries once each at $BENCH_SF_DIR on local[$BENCH_CPUS], and print one line of JSON."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from lexforge.plans import catalogue

HEADLINE = ["cost_dictionary", "doc_budget", "chain2", "side_entropy", "argmax_surface", "span_cover", "fragments", "as_counted", "lexicon_merge", "eval_loss", "eval_total", "keys_diff", "hash_sample"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        # The documents are one small file of large rows; without this, one task reads them all.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.QUERIES["split_counts"](spark, sf).write.format("noop").mode("overwrite").save()  # starts the executors
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalogue.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
