"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from catalog import fixtures as fx
from catalog.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
SEARCHES = [
    "tokenize_words", "count_words", "lookup_postings", "search_body_tfidf", "search_body_bm25",
    "search_body_bm25_stemmed", "search_title_binary", "search_anchor", "search_body_and_title_bm25",
    "ultimate_search_unstemmed", "ultimate_search", "most_similar", "evaluate", "grid_search",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("lexispark-bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("build_body_index", lambda: fx.body_index(spark, SF_DIR))
    timed("build_body_index_stemmed", lambda: fx.body_index(spark, SF_DIR, True))
    timed("build_title_index", lambda: fx.title_index(spark, SF_DIR))
    timed("build_title_index_stemmed", lambda: fx.title_index(spark, SF_DIR, True))
    timed("build_anchor_index", lambda: fx.anchor_index(spark, SF_DIR))
    for name in SEARCHES:
        timed(name, lambda: run(QUERIES[name](spark, SF_DIR)))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
