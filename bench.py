"""Times the headline queries and prints one JSON line.

Each query runs twice and the second run counts. Queries of ``STORED`` start from tables or a model
that the first run has stored; they are summed apart from those that start from the sources. What
they find stored costs ``ml_dataset`` and ``train_model``.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesflow.checks import queries  # noqa: E402
from salesflow.checks.queries import QUERIES  # noqa: E402
from salesflow.session import get_session  # noqa: E402

HEADLINE = [
    "clean_sales", "sales_enriched", "zone_context", "sales_zone_context", "family_context",
    "ml_dataset", "report_union", "annual_totals", "customer_features", "sales_annual_context",
    "outlier_trim", "indexed_categories", "catalogue", "candidate_grid", "top_n_per_client",
    "best_price", "error_metrics", "residual_histogram", "normalise_text", "unit_price",
    "train_model", "calibrated", "recommend_top_n", "best_price_model",
]

STORED = {"catalogue", "candidate_grid", "top_n_per_client", "calibrated", "recommend_top_n", "best_price_model"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                        spark__driver__memory="16g", spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false",
                        spark__python__sql__dataFrameDebugging__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    for name in names:
        if name == "train_model":  # one long job: not repeated
            timed(name, lambda: queries._model(spark, folder))
            continue
        run(name)  # lets the JVM compile, and stores the tables a query starts from
        timed(name, lambda: run(name))
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "from_source_seconds": round(sum(s for q, s in seconds.items() if q not in STORED), 3),
                      "stored_input_seconds": round(sum(s for q, s in seconds.items() if q in STORED), 3),
                      "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
