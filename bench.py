"""Time registered queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (cores), ``BENCH_QUERIES``
(comma-separated names, ``all``, default the headline queries), ``BENCH_RUNS``
(best of n, default 1).
Every run computes the whole result, including its working sets; nothing is
kept from one query to the next.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from procurelens import registry  # noqa: E402
from procurelens.session import build_session  # noqa: E402
from procurelens.sources.tables import release  # noqa: E402

HEADLINE = (
    "dq_missing_counts", "dq_domain_profile", "dq_id_collisions", "clean_fact",
    "spend_kpis", "spend_yoy", "spend_monthly", "spend_by_department", "spend_by_category",
    "spend_top_subcategories", "spend_po_value_stats", "spend_dept_category_affinity",
    "vendor_spend_ranking", "vendor_concentration", "vendor_top3_by_category",
    "vendor_delivery_scorecard", "delivery_overall", "delivery_by_category",
    "delivery_lateness_buckets", "delivery_by_month", "open_aging",
    "price_index_bands", "ppv_by_vendor", "price_vendor_effect", "price_volume_effect",
    "price_year_adjusted", "opp_summary", "opp_scorecard", "opp_quadrants", "opp_tail_spend",
    "fc_accuracy", "fc_final",
)
WARM_UP = ("clean_fact", "spend_by_category", "price_index_bands", "opp_scorecard")


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    release(spark)
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    queries = registry.all_queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = (list(queries) if chosen == "all"
             else [n for n in chosen.split(",") if n] or list(HEADLINE))
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus), memory="20g")
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        run(queries[name], spark, folder)
    times = {n: round(min(run(queries[n], spark, folder) for _ in range(runs)), 3) for n in names}
    print(json.dumps({
        "metric": "total wall time of the timed queries",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
