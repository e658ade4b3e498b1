"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shoal.plans import QUERIES  # noqa: E402
from shoal.session import build_session, scratch_space  # noqa: E402

HEADLINE = (
    "agg_basic", "i2i_topn", "itemcf_v1", "pairs_once", "swing_v1", "swing_query_i2i", "knn_cosine", "levenshtein_pairs",
    "tfidf_topn", "deepwalk", "weighted_sample", "funnel_report", "report_ratios", "ab_ctr", "uninstall_rate", "hot_in_search",
    "supplement_lists", "user_hot_category", "user_behaviour_profile", "user_hierarchy", "eligible_items", "audience_week_not_today",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    spark = build_session("bench", f"local[{cpus}]", cpus, {"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        with scratch_space(spark):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
