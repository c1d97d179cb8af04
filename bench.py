"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

* ``panel_build`` is the full microdata job (scan lineitem/orders/customer,
  join, grouping-sets cube) timed cold, without any cache.
* ``fact_build`` materialises the flagged fact with its derived columns (what
  the reference's loader does once) and persists it.
* ``panel_build_bucketed`` is the same cube from line items and orders
  co-bucketed by order key (layout written once, untimed); it is reported but
  not added to the total, being an alternative to ``panel_build``.
* ``cold`` has the first run of each query, ``extra`` the model fits, the stream, loads and audits.
* every other query then runs against that fact, as the reference's SQL runs
  against its loaded database.  Each is timed best-of-``BENCH_REPEATS``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "p1_ranking", "p1_profile", "p1_focus_vs_bench", "p1_pivot", "p1_distance", "v_ranking",
    "p2_gender_gap", "p2_focus_gender_by_level", "p3_age_effect", "p3_focus_age_by_level",
    "topk_excluded", "quality_inventory", "stats_by_level", "quality_by_entity", "entity_metrics",
    "comparison_table", "bi_map", "bi_kpis", "star_view", "clean_panel", "expectations",
    "rank_distributed", "topk_per_entity", "fk_violations", "knn_predict",
]

EXTRA = ["kmeans_clusters", "elbow", "tree_forest_compare", "tree_rules", "panel_stream", "silhouette_euclid",
         "sql_p1_ranking", "distinct_profile", "constraints", "load_metrics", "rejects", "refresh_readback"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from panelgap.plans import catalog, model
    from panelgap.session import local_session

    spark = local_session(master=f"local[{cpus}]")
    qs = catalog.queries()

    # warm-up: JVM, code generation, Python workers (tiny scale factor)
    small = "/root/testdata/sf0.001"
    if os.path.isdir(small):
        qs["p1_ranking"](spark, small).collect()
        model.clear_cache()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def run(name, fn):
        best = None
        for _ in range(repeats):
            t = time.perf_counter()
            fn()
            dt = time.perf_counter() - t
            cold.setdefault(name, round(dt, 4))
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 4)

    run("panel_build", lambda: qs["panel_build"](spark, sf_dir).collect())

    # the at-scale layout: line items and orders co-bucketed by order key
    # (written once, untimed), then the cube without the line-item shuffle
    from panelgap.operators.panel import expand_cube
    from panelgap.session import ensure_checkpoint_dir
    from panelgap.sources.layout import panel_groups_bucketed, write_bucketed_sources
    tables = write_bucketed_sources(spark, sf_dir, os.path.join(ensure_checkpoint_dir(spark), "bench-layout"),
                                    n_buckets=int(cpus))
    run("panel_build_bucketed", lambda: expand_cube(panel_groups_bucketed(spark, sf_dir, tables)).collect())

    t = time.perf_counter()
    model.fact(spark, sf_dir).count()
    times["fact_build"] = round(time.perf_counter() - t, 4)

    for name in HEADLINE:
        run(name, lambda n=name: qs[n](spark, sf_dir).collect())

    # model fits, loads and audits, once each and outside the total
    extra: dict[str, float] = {}
    for name in EXTRA:
        t = time.perf_counter()
        qs[name](spark, sf_dir).collect()
        extra[name] = round(time.perf_counter() - t, 4)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    # the bucketed build is an alternative to panel_build, not extra work
    total = sum(v for k, v in times.items() if k != "panel_build_bucketed")
    print(json.dumps({"metric": "total_sec", "value": round(total, 4), "unit": "sec",
                      "queries": times, "cold": cold, "extra": extra, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
