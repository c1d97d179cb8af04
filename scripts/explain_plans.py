"""Write formatted physical plans of key queries to docs/plans/.

usage: python scripts/explain_plans.py [sf_dir]

Plans are taken with ``spark.sql.autoBroadcastJoinThreshold=-1`` so that they
show what the optimizer picks when the tables are large (explicit broadcast
hints on bounded dimensions still apply).
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEY = ["panel_build", "p1_ranking", "p2_gender_gap", "entity_metrics", "derive_gaps", "clean_panel",
       "expectations", "fk_violations", "rank_distributed", "topk_per_entity", "knn_predict", "bi_kpis"]


def main():
    from panelgap.plans import catalog
    from panelgap.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out, exist_ok=True)
    qs = catalog.queries()
    for n in KEY:
        df = qs[n](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(mode)
        with open(os.path.join(out, f"{n}.txt"), "w") as f:
            f.write(text)
        print(n, len(text.splitlines()), "lines")
    spark.stop()


if __name__ == "__main__":
    main()
