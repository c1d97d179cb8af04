"""The corpus pipeline against its stages' rules by brute force."""

from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F

from panelgap.llm.quality import quality_report

from test_corpus_operators import SF, brute_overlaps, plain_components, plain_fingerprint


def test_stages_in_order_and_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "source_mix", "shards"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, seen[-1], SF).write.parquet(path)
        seen.append(spark.read.parquet(path))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    kept = {r.doc_id for r in quality_report(docs).where(F.col("kept")).collect()}
    assert ids[1] == kept
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in seen[1].collect()]
    assert ids[2] == set(plain_components(rows))
    texts = [(r.doc_id, r.text) for r in seen[2].collect()]
    assert ids[3] == ids[2] - {d for d, _ in brute_overlaps(texts, items)}
    copies = Counter(r.doc_id for r in seen[4].collect())
    assert set(copies) <= ids[3] and max(copies.values()) <= 3
    assert all(d.columns == docs.columns for d in seen[1:5])
    sizes = Counter(r["shard"] for r in seen[5].collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1 and seen[5].count() == seen[4].count()
    assert cp.run(spark, SF).count() == seen[5].count()
