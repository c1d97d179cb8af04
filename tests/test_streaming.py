"""Structured Streaming panel: folding line-item files in one micro-batch at a
time ends in the same cube as the batch build."""

from panelgap.operators.panel import expand_cube
from panelgap.plans import model
from panelgap.streaming.panel_stream import panel_groups, start_panel_stream
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "lineitem_parts")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(3).write.parquet(src)
    out, ckpt = str(tmp_path / "groups"), str(tmp_path / "state")
    q = start_panel_stream(spark, SF_SMALL, out, ckpt, lineitem_path=src, files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 3   # one file per batch
    streamed = expand_cube(panel_groups(spark, SF_SMALL, out))
    batch = model.cells(spark, SF_SMALL)
    assert streamed.count() == 624
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
