"""A replay reads items that are written once; keys without items to give hand over nothing."""

from vocalake import registry
from vocalake.adapters import view
from vocalake.queries import media  # noqa: F401


def test_replayed_signal_is_worked_out_once(spark):
    timed = media._timed(view(spark, "/root/testdata/sf0.001", "signal"))
    plan = timed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and timed.columns == ["clip_id", "idx", "ts", "value"]
    assert registry.QUERIES["st1_stream_context_tail"](spark, "/root/testdata/sf0.001").count() == timed.count()
