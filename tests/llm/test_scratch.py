"""What a written step leaves behind on the driver."""

import gc

from mattone.llm import scratch


def test_written_step_collects_the_drivers_garbage(spark, monkeypatch):
    """An object that nothing uses any more is gone after a step that leaves the heap fuller than the share."""
    monkeypatch.setattr(scratch, "HEAP_SHARE", 0.0)
    unused = spark._jvm.java.lang.Object()
    left = spark._jvm.java.lang.ref.WeakReference(unused)
    del unused
    gc.collect()
    table = scratch.written(spark.range(10), "garbage")
    assert left.get() is None
    assert table.count() == 10


def test_written_step_leaves_a_heap_with_room_alone(spark, monkeypatch):
    monkeypatch.setattr(scratch, "HEAP_SHARE", 1.0)
    assert sorted(r.id for r in scratch.written(spark.range(3), "room").collect()) == [0, 1, 2]
