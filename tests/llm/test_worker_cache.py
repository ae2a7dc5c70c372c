"""What a Python worker keeps between stages."""

import weakref
from types import SimpleNamespace

from pyspark import TaskContext

from millrace.llm import common


class Tables:
    """Holds itself, as encoders do."""

    def __init__(self):
        self.own = self


def test_worker_holds_the_objects_of_one_stage(monkeypatch):
    def in_stage(n):
        monkeypatch.setattr(TaskContext, "_taskContext", SimpleNamespace(stageId=lambda: n))

    in_stage(1)
    scoring = weakref.ref(common.worker_cache(("scoring",), Tables))
    stems = weakref.ref(common.worker_cache(("stems",), Tables))
    assert common.worker_cache(("scoring",), Tables) is scoring() is not None and stems() is not None
    in_stage(2)
    assert common.worker_cache(("scoring",), Tables) is scoring()
    packing = weakref.ref(common.worker_cache(("packing",), Tables))
    assert packing() is not None and scoring() is not None
    assert stems() is None  # only an earlier stage asked for it
    in_stage(3)
    common.worker_cache(("next",), Tables)
    assert packing() is None and scoring() is None
    in_stage(4)
    common.drop_other_stages()
    made = []
    common.worker_cache(("next",), lambda: made.append(1) or Tables())
    assert made == [1]
    in_stage(5)
    common.drop_other_stages()
