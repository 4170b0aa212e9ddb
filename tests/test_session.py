"""Staged tables and their removal."""

import os

from tabulyst import session


def test_temporary_stages(spark):
    kept = session.stage(spark.range(3), "kept")
    with session.temporary_stages(spark):
        first = session.stage(spark.range(5), "first")
        with session.temporary_stages(spark):
            second = session.stage(first.filter("id > 1"), "second")
            assert second.count() == 3
            inner = second.inputFiles()[0].removeprefix("file://")
        assert not os.path.exists(inner) and first.count() == 5
        outer = first.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(os.path.dirname(outer)) and kept.count() == 3
