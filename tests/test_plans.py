"""Plan guards: the scale rules hold in every registered query's physical plan."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.test_oracle import WRITERS

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
PYTHON_ALLOWED = {"detail_fields_parsed"}     # the HTML-parser variant (mapInPandas)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k not in WRITERS))
def test_no_cross_join_or_row_udf(spark, key):
    text = _plan(E.queries()[key](spark, SF))
    for op in FORBIDDEN:
        assert op not in text, (key, op)
    if key not in PYTHON_ALLOWED:
        assert "MapInPandas" not in text and "PythonUDF" not in text, key


def test_silver_shuffles_postings_once(spark):
    text = _plan(E.queries()["silver_all_dates"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 2          # the dedup aggregate; companies by name
    assert "SortMergeJoin" not in text                           # small companies side broadcast by size
