"""Physical-plan shape of every registered query (sf0.001), each materialised step included."""

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as E
from conftest import SF001

TOP_K = {"top_similar_items", "recent_ratings_k5", "vector_top_similar", "top_rated_by_user",
         "als_recommend_all"}


@pytest.fixture(scope="module")
def plans(spark):
    """Per query the text of its plan and of the plan of every frame that it writes on the way."""
    out, steps, write = {}, [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        steps.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    patch = pytest.MonkeyPatch()
    patch.setattr(DataFrameWriter, "parquet", recorded)
    for name, fn in E.queries().items():
        if name == "als_grid" or name in E.LLM_QUERIES:    # a loop of fits; tests/llm
            continue
        steps.clear()
        last = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        out[name] = "\n".join([*steps, last])
    patch.undo()
    return out


def test_no_cartesian_products(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p] == []


def test_no_nested_loop_joins(plans):
    assert [n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p] == []


def test_top_k_is_cut_before_the_shuffle(plans):
    for name in TOP_K:
        assert "WindowGroupLimit" in plans[name], name


def test_no_row_at_a_time_python(plans):
    assert [n for n, p in plans.items() if "BatchEvalPython" in p] == []
