"""Plans of the native operators: no Python worker in any step; no cross join in any query of the folder."""

import pytest
from conftest import SF001
from pyspark.sql import DataFrameWriter

from tastespark.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def plans(spark):
    """Per query the plans of what it writes on the way, and its own."""
    out, steps, write = {}, [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        steps.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    patch = pytest.MonkeyPatch()
    patch.setattr(DataFrameWriter, "parquet", recorded)
    for name in ("op1_mix_sources", "op8_chat", "op7_line_dedup", "op11_periodic_runs", "op12_whitening", "op13_decontaminate"):
        steps.clear()
        last = REGISTRY[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        out[name] = "\n".join([*steps, last])
    patch.undo()
    return out


@pytest.mark.parametrize("name", ["op1_mix_sources", "op8_chat", "op7_line_dedup"])
def test_no_python_workers(plans, name):
    assert not any(x in plans[name] for x in ("Python", "Pandas", "Arrow"))


def test_no_cross_joins(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoop" in p] == []
