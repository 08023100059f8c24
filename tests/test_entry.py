"""Driver contract of __spark_entry__.py."""

import __spark_entry__ as E


def test_entry_runs_and_has_rows(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["id1", "id2", "similarity", "rank"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    rows_only = set(qs) - set(orc) - set(E.LLM_QUERIES)
    assert all(name.startswith("als_") for name in rows_only)


def test_no_cross_join_in_library():
    import pathlib
    import re

    root = pathlib.Path(E.__file__).parent / "tastespark"
    for path in root.rglob("*.py"):
        text = path.read_text()
        assert "crossJoin" not in text and not re.search(r"how=.cross", text), path
