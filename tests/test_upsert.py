"""The bucketed upsert table: rows, replays, files and folders over many batches."""

import os

import pytest
from pyspark.sql import functions as F

from tastespark.plans.materialize import dropped_after, stored
from tastespark.sinks.upsert import UpsertTable


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_many_batches_keep_as_many_files_as_buckets(spark, tmpdir_path):
    """Forty batches of three keys: each rewrites its own buckets, and neither files nor folders add up."""
    table, want = UpsertTable(spark, f"{tmpdir_path}/t", ["k"], buckets=4), {}
    before = None
    for n in range(40):
        batch = [(n * 5 % 11, float(n)), (n % 3, float(-n)), (100 + n % 7, 0.5)]
        batch = list({k: (k, v) for k, v in batch}.values())
        old = table.manifest()
        assert table.upsert(spark.createDataFrame(batch, "k long, v double"), n)
        want.update(dict(batch))
        new = table.manifest()
        touched = {str(b) for b in table.buckets_of(spark.createDataFrame(batch, "k long, v double"))}
        if old:
            assert {b for b in new["folders"] if new["folders"][b] != old["folders"].get(b)} == touched
        before = old
    assert rows_of(table.read()) == sorted(want.items())
    assert table.files() == 4 and len(os.listdir(f"{tmpdir_path}/t/manifest")) <= 4      # with check sums
    live = {f.split("/")[0] for m in (before, table.manifest()) for f in m["folders"].values()}
    assert set(os.listdir(f"{tmpdir_path}/t/data")) == live


def test_replayed_batch_changes_nothing_and_sees_what_it_saw(spark, tmpdir_path):
    table = UpsertTable(spark, f"{tmpdir_path}/t", ["k", "j"], by=["k"], buckets=3)
    make = lambda rows: spark.createDataFrame(rows, "k long, j long, v string")
    assert table.read() is None and table.files() == 0
    assert table.upsert(make([(1, 1, "a"), (2, 1, "b")]), 0)
    assert table.upsert(make([(1, 1, "c"), (1, 2, "d")]), 1)
    now = table.manifest()
    assert not table.upsert(make([(1, 1, "again")]), 1) and not table.upsert(make([(9, 9, "old")]), 0)
    assert table.manifest() == now
    assert rows_of(table.read()) == [(1, 1, "c"), (1, 2, "d"), (2, 1, "b")]
    assert rows_of(table.read(before=1)) == [(1, 1, "a"), (2, 1, "b")] and table.read(before=0) is None
    assert table.upsert(make([]), 2) and rows_of(table.read()) == [(1, 1, "c"), (1, 2, "d"), (2, 1, "b")]


def test_buckets_are_read_apart(spark, tmpdir_path):
    table = UpsertTable(spark, f"{tmpdir_path}/t", ["k"], buckets=8)
    table.upsert(spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), 0)
    some = spark.createDataFrame([(5,), (6,)], "k long")
    only = table.buckets_of(some)
    part = table.read(only=only)
    assert {5, 6} <= {r.k for r in part.collect()} and part.count() < 100
    assert len(part.inputFiles()) == len(only) <= 2
    assert rows_of(table.read(only=[])) == []


def test_a_lost_draft_leaves_the_table_as_it_was(spark, tmpdir_path, monkeypatch):
    table = UpsertTable(spark, f"{tmpdir_path}/t", ["k"], buckets=2)
    table.upsert(spark.createDataFrame([(1, 1)], "k long, v long"), 0)
    monkeypatch.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.upsert(spark.createDataFrame([(1, 2)], "k long, v long"), 1)
    monkeypatch.undo()
    assert rows_of(table.read()) == [(1, 1)]
    assert table.upsert(spark.createDataFrame([(1, 3)], "k long, v long"), 1) and rows_of(table.read()) == [(1, 3)]
    assert len(os.listdir(f"{tmpdir_path}/t/data")) == 2      # what the two newest manifests name


def test_intermediate_tables_go_at_the_end_of_their_block(spark, tmpdir_path):
    with dropped_after(spark):
        gone = stored(spark.range(5), "gone").inputFiles()[0]
        kept = stored(spark.range(5), "kept", keep=True)
        with dropped_after(spark):
            inner = stored(spark.range(3), "inner", compact=True).inputFiles()[0]
        assert not os.path.exists(inner.removeprefix("file://")) and os.path.exists(gone.removeprefix("file://"))
    assert not os.path.exists(gone.removeprefix("file://")) and kept.count() == 5
    with pytest.raises(ValueError):
        with dropped_after(spark):
            gone = stored(spark.range(5), "gone").inputFiles()[0]
            raise ValueError
    assert not os.path.exists(gone.removeprefix("file://"))
