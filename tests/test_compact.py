"""Compaction of stream tables: few files, every row once, whatever fails."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom import Registry, TableSpec, Field
from tagloom.plans.sink import replace_partition
from tagloom.spec import INTEGER
from tagloom.streaming import compact as module
from tagloom.streaming.compact import compact, packed
from tagloom.streaming.ingest import _create_tables

SPEC = TableSpec("t_a", (Field("w", INTEGER),))


def _batch(spark, database, stream, batch, values):
    rows = spark.createDataFrame([(v,) for v in values], "w int").repartition(2)
    replace_partition(rows, f"`{database}`.`t_a`", {"stream_id": stream, "batch_id": batch})


def _files(spark, database):
    return spark.table(f"{database}.t_a").select(F.input_file_name().alias("f")).distinct().count()


def _rows(spark, database):
    spark.catalog.refreshTable(f"{database}.t_a")
    return Counter((r.stream_id, r.w) for r in spark.table(f"{database}.t_a").collect())


def test_packing():
    assert packed({}, 10) == [] and packed({1: 3}, 10) == []
    assert packed({1: 3, 2: 3, 3: 5, 5: 1, 4: 90, 6: 1, 7: 1}, 10) == [[1, 2], [5, 6, 7]]


def test_batches_end_in_few_files_and_every_row_stays_once(spark, database, monkeypatch):
    _create_tables(spark, database, Registry.of(SPEC))
    expected = Counter()
    for stream, batches in (("one", 24), ("two", 3)):
        for b in range(batches):
            values = [100 * b + k for k in range(4)]
            _batch(spark, database, stream, b, values)
            expected.update((stream, v) for v in values)
    assert _files(spark, database) > 30

    drop, calls = module._drop, []

    def fail_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost")
        drop(*args)

    monkeypatch.setattr(module, "_drop", fail_once)
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, database)
    compact(spark, database)
    assert _rows(spark, database) == expected
    assert _files(spark, database) <= 6
    ledger = spark.table(f"{database}.stream_ledger").filter("table_name LIKE '%t_a`'").collect()
    assert {r.state for r in ledger} == {"switched"} and max(len(r.batches) for r in ledger) == 23

    # the newest batch, repeated, replaces itself and nothing else; new ones are merged later
    _batch(spark, database, "one", 23, [-1])
    expected = Counter({k: n for k, n in expected.items() if not (k[0] == "one" and k[1] >= 2300)}) + Counter([("one", -1)])
    assert _rows(spark, database) == expected
    _batch(spark, database, "one", 24, [-2])
    compact(spark, database)
    assert _rows(spark, database) == expected + Counter([("one", -2)])
    assert compact(spark, database).count() == 0
