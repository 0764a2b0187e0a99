"""The table of handled keys: what a batch sees, repeats after failures, growth, and the cost of many batches."""

import pytest

from newsweave.session import work_path
from newsweave.sources.keyed import KeyTable


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def run(table, spark, names, batch):
    """A batch: the names that are new, which are added."""
    batch_keys = keys(spark, names)
    known = {r["url"] for r in table.known(table.start(batch_keys, batch)).collect()}
    new = [n for n in dict.fromkeys(names) if n not in known]
    table.add(keys(spark, new), batch)
    return new


def test_keys_are_new_once(spark):
    table = KeyTable(spark, work_path(spark, "keys"), rows_per_bucket=3)
    assert run(table, spark, ["a", "b", "a", "é"], 0) == ["a", "b", "é"]
    assert run(table, spark, ["b", "c"], 1) == ["c"]
    assert run(table, spark, [], 2) == []
    assert run(table, spark, ["a", "b", "c", "é"], 3) == []


def test_a_repeated_batch_sees_what_was_before_it(spark):
    table = KeyTable(spark, work_path(spark, "keys"))
    run(table, spark, [f"k{i}" for i in range(50)], 0)
    assert run(table, spark, ["k1", "x", "y"], 1) == ["x", "y"]
    again = KeyTable(spark, table.path)  # a new driver; the first try had written its keys
    assert run(again, spark, ["k1", "x", "y"], 1) == ["x", "y"]
    again.start(keys(spark, ["k1", "x", "y"]), 1)
    again.add(keys(spark, ["x"]), 1)  # this try only handled one of them
    assert run(again, spark, ["x", "y", "k1", "k2"], 2) == ["y"]


def test_growth_that_was_cut_short(spark):
    table = KeyTable(spark, work_path(spark, "keys"), rows_per_bucket=2)
    names = [f"k{i}" for i in range(200)]
    run(table, spark, names, 0)
    first = table.bits()
    table._write(keys(spark, ["lost"]).selectExpr("url", "0 AS bucket", "0L AS version"), first + 2)  # without a mark
    table._files.delete(table._location(f"bits={first + 2}/_SUCCESS"), False)
    assert run(table, spark, ["lost", "k5"], 1) == ["lost"]
    assert table.bits() > first and table._numbers("", "bits") == [table.bits()]
    assert run(table, spark, [*names, "new"], 2) == ["new"]


def test_rows_read_stay_flat(spark):
    table = KeyTable(spark, work_path(spark, "keys"), rows_per_bucket=8)
    read = []
    for batch in range(24):
        names = [f"k{batch * 30 + i}" for i in range(30)]
        buckets = table.start(keys(spark, names), batch)
        read.append(table.known(buckets).count())
        assert read[-1] <= 8 * max(len(buckets), 1) and len(buckets) <= 30
        table.add(keys(spark, names), batch)
    assert max(read) <= 30 * 8 and table.bits() >= 6
    everything = keys(spark, [f"k{i}" for i in range(24 * 30)])
    assert run(table, spark, [r["url"] for r in everything.collect()], 24) == []


@pytest.mark.parametrize("name", ["with.dot", "url"])
def test_key_names(spark, name):
    table = KeyTable(spark, work_path(spark, "keys"), name)
    df = spark.createDataFrame([("a",)], f"`{name}` string")
    assert table.start(df, 0) == []
