"""Consecutive numbers over several ranges."""

import random

from pyspark.sql import functions as F

from newsweave.operators.numbering import numbered


def test_numbers_follow_the_order(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", None]), rng.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, `name.x` string, v double").repartition(7)
    found = numbered(df, "n", F.desc_nulls_last("`name.x`"), F.asc("id"), start=1)
    assert found.columns == ["id", "name.x", "v", "n"]
    order = sorted(rows, key=lambda r: (r[1] is None, [-ord(c) for c in r[1] or ""], r[0]))
    assert [tuple(r) for r in found.orderBy("n").collect()] == [(*r, i) for i, r in enumerate(order, 1)]
    assert numbered(df.limit(0), "n", F.asc("id")).count() == 0
