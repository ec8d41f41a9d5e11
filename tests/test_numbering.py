"""Consecutive numbers over range partitions."""

import random

from pyspark.sql import functions as F

from snaptrail.operators.numbering import numbered


def test_numbers_are_the_places_in_order(spark):
    random.seed(5)
    rows = [(random.choice([None, *range(30)]), random.random(), i) for i in range(2000)]
    table = spark.createDataFrame(rows, "key int, part double, number_of int").repartition(7)
    found = numbered(table, "key", F.desc("part"))
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [r.number_of for r in sorted(found.collect(), key=lambda r: r.number)] == [r[2] for r in expected]
    assert sorted(r.number for r in found.collect()) == list(range(1, 2001))
    assert found.columns == [*table.columns, "number"]


def test_ties_and_empty_tables(spark):
    same = spark.range(500).select(F.lit(1).alias("key")).repartition(4)
    assert sorted(r.number for r in numbered(same, "key").collect()) == list(range(1, 501))
    assert numbered(same.limit(0), "key").collect() == []
