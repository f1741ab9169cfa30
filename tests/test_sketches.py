"""Sketches by part, put together, against those of all rows and against exact answers."""

import random

from pyspark.sql import functions as F

from lodestay.operators import sketches


def test_distinct_counts_merge(spark):
    df = spark.range(200_000, numPartitions=6).select((F.col("id") % 11).alias("part"), (F.xxhash64("id") % 30_000).alias("v"))
    parts = sketches.distinct_sketches(df, ["part"], "v")
    whole = sketches.distinct_sketches(df, [], "v")
    one, other = (sketches.merge_distinct(s, []).select(sketches.distinct()).first()[0] for s in (parts, whole))
    exact = df.select("v").distinct().count()
    assert one == other and abs(one - exact) <= sketches.distinct_error() * exact
    few = sketches.distinct_sketches(spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, None)], "k int, v string"), ["k"], "v")
    assert {r.k: r.n for r in few.select("k", sketches.distinct().alias("n")).collect()} == {1: 1, 2: 0}


def test_quantiles_merge(spark):
    rng = random.Random(2)
    values = [rng.gauss(0, 1) for _ in range(40_000)]
    df = spark.createDataFrame([(i % 13, v) for i, v in enumerate(values)], "part int, v double").repartition(5)
    merged = sketches.merge_quantiles(sketches.quantile_sketches(df, ["part"], "v"), [])
    values.sort()
    for q in (0.05, 0.5, 0.9):
        got = merged.select(sketches.quantile(q)).first()[0]
        assert abs(sum(v <= got for v in values) / len(values) - q) <= 2 * sketches.rank_error()
    none = sketches.quantile_sketches(spark.createDataFrame([(1, None)], "k int, v double"), ["k"], "v")
    assert none.select(sketches.quantile()).first()[0] is None
