"""Sums and means have the same bits for any order, partitioning and grouping."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lodgeflow import functions as fn
from lodgeflow import operators


@pytest.fixture(scope="module")
def values():
    rng = random.Random(4)
    return [rng.choice([1, 1e-3, 1e5, 1e9]) * rng.uniform(-1, 1) for _ in range(4000)]


def _table(spark, values, parts):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k bigint, v double")
    return rows.repartition(parts)


def test_plain_sums_differ_and_exact_ones_do_not(spark, values):
    plain, exact = set(), set()
    for seed in range(6):
        order = random.Random(seed).sample(values, len(values))
        table = _table(spark, order, 1 + seed)
        plain.add(table.agg(F.sum("v")).first()[0])
        exact.add(table.agg(fn.exact_sum(fn.exact_parts(F.col("v")))).first()[0])
    assert len(plain) > 1 and len(exact) == 1
    want = float(sum(map(Fraction, values)))
    assert exact.pop() == pytest.approx(want, rel=1e-13)


def test_partial_sums_merge_to_the_same_bits(spark, values):
    table = _table(spark, values, 3)
    whole = table.agg(fn.exact_mean(F.col("v"))).first()[0]
    for groups in (2, 17, 4000):
        parts = [c.alias(n) for n, c in fn.exact_parts(F.col("v")).items()]
        partial = table.groupBy(F.col("k") % groups).agg(*parts)
        assert partial.agg(fn.mean_of_parts()).first()[0] == whole


def test_32_bit_floats_are_summed_exactly(spark):
    floats = [0.1, 4.3, -2.7, 1e-7, 123456.7]
    table = spark.createDataFrame([(v,) for v in floats], "v float")
    held = [r[0] for r in table.collect()]
    assert table.agg(fn.exact_sum(fn.exact_parts(F.col("v")))).first()[0] == float(sum(map(Fraction, held)))


@pytest.mark.parametrize("special, want", [
    ([1.0, float("nan")], float("nan")), ([1.0, float("inf")], float("inf")), ([1e300, 1e300, -1.5], 2e300),
    ([None, 2.0, 4.0], 6.0), ([None, None], None), ([], None), ([-0.5, 0.25], -0.25),
])
def test_special_values(spark, special, want):
    table = spark.createDataFrame([(v,) for v in special], "v double")
    parts = fn.exact_parts(F.col("v"))
    total, mean = table.agg(fn.exact_sum(parts), fn.exact_mean(F.col("v"))).first()
    n = sum(v is not None for v in special)
    if want is None:
        assert total is None and mean is None
    else:
        assert (math.isnan(want) and math.isnan(total)) or (total == want and mean == want / n)


def test_scores_and_sliding_windows(spark, values):
    """Orders of the same reviews that gave different means before."""
    found = set()
    for seed in range(4):
        order = random.Random(seed).sample(values, len(values))
        table = _table(spark, order, 1 + seed).select(
            F.expr("timestamp_ntz'2025-01-01 10:00:00' + make_dt_interval(0, 0, 0, int(v) % 600)").alias("at"),
            F.lit(7).alias("listing_id"),
            F.col("v").alias("review_score"),
        )
        hours = operators.sliding_mean(table, "at", ["listing_id"], F.col("review_score"), "m")
        means = operators.avg_review_score(table)
        found.add((tuple(sorted(map(tuple, hours.collect()))), tuple(map(tuple, means.collect()))))
    assert len(found) == 1
