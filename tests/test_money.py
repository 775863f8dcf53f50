"""Amounts with more than four decimals raise at every size; four decimals never do."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.money import money_units


def units(spark, *amounts):
    return [r.u for r in spark.createDataFrame([(a,) for a in amounts], "a double").select(money_units("a").alias("u")).collect()]


@pytest.mark.parametrize("amount", [0.00001, 1.23456, 10000000.00004, 60000000.00006, 100000000.00004, 1e9 + 0.00004, 1e11 + 0.00005])
def test_more_decimals_raise(spark, amount):
    for signed in (amount, -amount):
        with pytest.raises(Exception, match="more than four decimals"):
            units(spark, signed)


def test_four_decimals_are_exact(spark):
    rng = random.Random(3)
    whole = [rng.randrange(10 ** rng.randrange(1, 16)) * rng.choice([1, -1]) for _ in range(3000)] + [0, 10 ** 12, 10 ** 15 - 1]
    assert units(spark, *[w / 10000 for w in whole], None) == [*whole, None]
    assert units(spark, 0.1 + 0.2) == [3000]


def test_sums_of_noise_pass(spark):
    assert spark.range(1).select(money_units(F.lit(19.99) * 3).alias("u")).first().u == 599700
