"""The time split against a full sort, on data full of ties."""

import random
from collections import Counter

import pytest

from affinity.operators import split
from affinity.schemas import RATINGS


def halves(spark, rows, **kw):
    df = spark.createDataFrame(rows, RATINGS).repartition(3)
    return [[tuple(r) for r in half.collect()] for half in split.time_split(df, **kw)]


def expected(rows, share=0.6):
    ordered = sorted(rows, key=lambda r: (r[3], r[0], r[1], r[2]))
    k = int(len(rows) * share)
    return [Counter(r[:3] for r in part) for part in (ordered[:k], ordered[k:])]


def check(spark, rows, **kw):
    train, test = halves(spark, rows, **kw)
    assert [Counter(train), Counter(test)] == expected(rows, kw.get("share", 0.6))


def test_distinct_times(spark):
    rows = [(i, i, 1.0, 1000 - i) for i in range(11)]
    train, test = halves(spark, rows)
    assert (len(train), len(test)) == (6, 5)
    check(spark, rows)


def test_nulls_come_first(spark):
    rows = [(i, i % 3, 1.0 + i % 2, 50 - i) for i in range(20)]
    rows[3], rows[7], rows[11] = (3, 0, 2.0, None), (7, None, 1.0, 43), (None, 2, None, None)
    train, test = halves(spark, rows)
    key = lambda r: tuple((v is not None, v or 0) for v in (r[3], r[0], r[1], r[2]))
    by_hand = sorted(rows, key=key)
    assert [Counter(train), Counter(test)] == [
        Counter(r[:3] for r in part) for part in (by_hand[:12], by_hand[12:])
    ]


def test_one_timestamp(spark):
    check(spark, [(i % 4, i % 3, (i % 5) / 2, 7) for i in range(10)])


def test_all_rows_equal(spark):
    rows = [(1, 2, 3.0, 4)] * 10
    train, test = halves(spark, rows)
    assert (len(train), len(test)) == (6, 4)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny(spark, n):
    check(spark, [(i, i, 0.5, i) for i in range(n)])


@pytest.mark.parametrize("seed, bins", [(1, 2), (2, 3), (3, 8), (4, split.BINS)])
def test_ties_at_every_level(spark, seed, bins):
    """Few bins force the search through several histograms and all columns."""
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([-5, 1, 2, 2**31 - 1]),
            rng.randrange(4),
            rng.randrange(1, 9) / 2,
            rng.choice([0, 50, 51, 10**9]),
        )
        for _ in range(300)
    ]
    check(spark, rows, bins=bins, few=bins)


def test_a_third_of_all_rows_is_one_row(spark):
    rng = random.Random(9)
    hot = [(7, 7, 4.0, 500)] * 200
    rest = [(rng.randrange(9), rng.randrange(9), 1.5, rng.randrange(1000)) for _ in range(400)]
    for share in (0.4, 0.6):
        check(spark, hot + rest, share=share, bins=4, few=4)


def test_negative_times_and_extremes(spark):
    rows = [(1, 1, 0.5, t) for t in (-(2**31), -1, 0, 1, 2**31 - 1)]
    check(spark, rows, bins=2, few=1)
