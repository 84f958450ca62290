"""Exact split by time, without a sort.

The oldest share of the rows is for training, the rest for testing. Rows are
ordered by (timestamp, userId, movieId, rating); rows equal in all four are
interchangeable. The k-th row of that order is found from histograms of bounded
size, one column after another, so no task and no driver ever holds a day, a
second or a user as a whole. The two halves are then plain filters on the scan,
plus the copies of the k-th row that belong to each side.

Nulls come first, as in an ascending ``order by``. Where there are any, they stand in for a
value just below the smallest one until the halves are made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ("timestamp", "userId", "movieId", "rating")
OUTPUT = ("userId", "movieId", "rating")

# Bins of a histogram: what each task adds to the shuffle, and what the driver sees.
BINS = 4_096

# Tied rows up to which their different values are listed instead of searched.
FEW = 65_536


@dataclass(frozen=True)
class Boundary:
    """The last training row: its values, its copies, and how many of them train."""

    values: tuple
    copies: int
    train_copies: int


def train_size(rows: int, share: float) -> int:
    return int(rows * share)


def _bin(column: Column, low, high, bins: int) -> Column:
    if isinstance(low, int):
        width = (high - low) // bins + 1
        return F.floor((column.cast("long") - F.lit(low).cast("long")) / F.lit(width))
    return F.floor((column - F.lit(low)) / F.lit((high - low) / bins))


def _without_nulls(ratings: DataFrame) -> tuple[DataFrame, dict]:
    """The ratings with a value below all others in place of nulls, and these values.

    Columns without nulls stay as they are, so that filters on them reach the scan.
    """
    found = ratings.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in ORDER],
        *[F.min(c).alias(c) for c in ORDER],
    ).first()
    below = {
        c: (found[c] - 1 if found[c] is not None else 0) for c in ORDER if found[f"n_{c}"]
    }
    if not below:
        return ratings, below
    kinds = dict(ratings.dtypes)
    wide = {c: "double" if kinds[c] in ("float", "double") else "long" for c in below}
    return ratings.withColumns(
        {
            c: F.coalesce(F.col(c).cast(wide[c]), F.lit(value).cast(wide[c]))
            for c, value in below.items()
        }
    ), below


def _with_nulls(half: DataFrame, below: dict, kinds: dict) -> DataFrame:
    return half.select(
        *[
            F.when(F.col(c) != F.lit(below[c]), F.col(c)).cast(kinds[c]).alias(c)
            if c in below
            else F.col(c)
            for c in OUTPUT
        ]
    )


def _bounds(rows: DataFrame, name: str) -> tuple:
    """(lowest, highest, rows) of a column."""
    return tuple(rows.agg(F.min(name), F.max(name), F.count(F.lit(1))).first())


def _locate(rows: DataFrame, name: str, k: int, bounds: tuple, bins: int) -> tuple:
    """The k-th smallest value of a column, the rows below it and the rows at it.

    Each pass reads the one column and only the range that still matters.
    """
    column = F.col(name)
    low, high, at = bounds
    below = 0
    while low < high:
        histogram = (
            rows.filter(column.between(low, high))
            .groupBy(_bin(column, low, high, bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            .collect()
        )
        for row in sorted(histogram, key=lambda r: r["bin"]):
            if below + row["n"] >= k:
                low, high, at = row["lo"], row["hi"], row["n"]
                break
            below += row["n"]
    return low, below, at


def find_boundary(
    ratings: DataFrame, k: int, bounds: tuple, bins: int = BINS, few: int = FEW
) -> Boundary:
    """The k-th row (from 1) of the total order; ``bounds`` are those of the timestamp."""
    rows, values, at = ratings, (), None
    for i, name in enumerate(ORDER):
        if at is not None and at <= few:
            rest = ORDER[i:]
            groups = rows.groupBy(*rest).agg(F.count(F.lit(1)).alias("n")).collect()
            for group in sorted(groups, key=lambda g: g[:-1]):
                if group["n"] >= k:
                    return Boundary(values + tuple(group[:-1]), group["n"], k)
                k -= group["n"]
        bounds = bounds if i == 0 else _bounds(rows, name)
        value, below, at = _locate(rows, name, k, bounds, bins)
        rows = rows.filter(F.col(name) == F.lit(value))
        values += (value,)
        k -= below
    return Boundary(values, at, k)


def _beyond(values: tuple, before: bool) -> Column:
    """Rows strictly before (or after) ``values`` in the total order."""
    condition = F.lit(False)
    for name, value in reversed(list(zip(ORDER, values))):
        column, value = F.col(name), F.lit(value)
        strict = column < value if before else column > value
        condition = strict | ((column == value) & condition)
    # Implied by the rest; as a plain range on one column it reaches the scan.
    first, value = F.col(ORDER[0]), F.lit(values[0])
    return (first <= value if before else first >= value) & condition


def _copies(ratings: DataFrame, boundary: Boundary, n: int) -> DataFrame:
    kinds = dict(ratings.dtypes)
    values = dict(zip(ORDER, boundary.values))
    return ratings.sparkSession.range(n).select(
        *[F.lit(values[name]).cast(kinds[name]).alias(name) for name in OUTPUT]
    )


def time_split(
    ratings: DataFrame, share: float = 0.6, bins: int = BINS, few: int = FEW
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the oldest ``int(n * share)`` rows and all others."""
    kinds = dict(ratings.dtypes)
    ratings, below = _without_nulls(ratings)
    bounds = _bounds(ratings, ORDER[0])
    k = train_size(bounds[-1], share)
    if k == 0:
        every = _with_nulls(ratings.select(*OUTPUT), below, kinds)
        return every.filter(F.lit(False)), every
    boundary = find_boundary(ratings, k, bounds, bins, few)
    halves = []
    for before, copies in (
        (True, boundary.train_copies),
        (False, boundary.copies - boundary.train_copies),
    ):
        half = ratings.filter(_beyond(boundary.values, before)).select(*OUTPUT)
        half = half.union(_copies(ratings, boundary, copies)) if copies else half
        halves.append(_with_nulls(half, below, kinds) if below else half)
    return halves[0], halves[1]
