"""Models of higher rank from fits that walk through blocks of factors."""

import pytest
from test_walk import WALK, ratings, same

from affinity.operators import evaluate, rankk


@pytest.mark.parametrize("limits", WALK.values(), ids=WALK)
def test_walked_models_of_higher_rank_are_the_same(spark, workspace, limits):
    df, rows = ratings(spark), evaluate.weighted(ratings(spark, 9, 300))
    plain = rankk.fit(workspace, df, 3, (0.05, 0.2), (1, 2), name="plain_rank")
    walked = rankk.fit(workspace, df, 3, (0.05, 0.2), (1, 2), limits, name=f"walked_rank_{limits.group_rows}")
    for a, b in zip(plain, walked, strict=True):
        same(a.users, b.users)
        same(a.items, b.items)
        same(rankk.equation_gaps(a, df), rankk.equation_gaps(b, df))
    same(rankk.errors(plain, rows), rankk.errors(walked, rows))
