"""The model of rank 2 from a fit that walks through blocks of factors."""

from test_walk import WALK, ratings, same

from affinity.operators import evaluate, factor, factor2


def test_a_walked_model_of_rank_2_is_the_same(spark, workspace):
    df, rows, limits = ratings(spark), evaluate.weighted(ratings(spark, 9, 300)), WALK["split"]
    plain, walked = (
        factor2.fit(workspace, df.dropna(), 0.05, 3, own, name=f"two_{own.walk_pairs}_{own.group_rows}")
        for own in (factor.Limits(), limits)
    )
    same(plain.users, walked.users)
    same(plain.items, walked.items)
    same(factor2.error(plain, rows), factor2.error(walked, rows))
