"""The stages of a run: ratings, halves, grid, model, lists. Each is written once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from affinity.config import Config
from affinity.operators import evaluate, factor, model, popular, rankk, split
from affinity.workspace import Workspace


class Stages:
    def __init__(
        self,
        workspace: Workspace,
        ratings: DataFrame,
        movies: DataFrame,
        config: Config = Config(),
    ):
        self.workspace, self.config = workspace, config
        self._ratings, self.movies = ratings, movies
        self._halves: tuple[DataFrame, DataFrame] | None = None
        self._fit: factor.GridFit | None = None
        self._model: model.Model | None = None
        self._published: str | None = None
        self.rank2 = None  # a rank-2 model, where one was asked for
        self._ranks: dict[tuple, list[rankk.RankModel]] = {}
        self._rank_best: dict[tuple, rankk.RankModel] = {}

    def ratings(self) -> DataFrame:
        return self.workspace.stage("ratings", lambda: self._ratings)

    def halves(self) -> tuple[DataFrame, DataFrame]:
        """(train, test) as filters on the written ratings."""
        if self._halves is None:
            self._halves = split.time_split(self.ratings(), self.config.train_share)
        return self._halves

    def train(self) -> DataFrame:
        return self.workspace.stage("train", lambda: self.halves()[0])

    def test(self) -> DataFrame:
        return self.workspace.stage("test", lambda: self.halves()[1])

    def known_users(self) -> DataFrame:
        return self.workspace.stage(
            "known_users", lambda: popular.distinct_users(self.train())
        )

    def fit(self) -> factor.GridFit:
        if self._fit is None:
            self._fit = factor.fit_grid(
                self.workspace, self.train(), self.config.lambdas, self.config.iterations
            )
        return self._fit

    def errors(self) -> DataFrame:
        """Hold-out error of every grid point."""
        return self.workspace.stage(
            "errors",
            lambda: evaluate.grid_errors(self.fit(), evaluate.weighted(self.test())),
        )

    def overlap_errors(self) -> DataFrame:
        """The same on pairs that occur in both halves."""
        return evaluate.grid_errors(self.fit(), evaluate.overlap(self.train(), self.test()))

    def model(self) -> model.Model:
        if self._model is None:
            self._model = model.best_model(self.fit(), self.errors())
        return self._model

    def weighted_test(self) -> DataFrame:
        return self.workspace.stage("weighted_test", lambda: evaluate.weighted(self.test()))

    def rank_models(self, rank: int, lambdas: tuple, iterations: tuple) -> list[rankk.RankModel]:
        """Models of any rank, one for every (lambda, iterations)."""
        key = (rank, lambdas, iterations)
        if key not in self._ranks:
            name = f"rank_{rank}_{len(self._ranks)}"
            self._ranks[key] = rankk.fit(self.workspace, self.train(), rank, lambdas, iterations, name=name)
        return self._ranks[key]

    def rank_errors(self, rank: int, lambdas: tuple, iterations: tuple) -> DataFrame:
        models = self.rank_models(rank, lambdas, iterations)
        name = f"rank_errors_{list(self._ranks).index((rank, lambdas, iterations))}"
        return self.workspace.stage(name, lambda: rankk.errors(models, self.weighted_test()))

    def rank_best(self, rank: int, lambdas: tuple, iterations: tuple) -> rankk.RankModel:
        """The one of least hold-out error, saved and read back."""
        key = (rank, lambdas, iterations)
        if key not in self._rank_best:
            chosen = rankk.best_model(self.rank_models(*key), self.rank_errors(*key))
            path = self.workspace.path(f"best_rank_{rank}_{len(self._rank_best)}")
            rankk.save(chosen, path)
            self._rank_best[key] = rankk.load(self.workspace.spark, path)
        return self._rank_best[key]

    def published(self) -> str:
        """Root under which the best model is the current one."""
        if self._published is None:
            root = self.workspace.path("registry")
            model.publish(self.model(), root)
            self._published = root
        return self._published

    def popular(self) -> DataFrame:
        return self.workspace.stage(
            "popular", lambda: popular.popular(self.train(), self.config.list_size)
        )
